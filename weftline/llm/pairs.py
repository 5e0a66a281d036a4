"""Items that appear together (problem 7): exact pair counts and NPMI by heavy-light decomposition.

Tokens (basket, item) are hashed to partitions by basket and sorted, and each partition is cut into blocks of
whole baskets. Within a block
- heavy x heavy: the heavy items (the HEAVY most frequent ones) are rows of a bit matrix over the block's baskets,
  and a pair's count is the popcount of the AND of two rows;
- heavy x light: each light item's posting list probes the heavy rows, bit by bit;
- light x light: the pairs of a basket are coded as integers and counted by value inside the block.
Each block gives (pair, count), counts of all blocks are summed and scored. Items under min_df are left out
beforehand, since no pair with one of them can pass; N and df stay those of all baskets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weftline.llm.terms import graph_pairs, term_frequencies
from weftline.runtime import cut

HEAVY = 512  # rows of the bit matrix: memory and time of a block, not the result, depend on it
BLOCK_TOKENS = 1_000_000
CODES = 4_000_000  # light pairs held before they are counted by value
COUNTS = T.StructType([T.StructField("ia", T.LongType()), T.StructField("ib", T.LongType()), T.StructField("cnt", T.LongType())])


def _count_codes(codes: list[np.ndarray], so_far: tuple[np.ndarray, np.ndarray] | None):
    keys, counts = np.unique(np.concatenate(codes), return_counts=True)
    if so_far is None:
        return keys, counts
    keys, counts = np.concatenate([so_far[0], keys]), np.concatenate([so_far[1], counts])
    uniq, where = np.unique(keys, return_inverse=True)
    return uniq, np.bincount(where, counts, len(uniq)).astype(np.int64)


def count_block(basket: np.ndarray, item: np.ndarray, heavy: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs ia < ib of one block with their counts. basket ascends; (basket, item) is distinct; items < heavy are heavy."""
    dense = np.cumsum(np.r_[0, (basket[1:] != basket[:-1]).astype(np.int64)]) if len(basket) else basket
    n = int(dense[-1]) + 1 if len(dense) else 0
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    is_heavy = item < heavy
    rows, row_of = np.unique(item[is_heavy], return_inverse=True)
    bits = np.zeros((len(rows), (n + 63) // 64), np.uint64)
    hb = dense[is_heavy]
    np.bitwise_or.at(bits, (row_of, hb >> 6), np.uint64(1) << (hb & 63).astype(np.uint64))
    for i in range(len(rows) - 1):
        both = np.bitwise_count(bits[i + 1 :] & bits[i]).sum(axis=1, dtype=np.int64)
        hit = np.flatnonzero(both)
        if len(hit):
            out.append((np.full(len(hit), rows[i]), rows[i + 1 + hit], both[hit]))
    lb, li = dense[~is_heavy], item[~is_heavy]
    lights, light_of = np.unique(li, return_inverse=True)
    if len(rows) and len(lights):
        word, bit = lb >> 6, (lb & 63).astype(np.uint64)
        for i in range(len(rows)):
            found = (bits[i][word] >> bit) & np.uint64(1)
            counts = np.bincount(light_of[found.astype(bool)], minlength=len(lights))
            hit = np.flatnonzero(counts)
            if len(hit):
                out.append((np.full(len(hit), rows[i]), lights[hit], counts[hit]))
    if len(li) > 1:
        order = np.lexsort((light_of, lb))
        lb, code = lb[order], light_of[order].astype(np.int64)
        at, step, held, size, total = np.arange(len(lb)), 1, [], 0, None
        while len(at):
            at = at[at + step < len(lb)]
            at = at[lb[at + step] == lb[at]]
            if len(at):
                held.append(code[at] * len(lights) + code[at + step])
                size += len(at)
                if size > CODES:
                    total, held, size = _count_codes(held, total), [], 0
            step += 1
        if held:
            total = _count_codes(held, total)
        if total is not None:
            out.append((lights[total[0] // len(lights)], lights[total[0] % len(lights)], total[1]))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part).astype(np.int64) for part in zip(*out))


def _blocks(heavy: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_b, held_i, size = [], [], 0

        def flush(final: bool):
            b, i = np.concatenate(held_b), np.concatenate(held_i)
            # the last basket may go on in the next batch
            stop = len(b) if final else int(np.searchsorted(b, b[-1]))
            held_b[:], held_i[:] = [b[stop:]], [i[stop:]]
            if not stop:
                return None
            return pa.record_batch([pa.array(x) for x in count_block(b[:stop], i[:stop], heavy)], ["ia", "ib", "cnt"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held_b.append(batch.column(0).to_numpy(zero_copy_only=False))
            held_i.append(batch.column(1).to_numpy(zero_copy_only=False))
            size += batch.num_rows
            if size >= BLOCK_TOKENS:
                if (out := flush(False)) is not None:
                    yield out
                size = len(held_b[0])
        if held_b and (out := flush(True)) is not None:
            yield out

    return run


def count_pairs(pairs: DataFrame, freq: DataFrame, min_df: int, heavy: int = HEAVY) -> tuple[DataFrame, DataFrame]:
    """Counts (ia, ib, cnt) by item number, and the numbered items (node_id, df, iid)."""
    frequent = freq.where(F.col("df") >= min_df).select("node_id", "df")
    top = frequent.orderBy(F.desc("df"), "node_id").limit(heavy)
    # at most `heavy` rows, so one window over all of them and a broadcast are bounded
    top = cut(top.withColumn("iid", (F.row_number().over(Window.orderBy(F.desc("df"), "node_id")) - 1).cast("bigint")), "heavy")
    rest = frequent.join(F.broadcast(top.select("node_id")), "node_id", "left_anti")
    rest = cut(rest.withColumn("iid", F.lit(heavy) + F.monotonically_increasing_id()), "light")
    numbered = pairs.select("bid", "node_id")
    # hot items meet a broadcast table; what is left for the shuffled join has no hot key
    tokens = numbered.join(F.broadcast(top), "node_id").select("bid", "iid")
    tokens = tokens.unionByName(numbered.join(rest, "node_id").select("bid", "iid"))
    ordered = tokens.repartition("bid").sortWithinPartitions("bid")
    partial = ordered.mapInArrow(_blocks(heavy), COUNTS)
    return partial.groupBy("ia", "ib").agg(F.sum("cnt").alias("cnt")), top.unionByName(rest)


def associated_pairs(baskets: DataFrame, min_df: int = 4, min_cooc: int = 3, min_npmi: float = 0.25) -> DataFrame:
    """(a, b, cooc, npmi) with a < b for the pairs that pass all thresholds; NPMI is unrounded, lift beside it.

    Ids, baskets, N and df are those of term counting; an empty table gives no rows, null and repeated elements
    and repeated rows don't count twice.
    """
    pairs, n = graph_pairs(baskets)
    freq = cut(term_frequencies(pairs), "freq")
    counts, items = count_pairs(pairs, freq, min_df)
    a = items.select(F.col("iid").alias("ia"), F.col("node_id").alias("na"), F.col("df").alias("da"))
    b = items.select(F.col("iid").alias("ib"), F.col("node_id").alias("nb"), F.col("df").alias("db"))
    scored = counts.where(F.col("cnt") >= min_cooc).join(a, "ia").join(b, "ib")
    total = F.lit(float(max(n, 1)))
    p_ab, p_a, p_b = F.col("cnt") / total, F.col("da") / total, F.col("db") / total
    npmi = F.when(F.col("cnt") == n, 1.0).otherwise(F.log(p_ab / (p_a * p_b)) / -F.log(p_ab))
    scored = scored.select(
        F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"), F.col("cnt").alias("cooc"),
        npmi.alias("npmi"), (p_ab / (p_a * p_b)).alias("lift"),
    )
    return scored.where(F.col("npmi") >= min_npmi)
