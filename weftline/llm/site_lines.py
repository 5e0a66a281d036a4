"""Lines repeated across one source's documents (problem 6), by suffix arrays over line identifiers.

Every line with letters is a 16-byte identifier of its letters; a source's identifiers in order are its text, and a
suffix begins at each of its lines. Suffixes are ranked by prefix doubling: two suffixes have one rank at length n if
their next n lines agree, and the rank at n + m is the pair of the rank at n and that of the suffix n lines on at m. So
suffixes of one rank are a run of the suffix array with a common prefix of n lines: the occurrences of one block. Only
ranks that stand in enough documents go on, doubling upwards until none is left and then halving downwards, which
gives the longest repeated block at each line, whatever its length. Blocks that no longer one covers are deleted.

Documents of a rank are counted by rank and document first, so neither a source nor a line is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import letters_only
from weftline.runtime import cut

LINES = "source string, doc_id string, at int, line_no int, key binary"
BROADCAST_ROWS = 100_000  # frequent ranks that are sent to every executor, at most; more are joined by a shuffle


def distinct_docs(docs: DataFrame) -> DataFrame:
    """(doc_id, source, body) of each doc_id that has a source; of repeated rows the first by path, then body."""
    kept = docs.where("doc_id is not null and source is not null").select("doc_id", "source", "body", "path")
    order = F.struct(F.col("path").isNull(), "path", F.col("body").isNull(), F.xxhash64("body"), "source")
    one = kept.groupBy("doc_id").agg(F.min_by(F.struct("source", "body"), order).alias("d"))
    return one.select("doc_id", "d.source", "d.body")


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids: dict[str, bytes] = {}
    for batch in batches:
        rows: tuple[list, ...] = ([], [], [], [], [])
        for source, doc_id, body in zip(*(c.to_pylist() for c in batch.columns)):
            at = 0
            for number, line in enumerate(body.split("\n"), 1):
                key = ids.get(line)
                if key is None:
                    letters = letters_only(line)
                    key = ids[line] = xxhash.xxh3_128_digest(letters) if letters else b""
                    if len(ids) > 100_000:
                        ids.clear()
                if key:
                    for part, value in zip(rows, (source, doc_id, at, number, key)):
                        part.append(value)
                    at += 1
            if len(rows[0]) > 50_000:
                yield _batch(rows)
                rows = ([], [], [], [], [])
        yield _batch(rows)


def _batch(rows: tuple[list, ...]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
    return pa.record_batch([pa.array(r, k) for r, k in zip(rows, kinds)], ["source", "doc_id", "at", "line_no", "key"])


def line_keys(one: DataFrame) -> DataFrame:
    """(source, doc_id, at, line_no, key) of every line with letters; at counts these lines within the document."""
    return one.where("body is not null").select("source", "doc_id", "body").mapInArrow(_lines, LINES)


def _frequent(ranked: DataFrame, sizes: DataFrame, min_docs: int, min_share: float, label: str) -> DataFrame | None:
    """Of (source, doc_id, at, rank) those whose rank stands in enough documents, with docs; None if there are none."""
    held = ranked.groupBy("source", "rank", "doc_id").agg(F.lit(1).alias("one")).groupBy("source", "rank").agg(F.count("*").alias("docs"))
    enough = cut(held.where(F.col("docs") >= min_docs).join(sizes, "source").where(F.col("docs") >= F.lit(min_share) * F.col("source_docs")).select("source", "rank", "docs"), "ranks")
    n = enough.count()
    if not n:
        return None
    return cut(ranked.join(F.broadcast(enough) if n <= BROADCAST_ROWS else enough, ["source", "rank"]), label)


def repeated_blocks(one: DataFrame, keys: DataFrame, min_docs: int = 3, min_share: float = 0.15) -> DataFrame:
    """(source, doc_id, at, n_lines, rank, docs): the longest block in enough documents at each line that begins one.

    Blocks that a block beginning a line earlier covers are left out. docs: the source's documents that hold the block.
    """
    spark = one.sparkSession
    sizes = cut(one.groupBy("source").agg(F.count("*").alias("source_docs")), "sizes")
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    pair = lambda x, y: F.unhex(F.md5(F.concat(x, y)))

    def joined(left: DataFrame, right: DataFrame, by: int | None) -> DataFrame:
        """Blocks of left, each followed by the block of right that begins where it ends."""
        at = F.col("at") + (F.lit(by) if by is not None else F.col("n_lines"))
        then = right.select("doc_id", F.col("at").alias("then_at"), F.col("rank").alias("then_rank"))
        return left.withColumn("then_at", at.cast("int")).join(then, ["doc_id", "then_at"])

    levels = []
    level = _frequent(keys.select("source", "doc_id", "at", F.col("key").alias("rank")), sizes, min_docs, min_share, "level")
    while level is not None:
        levels.append(level)
        twice = joined(level, level, 1 << (len(levels) - 1)).select("source", "doc_id", "at", pair("rank", "then_rank").alias("rank"))
        level = _frequent(twice, sizes, min_docs, min_share, "level")
    if not levels:
        return spark.createDataFrame([], "source string, doc_id string, at int, n_lines int, rank binary, docs bigint")
    # at each line the longest power of two, then what of the lesser powers it can be followed by
    state = None
    for k, level in enumerate(levels):
        rows = level.withColumn("n_lines", F.lit(1 << k)).withColumn("real", F.lit(True))
        if k + 1 < len(levels):
            longer = levels[k + 1].select("doc_id", "at", F.lit(True).alias("grows"))
            rows = _remaining(cut(rows.join(longer, ["doc_id", "at"], "left").withColumn("grows", F.coalesce("grows", F.lit(False))), "blocks"))
        state = rows if state is None else state.unionByName(rows)
    state = cut(state, "blocks")
    for k in range(len(levels) - 2, -1, -1):
        tried = joined(state.where(F.col("n_lines") >= 1 << (k + 1)), levels[k], None)
        # the number of lines goes into the rank, so ranks of all lengths are counted together
        named = F.concat(F.col("n_lines").cast("string").cast("binary"), pair("rank", "then_rank"))
        found = _frequent(tried.select("source", "doc_id", "at", "n_lines", named.alias("rank")), sizes, min_docs, min_share, "level")
        if found is not None:
            longer = found.select("doc_id", "at", "n_lines", F.col("rank").alias("new_rank"), F.col("docs").alias("new_docs"))
            met = cut(state.join(longer, ["doc_id", "at", "n_lines"], "left").withColumn("grows", F.col("new_rank").isNotNull()), "blocks")
            grown = met.where("grows").select("source", "doc_id", "at", (F.col("n_lines") + (1 << k)).alias("n_lines"), F.col("new_rank").alias("rank"), F.col("new_docs").alias("docs"), "real")
            state = cut(grown.unionByName(_remaining(met).select(grown.columns)), "blocks")
    best = state.where("real").drop("real")
    ends = F.col("at") + F.col("n_lines")
    # within one document
    before = Window.partitionBy("doc_id").orderBy("at")
    return best.withColumn("last_end", F.lag(ends).over(before)).where(F.col("last_end").isNull() | (F.col("last_end") < ends)).drop("last_end")


def _remaining(rows: DataFrame) -> DataFrame:
    """Rows that don't grow, and beside them those that do, as counted only (not real), where both have one rank.

    So whatever is counted later, all documents of a rank take part in it.
    """
    stay = rows.where("not grows")
    shadows = rows.where("grows").join(stay.select("source", "rank").distinct(), ["source", "rank"], "left_semi").withColumn("real", F.lit(False))
    return stay.unionByName(shadows).drop("grows")


def repeated_lines(docs: DataFrame, min_docs: int = 3, min_share: float = 0.15) -> DataFrame:
    """(doc_id, line_no) of each line inside a repeated block.

    Null and empty bodies count as documents without lines; lines without letters are never found; a line twice in
    one document counts once; docs without source or doc_id take no part.
    """
    one = cut(distinct_docs(docs), "docs")
    keys = cut(line_keys(one), "lines")
    blocks = repeated_blocks(one, keys, min_docs, min_share)
    inside = blocks.select("doc_id", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n_lines") - 1)).alias("at")).distinct()
    return keys.join(inside, ["doc_id", "at"], "left_semi").select("doc_id", "line_no")


def block_sizes(docs: DataFrame, min_docs: int = 3, min_share: float = 0.15) -> DataFrame:
    """(source, n_lines, docs, blocks, occurrences): how many different blocks of a length stand in so many documents, and how often they are deleted."""
    one = cut(distinct_docs(docs), "docs")
    blocks = repeated_blocks(one, cut(line_keys(one), "lines"), min_docs, min_share)
    each = blocks.groupBy("source", "n_lines", "rank").agg(F.first("docs").alias("docs"), F.count("*").alias("n"))
    return each.groupBy("source", "n_lines", "docs").agg(F.count("*").alias("blocks"), F.sum("n").alias("occurrences"))


def without_repeated_lines(docs: DataFrame, min_docs: int = 3, min_share: float = 0.15) -> DataFrame:
    """(doc_id, source, body, n_removed): each document with a source, without its repeated lines."""
    found = repeated_lines(docs, min_docs, min_share).groupBy("doc_id").agg(F.collect_set("line_no").alias("gone"))
    one = distinct_docs(docs).join(found, "doc_id", "left")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    lines = F.filter(F.split("body", "\n", -1), lambda _, i: ~F.array_contains(gone, i + 1))
    return one.select("doc_id", "source", F.array_join(lines, "\n").alias("body"), F.size(gone).alias("n_removed"))
