"""Frequency of every distinct term (problem 1) over baskets of node ids.

Method: a range-partitioned external sort of (term, record) pairs and a run-length scan over each sorted
partition. The range key is the pair, not the term, so a term that a third of all records hold is spread over
many partitions; a (term, record) pair lies in one partition only, so record counts of a term's runs add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import fold_id
from weftline.runtime import cut

RUNS = "node_id string, occurrences bigint, df bigint"


PAIRS = "doc_id string, unit int, node_id string, occ bigint"


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, unit, node_id, occ) of rows (doc_id, unit, nodes), added up within each batch; each spelling is folded once a batch."""
    for batch in batches:
        doc_id, unit, nodes = batch.columns
        row = pc.list_parent_indices(nodes)
        coded = pc.list_flatten(nodes).dictionary_encode()
        ids = pa.array([fold_id(v) or None for v in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)
        table = pa.table([doc_id.take(row), unit.take(row), ids], ["doc_id", "unit", "node_id"]).filter(pc.is_valid(ids))
        summed = table.group_by(["doc_id", "unit", "node_id"]).aggregate([([], "count_all")]).select(["doc_id", "unit", "node_id", "count_all"])
        yield from summed.rename_columns(["doc_id", "unit", "node_id", "occ"]).combine_chunks().to_batches()


def basket_pairs(baskets: DataFrame) -> DataFrame:
    """Distinct (doc_id, unit, node_id) with occ, how often the node stands in the basket's rows.

    Node ids are folded (NFKC, trimmed, lower case). Null arrays and elements and ids that fold to nothing give
    no row. Null doc_id or unit is a key of its own, as in SQL's DISTINCT. Further columns are ignored. Counts are
    added up before the shuffle, so a basket repeated any number of times is one row a batch; the rows of a basket come
    to one partition, which the steps after it use.
    """
    folded = baskets.select("doc_id", F.col("unit").cast("int").alias("unit"), "nodes").where("nodes is not null").mapInArrow(_folded, PAIRS)
    return folded.repartition("doc_id", "unit").groupBy("doc_id", "unit", "node_id").agg(F.sum("occ").alias("occ"))


def graph_pairs(baskets: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, unit, node_id, occ, bid) of the baskets with at least two distinct nodes, as a written table, and their number N.

    bid is a number of the basket, fixed by being written. A basket's distinct nodes are what one task holds at a time.
    """
    own = Window.partitionBy("doc_id", "unit")
    numbered = basket_pairs(baskets).withColumn("row", F.monotonically_increasing_id())
    numbered = numbered.withColumn("bid", F.min("row").over(own)).withColumn("n_nodes", F.count("*").over(own))
    kept = cut(numbered.where("n_nodes > 1").withColumn("is_first", F.col("row") == F.col("bid")).drop("row", "n_nodes"), "pairs")
    return kept.drop("is_first"), kept.where("is_first").count()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Run lengths of a sorted stream: a run that reaches a batch's end is carried into the next batch."""
    open_term, open_occ, open_df = None, 0, 0
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        terms, docs, units, occ = (batch.column(i) for i in range(4))
        n = batch.num_rows
        starts = [0]
        if n > 1:
            change = pc.not_equal(terms.slice(1), terms.slice(0, n - 1))
            starts += [i + 1 for i in pc.indices_nonzero(change).to_pylist()]
        ends = starts[1:] + [n]
        out_t, out_o, out_d = [], [], []
        for start, end in zip(starts, ends):
            term = terms[start].as_py()
            d, u = docs.slice(start, end - start), units.slice(start, end - start)
            size = end - start
            distinct = size
            if size > 1:
                repeat = pc.and_(
                    _same(d.slice(1), d.slice(0, size - 1)), _same(u.slice(1), u.slice(0, size - 1))
                )
                distinct -= pc.sum(repeat).as_py() or 0
            if last == (term, d[0].as_py(), u[0].as_py()):
                distinct -= 1
            total = pc.sum(occ.slice(start, size)).as_py()
            if term == open_term:
                open_occ, open_df = open_occ + total, open_df + distinct
            else:
                if open_term is not None:
                    out_t.append(open_term), out_o.append(open_occ), out_d.append(open_df)
                open_term, open_occ, open_df = term, total, distinct
            last = (term, d[size - 1].as_py(), u[size - 1].as_py())
        yield _runs(out_t, out_o, out_d)
    if open_term is not None:
        yield _runs([open_term], [open_occ], [open_df])


def _same(x: pa.Array, y: pa.Array) -> pa.Array:
    both_null = pc.and_(pc.is_null(x), pc.is_null(y))
    return pc.or_(both_null, pc.fill_null(pc.equal(x, y), False))


def _runs(terms: list, occ: list, df: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(terms, pa.string()), pa.array(occ, pa.int64()), pa.array(df, pa.int64())], ["node_id", "occurrences", "df"])


def term_frequencies(pairs: DataFrame) -> DataFrame:
    """(node_id, occurrences, df) of pairs (doc_id, unit, node_id, occ); an empty input gives no rows.

    Repeated (term, record) rows count once in df and each in occurrences.
    """
    keys = ["node_id", "doc_id", "unit"]
    ordered = pairs.select(*keys, "occ").repartitionByRange(*keys).sortWithinPartitions(*keys)
    runs = ordered.mapInArrow(_scan, RUNS)
    return runs.groupBy("node_id").agg(F.sum("occurrences").alias("occurrences"), F.sum("df").alias("df"))


def node_frequencies(baskets: DataFrame, min_df: int = 4, max_share: float = 0.05) -> DataFrame:
    """(node_id, occurrences, df, n_baskets, mark); mark is rare (df < min_df), common (df > max_share N) or null.

    Only nodes in baskets of at least two distinct nodes count; both marks can't hold where N >= 80 at the
    defaults, below that rare goes first.
    """
    pairs, n = graph_pairs(baskets)
    counted = term_frequencies(pairs)
    mark = F.when(F.col("df") < min_df, "rare").when(F.col("df") > F.lit(max_share) * F.lit(n), "common")
    return counted.select("node_id", "occurrences", "df", F.lit(n).cast("bigint").alias("n_baskets"), mark.alias("mark"))
