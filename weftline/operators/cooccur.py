"""Co-occurrence: frequencies, pairs, association, thresholds, trend and the bounded graph's tables.

A basket set is (basket, date, nodes) with nodes distinct; baskets of fewer than two nodes take no part anywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.config import Config
from weftline.functions import scalars as S

MIN_TREND_BASKETS = 5


def usable(baskets: DataFrame) -> DataFrame:
    """Baskets with their distinct non-null nodes in order, of which there are at least two."""
    nodes = F.array_sort(F.array_distinct(F.filter("nodes", lambda n: n.isNotNull())))
    return baskets.withColumn("nodes", nodes).where(F.size("nodes") >= 2)


def basket_count(baskets: DataFrame) -> DataFrame:
    """One row, n."""
    return usable(baskets).agg(F.count("*").alias("n"))


def document_frequency(baskets: DataFrame) -> DataFrame:
    return usable(baskets).select(F.explode("nodes").alias("node")).groupBy("node").agg(F.count("*").alias("df"))


def frequent_only(baskets: DataFrame, freq: DataFrame, min_df: int) -> DataFrame:
    """Baskets reduced to nodes that can still pass, before pairs are built; N and df aren't touched by it."""
    keys = [c for c in baskets.columns if c != "nodes"]
    tokens = baskets.withColumn("__row", F.monotonically_increasing_id())
    rows = tokens.select("__row", *keys, F.explode("nodes").alias("node")).join(freq.where(F.col("df") >= min_df).select("node"), "node", "left_semi")
    return rows.groupBy("__row", *keys).agg(F.array_sort(F.collect_list("node")).alias("nodes")).drop("__row").where(F.size("nodes") >= 2)


def pairs_of(nodes) -> F.Column:
    """All pairs of an ordered array, as structs a < b."""
    heads = F.transform(nodes, lambda x, i: F.transform(F.slice(nodes, i + 2, F.greatest(F.size(nodes) - i - 1, F.lit(0))), lambda y: F.struct(x.alias("a"), y.alias("b"))))
    return F.flatten(heads)


def pair_counts(baskets: DataFrame, recent: F.Column | None = None) -> DataFrame:
    """(a, b, cooc) over baskets with ordered nodes; with `recent`, cooc_recent and cooc_base, too. Counts are combined before the shuffle."""
    flag = recent if recent is not None else F.lit(False)
    each = baskets.select(F.explode(pairs_of(F.col("nodes"))).alias("p"), flag.alias("recent")).select("p.a", "p.b", "recent")
    counts = [F.count("*").alias("cooc")]
    if recent is not None:
        counts += [F.count_if("recent").alias("cooc_recent"), F.count_if(~F.col("recent")).alias("cooc_base")]
    return each.groupBy("a", "b").agg(*counts)


def prefilter_stats(baskets: DataFrame) -> DataFrame:
    """(n_baskets, n_nodes, n_edges) before any threshold; this is the one query that needs the unpruned pairs."""
    kept = usable(baskets)
    n_nodes = document_frequency(baskets).agg(F.count("*").alias("n_nodes")).scalar()
    n_edges = pair_counts(kept).agg(F.count("*").alias("n_edges")).scalar()
    return basket_count(baskets).select(F.col("n").alias("n_baskets"), n_nodes.alias("n_nodes"), n_edges.alias("n_edges"))


def edges(baskets: DataFrame, cfg: Config) -> DataFrame:
    """(a, b, cooc, npmi, jaccard): pairs that pass min_cooc, both min_df and the unrounded min_npmi; scores then rounded to 4 places."""
    kept = usable(baskets)
    freq = document_frequency(baskets)
    counted = pair_counts(frequent_only(kept, freq, cfg.min_df)).where(F.col("cooc") >= cfg.min_cooc)
    return score(counted, freq, basket_count(baskets), cfg)


def score(counted: DataFrame, freq: DataFrame, total: DataFrame, cfg: Config) -> DataFrame:
    rest = [c for c in counted.columns if c not in ("a", "b", "cooc")]
    joined = (
        counted.join(freq.select(F.col("node").alias("a"), F.col("df").alias("df_a")), "a")
        .join(freq.select(F.col("node").alias("b"), F.col("df").alias("df_b")), "b")
        .where((F.col("df_a") >= cfg.min_df) & (F.col("df_b") >= cfg.min_df))
        .withColumn("n", total.scalar())
    )
    scored = joined.withColumn("score", S.npmi(F.col("cooc"), F.col("df_a"), F.col("df_b"), F.col("n"))).where(F.col("score") >= cfg.min_npmi)
    return scored.select("a", "b", "cooc", F.round("score", 4).alias("npmi"), F.round(S.jaccard(F.col("cooc"), F.col("df_a"), F.col("df_b")), 4).alias("jaccard"), *rest)


@dataclass(frozen=True)
class Split:
    """A cut between a recent and an older set of baskets."""

    cutoff: str
    n_recent: int
    n_base: int


def trend_split(baskets: DataFrame, cfg: Config) -> Split | None:
    """Where the recent part begins. recent_days counts distinct dates that occur, not calendar days.

    With more dates than that the cut is at the recent_days-th from the end, else at the last date alone. Undated baskets
    are older ones. No trend with fewer than two dates or fewer than five baskets on a side.
    """
    if not cfg.trend_enabled:
        return None
    kept = usable(baskets)
    # ordered by date, recent_days + 1 rows at most
    last = [r[0] for r in kept.select(F.col("date").cast("string").alias("d")).where("d is not null and d <> ''").distinct().orderBy(F.desc("d")).limit(cfg.recent_days + 1).collect()]
    if len(last) < 2:
        return None
    cutoff = last[cfg.recent_days - 1] if len(last) > cfg.recent_days else last[0]
    row = kept.agg(F.count_if(is_recent(cutoff)).alias("r"), F.count_if(~is_recent(cutoff)).alias("b")).first()
    return Split(cutoff, row.r, row.b) if min(row.r, row.b) >= MIN_TREND_BASKETS else None


def is_recent(cutoff: str) -> F.Column:
    return F.coalesce(F.col("date").cast("string") >= cutoff, F.lit(False))


def edges_with_trend(baskets: DataFrame, cfg: Config) -> DataFrame:
    """Edges with npmi_recent, npmi_baseline, surprise and is_new, null where there is no trend.

    Pairs and frequencies of both sides come out of the same two aggregations as the totals.
    """
    split = trend_split(baskets, cfg)
    empty = [F.lit(None).cast("double").alias(c) for c in ("npmi_recent", "npmi_baseline", "surprise")] + [F.lit(None).cast("boolean").alias("is_new")]
    if split is None:
        return edges(baskets, cfg).select("*", *empty)
    recent = is_recent(split.cutoff)
    kept = usable(baskets)
    sided = kept.select(F.explode("nodes").alias("node"), recent.alias("r")).groupBy("node").agg(F.count("*").alias("df"), F.count_if("r").alias("df_r"), F.count_if(~F.col("r")).alias("df_o"))
    counted = pair_counts(frequent_only(kept.select("date", "nodes"), sided, cfg.min_df), recent).where(F.col("cooc") >= cfg.min_cooc)
    scored = score(counted, sided.select("node", "df"), basket_count(baskets), cfg)
    for end in "ab":
        scored = scored.join(sided.select(F.col("node").alias(end), F.col("df_r").alias(f"r_{end}"), F.col("df_o").alias(f"o_{end}")), end)
    side = lambda c, x, n: F.coalesce(S.npmi(F.col(c), F.col(f"{x}_a"), F.col(f"{x}_b"), F.lit(n)), F.lit(0.0))
    scored = scored.withColumn("now", side("cooc_recent", "r", split.n_recent)).withColumn("then", side("cooc_base", "o", split.n_base))
    return scored.select(
        "a", "b", "cooc", "npmi", "jaccard", F.round("now", 4).alias("npmi_recent"), F.round("then", 4).alias("npmi_baseline"),
        F.round(F.col("now") - F.col("then"), 4).alias("surprise"), ((F.col("cooc_base") == 0) & (F.col("cooc_recent") > 0)).alias("is_new"),
    )


def top_edges(scored: DataFrame, limit: int) -> DataFrame:
    """The strongest edges; ties go by count, then by the nodes' order."""
    return scored.orderBy(F.desc("npmi"), F.desc("cooc"), "a", "b").limit(limit)


def endpoints(scored: DataFrame) -> DataFrame:
    """A row for each end of each edge: (node, neighbour, npmi, cooc)."""
    keep = ["npmi", "cooc"]
    return scored.select(F.col("a").alias("node"), F.col("b").alias("neighbour"), *keep).unionByName(scored.select(F.col("b").alias("node"), F.col("a").alias("neighbour"), *keep))


def node_metrics(scored: DataFrame) -> DataFrame:
    """(node, degree, strength), strength to 4 places."""
    return endpoints(scored).groupBy("node").agg(F.count("*").alias("degree"), F.round(F.sum(F.col("npmi").cast("decimal(20,6)")).cast("double"), 4).alias("strength"))


def strongest_subgraph(scored: DataFrame, max_nodes: int) -> DataFrame:
    """Edges between the max_nodes strongest nodes, all edges where there are no more nodes than that."""
    best = node_metrics(scored).orderBy(F.desc("strength"), "node").limit(max_nodes).select("node")
    inside = scored.join(best.withColumnRenamed("node", "a"), "a", "left_semi").join(best.withColumnRenamed("node", "b"), "b", "left_semi")
    return inside.select(*scored.columns)


def neighbours(scored: DataFrame, k: int = 8) -> DataFrame:
    """(node, rank, neighbour, npmi): each node's k strongest neighbours."""
    order = Window.partitionBy("node").orderBy(F.desc("npmi"), F.desc("cooc"), "neighbour")
    return endpoints(scored).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("node", "rank", "neighbour", "npmi")


def graph_nodes(scored: DataFrame, freq: DataFrame, meta: DataFrame) -> DataFrame:
    """Nodes of the graph with label, kind and group; a node without meta is a term named by its id."""
    found = node_metrics(scored).join(freq, "node", "left").join(meta.select(F.col("id").alias("node"), "label", "kind"), "node", "left")
    kind = F.coalesce("kind", F.lit("term"))
    label = F.coalesce("label", F.regexp_replace("node", "^t:", ""))
    return found.select(F.col("node").alias("id"), label.alias("label"), kind.alias("kind"), S.group_of(kind).alias("node_group"), F.coalesce("df", F.lit(0)).alias("df"), "degree", "strength")
