"""Queries over a finished graph and its articles: filters, search, facets, rankings, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions import scalars as S
from weftline.operators.cooccur import endpoints, neighbours


def articles_index(docs: DataFrame, baskets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(pos, doc_id, title, date, source, url, tier, n_units, snippet, nodes): articles from new to old, undated last.

    nodes are those of the article's baskets that stand in the graph; n_units counts its baskets. Nodes meet per article
    by a distinct count over (doc, node) rows, so a document of any number of units is combined before the shuffle.
    """
    graph = nodes.select(F.col("id").alias("node")).distinct()
    used = baskets.select("doc_id", F.explode("nodes").alias("node")).distinct().join(graph, "node", "left_semi")
    own = used.groupBy("doc_id").agg(F.array_sort(F.collect_list("node")).alias("nodes"))
    sizes = baskets.groupBy("doc_id").agg(F.count("*").alias("n_units"))
    rows = docs.join(sizes, "doc_id", "left").join(own, "doc_id", "left")
    rows = rows.select(
        "doc_id", "title", F.coalesce("date", F.lit("")).alias("date"), "source", "url", "tier", F.coalesce("n_units", F.lit(0)).alias("n_units"),
        S.snippet(F.col("title"), F.col("body")).alias("snippet"), F.coalesce("nodes", F.array().cast("array<string>")).alias("nodes"),
    )
    return numbered(rows, [F.desc("date"), F.desc("title"), F.asc("doc_id")])


def numbered(rows: DataFrame, order: list[Column], name: str = "pos") -> DataFrame:
    """Rows with their place in a total order, from 0. A range sort numbers partitions apart and adds their offsets, so no task holds all rows."""
    ordered = rows.orderBy(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    from weftline.runtime import cut

    ordered = cut(ordered, "ordered")
    sizes = ordered.groupBy("__part").agg(F.count("*").alias("__n"))
    # a row a partition
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy("__at")) - 1
    out = ordered.join(F.broadcast(before.select("__part", "__before")), "__part").withColumn(name, (inside + F.col("__before")).cast("bigint"))
    return out.select(name, *rows.columns)


def inverted_index(articles: DataFrame) -> DataFrame:
    """(node, positions): where each node's articles stand in the list."""
    return articles.select(F.explode("nodes").alias("node"), "pos").groupBy("node").agg(F.array_sort(F.collect_list("pos")).alias("positions"))


def visible_subgraph(edges: DataFrame, nodes: DataFrame, min_npmi: float, groups: list[str]) -> tuple[DataFrame, DataFrame]:
    """Edges of at least min_npmi between visible nodes, and their ends. Terms always show, other groups when asked for."""
    shown = nodes.where(F.col("node_group").isin("term", *groups)).select("id")
    seen = edges.where(F.col("npmi") >= min_npmi).join(shown.withColumnRenamed("id", "a"), "a", "left_semi").join(shown.withColumnRenamed("id", "b"), "b", "left_semi").select(*edges.columns)
    ends = seen.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return seen, nodes.join(ends, "id", "left_semi")


def label_search(nodes: DataFrame, text: str) -> DataFrame:
    return nodes.where(F.contains("label", F.lit(text)))


def cluster_summary(nodes: DataFrame, least: int = 4, top: int = 3) -> DataFrame:
    """(community, size, x, y, labels) of communities of at least `least` members, with their strongest labels."""
    rank = Window.partitionBy("community").orderBy(F.desc("strength"), "label")
    heads = nodes.withColumn("nth", F.row_number().over(rank)).where(F.col("nth") <= top).groupBy("community").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "label"))), lambda s: s.label).alias("labels"))
    sizes = nodes.groupBy("community").agg(F.count("*").alias("size"), F.round(F.avg("x"), 2).alias("x"), F.round(F.avg("y"), 2).alias("y")).where(F.col("size") >= least)
    return sizes.join(heads, "community")


def neighbour_table(edges: DataFrame, node: str, min_npmi: float, k: int = 20) -> DataFrame:
    rows = endpoints(edges.where(F.col("npmi") >= min_npmi)).where(F.col("node") == node)
    return rows.orderBy(F.desc("npmi"), F.desc("cooc"), "neighbour").limit(k).select("neighbour", "npmi", "cooc")


def node_articles(articles: DataFrame, node: str, k: int = 8) -> tuple[DataFrame, DataFrame]:
    """The first k articles of a node, and one row with their whole number."""
    hits = articles.where(F.array_contains("nodes", node))
    return hits.orderBy("pos").limit(k), hits.agg(F.count("*").alias("total"))


def strongest_pairs(edges: DataFrame, k: int = 40) -> DataFrame:
    return edges.orderBy(F.desc("npmi"), F.desc("cooc"), "a", "b").limit(k)


def label_priority(nodes: DataFrame, top: int = 60) -> DataFrame:
    """Nodes whose labels show: all that aren't terms, and the `top` strongest; entities first, then by strength."""
    best = nodes.orderBy(F.desc("strength"), "id").limit(top).select("id")
    chosen = nodes.where("node_group <> 'term'").select("id").unionByName(best).distinct()
    return nodes.join(chosen, "id", "left_semi").orderBy(F.col("node_group") == "term", F.desc("strength"), "id")


def haystack(labels: Column | None = None) -> Column:
    parts = [F.col("title"), F.col("snippet"), F.col("source")] + ([F.array_join(labels, " ")] if labels is not None else [])
    return F.lower(F.concat_ws(" ", *parts))


def article_search(articles: DataFrame, node: str | None = None, source: str | None = None, days: int | None = None, text: str | None = None, labels: Column | None = None) -> DataFrame:
    """Articles that meet all given predicates. days counts back from the latest date there is; undated articles then don't show."""
    rows = articles
    if node is not None:
        rows = rows.where(F.array_contains("nodes", node))
    if source is not None:
        rows = rows.where(F.col("source") == source)
    if days is not None:
        latest = articles.agg(F.max(F.nullif("date", F.lit(""))).alias("latest"))
        oldest = F.date_format(F.date_sub(F.try_to_date(F.col("latest"), "yyyy-MM-dd"), days), "yyyy-MM-dd")
        rows = rows.withColumn("latest", latest.scalar()).where((F.col("date") != "") & (F.col("date") >= oldest)).drop("latest")
    if text:
        rows = rows.where(F.contains(haystack(labels), F.lit(text.lower())))
    return rows


def article_order(mode: str) -> list[Column]:
    """new is the list's own order, old its reverse, nodes the most nodes first."""
    return {"new": [F.asc("pos")], "old": [F.desc("pos")], "nodes": [F.desc(F.size("nodes")), F.asc("pos")]}[mode]


def page(rows: DataFrame, mode: str = "new", number: int = 0, first: int = 60, more: int = 120) -> DataFrame:
    """Page 0 has `first` rows, each later one `more`."""
    ordered = rows.orderBy(*article_order(mode))
    return ordered.limit(first) if number == 0 else ordered.offset(first + (number - 1) * more).limit(more)


def source_facet(articles: DataFrame) -> DataFrame:
    named = articles.where(F.coalesce("source", F.lit("")) != "")
    return named.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")


def chips(articles: DataFrame, nodes: DataFrame, k: int = 8) -> DataFrame:
    """(pos, labels, more): the labels of each article's nodes, entities first and then by df; `more` counts those beyond k."""
    info = nodes.select(F.col("id").alias("node"), "label", (F.col("node_group") == "term").alias("plain"), "df")
    rows = articles.select("pos", F.explode("nodes").alias("node")).join(info, "node")
    order = Window.partitionBy("pos").orderBy("plain", F.desc("df"), "node")
    ranked = rows.withColumn("nth", F.row_number().over(order))
    return ranked.groupBy("pos").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("nth") <= k, F.struct("nth", "label")))), lambda s: s.label).alias("labels"),
        F.greatest(F.count("*") - k, F.lit(0)).alias("more"),
    )


def latest_date(articles: DataFrame) -> DataFrame:
    return articles.agg(F.max(F.nullif("date", F.lit(""))).alias("latest"))


def period(articles: DataFrame) -> DataFrame:
    """One row: from〜to over the dates there are."""
    day = F.nullif("date", F.lit(""))
    return articles.agg(F.coalesce(F.concat(F.min(day), F.lit("〜"), F.max(day)), F.lit("日付なし")).alias("period"))


def entity_neighbourhoods(nodes: DataFrame, edges: DataFrame, top: int = 20, k: int = 8) -> DataFrame:
    """(id, label, strength, near): the strongest facilities and policies, each with its k strongest neighbours."""
    best = nodes.where(F.col("node_group").isin("facility", "policy")).orderBy(F.desc("strength"), "id").limit(top)
    near = neighbours(edges, k).join(nodes.select(F.col("id").alias("neighbour"), F.col("label").alias("name")), "neighbour")
    listed = near.groupBy("node").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "name"))), lambda s: s["name"]).alias("near"))
    return best.join(listed.withColumnRenamed("node", "id"), "id", "left").select("id", "label", "strength", "near")


def community_members(nodes: DataFrame, top: int = 10, k: int = 12) -> DataFrame:
    """(community, size, labels): the largest communities with their strongest members."""
    rank = Window.partitionBy("community").orderBy(F.desc("strength"), F.desc("label"))
    heads = nodes.withColumn("nth", F.row_number().over(rank)).where(F.col("nth") <= k).groupBy("community").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "label"))), lambda s: s.label).alias("labels"))
    sizes = nodes.groupBy("community").agg(F.count("*").alias("size")).orderBy(F.desc("size"), "community").limit(top)
    return sizes.join(heads, "community").orderBy(F.desc("size"), "community")


def top_nodes(nodes: DataFrame, k: int = 30) -> DataFrame:
    """The nodes in most baskets, with their place."""
    best = nodes.orderBy(F.desc("df"), "id").limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("df"), "id")))


def surprise_ranking(edges: DataFrame, k: int = 20) -> DataFrame:
    """The pairs that gained most, with their place."""
    order = [F.desc("surprise"), F.col("a"), F.col("b")]
    best = edges.where("surprise is not null").orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def node_articles(articles: DataFrame, node: str) -> DataFrame:
    """Articles that hold a node, in the order of the list."""
    return articles.where(F.array_contains("nodes", node)).select("pos", "doc_id", "date", "title")
