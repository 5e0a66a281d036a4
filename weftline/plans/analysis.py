"""The whole run: articles to baskets to the graph to its outputs."""

from __future__ import annotations

import os
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.config import Config
from weftline.functions import scalars as S
from weftline.operators import browse, cooccur, graph, textproc
from weftline.runtime import cut
from weftline.sinks import export


def bounded_graph(baskets: DataFrame, meta: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) within max_edges and max_nodes, with community, betweenness, position and size."""
    spark = baskets.sparkSession
    scored = cut(cooccur.strongest_subgraph(cut(cooccur.top_edges(cooccur.edges_with_trend(baskets, cfg), cfg.max_edges), "top"), cfg.max_nodes), "edges")
    nodes = cooccur.graph_nodes(scored, cooccur.document_frequency(baskets), meta)
    # both sides are bounded by max_edges and max_nodes
    found = [(r.a, r.b, r.npmi) for r in scored.select("a", "b", "npmi").collect()]
    near = graph.adjacency(found)
    group, between, place = graph.communities(near), graph.betweenness(near, cfg.betweenness_max_nodes), graph.layout(near, cfg.layout_iterations)
    extra = [(v, group[v], between[v], *place[v]) for v in near]
    added = spark.createDataFrame(extra, "id string, community int, betweenness double, x double, y double")
    whole = nodes.join(F.broadcast(added), "id").withColumn("df_max", nodes.agg(F.max("df").alias("df_max")).scalar())
    return cut(whole.withColumn("size", S.node_size(F.col("df"), F.col("df_max"))).drop("df_max"), "nodes"), scored


def node_meta(entities: DataFrame) -> DataFrame:
    return entities.select("id", "label", F.col("etype").alias("kind"))


def analyse(spark: SparkSession, docs: DataFrame, entities: DataFrame, stopwords: set[str], cfg: Config, out: str, tokenize=textproc.morpheme_tokens) -> dict:
    """Writes all outputs into the folder `out` of this machine and returns what the report's head says. Without articles only a report is written."""
    os.makedirs(out, exist_ok=True)
    at = lambda name: str(Path(out) / name)
    meta = {"generated_at": datetime.now(timezone.utc).isoformat(timespec="seconds"), "n_articles": docs.count(), "period": "日付なし", "n_baskets": 0, "n_nodes_before": 0, "n_edges_before": 0}
    if not meta["n_articles"]:
        Path(at("report.md")).write_text(export.report(meta, [], [], [], [], []), encoding="utf-8")
        return meta
    analyser = textproc.make_analyser(entities, stopwords, cfg, tokenize)
    baskets = cut(textproc.build_baskets(docs, analyser, cfg), "baskets")
    stats = cooccur.prefilter_stats(baskets).first()
    meta |= {"n_baskets": stats.n_baskets, "n_nodes_before": stats.n_nodes, "n_edges_before": stats.n_edges}
    nodes, edges = bounded_graph(baskets, node_meta(entities), cfg)
    articles = browse.articles_index(docs, baskets, nodes)
    meta["period"] = browse.period(articles).first().period
    rows = lambda df: [r.asDict(recursive=True) for r in df.collect()]
    node_rows, edge_rows = rows(nodes.orderBy(F.desc("strength"), "id")), rows(edges)
    labels = {n["id"]: n["label"] for n in node_rows}
    listed = [r.asDict(recursive=True) for r in articles.orderBy("pos").toLocalIterator()]
    meta["sources"] = sorted({a["source"] for a in listed if a["source"]})
    export.write_nodes_csv(at("nodes.csv"), node_rows)
    export.write_edges_csv(at("edges.csv"), edge_rows)
    export.write_articles_csv(at("articles.csv"), listed, labels)
    export.write_gexf(at("graph.gexf"), node_rows, edge_rows)
    data = export.payload(node_rows, edge_rows, listed, meta)
    export.write_json(at("graph.json"), data)
    export.write_html(at("graph.html"), data, "語のつながり", export.GRAPH_SCRIPT)
    export.write_html(at("articles.html"), data, "記事一覧", export.LIST_SCRIPT)
    text = export.report(meta, node_rows, edge_rows, rows(browse.entity_neighbourhoods(nodes, edges)), rows(browse.community_members(nodes)), listed)
    Path(at("report.md")).write_text(text, encoding="utf-8")
    return meta
