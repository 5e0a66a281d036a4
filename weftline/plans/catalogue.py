"""The core's queries by name, and the SQL that gives the same rows.

Every query runs over its whole tables; a limit stands only where it is the feature (a ranking, a page, a capped graph).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.config import Config
from weftline.functions import scalars as S
from weftline.operators import browse, collect, cooccur, textproc, timestamps
from weftline.plans import analysis
from weftline.runtime import cut, table
from weftline.sources import feeds
from weftline.sources.articles import distinct_bodies

CFG = Config(min_df=4, min_cooc=3, min_npmi=0.25)
TODAY = date(2026, 8, 31)


def _baskets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "baskets").select("doc_id", "unit", "date", "nodes")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    """Each doc_id once, the first by path."""
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("path"))
    return table(spark, d, "docs").withColumn("nth", nth).where("nth = 1").drop("nth")


def _items(spark: SparkSession, d: str) -> DataFrame:
    """Feed items with their day as F2 reads it and their order over all sources."""
    items = table(spark, d, "feed_items")
    seq = F.col("batch_id").cast("bigint") * 1_000_000_000 + F.col("item_id")
    return items.withColumn("published", F.coalesce(S.normalize_date(F.col("published")), F.lit(""))).withColumn("seq", seq)


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return cut(cooccur.edges(_baskets(spark, d), CFG), "edges")


def _graph_nodes(spark: SparkSession, d: str, scored: DataFrame) -> DataFrame:
    return cooccur.graph_nodes(scored, cooccur.document_frequency(_baskets(spark, d)), analysis.node_meta(table(spark, d, "entities")))


def _articles(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "nodes").select("id")
    return browse.articles_index(_docs(spark, d), table(spark, d, "baskets").where("nodes is not null").select("doc_id", "nodes"), nodes)


# --- scans, scalars, filters --------------------------------------------------------------------------------------
def p3_found(spark, d):
    return timestamps.normalised_times(table(spark, d, "docs"), table(spark, d, "feed_items"), table(spark, d, "feed_sources"))


def dedup_exact_body(spark, d):
    return distinct_bodies(table(spark, d, "docs").where("body is not null").withColumn("idx", F.col("doc_id"))).select("doc_id", "path")


def sentence_units(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(S.sentences(F.col("text"))).alias("unit", "text"))


def paragraph_units(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(S.units(F.col("text"), "paragraph")).alias("unit", "text"))


def content_lines(spark, d):
    return _docs(spark, d).select("doc_id", F.posexplode(S.content_lines(F.col("body"))).alias("line_no", "line"))


def clean_bodies(spark, d):
    return _docs(spark, d).where("body is not null").select("doc_id", collect.clean_body(F.col("body")).alias("body"))


def shared_template_lines(spark, d):
    pages = _docs(spark, d).where("source is not null").select(F.col("source").alias("batch"), F.col("doc_id").alias("page"), "body")
    return collect.template_lines(pages)


def analysis_text(spark, d):
    return _docs(spark, d).where("body is not null").select("doc_id", S.analysis_text(F.col("title"), F.col("body")).alias("text"))


def title_keys(spark, d):
    return table(spark, d, "feed_items").select("item_id", S.title_key(F.col("title")).alias("title_key"))


def title_key_dedup(spark, d):
    history = spark.createDataFrame([], "doc_id string")
    return collect.new_items(_items(spark, d), history).select("item_id")


def history_anti_join(spark, d):
    stored = _docs(spark, d).where("url is not null").select(S.item_id(F.col("url")).alias("doc_id")).distinct()
    return table(spark, d, "feed_items").join(stored, "doc_id", "left_anti").select("item_id")


def canonical_urls(spark, d):
    return table(spark, d, "feed_items").select("item_id", S.canonical_url_udf("url").alias("url"))


def doc_hash_ids(spark, d):
    docs = table(spark, d, "docs")
    return docs.select("path", S.item_id(F.col("url")).alias("item_id"), S.doc_id(F.col("url"), F.col("path"), F.lit(0), F.col("title")).alias("doc_id"))


def normalize_dates(spark, d):
    raw = table(spark, d, "feed_items").select("item_id", "published")
    return raw.select("item_id", S.normalize_date(F.col("published")).alias("day"))


def age_filter(spark, d):
    src = table(spark, d, "feed_sources").select(F.col("id").alias("source_id"), "max_age_days")
    rows = _items(spark, d).join(src, "source_id")
    return rows.where(collect.young_enough(F.col("published"), F.col("max_age_days"), TODAY)).select("item_id")


def title_pattern_filter(spark, d):
    rows = table(spark, d, "feed_items").withColumn("title_pattern", F.lit("博物館|[Mm]useum"))
    return rows.where(collect.title_matches(F.col("title_pattern"))).select("item_id")


def max_items_per_source(spark, d):
    src = table(spark, d, "feed_sources").select(F.col("id").alias("source_id"), "max_items")
    rows = table(spark, d, "feed_items").join(src, "source_id")
    return collect.capped(rows, F.col("max_items"), order=("batch_id", "pos", "item_id")).select("item_id")


def source_run_metrics(spark, d):
    items = _items(spark, d).select("source_id", F.col("item_id").alias("pos"), "title", "published")
    rows = collect.run_metrics(items, table(spark, d, "feed_sources"), TODAY)
    return rows.withColumn("samples", F.array_join("samples", " / "))


def stored_articles(spark, d):
    return collect.stored_form(_items(spark, d), table(spark, d, "feed_sources"), TODAY).select("yyyy", "mm", "file", "content")


def useful_summaries(spark, d):
    return table(spark, d, "feed_items").select("item_id", S.useful_summary(F.col("summary"), F.col("title")).alias("summary"))


def publisher_split(spark, d):
    title, publisher = S.split_publisher(F.col("title"), F.col("publisher"))
    return table(spark, d, "feed_items").select("item_id", title.alias("title"), publisher.alias("publisher"))


def snippets(spark, d):
    return _docs(spark, d).where("body is not null").select("doc_id", S.snippet(F.col("title"), F.col("body")).alias("snippet"))


def escaped_titles(spark, d):
    return _docs(spark, d).select("doc_id", S.escape_html(F.col("title")).alias("html"), S.yaml_scalar(F.col("title")).alias("yaml"))


def collect_events_daily(spark, d):
    rows = table(spark, d, "feed_items")
    return rows.groupBy(F.window("collected_at", "1 day"), "source_id").agg(F.count("*").alias("n")).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "source_id", "n")


# --- co-occurrence ------------------------------------------------------------------------------------------------
def term_df(spark, d):
    return cooccur.document_frequency(_baskets(spark, d))


def pair_counts(spark, d):
    return cooccur.pair_counts(cooccur.usable(_baskets(spark, d)))


def npmi_edges(spark, d):
    return cooccur.edges(_baskets(spark, d), CFG)


def npmi_edges_topk(spark, d):
    return cooccur.top_edges(cooccur.edges(_baskets(spark, d), CFG), 100)


def basket_npmi_orders(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    baskets = rows.groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("nodes"))
    return cooccur.edges(baskets, Config(min_df=4, min_cooc=3, min_npmi=-1.0))


def trend_surprise(spark, d):
    return cooccur.edges_with_trend(_baskets(spark, d), CFG)


def prefilter_stats(spark, d):
    return cooccur.prefilter_stats(_baskets(spark, d))


def distinct_dates(spark, d):
    return table(spark, d, "baskets").where("date is not null").select(F.col("date").cast("string").alias("day")).distinct()


def node_strength_degree(spark, d):
    return cooccur.node_metrics(_edges(spark, d))


def max_nodes_subgraph(spark, d):
    return cooccur.strongest_subgraph(_edges(spark, d), 60)


def node_neighbors_topk(spark, d):
    return cooccur.neighbours(_edges(spark, d), 8)


def graph_node_table(spark, d):
    return _graph_nodes(spark, d, _edges(spark, d))


def node_sizes(spark, d):
    nodes = table(spark, d, "nodes").where("df >= 0")
    top = nodes.agg(F.max("df").alias("df_max")).scalar()
    return nodes.withColumn("df_max", top).select("id", S.node_size(F.col("df"), F.col("df_max")).alias("size"), S.group_of(F.col("kind")).alias("node_group"))


# --- text analysis ------------------------------------------------------------------------------------------------
def _document_docs(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.lit("").alias("title"), F.col("text").alias("body"), F.lit("").alias("date"))


def _analyser(spark, d, tokenize=textproc.morpheme_tokens):
    return textproc.make_analyser(table(spark, d, "entities"), set(), CFG, tokenize)


def compound_frequency(spark, d):
    analysed = textproc.analysed_units(textproc.unit_rows(_document_docs(spark, d)), _analyser(spark, d, textproc.latin_tokens))
    return textproc.compound_frequency(analysed, CFG)


def compound_merge_terms(spark, d):
    return textproc.build_baskets(_document_docs(spark, d), _analyser(spark, d, textproc.latin_tokens), CFG).select("doc_id", "unit", "nodes")


def entity_mask(spark, d):
    return textproc.entity_mentions(textproc.unit_rows(_docs(spark, d).where("body is not null")), _analyser(spark, d))


def dictionary_candidates(spark, d):
    known = table(spark, d, "entities").select(F.explode("aliases").alias("alias")).unionByName(table(spark, d, "entities").select(F.col("label").alias("alias")))
    baskets = table(spark, d, "baskets").select(F.array_distinct("nodes").alias("nodes"))
    return textproc.dictionary_candidates(baskets, known)


# --- articles and graph queries -----------------------------------------------------------------------------------
def articles_index(spark, d):
    return _articles(spark, d).withColumn("nodes", F.array_join("nodes", " "))


def inverted_index(spark, d):
    return browse.inverted_index(_articles(spark, d)).withColumn("positions", F.array_join(F.transform("positions", lambda p: p.cast("string")), " "))


def source_facets(spark, d):
    return browse.source_facet(_docs(spark, d))


def article_search(spark, d):
    return browse.article_search(_articles(spark, d), node="t:conservation", text="museum").select("doc_id", "pos")


def article_page(spark, d):
    return browse.page(_articles(spark, d), "nodes", 1).select("doc_id")


def article_chips(spark, d):
    nodes = table(spark, d, "nodes").select("id", "label", S.group_of(F.col("kind")).alias("node_group"), F.coalesce("df", F.lit(0)).alias("df"))
    return browse.chips(_articles(spark, d), nodes).withColumn("labels", F.array_join("labels", " "))


def recent_articles(spark, d):
    return _articles(spark, d).where("pos < 20").select("pos", "date", "title", "source")


def article_period(spark, d):
    return browse.period(_docs(spark, d)).withColumn("latest", browse.latest_date(_docs(spark, d)).scalar())


def visible_subgraph(spark, d):
    scored = _edges(spark, d)
    return browse.visible_subgraph(scored, _graph_nodes(spark, d, scored), 0.4, ["facility"])[0]


def label_search(spark, d):
    return browse.label_search(table(spark, d, "nodes"), "博物館").select("id")


def label_priority(spark, d):
    scored = _edges(spark, d)
    return browse.label_priority(_graph_nodes(spark, d, scored)).select("id", "node_group", "strength")


def strongest_pairs(spark, d):
    return browse.strongest_pairs(_edges(spark, d))


def neighbour_table(spark, d):
    return browse.neighbour_table(_edges(spark, d), "t:conservation", 0.25)


def entity_neighbourhoods(spark, d):
    scored = _edges(spark, d)
    return browse.entity_neighbourhoods(_graph_nodes(spark, d, scored), scored).withColumn("near", F.array_join("near", " "))


def community_members(spark, d):
    nodes = table(spark, d, "nodes").where("community is not null and strength is not null")
    return browse.community_members(nodes).withColumn("labels", F.array_join("labels", " "))


def graph_communities(spark, d):
    nodes, _ = analysis.bounded_graph(_baskets(spark, d), analysis.node_meta(table(spark, d, "entities")), CFG)
    return nodes


def cluster_summary(spark, d):
    return browse.cluster_summary(graph_communities(spark, d)).withColumn("labels", F.array_join("labels", " "))


def top_nodes(spark, d):
    return browse.top_nodes(_graph_nodes(spark, d, _edges(spark, d))).select("rank", "id", "label", "df", "degree")


def surprise_ranking(spark, d):
    return browse.surprise_ranking(trend_surprise(spark, d)).select("rank", "a", "b", "surprise", "is_new")


def node_articles(spark, d):
    return browse.node_articles(_articles(spark, d), "t:conservation")


def template_free_bodies(spark, d):
    pages = _docs(spark, d).where("source is not null and body is not null").select(F.col("source").alias("batch"), F.col("doc_id").alias("page"), "body")
    return collect.without_template_lines(pages).select(F.col("page").alias("doc_id"), "body")


def html_to_text(spark, d):
    """Pages made of each doc's id, path and tier, with what a page has around them."""
    field = lambda c: F.coalesce(F.col(c), F.lit("none"))
    page = F.concat(F.lit("<html><head><title>Page "), field("doc_id"), F.lit("</title><style>p {}</style></head><body><nav>menu</nav><p>"), field("path"), F.lit("<br>second &amp; line</p><div>"), field("tier"), F.lit("<script>x</script></div></body></html>"))
    return table(spark, d, "docs").select("path", S.html_text_udf(page).alias("h")).select("path", F.col("h.title").alias("title"), F.col("h.text").alias("text"))


def link_list_items(spark, d):
    """A list page for each doc: a link before it, the day of some before its link and of all after it."""
    id_ = F.col("doc_id")
    day = F.when(id_ < "8", F.lit("2026-08-14 ")).otherwise(F.lit(""))
    page = F.concat(F.lit("2020-01-01 <a href='/top'>top entry</a> "), day, F.lit("<a href='/a/"), id_, F.lit("?utm_source=x&amp;id="), id_, F.lit("#top'>Article "), id_, F.lit("</a> 2026-08-10 <a href='javascript:x()'>no entry</a>"))
    pages = _docs(spark, d).where("doc_id is not null").select(F.lit("https://h.example/list/").alias("url"), page.alias("html"))
    return feeds.list_links(pages, "/a/").select("title", "url", "published")


QUERIES = {f.__name__: f for f in (
    top_nodes, surprise_ranking, node_articles, template_free_bodies, html_to_text, link_list_items,
    p3_found, dedup_exact_body, sentence_units, paragraph_units, content_lines, clean_bodies, shared_template_lines, analysis_text, title_keys, title_key_dedup, history_anti_join,
    canonical_urls, doc_hash_ids, normalize_dates, age_filter, title_pattern_filter, max_items_per_source, source_run_metrics, stored_articles, useful_summaries, publisher_split,
    snippets, escaped_titles, collect_events_daily, term_df, pair_counts, npmi_edges, npmi_edges_topk, basket_npmi_orders, trend_surprise, prefilter_stats, distinct_dates,
    node_strength_degree, max_nodes_subgraph, node_neighbors_topk, graph_node_table, node_sizes, compound_frequency, compound_merge_terms, entity_mask, dictionary_candidates,
    articles_index, inverted_index, source_facets, article_search, article_page, article_chips, recent_articles, article_period, visible_subgraph, label_search, label_priority,
    strongest_pairs, neighbour_table, entity_neighbourhoods, community_members, graph_communities, cluster_summary,
)}

# --- SQL ----------------------------------------------------------------------------------------------------------
_SPACE = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _day(x: str) -> str:
    tries = []
    for form in S.DATE_FORMS:
        part = lambda i, form=form: f"regexp_extract({x}, '{form}', {i})"
        tries.append(f"strftime(try_cast(nullif({part(1)}, '') || '-' || lpad({part(2)}, 2, '0') || '-' || lpad({part(3)}, 2, '0') as date), '%Y-%m-%d')")
    return f"coalesce({', '.join(tries)})"


_ONE_DOC = "(select * exclude (nth) from (select *, row_number() over (partition by doc_id order by path) as nth from docs) where nth = 1)"
_ITEMS = f"(select * replace (coalesce({_day('published')}, '') as published), batch_id::bigint * 1000000000 + item_id as seq from feed_items)"
_KEY = "regexp_replace(title, '[" + _SPACE[1:-1] + r"「」『』【】\[\]（）()〈〉《》“”\"''‘’\-–—―－:：|｜/／]" + "', '', 'g')"
_BOIL = S.BOILERPLATE.replace("'", "''")
_CONTENT = f"""(select doc_id, list_distinct_in_order as lines from (
  select doc_id, list_filter(list_transform(string_split(body, chr(10)), lambda x: {_strip('x')}), lambda x: length(x) >= 15 and not regexp_matches(x, '{_BOIL}')) as l,
    list_filter(l, lambda x, i: list_position(l, x) = i) as list_distinct_in_order from {_ONE_DOC} where body is not null))"""
_GROUP = "case {} when 'facility' then 'facility' when 'policy' then 'policy' when 'law' then 'policy' when 'program' then 'policy' when 'org' then 'other' when 'region' then 'other' when 'person' then 'other' else 'term' end"
_USABLE = """usable as (select * from (select row_number() over () as rid, date, list_sort(list_distinct(list_filter(nodes, lambda x: x is not null))) as nodes from baskets) where len(nodes) >= 2),
tokens as (select rid, date, unnest(nodes) as node from usable),
freq as (select node, count(*) as df from tokens group by node),
n as (select count(*) as n from usable)"""


def _score(c: str, a: str, b: str, n: str) -> str:
    return f"case when {c} >= {n} then 1.0 when {c} > 0 then ln(({c} / {n}::double) / (({a} / {n}::double) * ({b} / {n}::double))) / -ln({c} / {n}::double) end"


_EDGES = f"""{_USABLE},
cooc as (select x.node as a, y.node as b, count(*) as cooc from tokens x join tokens y on x.rid = y.rid and x.node < y.node group by all having count(*) >= 3),
scored as (select a, b, cooc, fa.df as df_a, fb.df as df_b, {_score('cooc', 'fa.df', 'fb.df', 'n')} as s from cooc join freq fa on fa.node = a join freq fb on fb.node = b, n where fa.df >= 4 and fb.df >= 4),
edge as (select a, b, cooc, round(s, 4) as npmi, round(cooc / (df_a + df_b - cooc)::double, 4) as jaccard from scored where s >= 0.25),
ends as (select a as node, b as neighbour, npmi, cooc from edge union all select b, a, npmi, cooc from edge),
metric as (select node, count(*) as degree, round(cast(sum(npmi::decimal(20,6)) as double), 4) as strength from ends group by node),
gnode as (select m.node as id, coalesce(e.label, regexp_replace(m.node, '^t:', '')) as label, coalesce(e.etype, 'term') as kind, {_GROUP.format("coalesce(e.etype, 'term')")} as node_group,
  coalesce(f.df, 0) as df, degree, strength from metric m left join freq f on f.node = m.node left join entities e on e.id = m.node)"""
_SNIPPET = f"""case when length(flat) > 180 then substr(flat, 1, 180) || '…' else flat end"""
_SNIPPETS = f"""snip as (select *, {_SNIPPET} as snippet from (select *, {_strip("regexp_replace(rest2, '" + _SPACE + "+', ' ', 'g')")} as flat from (
  select *, case when head <> '' and starts_with(rest1, head) then substr(rest1, length(head) + 1) else rest1 end as rest2 from (
  select *, {_strip("case when head <> '' and starts_with(body, head || '。') then substr(body, length(head) + 2) else body end")} as rest1 from (
  select *, coalesce(title, '') as head from {_ONE_DOC})))))"""
_ARTICLES = f"""{_SNIPPETS},
per as (select doc_id, count(*) as n_units from baskets where nodes is not null group by doc_id),
own as (select doc_id, list_sort(list(distinct node)) as nodes from (select doc_id, unnest(nodes) as node from baskets) semi join (select id as node from nodes) using (node) group by doc_id),
art as (select row_number() over (order by coalesce(date, '') desc, title desc nulls last, s.doc_id) - 1 as pos, s.doc_id, title, coalesce(date, '') as date, source, url, tier,
  coalesce(n_units, 0) as n_units, snippet, coalesce(own.nodes, []) as nodes from snip s left join per on per.doc_id = s.doc_id left join own on own.doc_id = s.doc_id)"""
_TREND = f"""{_USABLE},
days as (select distinct date from usable where date is not null),
cut as (select case when (select count(*) from days) > 7 then (select date from (select date, row_number() over (order by date desc) as k from days) where k = 7) else (select max(date) from days) end as c),
side as (select rid, coalesce(date >= c, false) as r from usable, cut),
tot as (select count(*) as n, count_if(r) as nr, count_if(not r) as no from side),
f2 as (select node, count(*) as df, count_if(r) as dr, count_if(not r) as dold from tokens join side using (rid) group by node),
p as (select x.node as a, y.node as b, count(*) as cooc, count_if(r) as cr, count_if(not r) as co from tokens x join tokens y on x.rid = y.rid and x.node < y.node join side s on s.rid = x.rid group by all having count(*) >= 3),
z as (select a, b, cooc, fa.df as da, fb.df as db, cr, co, {_score('cooc', 'fa.df', 'fb.df', 'tot.n')} as s, coalesce({_score('cr', 'fa.dr', 'fb.dr', 'nr')}, 0.0) as now, coalesce({_score('co', 'fa.dold', 'fb.dold', 'no')}, 0.0) as was
  from p join f2 fa on fa.node = a join f2 fb on fb.node = b, tot where fa.df >= 4 and fb.df >= 4)"""

#: The dictionary's names in the order in which they are looked for, each with a character of its own at the end.
_NAMES = """named as (select alias, min(id) as id from (select id, unnest(aliases) as alias from entities union all select id, label from entities) where alias <> '' group by alias),
ranked as (select *, chr(cast(57344 + row_number() over (order by length(alias) desc, alias) as int)) as mark from named),
names as (select list(alias || mark order by mark) as l from ranked)"""
_MASK = "list_reduce(list_concat([text], (select l from names)), lambda t, y: replace(t, y[1:len(y) - 1], y[len(y):]))"


def _units(x: str) -> str:
    return f"""list_filter(list_transform(string_split_regex(regexp_replace({x}, '([。！？!?])\\s*', '\\1' || chr(1), 'g'), chr(1) || '|\\n+'), lambda x: {_strip('x')}), lambda x: length(x) >= 4 and regexp_matches(x, '{S.CONTENT_CHARACTER}'))"""


_STOP = ", ".join(f"'{w}'" for w in sorted(textproc.LATIN_STOP))
SQL = {
    "top_nodes": f"with {_EDGES} select cast(row_number() over (order by df desc, id) as int) as rank, id, label, df, degree from gnode order by df desc, id limit 30",
    "surprise_ranking": f"""with {_TREND}, t as (select a, b, round(now - was, 4) as surprise, co = 0 and cr > 0 as is_new from z where s >= 0.25)
      select cast(row_number() over (order by surprise desc, a, b) as int) as rank, * from t order by surprise desc, a, b limit 20""",
    "node_articles": f"with {_ARTICLES} select pos, doc_id, date, title from art where list_contains(nodes, 't:conservation')",
    "template_free_bodies": f"""with pages as (select source as batch, doc_id, body from {_ONE_DOC} where source is not null and body is not null), n as (select batch, count(*) as n from pages group by batch),
      lined as (select *, {_strip('raw')} as line from (select batch, doc_id, unnest(string_split(body, chr(10))) as raw, generate_subscripts(string_split(body, chr(10)), 1) as nth from pages)),
      c as (select batch, line, count(distinct doc_id) as pages from lined where line <> '' group by batch, line),
      t as (select batch, line from c join n using (batch) where n >= 3 and pages >= greatest(3, floor(n * 0.4))),
      k as (select doc_id, string_agg(raw, chr(10) order by nth) as body from lined anti join t using (batch, line) group by doc_id)
      select pages.doc_id, k.body from pages left join k using (doc_id)""",
    "html_to_text": "select path, 'Page ' || coalesce(doc_id, 'none') as title, coalesce(path, 'none') || chr(10) || 'second & line' || chr(10) || chr(10) || coalesce(tier, 'none') as text from docs",
    "link_list_items": f"select 'Article ' || doc_id as title, 'https://h.example/a/' || doc_id || '?id=' || doc_id as url, case when doc_id < '8' then '2026-08-14' else '2026-08-10' end as published from {_ONE_DOC} where doc_id is not null",
    "canonical_urls": f"""with t as (select item_id, {_strip("url")} as u from feed_items),
      p as (select item_id, u, split_part(u, '#', 1) as w from t),
      q as (select item_id, u, regexp_replace(split_part(w, '?', 1), '^([A-Za-z][A-Za-z0-9+.-]*):', lower(regexp_extract(w, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || ':') as base,
        list_filter(string_split(case when contains(w, '?') then w[position('?' in w) + 1:] else '' end, '&'), lambda x: x <> '' and not regexp_matches(split_part(x, '=', 1), '{S.TRACKING_KEYS}')) as ks from p)
      select item_id, base || case when len(ks) > 0 then '?' || array_to_string(list_transform(ks, lambda x: case when contains(x, '=') then x else x || '=' end), '&') else '' end as url from q""",
    "publisher_split": f"""with t as (select item_id, title, coalesce(publisher, '') as known, '{_SPACE}[-–—]{_SPACE}' || regexp_escape(coalesce(publisher, '')) || '{_SPACE}*$' as ends, '{_SPACE}+[-–—]{_SPACE}+([^-–—]{{2,30}})$' as tail from feed_items)
      select item_id, case when known <> '' and regexp_matches(title, ends) then regexp_replace(title, ends, '') when regexp_matches(title, tail) then {_strip("regexp_replace(title, tail, '')")} else title end as title,
      case when known <> '' then known when title is null then null else {_strip("regexp_extract(title, tail, 1)")} end as publisher from t""",
    "entity_mask": f"""with {_NAMES}, whole as (select doc_id, case when coalesce(title, '') <> '' and not starts_with(body, title) then title || '。' || chr(10) || body else body end as t from {_ONE_DOC} where body is not null),
      u as (select doc_id, generate_subscripts(l, 1) - 1 as unit, unnest(l) as text from (select doc_id, {_units('t')} as l from whole)),
      m as (select doc_id, unit, {_MASK} as masked from u)
      select distinct doc_id, cast(unit as int) as unit, id as entity from m join ranked on contains(masked, mark)""",
    "compound_frequency": f"""with {_NAMES}, u as (select doc_id, generate_subscripts(l, 1) as unit, unnest(l) as text from (select doc_id, {_units('text')} as l from documents where text is not null)),
      r as (select doc_id, unit, unnest(rs) as run, generate_subscripts(rs, 1) as nr from (select doc_id, unit, regexp_extract_all(lower({_MASK}), '[a-zà-ÿ]{{3,}}( [a-zà-ÿ]{{3,}})*') as rs from u)),
      w as (select doc_id, unit, nr, unnest(ws) as word, generate_subscripts(ws, 1) as nth from (select *, string_split(run, ' ') as ws from r)),
      g as (select *, sum(case when word in ({_STOP}) then 1 else 0 end) over (partition by doc_id, unit, nr order by nth) as part from w),
      seq as (select list(word order by nth) as ws from g where word not in ({_STOP}) group by doc_id, unit, nr, part),
      n as (select unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ''))) as word from seq, (select unnest([2, 3, 4]) as k) where len(ws) >= k)
      select word, count(*) as freq from n group by word having count(*) >= {CFG.compound_min_freq}""",
    "dedup_exact_body": "select doc_id, path from (select doc_id, path, row_number() over (partition by body order by string_split(path, '/'), doc_id) as nth from docs where body is not null) where nth = 1",
    "sentence_units": f"""select doc_id, cast(generate_subscripts(l, 1) - 1 as int) as unit, unnest(l) as text from (select doc_id, list_filter(list_transform(
      string_split_regex(regexp_replace(text, '([。！？!?])\\s*', '\\1' || chr(1), 'g'), chr(1) || '|\\n+'), lambda x: {_strip('x')}), lambda x: length(x) >= 4 and regexp_matches(x, '{S.CONTENT_CHARACTER}')) as l from documents where text is not null)""",
    "paragraph_units": f"""select doc_id, cast(generate_subscripts(l, 1) - 1 as int) as unit, unnest(l) as text from (select doc_id, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {_strip('x')}), lambda x: length(x) >= 4) as l from documents where text is not null)""",
    "content_lines": f"select doc_id, cast(generate_subscripts(lines, 1) - 1 as int) as line_no, unnest(lines) as line from {_CONTENT}",
    "clean_bodies": f"select doc_id, substr(array_to_string(lines, chr(10)), 1, 20000) as body from {_CONTENT}",
    "shared_template_lines": f"""with pages as (select source as batch, doc_id as page, body from {_ONE_DOC} where source is not null and body is not null), n as (select batch, count(*) as n from pages group by batch),
      held as (select batch, page, line from (select distinct batch, page, {_strip('raw')} as line from (select batch, page, unnest(string_split(body, chr(10))) as raw from pages)) where line <> ''),
      c as (select batch, line, count(*) as pages from held group by batch, line)
      select batch, line, pages from c join n using (batch) where n >= 3 and pages >= greatest(3, floor(n * 0.4))""",
    "analysis_text": f"select doc_id, case when coalesce(title, '') <> '' and not starts_with(body, title) then title || '。' || chr(10) || body else body end as text from {_ONE_DOC} where body is not null",
    "title_keys": f"select item_id, {_KEY} as title_key from feed_items",
    "title_key_dedup": f"""with a as (select *, {_KEY} as key from (select *, row_number() over (partition by doc_id order by seq) as nth from {_ITEMS}) where nth = 1)
      select item_id from (select item_id, key, row_number() over (partition by key order by seq) as k from a) where k = 1 or coalesce(key, '') = ''""",
    "history_anti_join": f"select item_id from feed_items where doc_id is null or doc_id not in (select substr(sha256(url), 1, 12) from {_ONE_DOC} where url is not null)",
    "doc_hash_ids": "select path, substr(sha256(url), 1, 12) as item_id, substr(sha256((case when coalesce(url, '') <> '' then url else path || '#0' end) || ' ' || coalesce(title, '')), 1, 16) as doc_id from docs",
    "normalize_dates": f"select item_id, {_day('published')} as day from feed_items",
    "age_filter": f"select item_id from {_ITEMS} i join feed_sources s on s.id = i.source_id where coalesce(max_age_days, 0) <= 0 or published = '' or published >= strftime(date '{TODAY}' - cast(max_age_days as int), '%Y-%m-%d')",
    "title_pattern_filter": "select item_id from feed_items where regexp_matches(title, '博物館|[Mm]useum')",
    "max_items_per_source": "select item_id from (select item_id, max_items, row_number() over (partition by source_id order by batch_id, pos, item_id) as nth from feed_items i join feed_sources s on s.id = i.source_id) where nth <= max_items",
    "source_run_metrics": f"""with a as (select source_id, item_id as pos, title, published, coalesce(title_pattern = '' or title_pattern is null, true) or coalesce(regexp_matches(title, title_pattern), false) as hit,
      coalesce(max_age_days, 0) <= 0 or published = '' or published >= strftime(date '{TODAY}' - cast(max_age_days as int), '%Y-%m-%d') as young
      from (select *, row_number() over (partition by source_id order by item_id) as nth from {_ITEMS}) i join feed_sources s on s.id = i.source_id where nth <= max_items)
      select source_id, count(*) as fetched, count_if(not hit) as filtered, count_if(hit and not young) as aged_out, count_if(hit and young) as kept, count_if(hit and young and published = '') as undated,
      min(nullif(published, '')) filter (hit and young) as first_day, max(nullif(published, '')) filter (hit and young) as last_day,
      array_to_string((list(title order by pos) filter (hit and young))[1:3], ' / ') as samples from a group by source_id""",
    "stored_articles": f"""with a as (select i.*, s.tier, s.name, case when published = '' then '{TODAY}' else published end as day from {_ITEMS} i join feed_sources s on s.id = i.source_id)
      select substr(day, 1, 4) as yyyy, substr(day, 6, 2) as mm, source_id || '-' || doc_id || '.md' as file,
      '---' || chr(10) || 'title: "' || replace(replace(title, '\\', '\\\\'), '"', '\\"') || '"' || chr(10) || 'date: ' || day || chr(10) || 'source: "' || replace(replace(case when coalesce(publisher, '') = '' then name else publisher end, '\\', '\\\\'), '"', '\\"') || '"' || chr(10)
      || 'url: "' || replace(replace(url, '\\', '\\\\'), '"', '\\"') || '"' || chr(10) || 'tier: ' || tier || chr(10) || '---' || chr(10) || chr(10) || coalesce(case when tier = 'primary' then coalesce(nullif(body, ''), summary) else summary end, '') || chr(10) as content from a""",
    "useful_summaries": "select item_id, case when summary = title or starts_with(summary, substr(title, 1, 20)) then '' else summary end as summary from feed_items",
    "snippets": f"with {_SNIPPETS} select doc_id, snippet from snip where body is not null",
    "escaped_titles": f"""select doc_id, replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') as html, '"' || replace(replace(title, '\\', '\\\\'), '"', '\\"') || '"' as yaml from {_ONE_DOC}""",
    "collect_events_daily": "select strftime(collected_at, '%Y-%m-%d') as day, source_id, count(*) as n from feed_items where collected_at is not null group by all",
    "term_df": f"with {_USABLE} select node, df from freq",
    "pair_counts": f"with {_USABLE} select x.node as a, y.node as b, count(*) as cooc from tokens x join tokens y on x.rid = y.rid and x.node < y.node group by all",
    "npmi_edges": f"with {_EDGES} select * from edge",
    "npmi_edges_topk": f"with {_EDGES} select * from edge order by npmi desc, cooc desc, a, b limit 100",
    "basket_npmi_orders": f"""with tokens as (select distinct l_orderkey as rid, p_brand as node from lineitem join part on l_partkey = p_partkey),
      big as (select rid from tokens group by rid having count(*) >= 2), t as (select * from tokens semi join big using (rid)), freq as (select node, count(*) as df from t group by node), n as (select count(*) as n from big),
      c as (select x.node as a, y.node as b, count(*) as cooc from t x join t y on x.rid = y.rid and x.node < y.node group by all having count(*) >= 3),
      s as (select a, b, cooc, fa.df as da, fb.df as db, {_score('cooc', 'fa.df', 'fb.df', 'n')} as s from c join freq fa on fa.node = a join freq fb on fb.node = b, n where fa.df >= 4 and fb.df >= 4)
      select a, b, cooc, round(s, 4) as npmi, round(cooc / (da + db - cooc)::double, 4) as jaccard from s where s >= -1""",
    "trend_surprise": f"""with {_TREND} select a, b, cooc, round(s, 4) as npmi, round(cooc / (da + db - cooc)::double, 4) as jaccard, round(now, 4) as npmi_recent, round(was, 4) as npmi_baseline, round(now - was, 4) as surprise, co = 0 and cr > 0 as is_new
      from z where s >= 0.25""",
    "prefilter_stats": f"with {_USABLE}, p as (select distinct x.node as a, y.node as b from tokens x join tokens y on x.rid = y.rid and x.node < y.node) select (select n from n) as n_baskets, (select count(*) from freq) as n_nodes, (select count(*) from p) as n_edges",
    "distinct_dates": "select distinct strftime(date, '%Y-%m-%d') as day from baskets where date is not null",
    "node_strength_degree": f"with {_EDGES} select * from metric",
    "max_nodes_subgraph": f"with {_EDGES}, best as (select node from metric order by strength desc, node limit 60) select edge.* from edge where a in (from best) and b in (from best)",
    "node_neighbors_topk": f"with {_EDGES} select node, cast(k as int) as rank, neighbour, npmi from (select *, row_number() over (partition by node order by npmi desc, cooc desc, neighbour) as k from ends) where k <= 8",
    "graph_node_table": f"with {_EDGES} select * from gnode",
    "node_sizes": f"select id, round(6 + 22 * sqrt(df / (max(df) over ())::double), 2) as size, {_GROUP.format('kind')} as node_group from nodes where df >= 0",
    "dictionary_candidates": f"""with w as (select substr(node, 3) as word, count(*) as n from (select unnest(list_distinct(nodes)) as node from baskets) where node like 't:%' group by node having count(*) >= 3),
      known as (select unnest(aliases) as word from entities union select label from entities), f as (select word, n, case when regexp_matches(word, '{textproc.CANDIDATE_ENDING}') then 'A' when length(word) >= 4 then 'B' end as list from w anti join known using (word))
      select list, word, n, cast(rank as int) as rank from (select list, word, n, row_number() over (partition by list order by n desc, word) as rank from f where list is not null) where rank <= 50""",
    "articles_index": f"with {_ARTICLES} select * replace (array_to_string(nodes, ' ') as nodes) from art",
    "inverted_index": f"with {_ARTICLES} select node, array_to_string(list_sort(list(pos)), ' ') as positions from (select unnest(nodes) as node, pos from art) group by node",
    "source_facets": f"select source, count(*) as n from {_ONE_DOC} where coalesce(source, '') <> '' group by source",
    "article_search": f"with {_ARTICLES} select doc_id, pos from art where list_contains(nodes, 't:conservation') and contains(lower(concat_ws(' ', title, snippet, source)), 'museum')",
    "article_page": f"with {_ARTICLES} select doc_id from art order by len(nodes) desc, pos limit 120 offset 60",
    "article_chips": f"""with {_ARTICLES}, r as (select pos, label, row_number() over (partition by pos order by {_GROUP.format('kind')} = 'term', coalesce(df, 0) desc, id) as nth from (select pos, unnest(nodes) as id from art) join nodes using (id))
      select pos, array_to_string(list(label order by nth) filter (nth <= 8), ' ') as labels, greatest(count(*) - 8, 0) as more from r group by pos""",
    "recent_articles": f"with {_ARTICLES} select pos, date, title, source from art where pos < 20",
    "article_period": f"select coalesce(min(nullif(date, '')) || '〜' || max(nullif(date, '')), '日付なし') as period, max(nullif(date, '')) as latest from {_ONE_DOC}",
    "visible_subgraph": f"with {_EDGES}, v as (select id from gnode where node_group in ('term', 'facility')) select edge.* from edge where npmi >= 0.4 and a in (from v) and b in (from v)",
    "label_search": "select id from nodes where contains(label, '博物館')",
    "label_priority": f"with {_EDGES}, top as (select id from gnode order by strength desc, id limit 60) select id, node_group, strength from gnode where node_group <> 'term' or id in (from top)",
    "strongest_pairs": f"with {_EDGES} select * from edge order by npmi desc, cooc desc, a, b limit 40",
    "neighbour_table": f"with {_EDGES} select neighbour, npmi, cooc from ends where node = 't:conservation' and npmi >= 0.25 order by npmi desc, cooc desc, neighbour limit 20",
    "entity_neighbourhoods": f"""with {_EDGES}, best as (select id, label, strength from gnode where node_group in ('facility', 'policy') order by strength desc, id limit 20),
      near as (select e.node, g.label, row_number() over (partition by e.node order by e.npmi desc, e.cooc desc, e.neighbour) as k from ends e join gnode g on g.id = e.neighbour)
      select id, label, strength, (select array_to_string(list(n.label order by k), ' ') from near n where n.node = best.id and k <= 8) as near from best""",
    "community_members": """with v as (select * from nodes where community is not null and strength is not null), s as (select community, count(*) as size from v group by community order by size desc, community limit 10),
      r as (select community, label, row_number() over (partition by community order by strength desc, label desc) as k from v)
      select community, size, array_to_string(list(label order by k) filter (k <= 12), ' ') as labels from s join r using (community) group by all""",
}
