"""Collection of items: validation, caps, filters, history, template lines, storage form and run metrics."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions import scalars as S

TEMPLATE_MIN_PAGES, TEMPLATE_MIN_RATIO = 3, 0.4


def validate(source: dict) -> None:
    """Raises ValueError before anything is fetched: known kind, a link pattern for lists, patterns that compile."""
    if source.get("kind", "rss") not in ("rss", "html_list"):
        raise ValueError(f"{source.get('id')}: kind {source.get('kind')} isn't supported")
    if source.get("kind") == "html_list" and not source.get("link_pattern"):
        raise ValueError(f"{source.get('id')}: html_list needs a link_pattern")
    for key in ("link_pattern", "title_pattern"):
        try:
            re.compile(source.get(key) or "")
        except re.error as error:
            raise ValueError(f"{source.get('id')}: {key}: {error}") from error


def selected(sources: DataFrame, only: str | None = None) -> DataFrame:
    return sources.where("enabled") if only is None else sources.where(F.col("enabled") & (F.col("id") == only))


def capped(items: DataFrame, limit: Column | int, by: str = "source_id", order: tuple[str, ...] = ("pos",)) -> DataFrame:
    """The first `limit` items of each source in feed order, before any other filter."""
    nth = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return items.withColumn("__nth", nth).where(F.col("__nth") <= limit).drop("__nth")


def title_matches(pattern: Column) -> Column:
    """An empty or null pattern lets every title through; else it is searched anywhere in it."""
    return F.coalesce(pattern == "", F.lit(True)) | F.coalesce(F.expr("title rlike title_pattern"), F.lit(False))


def young_enough(published: Column, max_age_days: Column, today: date) -> Column:
    """0 days is no limit, undated items stay, the limit's own day counts."""
    oldest = F.date_format(F.date_sub(F.lit(today), max_age_days), "yyyy-MM-dd")
    undated = published.isNull() | (published == "")
    return (F.coalesce(max_age_days, F.lit(0)) <= 0) | undated | (published >= oldest)


def oldest_day(today: date, max_age_days: int) -> str:
    return (today - timedelta(days=max_age_days)).isoformat()


def new_items(items: DataFrame, history: DataFrame) -> DataFrame:
    """Items new by id and by title: ids count for all runs, title keys for this one only, where the first item of a key stays.

    `seq` orders items over sources. Ids are settled first, so an item that a title rejects never blocks a later id.
    """
    fresh = items.join(history.select("doc_id").distinct(), "doc_id", "left_anti")
    by_id = Window.partitionBy("doc_id").orderBy("seq")
    fresh = fresh.withColumn("key", S.title_key(F.col("title"))).withColumn("nth", F.row_number().over(by_id)).where("nth = 1").drop("nth")
    # titles without a key are groups of their own, so they don't meet in one task
    by_title = Window.partitionBy(F.coalesce(F.nullif("key", F.lit("")), F.concat(F.lit("\0"), "doc_id"))).orderBy("seq")
    first = fresh.withColumn("nth", F.row_number().over(by_title))
    return first.where("nth = 1").drop("nth", "key")


def template_lines(pages: DataFrame, min_pages: int = TEMPLATE_MIN_PAGES, ratio: float = TEMPLATE_MIN_RATIO) -> DataFrame:
    """(batch, line, pages) of lines on at least max(min_pages, floor(ratio n)) of a batch's n pages (batch, page, body)."""
    whole = pages.where("body is not null")
    n = whole.groupBy("batch").agg(F.count("*").alias("n"))
    held = whole.select("batch", F.explode(F.array_distinct(F.filter(F.transform(F.split("body", "\n"), lambda s: S.strip(s)), lambda s: s != ""))).alias("line"))
    counted = held.groupBy("batch", "line").agg(F.count("*").alias("pages"))
    limit = F.greatest(F.lit(min_pages), F.floor(F.col("n") * ratio))
    return counted.join(n, "batch").where((F.col("n") >= min_pages) & (F.col("pages") >= limit)).select("batch", "line", "pages")


def without_template_lines(pages: DataFrame, min_pages: int = TEMPLATE_MIN_PAGES, ratio: float = TEMPLATE_MIN_RATIO) -> DataFrame:
    """pages with the batch's template lines taken out of body."""
    lines = pages.select("batch", "page", F.posexplode_outer(F.split("body", "\n")).alias("at", "raw")).withColumn("line", S.strip(F.col("raw")))
    kept = lines.join(template_lines(pages, min_pages, ratio).select("batch", "line"), ["batch", "line"], "left_anti")
    text = kept.groupBy("batch", "page").agg(F.array_sort(F.collect_list(F.struct("at", "raw"))).alias("rows"))
    rest = pages.drop("body").join(text, ["batch", "page"], "left")
    return rest.withColumn("body", F.array_join(F.transform("rows", lambda r: r.raw), "\n")).drop("rows")


def fetches_body(fetch_body: Column, tier: Column) -> Column:
    """Bodies are fetched and stored of primary sources only."""
    return F.coalesce(fetch_body, F.lit(False)) & (tier == "primary")


def clean_body(body: Column) -> Column:
    return F.substring(F.array_join(S.content_lines(body), "\n"), 1, S.BODY_MAX_CHARS)


def stored_form(items: DataFrame, sources: DataFrame, today: date) -> DataFrame:
    """What is written for each item: month folder, file name and Markdown text; secondary sources store the summary only."""
    src = sources.select(F.col("id").alias("source_id"), "tier", F.col("name").alias("source_name"))
    rows = items.join(src, "source_id")
    day = F.when(F.coalesce("published", F.lit("")) == "", F.lit(today.isoformat())).otherwise(F.col("published"))
    by = F.when(F.coalesce("publisher", F.lit("")) == "", F.col("source_name")).otherwise(F.col("publisher"))
    text = F.when(F.col("tier") == "primary", F.coalesce(F.nullif("body", F.lit("")), "summary")).otherwise(F.col("summary"))
    head = F.concat(
        F.lit("---\ntitle: "), S.yaml_scalar(F.col("title")), F.lit("\ndate: "), day, F.lit("\nsource: "), S.yaml_scalar(by),
        F.lit("\nurl: "), S.yaml_scalar(F.col("url")), F.lit("\ntier: "), F.col("tier"), F.lit("\n---\n\n"), F.coalesce(text, F.lit("")), F.lit("\n"),
    )
    return rows.select(
        F.substring(day, 1, 4).alias("yyyy"), F.substring(day, 6, 2).alias("mm"), F.concat("source_id", F.lit("-"), "doc_id", F.lit(".md")).alias("file"), "doc_id", head.alias("content")
    )


def run_metrics(items: DataFrame, sources: DataFrame, today: date) -> DataFrame:
    """A row a source: fetched, filtered, aged, kept, undated, date span, three sample titles.

    items carry source_id, pos, title, published; the cap holds before the filters.
    """
    src = sources.select(F.col("id").alias("source_id"), "max_items", "title_pattern", "max_age_days")
    rows = capped(items.join(src, "source_id"), F.col("max_items"))
    hit = title_matches(F.col("title_pattern"))
    young = young_enough(F.col("published"), F.col("max_age_days"), today)
    flagged = rows.withColumn("hit", hit).withColumn("young", young)
    kept = F.col("hit") & F.col("young")
    per = flagged.groupBy("source_id").agg(
        F.count("*").alias("fetched"), F.count_if(~F.col("hit")).alias("filtered"), F.count_if(F.col("hit") & ~F.col("young")).alias("aged_out"), F.count_if(kept).alias("kept"),
        F.count_if(kept & (F.coalesce("published", F.lit("")) == "")).alias("undated"),
        F.min(F.when(kept, F.nullif("published", F.lit("")))).alias("first_day"), F.max(F.when(kept, F.nullif("published", F.lit("")))).alias("last_day"),
    )
    order = Window.partitionBy("source_id").orderBy("pos")
    samples = flagged.where(kept).withColumn("nth", F.row_number().over(order)).where("nth <= 3").groupBy("source_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "title"))), lambda s: s.title).alias("samples"))
    return per.join(samples, "source_id", "left")
