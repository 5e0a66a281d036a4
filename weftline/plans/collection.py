"""A collection run: fetch, scan, cap, filter, drop what is known, fetch bodies of primary sources, clean, store, report."""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from datetime import date
from functools import partial
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import scalars as S
from weftline.operators import collect as C
from weftline.runtime import cut
from weftline.sources import dictionaries, feeds

PAGE = "source_id string, kind string, url string, link_pattern string, content binary, failed string"


def fetch_pages(sources: DataFrame, fetch: Callable[[str], bytes]) -> DataFrame:
    """A row a source with its page or why there is none. Definitions are checked before anything is fetched; a failure stays with its source."""

    def run(frames):
        for frame in frames:
            rows = []
            for s in frame.to_dict("records"):
                try:
                    C.validate(s)
                    rows.append((s["id"], s["kind"], s["url"], s["link_pattern"], fetch(s["url"]), None))
                except Exception as error:
                    rows.append((s["id"], s["kind"], s["url"], s["link_pattern"], None, str(error)[:200]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PAGE.split(", ")])

    return cut(sources.select("id", "kind", "url", "link_pattern", "title_pattern").mapInPandas(run, PAGE), "fetched")


def with_bodies(items: DataFrame, fetch: Callable[[str], bytes], sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """body and body_error of items marked wanted: the page's cleaned text, or why there is none; the item stays as it is then.

    A source's items are fetched by one task, one after another, with rate_limit_sec after each page that came.
    """

    def run(frames):
        for frame in frames:
            bodies, errors = [], []
            for url, wanted, pause in zip(frame["url"], frame["wanted"], frame["rate_limit_sec"]):
                body = error = None
                if wanted:
                    try:
                        body = S.html_text(S.decode_page(fetch(url)))[1]
                        sleep(pause or 0)
                    except Exception as reason:
                        error = str(reason)[:200]
                bodies.append(body)
                errors.append(error)
            yield frame.assign(body=bodies, body_error=errors)

    schema = items.schema.simpleString()[len("struct<") : -1] + ",body:string,body_error:string"
    return items.repartition("source_id").mapInPandas(run, schema).withColumn("body", C.clean_body(F.col("body")))


def collect(spark: SparkSession, sources: DataFrame, history: DataFrame, today: date, fetch: Callable[[str], bytes] = feeds.fetch, out: str | None = None, fetch_body: Callable[[str], bytes] | None = None) -> tuple[DataFrame, DataFrame]:
    """(articles to store, run metrics). With `out` the articles are written below it as YYYY/MM/<source>-<id>.md.

    The order of the steps saves work: caps, title and age filters and known ids come before any body is fetched. A body
    is tried once (fetch_body), since an item can do without; template lines are looked for in cleaned and cut bodies.
    """
    fetch_body = fetch_body or (partial(fetch, retries=1) if fetch is feeds.fetch else fetch)
    chosen = C.selected(sources)
    pages = fetch_pages(chosen, fetch)
    scanned = cut(feeds.scan_pages(pages.where("content is not null").drop("failed")), "scanned")
    failed = pages.where("failed is not null").select("source_id", F.col("failed").alias("error")).unionByName(scanned.where("error is not null").select("source_id", "error"))
    src = chosen.select(F.col("id").alias("source_id"), "max_items", "title_pattern", "max_age_days", "fetch_body", "tier", "rate_limit_sec")
    items = scanned.where("error is null").drop("error").withColumn("doc_id", S.item_id(F.col("url"))).join(src, "source_id")
    capped = C.capped(items, F.col("max_items"))
    kept = capped.where(C.title_matches(F.col("title_pattern")) & C.young_enough(F.col("published"), F.col("max_age_days"), today))
    # sources in the order of their names, entries in the order of the feed
    kept = kept.withColumn("seq", F.struct("source_id", "pos"))
    fresh = cut(C.new_items(kept, history).drop("seq").withColumn("wanted", C.fetches_body(F.col("fetch_body"), F.col("tier"))), "fresh")
    bodies = cut(with_bodies(fresh.drop("max_items", "title_pattern", "max_age_days", "fetch_body", "tier"), fetch_body), "bodies")
    pages_read = bodies.select(F.col("source_id").alias("batch"), F.col("doc_id").alias("page"), "body").where("body is not null")
    clean = C.without_template_lines(pages_read).select(F.col("page").alias("doc_id"), F.col("body").alias("clean"))
    templates = C.template_lines(pages_read).groupBy(F.col("batch").alias("source_id")).agg(F.count("*").alias("template_lines"))
    whole = bodies.join(clean, "doc_id", "left").withColumn("body", F.coalesce("clean", F.lit(""))).drop("clean")
    stored = cut(C.stored_form(whole, chosen, today), "stored")
    metrics = C.run_metrics(scanned.where("error is null").select("source_id", "pos", "title", "published"), chosen, today)
    written = fresh.groupBy("source_id").agg(F.count("*").alias("written"))
    errors = failed.groupBy("source_id").agg(F.min("error").alias("error"))
    no_body = bodies.where("body_error is not null").groupBy("source_id").agg(F.count("*").alias("bodies_failed"))
    report = chosen.select(F.col("id").alias("source_id"))
    for part in (metrics, written, errors, templates, no_body):
        report = report.join(part, "source_id", "left")
    status = F.when(F.col("error").isNotNull(), "failed").when(F.coalesce("fetched", F.lit(0)) == 0, "empty").otherwise("ok")
    report = report.withColumn("status", status).withColumn("skipped", F.coalesce("kept", F.lit(0)) - F.coalesce("written", F.lit(0)))
    if out:
        write_articles(stored, out)
    return stored, report.fillna(0, ["fetched", "filtered", "aged_out", "kept", "undated", "written", "template_lines", "bodies_failed"])


def write_articles(stored: DataFrame, out: str) -> None:
    """Text files below a folder that every executor reaches."""

    def run(rows):
        for r in rows:
            folder = Path(out) / r.yyyy / r.mm
            os.makedirs(folder, exist_ok=True)
            (folder / r.file).write_text(r.content, encoding="utf-8")

    stored.foreachPartition(run)


def known_ids(spark: SparkSession, folder: str) -> DataFrame:
    return dictionaries.existing_ids(spark, folder)
