"""Article files of seven families into one record form."""

from __future__ import annotations

import csv
import io
import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions import scalars as S
from weftline.schemas import DOC

try:
    import yaml
except ImportError:
    yaml = None

# File endings and the names a field goes by, in order of preference.
SUFFIXES = {"text": ("txt", "md", "markdown"), "html": ("html", "htm"), "json": ("json",), "jsonl": ("jsonl", "ndjson"), "csv": ("csv", "tsv")}
ALIASES = {
    "title": ("title", "見出し", "タイトル", "headline", "subject"),
    "body": ("body", "text", "content", "本文", "記事", "article"),
    "url": ("url", "link", "リンク", "出典url", "source_url"),
    "date": ("date", "published_at", "published", "日付", "発表日", "掲載日"),
    "source": ("source", "媒体", "出典", "発表元", "publisher", "site"),
    "tags": ("tags", "tag", "タグ", "分類"),
}
RECORD = "idx int, title string, body string, url string, date string, source string, tags array<string>, tier string"


def front_matter(raw: str) -> tuple[dict, str]:
    """(meta, body). Without a mapping between --- lines at the top all of the text is body; later --- lines belong to it."""
    if not raw.startswith("---"):
        return {}, raw
    parts = re.split(r"\n---[ \t]*(?:\n|$)", raw[3:], maxsplit=1)
    if len(parts) < 2:
        return {}, raw
    try:
        meta = yaml.safe_load(parts[0]) if yaml else dict(re.findall(r"^(\w+):\s*\"?(.*?)\"?\s*$", parts[0], re.M))
    except Exception:
        return {}, raw
    return (meta, parts[1]) if isinstance(meta, dict) else ({}, raw)


def pick(record: dict, field: str):
    """The first filled value among a field's names, case aside."""
    lowered = {str(k).strip().lower(): v for k, v in record.items() if k is not None}
    for name in ALIASES[field]:
        value = lowered.get(name.lower())
        if value is not None and str(value).strip():
            return value
    return None


def tag_list(value) -> list[str]:
    if value is None:
        return []
    parts = value if isinstance(value, list) else re.split(r"[,、;]", str(value))
    return [t for p in parts if (t := str(p).strip())]


def map_record(record: dict, stem: str, index: int) -> tuple | None:
    """One record, or None without body and title. A missing title is the body's first 40 characters, a missing date that of the file's name."""
    text = lambda f: (lambda v: "" if v is None else str(v))(pick(record, f))
    title, body = S.normalize_text(text("title")), S.normalize_text(text("body"))
    if not title and not body:
        return None
    day = S.first_date(text("date")) or S.first_date(stem)
    return (index, title or body[:40], body or "", text("url").strip(), day, text("source").strip(), tag_list(pick(record, "tags")), str(record.get("tier") or ""))


def read_records(kind: str, suffix: str, stem: str, raw: bytes) -> list[tuple]:
    """Records of one file."""
    found: list[tuple[int, dict]] = []
    if kind == "text":
        meta, body = front_matter(raw.decode("utf-8", "replace").replace("\r\n", "\n").lstrip("﻿"))
        body = S.normalize_text(body)
        if not body:
            return []
        first = next((line.lstrip("#").strip() for line in body.split("\n") if line.strip()), "")
        found = [(0, {**meta, "body": body, "title": pick(meta, "title") or first})]
    elif kind == "html":
        title, body = S.html_text(S.decode_page(raw))
        found = [(0, {"title": title, "body": body})]
    elif kind == "json":
        loaded = json.loads(raw.decode("utf-8-sig"))
        found = [(i, r) for i, r in enumerate(loaded if isinstance(loaded, list) else [loaded]) if isinstance(r, dict)]
    elif kind == "jsonl":
        for i, line in enumerate(raw.decode("utf-8-sig").splitlines()):
            try:
                record = json.loads(line) if line.strip() else None
            except ValueError:
                continue
            if isinstance(record, dict):
                found.append((i, record))
    elif kind == "csv":
        rows = csv.DictReader(io.StringIO(raw.decode("utf-8-sig")), delimiter="\t" if suffix == "tsv" else ",")
        found = [(i, {k: v for k, v in row.items() if k}) for i, row in enumerate(rows)]
    return [r for i, record in found if (r := map_record(record, stem, i)) is not None]


def _parse(frames):
    kinds = {s: k for k, suffixes in SUFFIXES.items() for s in suffixes}
    names = [part.split()[0] for part in RECORD.split(", ")]
    for frame in frames:
        out = []
        for path, content in zip(frame["path"], frame["content"]):
            stem, _, suffix = path.rsplit("/", 1)[-1].rpartition(".")
            try:
                out += [(path, *r) for r in read_records(kinds[suffix.lower()], suffix.lower(), stem, bytes(content))]
            except Exception:  # a file that can't be read gives no records, the others go on
                continue
        yield pd.DataFrame(out, columns=["path", *names])


def load_articles(spark: SparkSession, root: str) -> DataFrame:
    """Records of all supported files under root, without equal bodies: the first in path order stays. A missing root gives none.

    Readme files and anything under a name that begins with a dot or underscore are left out; endings in any case count.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], DOC)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = str(at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).getPath())
    files = files.withColumn("path", F.regexp_replace(F.expr(f"substr(path, {len(base) + 2})"), "^/+", ""))
    endings = "|".join(s for suffixes in SUFFIXES.values() for s in suffixes)
    wanted = F.col("path").rlike(rf"(?i)\.({endings})$") & ~F.col("path").rlike(r"(^|/)[._]") & ~F.col("path").rlike(r"(?i)(^|/)readme[^/]*$")
    records = files.where(wanted).select("path", "content").mapInPandas(_parse, f"path string, {RECORD}")
    docs = records.withColumn("doc_id", S.doc_id(F.col("url"), F.col("path"), F.col("idx"), F.col("title")))
    return distinct_bodies(docs).select(*[part.split()[0] for part in DOC.split(", ")])


def distinct_bodies(docs: DataFrame) -> DataFrame:
    """The first record of each body by path, part by part, then index. The window holds hashes and paths, not bodies."""
    order = Window.partitionBy("body_key").orderBy(F.split("path", "/"), "idx")
    keyed = docs.withColumn("body_key", F.sha2("body", 256))
    return keyed.withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth", "body_key")
