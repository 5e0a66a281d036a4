"""Declarative inputs: source definitions, entity dictionaries, stopwords. All are small files read on the driver."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.schemas import ENTITY, SOURCE

try:
    import yaml
except ImportError:
    yaml = None

SOURCE_DEFAULTS = {
    "kind": "rss", "tier": "secondary", "country": "JP", "lang": "ja", "enabled": True, "fetch_body": False, "max_items": 60,
    "rate_limit_sec": 2.0, "link_pattern": "", "title_pattern": "", "max_age_days": 0, "note": "",
}


def _documents(folder: str) -> list:
    """Mappings of all *.yaml files in order of name; names that begin with _ are templates. JSON is read where YAML can't be."""
    out = []
    for path in sorted(Path(folder).glob("*.yaml")) if os.path.isdir(folder) else []:
        if path.name.startswith("_"):
            continue
        text = path.read_text(encoding="utf-8")
        loaded = yaml.safe_load(text) if yaml else json.loads(text)
        out += [(path.name, m) for m in (loaded if isinstance(loaded, list) else [loaded]) if isinstance(m, dict)]
    return out


def load_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Feed definitions; id, name and url are mandatory, unknown keys are dropped, a missing folder gives no rows."""
    names = [part.split()[0] for part in SOURCE.split(", ")]
    rows = []
    for file, given in _documents(folder):
        for key in ("id", "name", "url"):
            if not given.get(key):
                raise ValueError(f"{file}: {key} is missing")
        whole = SOURCE_DEFAULTS | {k: v for k, v in given.items() if k in names}
        whole["rate_limit_sec"] = float(whole["rate_limit_sec"])
        rows.append(tuple(whole[n] for n in names))
    return spark.createDataFrame(rows, SOURCE)


def load_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Dictionary entries: label defaults to the id, etype to the id's prefix; aliases hold the label, longest first."""
    rows = []
    for _, given in _documents(folder):
        if not given.get("id"):
            continue
        label = given.get("label") or given["id"]
        names = sorted(dict.fromkeys([label, *(given.get("aliases") or [])]), key=len, reverse=True)
        meta = {k: str(v) for k, v in given.items() if k not in ("id", "label", "etype", "aliases")}
        rows.append((given["id"], label, given.get("etype") or given["id"].split(":")[0], names, meta))
    return spark.createDataFrame(rows, ENTITY)


def load_stopwords(path: str) -> set[str]:
    """One word a line, # begins a comment."""
    if not os.path.exists(path):
        return set()
    lines = Path(path).read_text(encoding="utf-8").splitlines()
    return {word for line in lines if (word := line.split("#", 1)[0].strip())}


def existing_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of stored articles: what stands after the last dash of each *.md file's name."""
    if not os.path.isdir(folder):
        return spark.createDataFrame([], "doc_id string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(folder)
    return files.select(F.regexp_extract("path", r"-([^-/]+)\.md$", 1).alias("doc_id")).where("doc_id <> ''").distinct()
