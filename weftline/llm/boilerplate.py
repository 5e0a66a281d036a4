"""Page boilerplate in article bodies (problem 2), by consensus of the paths of one host's pages.

A page is a body, its containers are its lines, and the class path of a line is its generalised form: folded case
and width, one blank for many, numbers, the publisher's name and the short segments of menus replaced by placeholders,
of a trail of links (`Home > News > ...`) the links without the page's title at the end, and of an unterminated line
with a label (`Read next: ...`) the label alone. Each page scores its lines by form, and the
pages of a host vote: a path that many of its pages hold, more than an article's sentences ever recur, or that the
votes of two other hosts have settled, is the page's. Every page is then read again and the lines of such paths come out.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.runtime import cut

TERMINATORS = ".!?。！？｡…।؟۔"
CLOSERS = "\"”’»」』)]）"
LINES = "field string, rec_id string, host string, line_no int, path bigint, is_new boolean, score double"
MIN_PAGES = 3  # pages of a host that must hold a path before the host's vote can settle it
MIN_SHARE = 0.08  # lower bound of the share of a host's pages that a page's own path reaches
CONSENSUS_PAGES = 8  # pages a host's vote needs before it counts at other hosts
CONSENSUS_HOSTS = 2  # hosts that must have settled a path so before it counts at others
CONFIDENCE = 1.64
MENU_SEGMENT = 40  # characters that an entry of a menu has at most

_NUMBER = re.compile(r"\d+(?:[.,:]\d+)*")
_SEPARATOR = re.compile(r"\s*([|>→])\s*|\s*(?<!\d)(/)(?!\d)\s*")  # guillemets close quotations too, so they are none
_SENTENCE_MARK = re.compile(r"[!?。।؟۔]|\.(?!\w)")
_LABEL = re.compile(r"(?:[・•*‣▸▶►◇\-–—]\s*|[^:.。!?]{0,30}?(?::\s+|:(?=[^\s\d/])|】\s*|\d位\s+|#\d+:\s*|\d\.\s+))(?=\S)")


def fold_line(line: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", line).casefold().split())


def terminated(folded: str) -> bool:
    body = folded.rstrip(CLOSERS)
    return bool(body) and body[-1] in TERMINATORS


def menu_path(text: str) -> str | None:
    """The path of a line of links, None for any other: an entry is short and no sentence. A slash between two words is no menu yet."""
    marks = ["".join(m.groups("")) for m in _SEPARATOR.finditer(text)]
    if not marks:
        return None
    parts = _SEPARATOR.sub("\0", text).split("\0")
    entry = [len(p) <= MENU_SEGMENT and not _SENTENCE_MARK.search(p) for p in parts]
    if all(entry) and (len(parts) > 2 or marks != ["/"]):
        return "\x02" * len(parts)
    if all(entry[:-1]) and marks[-1] == ">":
        return _NUMBER.sub("0", ">".join(parts[:-1])) + ">\x04"
    return None


def class_path(line: str, name: str | None) -> tuple[str | None, float]:
    """The generalised form of a line and its score, 1 for an article's line to -1 for a page's; None for a blank line."""
    text = fold_line(line)
    if not text:
        return None, 0.0
    ends = terminated(text)
    named = bool(name) and name in text
    if named:
        text = text.replace(name, "\x01")
    score = (0.5 if ends else -0.25) - 0.5 * named + min(len(text), 80) / 160
    if not ends and (menu := menu_path(text)):
        return menu, -1.0
    if not ends and (m := _LABEL.match(text)):
        rest = text[m.end() :]
        if len(rest) > 6:
            return _NUMBER.sub("0", m[0]) + "\x03" + ("\x01" if "\x01" in rest else ""), max(-1.0, score - 0.5)
    return _NUMBER.sub("0", text), max(-1.0, min(1.0, score))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for field, rec_id, host, name, body in zip(*(c.to_pylist() for c in batch.columns)):
            name = fold_line(name) if name else None
            seen: set[int] = set()
            for number, line in enumerate(body.split("\n"), 1):
                path, score = class_path(line, name)
                if path is None:
                    continue
                key = xxhash.xxh3_64_intdigest(path) - (1 << 63)
                rows.append((field, rec_id, host, number, key, key not in seen, score))
                seen.add(key)
            if len(rows) > 50_000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.float64()]
    columns = list(zip(*rows)) or [()] * 7
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["field", "rec_id", "host", "line_no", "path", "is_new", "score"])


def pages(docs: DataFrame, items: DataFrame, sources: DataFrame) -> DataFrame:
    """(field, rec_id, host, name, body): one row a page with a body. The host is the source, else the one in path, else the url's."""
    in_path = F.nullif(F.regexp_extract("path", r"([^/]+)-[0-9A-Fa-f]+\.[A-Za-z]+$", 1), F.lit(""))
    url_host = F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/:?#]+)", 1))
    of_docs = docs.select(F.lit("doc_body").alias("field"), F.col("doc_id").alias("rec_id"), F.coalesce("source", in_path, url_host, F.lit("")).alias("host"), "body")
    of_items = items.select(F.lit("item_body").alias("field"), F.col("item_id").cast("string").alias("rec_id"), F.coalesce("source_id", url_host, F.lit("")).alias("host"), "body")
    both = of_docs.unionByName(of_items).where("body is not null and rec_id is not null").dropDuplicates(["field", "rec_id"])
    names = sources.select(F.col("id").alias("host"), "name").dropDuplicates(["host"])
    return both.join(names, "host", "left").select("field", "rec_id", "host", "name", "body")


def page_lines(of: DataFrame) -> DataFrame:
    return of.mapInArrow(_lines, LINES)


def lower_bound(k, n):
    """Wilson's lower bound of a share k of n, as a column."""
    z2 = CONFIDENCE**2
    p = k / n
    root = F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    return (p + z2 / (2 * n) - CONFIDENCE * root) / (1 + z2 / n)


def line_votes(lines: DataFrame) -> DataFrame:
    """(host, path, held, scores, n_lines); votes of further pages add up. Counts are combined before the shuffle, so no host is gathered anywhere."""
    return lines.groupBy("host", "path").agg(F.sum(F.col("is_new").cast("bigint")).alias("held"), F.sum("score").alias("scores"), F.count("*").alias("n_lines"))


def host_sizes(of: DataFrame) -> DataFrame:
    return of.groupBy("host").agg(F.count("*").alias("n_pages"))


def winning_paths(votes: DataFrame, sizes: DataFrame) -> DataFrame:
    """(host, path) of the page's own lines, from one row a host and path, and one a host."""
    votes = votes.select("host", "path", "held", (F.col("scores") / F.col("n_lines")).alias("score"))
    votes = cut(votes.where(F.col("held") >= 1).join(sizes, "host"), "votes")
    bound = lower_bound(F.col("held"), F.col("n_pages"))
    # the better a path scores as an article's line, the more pages must hold it
    needed = F.lit(MIN_SHARE) * F.when(F.col("score") > 0.5, 1.25).otherwise(1.0)
    won = votes.where((F.col("held") >= MIN_PAGES) & (bound >= needed))
    settled = won.where(F.col("held") >= CONSENSUS_PAGES).groupBy("path").agg(F.count("*").alias("hosts")).where(F.col("hosts") >= CONSENSUS_HOSTS).select("path")
    elsewhere = votes.join(settled, "path", "left_semi").select("host", "path")
    return won.select("host", "path").unionByName(elsewhere).distinct()


def page_furniture(docs: DataFrame, items: DataFrame, sources: DataFrame) -> DataFrame:
    """(field, rec_id, line_no) of the lines that belong to the page. Null and empty bodies and blank lines give none."""
    of = pages(docs, items, sources)
    lines = cut(page_lines(of), "lines")
    return lines_of_paths(lines, winning_paths(line_votes(lines), host_sizes(of)))


def lines_of_paths(lines: DataFrame, paths: DataFrame) -> DataFrame:
    return lines.join(paths, ["host", "path"], "left_semi").select("field", "rec_id", "line_no")


def main_bodies(docs: DataFrame, items: DataFrame, sources: DataFrame) -> DataFrame:
    """(field, rec_id, body, n_removed): each page's main body."""
    return without_lines(pages(docs, items, sources), page_furniture(docs, items, sources))


def without_lines(of: DataFrame, lines: DataFrame) -> DataFrame:
    gone = lines.groupBy("field", "rec_id").agg(F.collect_set("line_no").alias("gone"))
    of = of.join(gone, ["field", "rec_id"], "left")
    dropped = F.coalesce("gone", F.array().cast("array<int>"))
    kept = F.filter(F.split("body", "\n", -1), lambda _, i: ~F.array_contains(dropped, i + 1))
    return of.select("field", "rec_id", F.array_join(kept, "\n").alias("body"), F.size(dropped).alias("n_removed"))
