"""Scalar functions of the analysis: built-in column expressions, or Arrow UDFs where Spark has none."""

from __future__ import annotations

import re
import unicodedata
from datetime import date, datetime
from email.utils import parsedate_to_datetime
from html.parser import HTMLParser
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.text import map_distinct

# Fixed values, equal to those the results have to match.
TRACKING_KEYS = r"^(utm_|fbclid|gclid|igshid|mc_[ce]id|ref|ref_src|spm|yclid|_ga)"
TRAILING_PUBLISHER = r"\s+[-–—]\s+([^-–—]{2,30})$"
CONTENT_CHARACTER = "[ぁ-んァ-ヶ一-龥a-zA-Z]"
SENTENCE_BREAK = r"(?<=[。！？!?])\s*|\n+"
BOILERPLATE = (
    r"メニュー開閉|メニューを開く|メニューを閉じる|ここから本文|本文へ移動|Adobe|Acrobat|Reader|rights reserved|Copyright|PDF形式|ダウンロード"
    r"|傍聴|お問(い)?合(わ)?せ|問い合わせ先|電話番号|電話:|内線|FAX|サイトマップ|プライバシーポリシー|ウェブアクセシビリティ|免責事項"
    r"|このページ|ページの先頭|前のページに戻る|関連リンク|新着情報一覧|別添|担当:|\(担当\)|https?://"
)
BODY_MAX_CHARS, MIN_LINE_CHARS, MIN_UNIT_CHARS, SNIPPET_CHARS = 20000, 15, 4, 180
GROUP_OF_KIND = {"term": "term", "facility": "facility", "policy": "policy", "law": "policy", "program": "policy", "org": "other", "region": "other", "person": "other"}
GROUP_LABEL = {"term": "語", "facility": "文化施設", "policy": "政策・制度・法令", "other": "組織・地域・人物"}
GROUP_SHAPE = {"term": "circle", "facility": "square", "policy": "diamond", "other": "triangle"}
GROUP_RGB = {"term": (137, 135, 129), "facility": (42, 120, 214), "policy": (235, 104, 52), "other": (137, 135, 129)}
DATE_FORMS = (r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})", r"(\d{4})年\s*(\d{1,2})月\s*(\d{1,2})日", r"(\d{4})(\d{2})(\d{2})")
SKIPPED_TAGS = {"script", "style", "noscript", "svg", "head", "nav", "header", "footer"}
BLOCK_TAGS = {"p", "div", "br", "li", "ul", "ol", "tr", "td", "th", "table", "section", "article", "main", "aside", "h1", "h2", "h3", "h4", "h5", "h6", "dl", "dt", "dd", "blockquote", "pre", "figure", "figcaption", "hr", "form"}


# --- text ---------------------------------------------------------------------------------------------------------
def normalize_text(value: str | None) -> str | None:
    """NFKC, one kind of line end, one blank for many, at most one blank line, no blanks at the ends."""
    if value is None:
        return None
    text = unicodedata.normalize("NFKC", value).replace("\r\n", "\n").replace("\r", "\n")
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", text)).strip()


@F.pandas_udf(T.StringType())
def normalize_text_udf(values: pd.Series) -> pd.Series:
    return map_distinct(normalize_text, values)


def sentences(body: Column) -> Column:
    """Units of a body: after a terminator or at line ends, at least four characters with a letter among them."""
    parts = F.transform(F.split(body, SENTENCE_BREAK), lambda s: strip(s))
    return F.filter(parts, lambda s: (F.length(s) >= MIN_UNIT_CHARS) & s.rlike(CONTENT_CHARACTER))


def units(body: Column, unit: str = "sentence") -> Column:
    """doc gives the whole text, paragraph the parts between blank lines, anything else sentences."""
    if unit == "doc":
        return F.array(body)
    if unit == "paragraph":
        parts = F.transform(F.split(body, r"\n\n"), lambda s: strip(s))
        return F.filter(parts, lambda s: F.length(s) >= MIN_UNIT_CHARS)
    return sentences(body)


def strip(value: Column) -> Column:
    """Unicode blanks off both ends, which trim() leaves."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def content_lines(body: Column) -> Column:
    """Lines of a fetched page worth keeping: long enough, no furniture words, each once."""
    lines = F.transform(F.split(body, "\n"), lambda s: strip(s))
    return F.array_distinct(F.filter(lines, lambda s: (F.length(s) >= MIN_LINE_CHARS) & ~s.rlike(BOILERPLATE)))


def analysis_text(title: Column, body: Column) -> Column:
    """The title goes before the body as a sentence, unless the body begins with it."""
    has = F.coalesce(title, F.lit("")) != ""
    return F.when(has & ~F.startswith(body, title), F.concat(title, F.lit("。\n"), body)).otherwise(body)


def title_key(title: Column) -> Column:
    """A title without blanks, brackets, dashes, colons, bars and slashes."""
    return F.regexp_replace(title, r"(?U)[\s「」『』【】\[\]（）()〈〉《》“”\"'‘’\-–—―－:：|｜/／]", "")


def snippet(title: Column, body: Column) -> Column:
    """The body without a repeated headline, on one line, cut to 180 characters and an ellipsis."""
    head = F.coalesce(title, F.lit(""))
    with_stop = F.concat(head, F.lit("。"))
    rest = F.when((head != "") & F.startswith(body, with_stop), F.substr(body, F.length(with_stop) + 1)).otherwise(body)
    rest = strip(rest)
    rest = F.when((head != "") & F.startswith(rest, head), F.substr(rest, F.length(head) + 1)).otherwise(rest)
    flat = strip(F.regexp_replace(rest, r"(?U)\s+", " "))
    return F.when(F.length(flat) > SNIPPET_CHARS, F.concat(F.substring(flat, 1, SNIPPET_CHARS), F.lit("…"))).otherwise(flat)


def escape_html(value: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(plain), F.lit(entity))
    return value


def yaml_scalar(value: Column) -> Column:
    """A double-quoted YAML scalar."""
    value = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), value, F.lit('"'))


# --- ids and urls -------------------------------------------------------------------------------------------------
def item_id(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 12)


def doc_id(url: Column, path: Column, index: Column, title: Column) -> Column:
    """16 hex digits of the url, or of path#index where there is none, and the raw title."""
    where = F.when(F.coalesce(url, F.lit("")) != "", url).otherwise(F.concat(path, F.lit("#"), index.cast("string")))
    return F.substring(F.sha2(F.concat_ws(" ", where, F.coalesce(title, F.lit(""))), 256), 1, 16)


def canonical_url(url: str | None) -> str | None:
    """No fragment, no tracking keys (a key that only begins like one counts, too), blank values kept."""
    if url is None:
        return None
    try:
        parts = urlsplit(url.strip())
        kept = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if not re.match(TRACKING_KEYS, k)]
        return urlunsplit((parts.scheme, parts.netloc, parts.path, urlencode(kept), ""))
    except ValueError:
        return url.strip()


@F.pandas_udf(T.StringType())
def canonical_url_udf(values: pd.Series) -> pd.Series:
    return map_distinct(canonical_url, values)


@F.pandas_udf(T.StringType())
def absolute_url_udf(base: pd.Series, link: pd.Series) -> pd.Series:
    return pd.Series([None if link_ is None else urljoin(base_ or "", link_) for base_, link_ in zip(base, link)], dtype=object)


def cut_publisher(title: str, publisher: str) -> tuple[str, str]:
    """Title without the publisher after a spaced dash at its end, and the publisher: the known one, else what stands there."""
    known = publisher and re.search(r"\s[-–—]\s" + re.escape(publisher) + r"\s*$", title)
    if known:
        return title[: known.start()], publisher
    tail = re.search(TRAILING_PUBLISHER, title)
    return (title[: tail.start()].strip(), publisher or tail[1].strip()) if tail else (title, publisher)


def split_publisher(title: Column, publisher: Column) -> tuple[Column, Column]:
    """The same as columns; a null publisher is an empty one."""
    known = F.coalesce(publisher, F.lit(""))
    end = F.concat(F.lit(r"(?U)\s[-–—]\s\Q"), F.replace(known, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E\s*$"))
    tail = "(?U)" + TRAILING_PUBLISHER
    suffix = F.regexp_extract(title, tail, 1)
    cut = F.when((known != "") & F.regexp_like(title, end), F.regexp_replace(title, end, F.lit(""))).when(suffix != "", strip(F.regexp_replace(title, tail, ""))).otherwise(title)
    return cut, F.when(known != "", known).otherwise(strip(suffix))


def useful_summary(summary: Column, title: Column) -> Column:
    """Empty where the summary only repeats the title."""
    return F.when((summary == title) | F.startswith(summary, F.substring(title, 1, 20)), F.lit("")).otherwise(summary)


# --- dates --------------------------------------------------------------------------------------------------------
def normalize_date(value: Column) -> Column:
    """yyyy-MM-dd of the first form whose first hit is a real date; null otherwise."""
    tries = []
    for form in DATE_FORMS:
        part = lambda i, form=form: F.lpad(F.regexp_extract(value, form, i), 4 if i == 1 else 2, "0")
        found = F.when(F.regexp_extract(value, form, 1) != "", F.concat_ws("-", part(1), part(2), part(3)))
        tries.append(F.date_format(F.try_to_date(found, "yyyy-MM-dd"), "yyyy-MM-dd"))
    return F.coalesce(*tries)


def last_date(text: str | None) -> str:
    """The last real date of the last form that has one, or an empty string."""
    best = ""
    for form in DATE_FORMS:
        for hit in re.finditer(form, text or ""):
            try:
                best = date(*map(int, hit.groups())).isoformat()
            except ValueError:
                continue
    return best


def first_date(text: str | None) -> str:
    for form in DATE_FORMS:
        if hit := re.search(form, text or ""):
            try:
                return date(*map(int, hit.groups())).isoformat()
            except ValueError:
                continue
    return ""


def feed_date(value: str | None) -> str:
    """The day as the feed writes it, in its own offset: RFC 822, ISO 8601, then any form of a day."""
    text = (value or "").strip()
    if not text:
        return ""
    try:
        return parsedate_to_datetime(text).date().isoformat()
    except (ValueError, TypeError, IndexError):
        pass
    try:
        return datetime.fromisoformat(text.replace("Z", "+00:00")).date().isoformat()
    except ValueError:
        return first_date(text)


@F.pandas_udf(T.StringType())
def feed_date_udf(values: pd.Series) -> pd.Series:
    return map_distinct(feed_date, values)


# --- html ---------------------------------------------------------------------------------------------------------
class _Reader(HTMLParser):
    """Text of a page's body, line by line, and its title. Skipping counts depth, so an end tag of a skipped kind always comes back up."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.skipped, self.in_title, self.title, self.out = 0, False, [], []

    def handle_starttag(self, tag, attrs):
        if tag == "title":
            self.in_title = True
        elif tag in SKIPPED_TAGS:
            self.skipped += 1
        elif tag in BLOCK_TAGS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        elif tag in SKIPPED_TAGS:
            self.skipped = max(0, self.skipped - 1)
        elif tag in BLOCK_TAGS:
            self.out.append("\n")

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif not self.skipped:
            self.out.append(data)


def html_text(page: str | None) -> tuple[str, str]:
    """(title, text) of an HTML page."""
    reader = _Reader()
    reader.feed(page or "")
    reader.close()
    lines = [line.strip() for line in "".join(reader.out).split("\n")]
    return normalize_text("".join(reader.title)) or "", normalize_text("\n".join(lines)) or ""


def strip_html(value: str | None) -> str | None:
    """The text of a piece of HTML, blocks on lines of their own; what holds no tag is only normalised."""
    if value is None:
        return None
    return normalize_text(value) if "<" not in value else html_text(value)[1]


@F.pandas_udf(T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType())]))
def html_text_udf(pages: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([html_text(p) for p in pages], columns=["title", "text"])


@F.pandas_udf(T.StringType())
def strip_html_udf(values: pd.Series) -> pd.Series:
    return map_distinct(strip_html, values)


def decode_page(raw: bytes | None) -> str | None:
    """Bytes by the charset named in the first 4096 of them, UTF-8 otherwise; what can't be read is replaced."""
    if raw is None:
        return None
    named = re.search(rb"charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", raw[:4096])
    for charset in ([named[1].decode("ascii")] if named else []) + ["utf-8"]:
        try:
            return raw.decode(charset, "replace")
        except LookupError:
            continue
    return None


@F.pandas_udf(T.StringType())
def decode_page_udf(values: pd.Series) -> pd.Series:
    return values.map(lambda v: decode_page(None if v is None else bytes(v)))


# --- scores -------------------------------------------------------------------------------------------------------
def npmi(cooc: Column, df_a: Column, df_b: Column, n: Column) -> Column:
    """Normalised pointwise mutual information; 1 where the pair stands in every basket."""
    cooc, df_a, df_b, n = (c.cast("double") for c in (cooc, df_a, df_b, n))
    p = cooc / n
    return F.when(cooc >= n, 1.0).when(cooc > 0, F.log(p / ((df_a / n) * (df_b / n))) / -F.log(p))


def jaccard(cooc: Column, df_a: Column, df_b: Column) -> Column:
    return cooc / (df_a + df_b - cooc)


def node_size(df: Column, df_max: Column) -> Column:
    return F.round(6 + 22 * F.sqrt(df / df_max), 2)


def group_of(kind: Column) -> Column:
    """Display group of a kind; an unknown kind shows as a term."""
    table = F.create_map(*[F.lit(x) for pair in GROUP_OF_KIND.items() for x in pair])
    return F.coalesce(F.try_element_at(table, kind), F.lit("term"))
