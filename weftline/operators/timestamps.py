"""Mixed timestamp formats and zones to one form (problem 3).

Distinct (raw, tz, country) values go into a dictionary that is parsed once, kept as a table and only added to;
rows get their instant by a join with it. A value with a time of day gives `yyyy-MM-dd HH:mm:ss.SSSSSS` in UTC, one
with a day only gives `yyyy-MM-dd` as written, anything else gives no row.
"""

from __future__ import annotations

import re
import unicodedata
from datetime import date, datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.runtime import new_path

# Month names, day-half words, era years and zone abbreviations as they are written.
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "en3": "jan feb mar apr may jun jul aug sep oct nov dec",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "de_at": "jänner feber märz april mai juni juli august september oktober november dezember",
    "de3": "jan feb mär apr mai jun jul aug sep okt nov dez",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "fr_plain": "janvier fevrier mars avril mai juin juillet aout septembre octobre novembre decembre",
    "fr3": "janv févr mars avr mai juin juil août sept oct nov déc",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "it": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
    "th": "มกราคม กุมภาพันธ์ มีนาคม เมษายน พฤษภาคม มิถุนายน กรกฎาคม สิงหาคม กันยายน ตุลาคม พฤศจิกายน ธันวาคม",
    "th3": "ม.ค. ก.พ. มี.ค. เม.ย. พ.ค. มิ.ย. ก.ค. ส.ค. ก.ย. ต.ค. พ.ย. ธ.ค.",
    "hi": "जनवरी फरवरी मार्च अप्रैल मई जून जुलाई अगस्त सितंबर अक्टूबर नवंबर दिसंबर",
    "hi2": "जनवरी फ़रवरी मार्च अप्रैल मई जून जुलाई अगस्त सितम्बर अक्तूबर नवम्बर दिसम्बर",
    "ar": "يناير فبراير مارس أبريل مايو يونيو يوليو أغسطس سبتمبر أكتوبر نوفمبر ديسمبر",
    "ar2": "يناير فبراير مارس ابريل مايو يونيه يوليه اغسطس سبتمبر اكتوبر نوفمبر ديسمبر",
}
EXTRA_MONTHS = {"sept": 9, "juill": 7, "fevr": 2, "dec": 12}
AM = ("午前", "上午", "오전", "a.m.", "a.m", "am", "凌晨", "早上", "पूर्वाह्न", "صباحا", "صباحًا", "ص")
PM = ("午後", "下午", "오후", "p.m.", "p.m", "pm", "晚上", "अपराह्न", "مساء", "مساءً", "م")
ERAS = {"明治": 1867, "大正": 1911, "昭和": 1925, "平成": 1988, "令和": 2018, "m": 1867, "t": 1911, "s": 1925, "h": 1988, "r": 2018}
ZONES = {
    "z": 0, "gmt": 0, "utc": 0, "ut": 0, "wet": 0, "west": 60, "cet": 60, "cest": 120, "mez": 60, "mesz": 120, "eet": 120, "eest": 180,
    "msk": 180, "gst": 240, "pkt": 300, "ict": 420, "wib": 420, "hkt": 480, "sgt": 480, "awst": 480, "jst": 540, "kst": 540,
    "acst": 570, "acdt": 630, "aest": 600, "aedt": 660, "nzst": 720, "nzdt": 780, "est": -300, "edt": -240, "cst": -360, "cdt": -300,
    "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600, "bst": 60, "ist": 330,
}
LOCAL_ZONES = {("cst", "CN"): 480, ("est", "AU"): 600, ("edt", "AU"): 660, ("ist", "IE"): 60, ("ist", "IL"): 120}
MONTH_FIRST = {"US"}


def _month_table() -> dict[str, int]:
    out = dict(EXTRA_MONTHS)
    for names in MONTHS.values():
        for i, name in enumerate(names.split()):
            out.setdefault(unicodedata.normalize("NFKC", name).strip("."), i + 1)
    return out


_MONTH = _month_table()
_MONTH_RX = "|".join(sorted((re.escape(m) for m in _MONTH), key=len, reverse=True))
_B, _E = r"(?<![^\W\d_])", r"(?![^\W\d_])"  # no letter before, none after
_HALF_RX = re.compile("|".join(re.escape(x) if not x.isascii() and len(x) > 1 else _B + re.escape(x) + _E for x in sorted(AM + PM, key=len, reverse=True)))
_ERA_RX = re.compile(r"(?:(明治|大正|昭和|平成|令和)|" + _B + r"([mtshr]))\s*(\d{1,2}|元)\s*[年./-]\s*(\d{1,2})\s*[月./-]\s*(\d{1,2})(?!\d)\s*日?")
_YMD_RX = re.compile(r"(?<!\d)(\d{4})\s*([-/.年년])\s*(\d{1,2})\s*[-/.月월]\s*(\d{1,2})(?!\d)\s*[日일.]?")
_NUM_RX = re.compile(r"(?<![\d.:])(\d{1,2})\s*([-/.])\s*(\d{1,2})\s*\2\s*(\d{4})(?!\d)")
_DMY_RX = re.compile(rf"(?<!\d)(\d{{1,2}})(?:\.|st|nd|rd|th|er|º)?[\s-]*(?:de\s+|of\s+)?{_B}({_MONTH_RX}){_E}\.?,?[\s-]*(?:de\s+)?(?:พ\.ศ\.|ค\.ศ\.)?\s*(\d{{4}}|\d{{2}})(?![\d:])")
_MDY_RX = re.compile(rf"{_B}({_MONTH_RX}){_E}\.?\s*(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?!\d)")
_TIME_RX = re.compile(
    r"(?<![\d.:])t?(\d{1,2})\s*(?::|h|時|时|点|點|시)\s*(\d{2}(?!\d)|\d{1,2}(?=\s*[分분]))\s*[分분]?"
    r"(?:\s*:?\s*(\d{1,2})(?:\s*[秒초]|(?<=:\d\d)|(?=[.,]\d)|(?=\D|$))(?:[.,](\d+))?)?"
)
_HOUR_RX = re.compile(r"(?<![\d.:])(\d{1,2})\s*(?:時|时|点|點|시|h|uhr)(?![^\W\d_])")
_HOUR_HALF_RX = re.compile(r"(?<![\d.:])(\d{1,2})\s*$")
_OFFSET_RX = re.compile(r"(?:" + _B + r"(?:gmt|utc))?\s*([+-])(\d{2}):?(\d{2})(?::?\d{2})?(?!\d)|" + _B + r"(?:gmt|utc)\s*([+-])(\d{1,2})(?::?(\d{2}))?(?!\d)|(?<=\d)\s*([+-])(\d{2})$")
_ZONE_RX = re.compile(r"(?<![^\W\d_])(" + "|".join(sorted(ZONES, key=len, reverse=True)) + r")(?![^\W\d_])")
_IANA_RX = re.compile(r"\[?\b([A-Z][A-Za-z_]+/[A-Za-z_/+-]+)\]?")


@lru_cache(maxsize=256)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except Exception:
        return None


def _ascii_digits(text: str) -> str:
    return "".join(str(unicodedata.decimal(ch)) if not ch.isascii() and unicodedata.decimal(ch, None) is not None else ch for ch in text)


def _year(value: str, country: str | None) -> int:
    year = int(value)
    if len(value) == 2:
        return year + (2000 if year < 70 else 1900)
    return year - 543 if 2400 < year < 2700 else year  # Buddhist years


def _epoch(digits: str) -> str | None:
    scale = {10: 0, 13: 3, 16: 6, 19: 9}[len(digits)]
    micros = int(digits) * 10 ** (6 - scale) if scale <= 6 else int(digits) // 10 ** (scale - 6)
    return _stamp(datetime(1970, 1, 1) + timedelta(microseconds=micros))


def _stamp(instant: datetime) -> str:
    return instant.strftime("%Y-%m-%d %H:%M:%S.%f") if instant.year > 999 else None


def _digits_only(text: str, tz: str | None) -> str | None:
    n = len(text)
    if n in (10, 13, 16, 19):
        return _epoch(text)
    if n == 8:
        return date(int(text[:4]), int(text[4:6]), int(text[6:])).isoformat()
    if n in (12, 14, 17):
        parts = [int(text[:4]), *(int(text[i : i + 2]) for i in range(4, min(n, 14), 2))]
        micros = int(text[14:17]) * 1000 if n == 17 else 0
        return _local(datetime(*parts, microsecond=micros), tz, None)
    return None


def _local(wall: datetime, tz: str | None, offset: int | None) -> str | None:
    """The instant of a wall time; fold 0 is the first of two, and in a gap the time moves on by the gap's length."""
    if offset is not None:
        return _stamp(wall - timedelta(minutes=offset))
    zone = _zone(tz) if tz else None
    return _stamp(wall.replace(tzinfo=zone).astimezone(timezone.utc)) if zone else None


def _date(text: str, country: str | None) -> tuple[date | None, str]:
    """The date in text, and text without it."""
    if m := _ERA_RX.search(text):
        year = ERAS[m[1] or m[2]] + (1 if m[3] == "元" else int(m[3]))
        found = date(year, int(m[4]), int(m[5]))
    elif m := _YMD_RX.search(text):
        found = date(_year(m[1], country), int(m[3]), int(m[4]))
    elif m := _DMY_RX.search(text):
        found = date(_year(m[3], country), _MONTH[m[2]], int(m[1]))
    elif m := _MDY_RX.search(text):
        found = date(_year(m[3], country), _MONTH[m[1]], int(m[2]))
    elif m := _NUM_RX.search(text):
        day, month = (m[3], m[1]) if country in MONTH_FIRST and m[2] != "." else (m[1], m[3])
        found = date(_year(m[4], country), int(month), int(day))
    elif m := re.search(r"(?<!\d)((?:19|20)\d{2})(\d{2})(\d{2})(?=t\d|\s|$)", text):
        found = date(int(m[1]), int(m[2]), int(m[3]))
    else:
        return None, text
    return found, text[: m.start()] + " " + text[m.end() :]


def parse_time(raw: str | None, tz: str | None = None, country: str | None = None) -> str | None:
    """One value as written -> UTC instant, calendar day or None.

    Null, empty, wordy and impossible values (30 February, 25:00, month 13 in the country's order) give None; so does
    a wall time without zone where tz is null or unknown. Digits of any script and full-width forms are read; years
    from 2401 to 2699 are Buddhist ones; fractions are cut to microseconds. A value of any length is read whole.
    """
    if raw is None:
        return None
    try:
        return _parse(raw, tz, country)
    except (ValueError, OverflowError):
        return None


def _parse(raw: str, tz: str | None, country: str | None) -> str | None:
    text = " ".join(_ascii_digits(unicodedata.normalize("NFKC", raw)).split())
    if not any(ch.isdigit() for ch in text):
        return None
    if text.isdigit():
        return _digits_only(text, tz)
    named = None
    if m := _IANA_RX.search(text):
        if _zone(m[1]):
            named, text = m[1], text[: m.start()] + " " + text[m.end() :]
    text = re.sub(r"^[^\d]*?(?:更新|公開|掲載|updated|published|posted)\s*:?\s*", "", text.lower())
    text = re.sub(r"[(（][^()（）\d]{1,12}[)）]", lambda m: " " + m[0][1:-1] + " " if m[0][1:-1].strip() in ZONES else " ", text)  # weekdays
    day, rest = _date(text, country)
    if day is None:
        return None
    half = None
    if m := _HALF_RX.search(rest):
        half, rest = ("am" if m[0] in AM else "pm"), rest[: m.start()] + " " + rest[m.end() :]
    clock, micros = None, 0
    if m := _TIME_RX.search(rest):
        clock = [int(m[1]), int(m[2]), int(m[3] or 0)]
        micros = int((m[4] or "0")[:6].ljust(6, "0"))
    elif m := _HOUR_RX.search(rest) or (half and _HOUR_HALF_RX.search(rest)):
        clock = [int(m[1]), 0, 0]
    if clock is None:
        return None if re.search(r"\d", rest) else day.isoformat()
    rest = rest[: m.start()] + " " + rest[m.end() :]
    if half:
        if clock[0] > 12:
            half = None
        elif half == "am":
            clock[0] %= 12
        else:
            clock[0] = clock[0] % 12 + 12
    wall = datetime(day.year, day.month, day.day, *clock, micros)
    offset = None
    if o := _OFFSET_RX.search(rest):
        sign, hours, minutes = next((g for g in ((o[1], o[2], o[3]), (o[4], o[5], o[6]), (o[7], o[8], None)) if g[0]))
        offset = (int(hours) * 60 + int(minutes or 0)) * (-1 if sign == "-" else 1)
        if abs(offset) > 18 * 60:
            return None
        rest = rest[: o.start()] + " " + rest[o.end() :]
    elif o := re.fullmatch(r"\s*([+-])(\d{2})\s*", rest):
        offset, rest = int(o[2]) * 60 * (-1 if o[1] == "-" else 1), ""
    elif z := _ZONE_RX.search(rest):
        offset = LOCAL_ZONES.get((z[1], country), ZONES[z[1]])
    if re.search(r"\d", rest):
        return None
    return _local(wall, named or tz, offset)


@F.pandas_udf(T.StringType())
def parse_time_udf(raw: pd.Series, tz: pd.Series, country: pd.Series) -> pd.Series:
    none = lambda v: v if isinstance(v, str) else None
    return pd.Series([parse_time(none(r), none(z), none(c)) for r, z, c in zip(raw, tz, country)], dtype=object)


class TimeDictionary:
    """Parsed distinct values as a table that grows: update() parses only what isn't there yet."""

    SCHEMA = "raw string, tz string, country string, utc string"

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or new_path(spark, "times")
        self._written = path is not None and self._exists()

    def _exists(self) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def table(self) -> DataFrame:
        if not self._written:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def update(self, values: DataFrame) -> TimeDictionary:
        """Add the values (raw, tz, country) that are new; null raw values are never kept."""
        fresh = values.select("raw", "tz", "country").where("raw is not null").distinct()
        if self._written:
            fresh = _same_value(fresh.alias("v"), self.table().alias("k"), "left_anti")
        fresh.withColumn("utc", parse_time_udf("raw", "tz", "country")).write.mode("append").parquet(self.path)
        self._written = True
        return self

    def normalise(self, rows: DataFrame) -> DataFrame:
        """rows (with raw, tz, country) and utc, null where the value can't be read."""
        named = self.table().select(*(F.col(c).alias(f"__{c}") for c in ("raw", "tz", "country", "utc")))
        on = F.col("raw") == F.col("__raw")
        for c in ("tz", "country"):
            on &= F.col(c).eqNullSafe(F.col(f"__{c}"))
        return rows.join(named, on, "left").select(*rows.columns, F.col("__utc").alias("utc"))


def _same_value(v: DataFrame, k: DataFrame, how: str) -> DataFrame:
    on = F.col("v.raw") == F.col("k.raw")
    for c in ("tz", "country"):
        on &= F.col(f"v.{c}").eqNullSafe(F.col(f"k.{c}"))
    return v.join(k, on, how)


def written_times(docs: DataFrame, items: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(field, rec_id, raw, tz, country) of docs and of items.

    A doc without source takes the id its file name begins with. A source not in the table leaves tz and country null.
    The table of sources is fixed and small, so Spark may broadcast it by its own size check.
    """
    src = sources.select(F.col("id").alias("src"), "tz", "country").dropDuplicates(["src"])
    in_path = F.nullif(F.regexp_extract(F.col("path"), r"([^/]+)-[0-9A-Fa-f]+\.[A-Za-z]+$", 1), F.lit(""))
    of_docs = docs.select(F.lit("doc_date").alias("field"), F.col("doc_id").alias("rec_id"), F.col("date").alias("raw"), F.coalesce("source", in_path).alias("src"))
    of_items = items.select(F.lit("item_published").alias("field"), F.col("item_id").cast("string").alias("rec_id"), F.col("published").alias("raw"), F.col("source_id").alias("src"))
    return tuple(part.where("raw is not null").join(src, "src", "left").select("field", "rec_id", "raw", "tz", "country") for part in (of_docs, of_items))


def normalised_times(docs: DataFrame, items: DataFrame, sources: DataFrame, path: str | None = None) -> DataFrame:
    """(field, rec_id, utc) of every readable value, each once; path keeps the dictionary for later batches."""
    of_docs, of_items = written_times(docs, items, sources)
    known = TimeDictionary(docs.sparkSession, path).update(of_docs).update(of_items)
    return known.normalise(of_docs.unionByName(of_items)).where("utc is not null").select("field", "rec_id", "utc").distinct()
