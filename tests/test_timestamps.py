import pytest

from weftline.operators.timestamps import TimeDictionary, normalised_times, parse_time

CASES = [
    ("2026-01-03T17:18:07", "Asia/Tokyo", "JP", "2026-01-03 08:18:07.000000"),
    ("2026-03-29T06:34:52.741661236+11:00", None, "AU", "2026-03-28 19:34:52.741661"),
    ("Mon, 26 Jan 2026 22:30:30 GMT", None, None, "2026-01-26 22:30:30.000000"),
    ("1776809736", None, None, "2026-04-21 22:15:36.000000"),
    ("1678223772578", None, None, "2023-03-07 21:16:12.578000"),
    ("２０２６／０５／２１ ２１：５５", "Asia/Tokyo", "JP", "2026-05-21 12:55:00.000000"),
    ("令和元年6月29日 08:34", "Asia/Tokyo", "JP", "2019-06-28 23:34:00.000000"),
    ("R7.10.4", "Asia/Tokyo", "JP", "2025-10-04"),
    ("04/01/2026 07:47", "America/New_York", "US", "2026-04-01 11:47:00.000000"),
    ("04/01/2026 07:47", "Europe/London", "GB", "2026-01-04 07:47:00.000000"),
    ("28 สิงหาคม 2569", "Asia/Bangkok", "TH", "2026-08-28"),
    ("13 août 2026 à 20h50", "Europe/Paris", "FR", "2026-08-13 18:50:00.000000"),
    ("2025. 9. 30. 오후 12:09", "Asia/Seoul", "KR", "2025-09-30 03:09:00.000000"),
    ("2026/10/25 01:51", "Europe/London", "GB", "2026-10-25 00:51:00.000000"),  # twice: the first
    ("2026-03-08 02:30", "America/New_York", "US", "2026-03-08 07:30:00.000000"),  # skipped: moves on
    ("2025年10月01日 午前0時57分", "Asia/Tokyo", "JP", "2025-09-30 15:57:00.000000"),
    ("٢٠٢٦-٠١-٠٢", "Asia/Dubai", "AE", "2026-01-02"),
    ("20260804", "Asia/Tokyo", "JP", "2026-08-04"),
]


@pytest.mark.parametrize("raw,tz,country,utc", CASES)
def test_formats(raw, tz, country, utc):
    assert parse_time(raw, tz, country) == utc


@pytest.mark.parametrize("raw", [None, "", "  ", "TBD", "2026年2月30日", "2026-23-05", "0000-00-00", "2026-01-01 25:00", "x" * 10_000, "19/09/2025 10:00 99"])
def test_unreadable(raw):
    assert parse_time(raw, "Asia/Tokyo", "JP") is None


def test_wall_time_without_zone_is_unreadable():
    assert parse_time("2026-01-03 10:00", None, None) is None
    assert parse_time("2026-01-03 10:00", "Nowhere/Land", None) is None


def test_dictionary_grows(spark, tmp_path):
    schema = "raw string, tz string, country string"
    path = f"file://{tmp_path}/times"
    known = TimeDictionary(spark, path).update(spark.createDataFrame([("2026-01-02", None, "JP"), ("2026-01-02", None, "JP"), (None, None, None)], schema))
    assert known.table().count() == 1
    again = TimeDictionary(spark, path).update(spark.createDataFrame([("2026-01-02", None, "JP"), ("TBD", "UTC", None)], schema))
    assert again.table().count() == 2


def test_rows(spark, listed):
    docs = spark.createDataFrame([("a", "2026-01-02 09:00", "s", None, 1), ("a", "2026-01-02 09:00", None, "x/s-12ab.md", 2), ("b", None, "s", None, 3), ("c", "n/a", "s", None, 4)], "doc_id string, date string, source string, path string, tz int")
    items = spark.createDataFrame([(7, "2026-01-02", "missing")], "item_id bigint, published string, source_id string")
    src = spark.createDataFrame([("s", "Asia/Tokyo", "JP")], "id string, tz string, country string")
    assert listed(normalised_times(docs, items, src)) == [("doc_date", "a", "2026-01-02 00:00:00.000000"), ("item_published", "7", "2026-01-02")]
    assert normalised_times(docs.limit(0), items.limit(0), src.limit(0)).count() == 0


def test_long_values_are_read():
    import time

    assert parse_time(" " * 5000 + "2026-08-14 10:00:00 UTC" + "\t" * 5000) == "2026-08-14 10:00:00.000000"
    began = time.time()
    for text in ("9" * 200_000, "1:" * 100_000, "word 1 " * 40_000, "+0" * 100_000):
        parse_time(text, "UTC", "JP")
    assert time.time() - began < 20
