import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from weftline.config import Config
from weftline.functions import scalars as S
from weftline.operators import browse, collect, textproc


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first().y


def test_scalars(spark):
    assert one(spark, "一文目です。二文目！三\n\n123456。", S.sentences) == ["一文目です。", "二文目！"]
    assert one(spark, "ab\n\nlong part\n\n  another ", lambda c: S.units(c, "paragraph")) == ["long part", "another"]
    assert one(spark, "2026-13-45 と 2026年8月5日", S.normalize_date) == "2026-08-05"
    assert one(spark, "2026/8/5", S.normalize_date) == "2026-08-05"
    assert one(spark, "n/a", S.normalize_date) is None
    assert one(spark, "「館」 再開 - 報", S.title_key) == "館再開報"
    assert one(spark, 'a\\"b', S.yaml_scalar) == '"a\\\\\\"b"'
    assert one(spark, "plan", S.group_of) == "term" and one(spark, "law", S.group_of) == "policy"
    assert S.last_date("2026-01-02 then 2026-01-03 2026年5月6日") == "2026-05-06"
    assert S.canonical_url("https://x.example/a?refund=1&b=&utm_x=2#f") == "https://x.example/a?b="
    assert S.normalize_text("Ａ\r\nB  c\n\n\n\nd ") == "A\nB c\n\nd"
    assert S.decode_page('<meta charset="Shift_JIS">文化'.encode("shift_jis")).endswith("文化")
    assert S.html_text(None) == ("", "")


def test_snippet(spark):
    got = spark.createDataFrame([("題", "題。題 " + "あ" * 200), ("", "短い\n文"), (None, None)], "t string, b string").select(S.snippet(F.col("t"), F.col("b")).alias("s")).collect()
    assert got[0].s == "あ" * 180 + "…" and got[1].s == "短い 文" and got[2].s is None


def test_validation():
    collect.validate({"id": "a", "kind": "rss"})
    for bad in ({"kind": "pdf"}, {"kind": "html_list"}, {"kind": "rss", "title_pattern": "("}):
        with pytest.raises(ValueError):
            collect.validate({"id": "a", **bad})


def test_dedup_by_id_then_title(spark, listed):
    items = spark.createDataFrame([(1, "a", "題 一"), (2, "b", "題一"), (3, "b", "別"), (4, "c", ""), (5, "d", ""), (6, "h", "新"), (7, "e", None)], "seq bigint, doc_id string, title string")
    history = spark.createDataFrame([("h",), ("h",)], "doc_id string")
    assert [r[0] for r in listed(collect.new_items(items, history), "seq")] == [1, 4, 5, 7]


def test_caps_ages_and_metrics(spark):
    src = spark.createDataFrame([("s", 3, "館", 10)], "id string, max_items int, title_pattern string, max_age_days int")
    items = spark.createDataFrame([("s", 1, "館 A", "2026-08-25"), ("s", 2, "other", "2026-08-25"), ("s", 3, "館 B", "2026-08-01"), ("s", 4, "館 C", "2026-08-30")], "source_id string, pos int, title string, published string")
    row = collect.run_metrics(items, src, date(2026, 8, 31)).first()
    assert (row.fetched, row.filtered, row.aged_out, row.kept, row.samples) == (3, 1, 1, 1, ["館 A"])
    assert collect.oldest_day(date(2026, 8, 31), 10) == "2026-08-21"


def test_template_lines(spark, listed):
    pages = spark.createDataFrame([("b", i, f"menu\nline {i}\nmenu\n  shared  ") for i in range(4)] + [("c", 9, "menu"), ("b", 10, None)], "batch string, page int, body string")
    assert listed(collect.template_lines(pages), "line", "pages") == [("menu", 4), ("shared", 4)]
    kept = {(r.batch, r.page): r.body for r in collect.without_template_lines(pages).collect()}
    assert kept["b", 0] == "line 0" and kept["c", 9] == "menu"


def test_only_primary_bodies_are_stored(spark):
    src = spark.createDataFrame([("p", "P", "primary"), ("q", "Q", "secondary")], "id string, name string, tier string")
    items = spark.createDataFrame([("p", "d1", "T", "u", "sum", "", "", "BODY"), ("q", "d2", "T", "u", "sum", "2026-07-01", "Pub", "BODY")], "source_id string, doc_id string, title string, url string, summary string, published string, publisher string, body string")
    got = {r.doc_id: r for r in collect.stored_form(items, src, date(2026, 8, 31)).collect()}
    assert "BODY" in got["d1"].content and got["d1"].yyyy == "2026" and 'source: "P"' in got["d1"].content
    assert "BODY" not in got["d2"].content and got["d2"].mm == "07" and got["d2"].file == "q-d2.md"


NOUN = "名詞"


def scripted(table):
    return lambda text: table.get(text.strip(), [])


def test_entities_longest_first():
    a = textproc.Analyser([("e:long", ["文化観光推進法"]), ("e:short", ["文化観光"])], set(), Config(), scripted({}))
    assert a.aliases.find("文化観光推進法と文化観光") == (["e:long", "e:short"], " " * 7 + "と" + " " * 4)
    assert textproc.Aliases([]).find("x") == ([], "x") and a.aliases.find("") == ([], "")


def test_aliases_match_replacing_one_by_one():
    rng = random.Random(5)
    for _ in range(300):
        names = list(dict.fromkeys("".join(rng.choices("abc", k=rng.randrange(1, 5))) for _ in range(rng.randrange(1, 7))))
        text = "".join(rng.choices("abcd", k=rng.randrange(0, 25)))
        want, rest = [], text
        for name in sorted(names, key=len, reverse=True):
            if name in rest:
                rest = rest.replace(name, " " * len(name))
                want.append(name)
        assert textproc.Aliases([(n, [n]) for n in names]).find(text) == (want, rest)


def test_runs_and_compounds():
    tokens = [("公立", NOUN, "普通名詞", "公立"), ("劇場", NOUN, "普通名詞", "劇場"), ("を", "助詞", "", "を"), ("御", "接頭辞", "", "御"), ("覧", NOUN, "普通名詞", "覧"), ("支える", "動詞", "一般", "支える"), ("三", NOUN, "数詞", "三")]
    a = textproc.Analyser([], {"公立劇場場"}, Config(), scripted({"文": tokens}))
    _, runs = a.runs("文")
    assert runs == [[["公立", "公立"], ["劇場", "劇場"]], [["覧", "覧"]], [["支える", "支える"]]]
    assert a.nodes(runs, {"公立劇場"}) == ["t:公立劇場", "t:支える"]
    assert a.nodes(runs, set()) == ["t:公立", "t:劇場", "t:支える"]


def test_baskets_end_to_end(spark):
    docs = spark.createDataFrame([("1", "", "old museum plan grows. the museum plan ends here", "2026-01-01"), ("2", None, "", None), ("3", "", None, None)], "doc_id string, title string, body string, date string")
    got = textproc.build_baskets(docs, textproc.Analyser([], set(), Config(unit="doc"), textproc.latin_tokens), Config(unit="doc")).collect()
    assert len(got) == 1 and "t:museumplan" in got[0].nodes


def test_articles_and_search(spark):
    docs = spark.createDataFrame([("a", "A館", "body of a", "2026-01-02", "s", "u", "primary"), ("b", "B", "body of b", None, "s", "u", "primary"), ("c", "C", "body of c", "2026-03-01", None, "u", "x")], "doc_id string, title string, body string, date string, source string, url string, tier string")
    baskets = spark.createDataFrame([("a", ["n", "m"]), ("a", ["n"]), ("c", ["z"])], "doc_id string, nodes array<string>")
    nodes = spark.createDataFrame([("n",), ("z",)], "id string")
    art = browse.articles_index(docs, baskets, nodes)
    got = [(r.pos, r.doc_id, r.n_units, r.nodes) for r in art.orderBy("pos").collect()]
    assert got == [(0, "c", 1, ["z"]), (1, "a", 2, ["n"]), (2, "b", 0, [])]
    assert [r.doc_id for r in browse.article_search(art, days=30).collect()] == ["c"]
    assert [r.doc_id for r in browse.article_search(art, source="s", text="a館").collect()] == ["a"]
    assert [r.doc_id for r in browse.page(art, "old", 0, 2).collect()] == ["b", "a"]
    assert [tuple(r) for r in browse.inverted_index(art).orderBy("node").collect()] == [("n", [1]), ("z", [0])]
    assert browse.period(art).first().period == "2026-01-02〜2026-03-01"
