import json

from weftline.sources import articles, dictionaries, feeds

RSS = """<?xml version="1.0"?><rss><channel>
<item><title>館の修理を拡充 - 朝の新報</title><link>https://n.example/a?utm_source=x&amp;id=7</link><pubDate>Fri, 14 Aug 2026 22:10:00 GMT</pubDate>
<description>&lt;a href="x"&gt;館の修理を拡充&lt;/a&gt;</description><source url="u">朝の新報</source></item>
<item><title></title><link>https://n.example/b</link></item></channel></rss>""".encode()
ATOM = b"""<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Hall reopens</title><link rel="alternate" href="https://n.example/c#x"/><published>2026-08-13T01:00:00+09:00</published><summary>More news</summary></entry></feed>"""
LIST = """<html><head><title>x</title></head><body><nav><a href="/news/9.html">navigation entry</a></nav><dl><dt>2026年8月1日</dt><dd><a href="/news/1.html">A long enough title</a></dd>
<dd><a href="/news/1.html#top">A long enough title</a></dd><dd><a href="javascript:x()">script here</a></dd><dd><a href="/news/2.html">PDF</a></dd></dl></body></html>"""


def test_rss_entry():
    (entry,) = feeds.parse_feed(RSS)
    assert entry == {"title": "館の修理を拡充", "url": "https://n.example/a?id=7", "summary": "", "published": "2026-08-14", "publisher": "朝の新報"}


def test_atom_entry():
    (entry,) = feeds.parse_feed(ATOM)
    assert entry["url"] == "https://n.example/c" and entry["published"] == "2026-08-13" and entry["summary"] == "More news"


def test_list_page():
    found = feeds.parse_links(LIST, "https://n.example/top/", r"/news/\d")
    assert [(e["title"], e["url"]) for e in found] == [("navigation entry", "https://n.example/news/9.html"), ("A long enough title", "https://n.example/news/1.html")]
    assert found[1]["published"] == "2026-08-01"


def test_dates_of_a_list_belong_to_the_nearest_link():
    page = "2026-08-14 <a href='/n/2'>second entry</a> <a href='/n/3'>third entry</a> 2026-08-10 <a href='/n/4'>fourth 2026-01-01</a><a href='/2025/02/03/n/5?d=2024-01-01'>fifth entry</a>"
    found = {e["title"]: e["published"] for e in feeds.parse_links(page, "https://n.example/", "/n/")}
    assert found == {"second entry": "2026-08-14", "third entry": "2026-08-10", "fourth 2026-01-01": "2026-08-10", "fifth entry": "2025-02-03"}
    nested = feeds.parse_links("<a href='/n/1'>outer <a href='/n/2'>inner</a> words</a> 2026-08-10", "https://n.example/", "/n/")
    assert [(e["title"], e["published"]) for e in nested] == [("outer inner words", "2026-08-10")]


def test_publisher_only_after_a_spaced_dash(spark):
    from weftline.functions import scalars as S

    cases = [("Interview with NHK", "NHK"), ("Hall opens - NHK", "NHK"), ("NHK", "NHK"), ("Hall opens – mc-x.com", "mc-x.com"), ("Hall opens - Daily", "Other"), ("Hall opens-NHK", "NHK"), ("Plain", None), ("A - x (b) ", r"x (b)"), (r"A - \\E.", r"\\E.")]
    want = [("Interview with NHK", "NHK"), ("Hall opens", "NHK"), ("NHK", "NHK"), ("Hall opens", "mc-x.com"), ("Hall opens", "Other"), ("Hall opens-NHK", "NHK"), ("Plain", ""), ("A", r"x (b)"), ("A", r"\\E.")]
    assert [S.cut_publisher(t, p or "") for t, p in cases] == want
    title, publisher = S.split_publisher(S.F.col("t"), S.F.col("p"))
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, p string").select("i", title.alias("t"), publisher.alias("p")).orderBy("i").collect()
    assert [(r.t, r.p) for r in rows] == want


def test_atom_links_and_blocks():
    atom = b'<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Only self</title><link rel="self" href="https://n.example/c"/></entry></feed>'
    assert feeds.parse_feed(atom) == []
    from weftline.functions.scalars import strip_html

    assert strip_html("<p>one</p><p>two</p>") == "one\n\ntwo" and strip_html("a &amp; b") == "a &amp; b" and strip_html(None) is None


def test_failing_source_is_a_row(spark):
    pages = spark.createDataFrame([("a", "rss", "u", "", bytearray(RSS)), ("b", "rss", "u", "", bytearray(b"no xml"))], "source_id string, kind string, url string, link_pattern string, content binary")
    got = {(r.source_id, r.error is None, r.title) for r in feeds.scan_pages(pages).collect()}
    assert ("a", True, "館の修理を拡充") in got and any(s == "b" and not fine for s, fine, _ in got)


def test_retries():
    calls = []

    def failing(request, timeout):
        calls.append(1)
        raise OSError("down")

    try:
        feeds.fetch("http://x", opener=failing, sleep=lambda s: calls.append(s))
        raise AssertionError
    except RuntimeError:
        assert calls == [1, 1, 1, 2, 1]


def test_article_files(spark, tmp_path):
    put = lambda name, text: (tmp_path / name).parent.mkdir(parents=True, exist_ok=True) or (tmp_path / name).write_bytes(text.encode())
    put("a/2026-08-05_x.md", "---\ntitle: First\nsource: S\ntags: [p, q]\n---\nBody one.\n---\nstill body")
    put("b.txt", "# Head line\nplain body")
    put("c.html", "<html><head><title>T</title></head><body><nav>menu</nav><p>para</p><p>two</p></body></html>")
    put("d.json", json.dumps([{"見出し": "J", "本文": "body j", "日付": "2026年1月2日"}, "no mapping"]))
    put("e.jsonl", '{"title": "L", "text": "body l"}\nbroken\n\n{"title": "", "body": ""}')
    put("f.csv", "﻿title,body,date\nC,body c,2026/3/4\n")
    put("g.tsv", "title\tbody\nD\tbody c\n")  # the same body as f.csv: dropped
    put("README.md", "not an article")
    put("_x/h.txt", "hidden")
    put("bad.json", "{")
    got = {r.title: r for r in articles.load_articles(spark, str(tmp_path)).collect()}
    assert set(got) == {"First", "Head line", "T", "J", "L", "C"}
    assert got["First"].date == "2026-08-05" and got["First"].tags == ["p", "q"] and got["First"].body.endswith("still body")
    assert got["T"].body == "para\n\ntwo" and got["J"].date == "2026-01-02" and got["C"].date == "2026-03-04"
    assert articles.load_articles(spark, str(tmp_path / "missing")).count() == 0


def test_dictionaries(spark, tmp_path):
    (tmp_path / "s.yaml").write_text('[{"id": "a", "name": "A", "url": "u", "other": 1, "fetch_body": true}]')
    (tmp_path / "_t.yaml").write_text('{"id": "t"}')
    (tmp_path / "stop.txt").write_text("# words\nfoo # note\n\nbar\n")
    src = dictionaries.load_sources(spark, str(tmp_path)).first()
    assert (src.id, src.kind, src.max_items, src.fetch_body) == ("a", "rss", 60, True)
    assert dictionaries.load_stopwords(str(tmp_path / "stop.txt")) == {"foo", "bar"}
    assert dictionaries.load_entities(spark, str(tmp_path)).first().aliases == ["a"]
    assert dictionaries.load_sources(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "site-0a1b2c.md").write_text("x")
    assert [r.doc_id for r in dictionaries.existing_ids(spark, str(tmp_path)).collect()] == ["0a1b2c"]
