from datetime import date

from weftline.plans.collection import collect
from weftline.sources.dictionaries import load_sources

FEED = "<rss><channel>{}</channel></rss>"
ENTRY = "<item><title>{t}</title><link>https://s.example/{u}?utm_source=f</link><pubDate>{d}</pubDate><description>about {t}</description></item>"
PAGE = "<html><body><nav>menu</nav><p>Shared template line of the site</p><p>The article body number {u} is long enough</p><p>short</p></body></html>"


def make_fake():
    def fake(url):
        if url == "feed:a":
            entries = [("Hall one opens", "1", "Fri, 14 Aug 2026 22:10:00 GMT"), ("Hall two opens", "2", "Fri, 14 Aug 2026 22:10:00 GMT"), ("Other topic", "3", ""), ("Hall old", "4", "Fri, 14 Aug 2020 22:10:00 GMT"), ("Hall three opens", "5", ""), ("Hall capped", "6", "")]
            return FEED.format("".join(ENTRY.format(t=t, u=u, d=d) for t, u, d in entries)).encode()
        if url == "feed:b":
            return FEED.format(ENTRY.format(t="Hall one opens", u="9", d="") + ENTRY.format(t="Hall four opens", u="8", d="")).encode()
        if url.startswith("https://s.example/"):
            if url.endswith("/2"):
                raise OSError("no page")
            return PAGE.format(u=url[-1]).encode()
        raise RuntimeError("down")

    return fake


def test_collection_run(spark, tmp_path):
    (tmp_path / "s.yaml").write_text(
        '[{"id": "a", "name": "A", "url": "feed:a", "tier": "primary", "fetch_body": true, "max_items": 5, "rate_limit_sec": 0, "title_pattern": "Hall", "max_age_days": 60},'
        ' {"id": "b", "name": "B", "url": "feed:b", "fetch_body": true}, {"id": "c", "name": "C", "url": "feed:none"}, {"id": "d", "name": "D", "url": "u", "kind": "pdf"}, {"id": "e", "name": "E", "url": "feed:a", "enabled": false}]'
    )
    fake = make_fake()
    history = spark.createDataFrame([], "doc_id string")
    stored, report = collect(spark, load_sources(spark, str(tmp_path)), history, date(2026, 8, 31), fake, str(tmp_path / "out"))
    got = {r.source_id: r for r in report.collect()}
    assert (got["a"].fetched, got["a"].filtered, got["a"].aged_out, got["a"].kept, got["a"].written) == (5, 1, 1, 3, 3)
    assert (got["a"].status, got["a"].skipped, got["a"].bodies_failed, got["b"].skipped, got["c"].status) == ("ok", 0, 1, 1, "failed")
    assert got["b"].written == 1 and got["c"].error and "kind" in got["d"].error and "e" not in got
    files = sorted(p.relative_to(tmp_path / "out").as_posix() for p in (tmp_path / "out").rglob("*.md"))
    assert len(files) == 4 and all(f.startswith("2026/08/") for f in files)
    texts = {p.name[:1]: [] for p in (tmp_path / "out").rglob("*.md")}
    for p in (tmp_path / "out").rglob("*.md"):
        texts[p.name[:1]].append(p.read_text())
    assert sum("The article body number" in t for t in texts["a"]) == 2 and any("about Hall two opens" in t for t in texts["a"])
    assert not any("article body" in t for t in texts["b"])  # secondary: summary only
    again, _ = collect(spark, load_sources(spark, str(tmp_path)), stored.select("doc_id"), date(2026, 8, 31), fake)
    assert again.count() == 1 and again.first().file.startswith("b-")  # the title that was seen in the first run only


def test_bodies_are_tried_once_and_politely(spark):
    from weftline.plans.collection import with_bodies

    def fetch(url):
        if url == "bad":
            raise OSError("gone")
        return f"<p>The body of page {url} is long enough</p>".encode()

    def sleep(seconds):
        if seconds != 2.5:
            raise OSError("wrong pause")

    items = spark.createDataFrame([("s", "p1", True, 2.5), ("s", "bad", True, 2.5), ("s", "p3", False, 2.5)], "source_id string, url string, wanted boolean, rate_limit_sec double")
    got = {r.url: (r.body, r.body_error) for r in with_bodies(items, fetch, sleep).collect()}
    assert got == {"p1": ("The body of page p1 is long enough", None), "bad": (None, "gone"), "p3": (None, None)}
