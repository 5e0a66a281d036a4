import csv
import json
import xml.etree.ElementTree as ET

from weftline.config import Config
from weftline.operators import textproc
from weftline.plans.analysis import analyse
from weftline.sources.dictionaries import load_entities
from weftline.streaming.incremental import ingest

TEXT = ["museum plan meets theatre fund. archive hall opens", "museum plan and theatre fund grow. archive hall opens again", "theatre fund saves museum plan. archive hall"]


def articles(spark, n=12):
    rows = [(str(i), f"title {i}", TEXT[i % 3], f"u{i}", f"2026-01-{1 + i:02d}", "src", f"p{i}", [], "primary") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id string, title string, body string, url string, date string, source string, path string, tags array<string>, tier string")


def test_run_writes_everything(spark, tmp_path):
    cfg = Config(unit="doc", min_df=2, min_cooc=2, min_npmi=-1.0, layout_iterations=10)
    entities = spark.createDataFrame([("facility:hall", "Hall", "facility", ["archive hall"], {})], "id string, label string, etype string, aliases array<string>, meta map<string,string>")
    meta = analyse(spark, articles(spark), entities, set(), cfg, str(tmp_path), textproc.latin_tokens)
    assert meta["n_articles"] == 12 and meta["n_baskets"] == 12
    data = json.loads((tmp_path / "graph.json").read_text())
    assert all(data["nodes"][e["a"]]["id"] < data["nodes"][e["b"]]["id"] for e in data["edges"])
    assert {n["id"] for n in data["nodes"]} >= {"facility:hall"}
    hall = next(i for i, n in enumerate(data["nodes"]) if n["id"] == "facility:hall")
    assert all(hall in data["articles"][p]["nodes"] for p in data["nodes"][hall]["articles"])
    with open(tmp_path / "edges.csv", encoding="utf-8-sig") as file:
        assert list(csv.reader(file))[0][:4] == ["Source", "Target", "Type", "Weight"]
    assert (tmp_path / "nodes.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    assert len(ET.parse(tmp_path / "graph.gexf").getroot().findall(".//{*}node")) == len(data["nodes"])
    assert "語のつながり" in (tmp_path / "report.md").read_text() and "__GRAPH_DATA__" not in (tmp_path / "graph.html").read_text()


def test_no_articles_gives_a_report_only(spark, tmp_path):
    analyse(spark, articles(spark, 0), load_entities(spark, str(tmp_path / "none")), set(), Config(), str(tmp_path / "out"))
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["report.md"]


def test_stream_stores_each_item_once(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    store, marks = f"file://{tmp_path}/store", f"file://{tmp_path}/marks"
    for name, urls in (("1.json", ["a", "b", "b"]), ("2.json", ["b", "c"])):
        (inbox / name).write_text("\n".join(json.dumps({"url": u, "title": "t"}) for u in urls))
        ingest(spark, f"file://{inbox}", "url string, title string", store, marks).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(store).collect()) == ["a", "b", "c"]


def test_entry_works_without_subpackage():
    import subprocess
    import sys

    code = "import sys; sys.modules['weftline.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__import__("conftest").ROOT)
    assert out.returncode == 0 and int(out.stdout.split()[0]) > 50
