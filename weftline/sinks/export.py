"""Outputs of the bounded graph and its articles: GEXF, CSV, JSON, HTML and a Markdown report.

The graph has at most max_nodes nodes and max_edges edges, so its tables are collected; articles are written from rows in
order, one at a time.
"""

from __future__ import annotations

import csv
import html
import json
import xml.etree.ElementTree as ET
from collections.abc import Iterable
from pathlib import Path

from weftline.functions.scalars import GROUP_LABEL, GROUP_RGB, GROUP_SHAPE

NODE_HEADER = ["Id", "Label", "kind", "group", "df", "degree", "strength", "betweenness", "community"]
EDGE_HEADER = ["Source", "Target", "Type", "Weight", "cooc", "npmi", "jaccard", "surprise", "is_new"]
ARTICLE_HEADER = ["date", "title", "source", "tier", "url", "nodes", "snippet"]
MARKER = "/*__GRAPH_DATA__*/null"


def _csv(path: str, header: list[str], rows: Iterable[list]) -> None:
    with open(path, "w", encoding="utf-8-sig", newline="") as file:
        writer = csv.writer(file, lineterminator="\n")
        writer.writerow(header)
        writer.writerows(rows)


def write_nodes_csv(path: str, nodes: list[dict]) -> None:
    ranked = sorted(nodes, key=lambda n: (-n["strength"], n["id"]))
    _csv(path, NODE_HEADER, ([n["id"], n["label"], n["kind"], n["node_group"], n["df"], n["degree"], n["strength"], n["betweenness"], n["community"]] for n in ranked))


def write_edges_csv(path: str, edges: list[dict]) -> None:
    ranked = sorted(edges, key=lambda e: (-e["npmi"], -e["cooc"], e["a"], e["b"]))
    blank = lambda v: "" if v is None else v
    _csv(path, EDGE_HEADER, ([e["a"], e["b"], "Undirected", e["npmi"], e["cooc"], e["npmi"], e["jaccard"], blank(e.get("surprise")), bool(e.get("is_new"))] for e in ranked))


def write_articles_csv(path: str, articles: Iterable[dict], labels: dict[str, str]) -> None:
    _csv(path, ARTICLE_HEADER, ([a["date"], a["title"], a["source"], a["tier"], a["url"], " ".join(labels.get(n, n) for n in a["nodes"]), a["snippet"]] for a in articles))


def write_gexf(path: str, nodes: list[dict], edges: list[dict]) -> None:
    """GEXF 1.2 with colour, size and position in the viz namespace."""
    base, viz = "http://www.gexf.net/1.2draft", "http://www.gexf.net/1.2draft/viz"
    ET.register_namespace("", base)
    ET.register_namespace("viz", viz)
    root = ET.Element(f"{{{base}}}gexf", {"version": "1.2"})
    graph = ET.SubElement(root, f"{{{base}}}graph", {"defaultedgetype": "undirected", "mode": "static"})
    kinds = {"node": [("kind", "string"), ("node_group", "string"), ("df", "long"), ("degree", "long"), ("strength", "double"), ("betweenness", "double"), ("community", "long")]}
    kinds["edge"] = [("cooc", "long"), ("npmi", "double"), ("jaccard", "double"), ("npmi_recent", "double"), ("npmi_baseline", "double"), ("surprise", "double"), ("is_new", "boolean")]
    for of, columns in kinds.items():
        listed = ET.SubElement(graph, f"{{{base}}}attributes", {"class": of, "mode": "static"})
        for i, (name, kind) in enumerate(columns):
            ET.SubElement(listed, f"{{{base}}}attribute", {"id": f"{of[0]}{i}", "title": name, "type": kind})

    def values(element: ET.Element, of: str, row: dict) -> None:
        box = ET.SubElement(element, f"{{{base}}}attvalues")
        for i, (name, kind) in enumerate(kinds[of]):
            if row.get(name) is not None:
                text = str(row[name]).lower() if kind == "boolean" else str(row[name])
                ET.SubElement(box, f"{{{base}}}attvalue", {"for": f"{of[0]}{i}", "value": text})

    box = ET.SubElement(graph, f"{{{base}}}nodes")
    for n in sorted(nodes, key=lambda n: n["id"]):
        element = ET.SubElement(box, f"{{{base}}}node", {"id": n["id"], "label": n["label"]})
        values(element, "node", n)
        red, green, blue = GROUP_RGB[n["node_group"]]
        ET.SubElement(element, f"{{{viz}}}color", {"r": str(red), "g": str(green), "b": str(blue)})
        ET.SubElement(element, f"{{{viz}}}size", {"value": str(n["size"])})
        ET.SubElement(element, f"{{{viz}}}position", {"x": str(n["x"]), "y": str(n["y"]), "z": "0.0"})
    box = ET.SubElement(graph, f"{{{base}}}edges")
    for i, e in enumerate(sorted(edges, key=lambda e: (e["a"], e["b"]))):
        element = ET.SubElement(box, f"{{{base}}}edge", {"id": str(i), "source": e["a"], "target": e["b"], "weight": str(e["npmi"])})
        values(element, "edge", e)
    ET.ElementTree(root).write(path, encoding="utf-8", xml_declaration=True)


def payload(nodes: list[dict], edges: list[dict], articles: list[dict], meta: dict) -> dict:
    """Nodes, edges and articles that point at each other by index."""
    at = {n["id"]: i for i, n in enumerate(nodes)}
    listed = [{**a, "nodes": [at[n] for n in a["nodes"] if n in at]} for a in articles]
    of_node: dict[int, list[int]] = {}
    for i, a in enumerate(listed):
        for n in a["nodes"]:
            of_node.setdefault(n, []).append(i)
    return {
        "nodes": [{**n, "articles": of_node.get(i, [])} for i, n in enumerate(nodes)],
        "edges": [{**e, "a": at[e["a"]], "b": at[e["b"]]} for e in edges if e["a"] in at and e["b"] in at],
        "articles": listed,
        "meta": {**meta, "n_nodes": len(nodes), "n_edges": len(edges), "n_articles": len(articles), "has_trend": any(e.get("surprise") is not None for e in edges)},
    }


def write_json(path: str, data: dict) -> None:
    Path(path).write_text(json.dumps(data, ensure_ascii=False, separators=(",", ":")), encoding="utf-8")


PAGE = """<!doctype html><meta charset="utf-8"><title>%s</title>
<style>body{font:15px/1.5 sans-serif;margin:1rem;max-width:60rem}input,select{font:inherit;margin-right:.5rem}li{margin:.4rem 0}small{color:#666}</style>
<h1>%s</h1><input id="q" placeholder="検索"><select id="s"></select><span id="n"></span><ol id="list"></ol><button id="more">続き</button>
<script>
const data = /*__GRAPH_DATA__*/null;
%s
</script>
"""
LIST_SCRIPT = """
const byId = (id) => document.getElementById(id);
const rows = data.articles.map((a) => ({...a, labels: a.nodes.map((i) => data.nodes[i].label)}));
const counts = {};
rows.forEach((a) => { if (a.source) counts[a.source] = (counts[a.source] || 0) + 1; });
byId("s").innerHTML = '<option value="">すべて</option>';
Object.entries(counts).sort((x, y) => y[1] - x[1]).forEach(([name, n]) => byId("s").add(new Option(`${name} (${n})`, name)));
let shown = 60;
function draw() {
  const text = byId("q").value.toLowerCase(), source = byId("s").value;
  const hits = rows.filter((a) => (!source || a.source === source) && [a.title, a.snippet, a.source, a.labels.join(" ")].join(" ").toLowerCase().includes(text));
  byId("n").textContent = hits.length;
  byId("list").replaceChildren(...hits.slice(0, shown).map((a) => {
    const item = document.createElement("li");
    const small = document.createElement("small");
    small.textContent = ` ${a.date} ${a.source} — ${a.labels.slice(0, 8).join("、")}`;
    item.append(a.title, small);
    return item;
  }));
}
byId("q").oninput = byId("s").onchange = () => { shown = 60; draw(); };
byId("more").onclick = () => { shown += 120; draw(); };
draw();
"""
GRAPH_SCRIPT = """
const rows = data.edges.slice().sort((x, y) => y.npmi - x.npmi);
const list = document.getElementById("list");
function draw() {
  const text = document.getElementById("q").value;
  const hits = rows.filter((e) => !text || [e.a, e.b].some((i) => data.nodes[i].label.includes(text)));
  document.getElementById("n").textContent = hits.length;
  list.replaceChildren(...hits.slice(0, 200).map((e) => {
    const item = document.createElement("li");
    item.textContent = `${data.nodes[e.a].label} — ${data.nodes[e.b].label} ${e.npmi}`;
    return item;
  }));
}
document.getElementById("q").oninput = draw;
draw();
"""


def write_html(path: str, data: dict, title: str, script: str) -> None:
    """A page that holds its data and needs nothing from elsewhere."""
    whole = PAGE % (html.escape(title), html.escape(title), script)
    text = json.dumps(data, ensure_ascii=False, separators=(",", ":")).replace("</", "<\\/")
    Path(path).write_text(whole.replace(MARKER, text, 1), encoding="utf-8")


def _table(header: list[str], rows: Iterable[list]) -> list[str]:
    head = ["| # | " + " | ".join(header) + " |", "|---:" * (len(header) + 1) + "|"]
    return head + ["| " + " | ".join(map(str, [i, *r])) + " |" for i, r in enumerate(rows, 1)]


def report(meta: dict, nodes: list[dict], edges: list[dict], neighbourhoods: list[dict], communities: list[dict], recent: list[dict]) -> str:
    """The ranked sections as Markdown; an empty graph says so and ends there."""
    lines = ["# 語のつながり 分析レポート", "", f"生成: {meta.get('generated_at', '')}", "", "| 項目 | 値 |", "|---|---|"]
    lines += [f"| 記事数 | {meta['n_articles']} |", f"| 対象期間 | {meta['period']} |", f"| 共起単位数 | {meta['n_baskets']} |"]
    lines += [f"| ノード数 | {len(nodes)}（絞り込み前 {meta['n_nodes_before']}） |", f"| エッジ数 | {len(edges)}（絞り込み前 {meta['n_edges_before']}） |", ""]
    if not nodes:
        return "\n".join([*lines, "共起グラフは空です。記事を増やすか、閾値を下げてください。", ""])
    label = {n["id"]: n["label"] for n in nodes}
    by = lambda key, k: sorted(nodes, key=lambda n: (-n[key], n["id"]))[:k]
    pairs = sorted(edges, key=lambda e: (-e["npmi"], -e["cooc"], e["a"], e["b"]))
    sections = [("頻出ノード", _table(["ノード", "種別", "出現数", "次数", "媒介中心性"], ([n["label"], GROUP_LABEL[n["node_group"]], n["df"], n["degree"], f"{n['betweenness']:.4f}"] for n in by("df", 30))))]
    sections += [("橋渡しのノード", _table(["ノード", "媒介中心性"], ([n["label"], f"{n['betweenness']:.4f}"] for n in by("betweenness", 15))))]
    sections += [("結びつきの強い組", _table(["組", "NPMI", "共起数"], ([f"{label[e['a']]} — {label[e['b']]}", e["npmi"], e["cooc"]] for e in pairs[:30])))]
    moved = sorted((e for e in edges if e.get("surprise") is not None), key=lambda e: (-e["surprise"], e["a"], e["b"]))[:20]
    if moved:
        sections += [("最近強まった組", _table(["組", "変化", "最近", "以前"], ([f"{'★' if e['is_new'] else ''}{label[e['a']]} — {label[e['b']]}", e["surprise"], e["npmi_recent"], e["npmi_baseline"]] for e in moved)))]
    sections += [("施設・政策のまわり", _table(["ノード", "近いノード"], ([n["label"], "、".join(n["near"] or [])] for n in neighbourhoods)))]
    sections += [("まとまり", _table(["番号", "大きさ", "主なノード"], ([c["community"], c["size"], "、".join(c["labels"])] for c in communities)))]
    sections += [("最近の記事", _table(["日付", "見出し", "媒体"], ([a["date"], a["title"], a["source"]] for a in recent[:20])))]
    for title, rows in sections:
        lines += [f"## {title}", "", *rows, ""]
    lines += ["## 注意", "", "- 共起は因果を意味しない。", "- 日付のない記事は以前の側に数える。", "- 最近の側は暦日ではなく、記事のある日付で数える。", f"- 形: {', '.join(f'{GROUP_LABEL[g]}={s}' for g, s in GROUP_SHAPE.items())}", ""]
    return "\n".join(lines)
