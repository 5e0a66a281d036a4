"""Logical schemas as Spark types."""

from __future__ import annotations

SOURCE = (
    "id string, name string, url string, kind string, tier string, country string, lang string, enabled boolean, fetch_body boolean, "
    "max_items int, rate_limit_sec double, link_pattern string, title_pattern string, max_age_days int, note string"
)
ITEM = "source_id string, pos int, title string, url string, summary string, published string, publisher string, body string, doc_id string"
DOC = "doc_id string, title string, body string, url string, date string, source string, path string, tags array<string>, tier string"
ENTITY = "id string, label string, etype string, aliases array<string>, meta map<string,string>"
TOKEN = "surface string, pos0 string, pos1 string, lemma string"
BASKET = "doc_id string, date string, unit int, nodes array<string>, text string"
EDGE = "a string, b string, cooc bigint, npmi double, jaccard double, npmi_recent double, npmi_baseline double, surprise double, is_new boolean"
NODE = "id string, label string, kind string, node_group string, df bigint, degree bigint, strength double, betweenness double, community int, x double, y double, size double"
