import itertools
import math
import random

from weftline.llm import pairs, terms

SCHEMA = "basket_id bigint, doc_id string, unit int, nodes array<string>, node_id string, df int"


def sample(n=300, seed=3):
    rng = random.Random(seed)
    words = [f"t:w{i}" for i in range(25)] + ["T:W1 ", "ｔ：ｗ２", None, " ", ""]
    weights = [60 // (i + 1) + 1 for i in range(25)] + [3] * 5
    rows = [(i, f"d{i % 40}" if i % 50 else None, i % 7, rng.choices(words, weights, k=rng.randrange(0, 8)), "clash", 1) for i in range(n)]
    return rows + rows[:30] + [(999, "d1", None, None, None, None)]


def brute(rows):
    import unicodedata

    fold = lambda s: unicodedata.normalize("NFKC", s).strip().lower()
    baskets, occ = {}, {}
    for _, doc, unit, nodes, _, _ in rows:
        for n in nodes or []:
            if n is not None and fold(n):
                baskets.setdefault((doc, unit), set()).add(fold(n))
                occ.setdefault((doc, unit), []).append(fold(n))
    kept = {k: v for k, v in baskets.items() if len(v) >= 2}
    df, occurrences = {}, {}
    for k, v in kept.items():
        for x in v:
            df[x] = df.get(x, 0) + 1
        for x in occ[k]:
            occurrences[x] = occurrences.get(x, 0) + 1
    return kept, df, occurrences


def test_frequencies(spark):
    rows = sample()
    kept, df, occ = brute(rows)
    got = {r.node_id: r for r in terms.node_frequencies(spark.createDataFrame(rows, SCHEMA), 10, 0.3).collect()}
    assert {k: (r.occurrences, r.df) for k, r in got.items()} == {k: (occ[k], df[k]) for k in df}
    assert {k for k, r in got.items() if r.mark == "rare"} == {k for k in df if df[k] < 10}
    assert {k for k, r in got.items() if r.mark == "common"} == {k for k in df if df[k] >= 10 and df[k] > 0.3 * len(kept)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert terms.node_frequencies(empty).count() == 0 and pairs.associated_pairs(empty).count() == 0


def test_pairs_match_brute_force(spark, monkeypatch):
    rows = sample()
    kept, df, _ = brute(rows)
    n, want = len(kept), {}
    for v in kept.values():
        for a, b in itertools.combinations(sorted(v), 2):
            want[a, b] = want.get((a, b), 0) + 1
    scored = {}
    for (a, b), c in want.items():
        s = 1.0 if c == n else math.log((c / n) / ((df[a] / n) * (df[b] / n))) / -math.log(c / n)
        if c >= 3 and min(df[a], df[b]) >= 4 and s >= -0.1:
            scored[a, b] = (c, round(s, 9))
    monkeypatch.setattr(pairs, "BLOCK_TOKENS", 50)  # many blocks
    for heavy in (0, 5, 512):
        table = spark.createDataFrame(rows, SCHEMA)
        base, total = terms.graph_pairs(table)
        counts, items = pairs.count_pairs(base, terms.term_frequencies(base), 4, heavy)
        name = {r.iid: r.node_id for r in items.collect()}
        got = {tuple(sorted((name[r.ia], name[r.ib]))): r.cnt for r in counts.collect()}
        assert total == n and got == {p: c for p, c in want.items() if min(df[p[0]], df[p[1]]) >= 4}
    got = {(r.a, r.b): (r.cooc, round(r.npmi, 9)) for r in pairs.associated_pairs(spark.createDataFrame(rows, SCHEMA), min_npmi=-0.1).collect()}
    assert got == scored


def test_block_counts_a_long_basket():
    import numpy as np

    a, b, c = pairs.count_block(np.zeros(400, np.int64), np.arange(400, dtype=np.int64), 150)
    assert len(a) == 400 * 399 // 2 and set(c) == {1} and (a < b).all()
