import itertools
import math
import random

from weftline.config import Config
from weftline.operators import cooccur

SCHEMA = "doc_id string, date string, nodes array<string>, a int"


def brute(baskets, cfg):
    kept = [sorted({n for n in b if n is not None}) for b in baskets if b]
    kept = [b for b in kept if len(b) >= 2]
    n, df, pairs = len(kept), {}, {}
    for b in kept:
        for x in b:
            df[x] = df.get(x, 0) + 1
        for p in itertools.combinations(b, 2):
            pairs[p] = pairs.get(p, 0) + 1
    out = {}
    for (a, b), c in pairs.items():
        if c < cfg.min_cooc or min(df[a], df[b]) < cfg.min_df:
            continue
        s = 1.0 if c >= n else math.log((c / n) / ((df[a] / n) * (df[b] / n))) / -math.log(c / n)
        if s >= cfg.min_npmi:
            out[a, b] = (c, round(s, 4), round(c / (df[a] + df[b] - c), 4))
    return n, len(df), len(pairs), out


def sample(seed=1, n=60):
    rng = random.Random(seed)
    words = [f"n{i}" for i in range(12)]
    out = [(str(i), f"2026-01-{1 + i % 9:02d}", rng.choices(words, k=rng.randrange(0, 6)) + [None], 1) for i in range(n)]
    return out + [("x", None, None, 2), ("y", None, [], 3)]


def test_edges_match_brute_force(spark, listed):
    data = sample()
    cfg = Config(min_df=4, min_cooc=2, min_npmi=0.05)
    df = spark.createDataFrame(data, SCHEMA)
    n, n_nodes, n_pairs, want = brute([r[2] for r in data], cfg)
    got = {(r.a, r.b): (r.cooc, r.npmi, r.jaccard) for r in cooccur.edges(df, cfg).collect()}
    assert got == want
    stats = cooccur.prefilter_stats(df).first()
    assert (stats.n_baskets, stats.n_nodes, stats.n_edges) == (n, n_nodes, n_pairs)


def test_pair_in_every_basket_scores_one(spark):
    df = spark.createDataFrame([("1", None, ["a", "b"], 1), ("2", None, ["b", "a", "a"], 1)], SCHEMA)
    assert [tuple(r)[:5] for r in cooccur.edges(df, Config(min_df=1, min_cooc=1)).collect()] == [("a", "b", 2, 1.0, 1.0)]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert cooccur.edges(df, Config()).count() == 0
    assert cooccur.edges_with_trend(df, Config()).count() == 0


def test_trend_counts_dates_that_occur(spark):
    def baskets(days, per=5):
        return spark.createDataFrame([(f"{d}{k}", d, ["a", "b"], 1) for d in days for k in range(per)] + [("u", None, ["a", "b"], 1)], SCHEMA)

    seven = [f"2026-01-{d:02d}" for d in range(1, 8)]
    assert cooccur.trend_split(baskets(seven), Config()).cutoff == "2026-01-07"  # exactly recent_days dates: the last one alone
    eight = seven + ["2026-02-01"]
    split = cooccur.trend_split(baskets(eight), Config())
    assert (split.cutoff, split.n_base) == ("2026-01-02", 6)  # undated baskets are older ones
    assert cooccur.trend_split(baskets(eight, 1), Config()) is None
    assert cooccur.trend_split(baskets(seven[:1]), Config()) is None


def test_new_pair_has_surprise(spark):
    old = [(f"o{i}", f"2026-01-{1 + i:02d}", ["a", "c"] if i % 2 else ["b", "d"], 1) for i in range(8)]
    new = [(f"n{i}", "2026-02-01", ["a", "b"], 1) for i in range(5)] + [("m", "2026-02-02", ["c", "d"], 1)]
    cfg = Config(min_df=1, min_cooc=1, min_npmi=-1, recent_days=2)
    got = {(r.a, r.b): r for r in cooccur.edges_with_trend(spark.createDataFrame(old + new, SCHEMA), cfg).collect()}
    assert got["a", "b"].is_new and got["a", "b"].npmi_baseline == 0.0 and got["a", "b"].surprise > 0
    assert not got["a", "c"].is_new


def test_rankings_break_ties_by_name(spark):
    edges = spark.createDataFrame([("a", "b", 3, 0.5), ("a", "c", 3, 0.5), ("b", "d", 4, 0.5), ("e", "f", 1, 0.9)], "a string, b string, cooc bigint, npmi double")
    assert [(r.a, r.b) for r in cooccur.top_edges(edges, 3).collect()] == [("e", "f"), ("b", "d"), ("a", "b")]
    metric = {r.node: (r.degree, r.strength) for r in cooccur.node_metrics(edges).collect()}
    assert metric["a"] == (2, 1.0) and metric["f"] == (1, 0.9)
    near = [(r.rank, r.neighbour) for r in cooccur.neighbours(edges, 1).where("node = 'a'").collect()]
    assert near == [(1, "b")]
    assert {(r.a, r.b) for r in cooccur.strongest_subgraph(edges, 2).collect()} == {("a", "b")}
