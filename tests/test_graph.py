import itertools
import random

from weftline.operators import graph


def ring(n):
    return [(f"v{i:02d}", f"v{(i + 1) % n:02d}", 1.0) for i in range(n)]


def slow_betweenness(near):
    nodes = list(near)
    total = dict.fromkeys(nodes, 0.0)
    for s, t in itertools.combinations(nodes, 2):
        level, paths = {s: [[s]]}, []
        frontier = [s]
        seen = {s}
        while frontier and not paths:
            following = {}
            for v in frontier:
                for w in near[v]:
                    if w not in seen:
                        following.setdefault(w, []).extend(p + [w] for p in level[v])
            paths = following.get(t, [])
            level, frontier = following, list(following)
            seen |= set(following)
        for p in paths:
            for v in p[1:-1]:
                total[v] += 1 / len(paths)
    n = len(nodes)
    return {v: round(2 * x / ((n - 1) * (n - 2)), 5) for v, x in total.items()}


def random_graph(n=14, p=0.25, seed=4):
    rng = random.Random(seed)
    return [(f"n{a:02d}", f"n{b:02d}", rng.random()) for a, b in itertools.combinations(range(n), 2) if rng.random() < p]


def test_betweenness_matches_path_enumeration():
    near = graph.adjacency(random_graph())
    assert graph.betweenness(near) == slow_betweenness(near)
    assert set(graph.betweenness(near, max_nodes=3).values()) == {0.0}


def test_components_by_size():
    parts = graph.components(graph.adjacency(ring(5) + [("x", "y", 1.0)]))
    assert [len(p) for p in parts] == [5, 2]


def test_communities_of_cliques():
    edges = [(f"{c}{a}", f"{c}{b}", 1.0) for c in "pqr" for a, b in itertools.combinations(range(5), 2)] + [("p0", "q0", 0.1), ("q1", "r0", 0.1)]
    near = graph.adjacency(edges)
    group = graph.communities(near)
    assert len(set(group.values())) == 3 and all(len({group[f"{c}{i}"] for i in range(5)}) == 1 for c in "pqr")
    assert graph.communities(near) == group and graph.modularity(near, group) > 0.6
    assert graph.communities({}) == {}


def test_layout_keeps_components_apart():
    near = graph.adjacency(ring(8) + [("x", "y", 1.0), ("s", "t", 1.0)])
    place = graph.layout(near, 50)
    assert max(abs(c) for p in place.values() for c in p) == 1000 and place == graph.layout(near, 50)
    assert len(set(place.values())) == len(place)
    assert graph.layout({}) == {}


def test_many_components_and_a_path():
    pairs = [(f"a{i:04d}", f"b{i:04d}", 0.5) for i in range(700)]
    place = graph.layout(graph.adjacency(pairs), 3)
    assert len(set(place.values())) == 1400
    path = graph.layout(graph.adjacency([(f"v{i}", f"v{i + 1}", 1.0) for i in range(6)]), 200)
    far = lambda a, b: ((path[a][0] - path[b][0]) ** 2 + (path[a][1] - path[b][1]) ** 2) ** 0.5
    assert far("v0", "v6") > far("v0", "v3") > far("v0", "v1")
