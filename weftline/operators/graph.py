"""Kernels for the bounded graph (at most max_nodes nodes and max_edges edges, so they run on the driver in numpy)."""

from __future__ import annotations

from collections import deque

import numpy as np

Edge = tuple[str, str, float]


def adjacency(edges: list[Edge]) -> dict[str, dict[str, float]]:
    out: dict[str, dict[str, float]] = {}
    for a, b, w in sorted(edges):
        out.setdefault(a, {})[b] = w
        out.setdefault(b, {})[a] = w
    return dict(sorted(out.items()))


def components(near: dict[str, dict[str, float]]) -> list[list[str]]:
    """Connected components, the largest first."""
    seen: set[str] = set()
    found = []
    for start in near:
        if start in seen:
            continue
        seen.add(start)
        queue, part = deque([start]), []
        while queue:
            node = queue.popleft()
            part.append(node)
            for other in near[node]:
                if other not in seen:
                    seen.add(other)
                    queue.append(other)
        found.append(sorted(part))
    return sorted(found, key=lambda p: (-len(p), p[0]))


def betweenness(near: dict[str, dict[str, float]], max_nodes: int = 1200) -> dict[str, float]:
    """Share of unweighted shortest paths through each node, normalised; zeros beyond max_nodes."""
    n = len(near)
    total = dict.fromkeys(near, 0.0)
    if n > max_nodes or n < 3:
        return total
    for source in near:
        order, parents = [], {v: [] for v in near}
        paths, depth = dict.fromkeys(near, 0), {source: 0}
        paths[source] = 1
        queue = deque([source])
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in near[v]:
                if w not in depth:
                    depth[w] = depth[v] + 1
                    queue.append(w)
                if depth[w] == depth[v] + 1:
                    paths[w] += paths[v]
                    parents[w].append(v)
        share = dict.fromkeys(near, 0.0)
        for w in reversed(order):
            for v in parents[w]:
                share[v] += paths[v] / paths[w] * (1 + share[w])
            if w != source:
                total[w] += share[w]
    return {v: round(x / ((n - 1) * (n - 2)), 5) for v, x in total.items()}


def modularity(near: dict[str, dict[str, float]], group: dict[str, int]) -> float:
    twice = sum(sum(ws.values()) for ws in near.values())
    inside: dict[int, float] = {}
    degree: dict[int, float] = {}
    for v, ws in near.items():
        degree[group[v]] = degree.get(group[v], 0.0) + sum(ws.values())
        inside[group[v]] = inside.get(group[v], 0.0) + sum(w for u, w in ws.items() if group[u] == group[v])
    return sum(inside[g] / twice - (degree[g] / twice) ** 2 for g in degree) if twice else 0.0


def _move_nodes(near: dict, loops: dict, order: list) -> dict:
    """One level: nodes move to the neighbouring community of greatest gain until none does."""
    degree = {v: sum(ws.values()) + 2 * loops.get(v, 0.0) for v, ws in near.items()}
    twice = sum(degree.values())
    group = {v: i for i, v in enumerate(order)}
    held = {group[v]: degree[v] for v in order}
    moved = True
    while moved and twice:
        moved = False
        for v in order:
            links: dict[int, float] = {}
            for u, w in near[v].items():
                links[group[u]] = links.get(group[u], 0.0) + w
            own = group[v]
            held[own] -= degree[v]
            gain = lambda g: links.get(g, 0.0) - held[g] * degree[v] / twice  # noqa: E731, B023
            best = max(sorted(links), key=gain, default=own)
            if best != own and gain(best) > gain(own) + 1e-12:
                group[v] = best
                moved = True
            held[group[v]] += degree[v]
    return group


def communities(near: dict[str, dict[str, float]], tries: int = 16, seed: int = 42) -> dict[str, int]:
    """Louvain's method over several node orders, the partition of greatest modularity kept; 0 is the largest community."""
    if not near:
        return {}
    rng = np.random.default_rng(seed)
    best: dict[str, int] = {}
    score = -1.0
    for attempt in range(tries):
        level, loops = {v: dict(ws) for v, ws in near.items()}, {}
        of = {v: v for v in near}
        while True:
            order = sorted(level)
            if attempt:
                order = [order[i] for i in rng.permutation(len(order))]
            group = _move_nodes(level, loops, order)
            if len(set(group.values())) == len(level):
                break
            of = {v: group[g] for v, g in of.items()}
            merged: dict = {g: {} for g in group.values()}
            own: dict = {g: 0.0 for g in group.values()}
            for v, ws in level.items():
                own[group[v]] += loops.get(v, 0.0)
                for u, w in ws.items():
                    if group[u] == group[v]:
                        own[group[v]] += w / 2
                    else:
                        merged[group[v]][group[u]] = merged[group[v]].get(group[u], 0.0) + w
            level, loops = merged, own
        value = modularity(near, of)
        if value > score + 1e-12:
            score, best = value, of
    members: dict = {}
    for v in sorted(best):
        members.setdefault(best[v], []).append(v)
    ranked = sorted(members.values(), key=lambda m: (-len(m), m[0]))
    return {v: i for i, part in enumerate(ranked) for v in part}


def distances(near: dict[str, dict[str, float]], nodes: list[str]) -> np.ndarray:
    """Lengths of the shortest paths within one component; an edge is the shorter the more it weighs, between 1/2 and 2."""
    at = {v: i for i, v in enumerate(nodes)}
    length = np.full((len(nodes), len(nodes)), np.inf)
    np.fill_diagonal(length, 0.0)
    for v in nodes:
        for u, w in near[v].items():
            length[at[v], at[u]] = 1 / (0.5 + min(max(w, 0.0), 1.5))
    for k in range(len(nodes)):
        np.minimum(length, length[:, k, None] + length[None, k], out=length)
    return length


def stress_layout(wanted: np.ndarray, iterations: int) -> np.ndarray:
    """Places whose distances come near the wanted ones: each step puts all nodes where a bound on the squared misfit is least.

    Begins with the two greatest axes of the doubly centred squares, so there is no random start.
    """
    n = len(wanted)
    if n == 1:
        return np.zeros((1, 2))
    centre = np.eye(n) - 1 / n
    value, axis = np.linalg.eigh(-0.5 * centre @ (wanted**2) @ centre)
    place = axis[:, -2:] * np.sqrt(np.maximum(value[-2:], 0.0))
    turn = np.arange(n) * np.pi * (3 - 5**0.5)
    place = place + 1e-3 * np.column_stack([np.cos(turn), np.sin(turn)])  # nodes in one spot come apart
    for _ in range(iterations):
        gap = np.linalg.norm(place[:, None] - place[None], axis=-1)
        ratio = np.where(gap > 1e-9, wanted / np.maximum(gap, 1e-9), 0.0)
        place = (place * ratio.sum(axis=1)[:, None] - ratio @ place) / n
        place -= place.mean(axis=0)
    return place


def layout(near: dict[str, dict[str, float]], iterations: int = 200) -> dict[str, tuple[float, float]]:
    """Components laid out one by one and set side by side in rows, the farthest coordinate at 1000.

    Each stands in a square of its own, the squares of a row as high as its first, so none overlap however many there are.
    """
    shapes = []
    for part in components(near):
        shape = stress_layout(distances(near, part), iterations)
        shapes.append((part, shape, 2 * float(np.abs(shape).max()) + 1.0))
    shapes.sort(key=lambda s: (-s[2], s[0][0]))
    width = max(shapes[0][2], sum(side * side for *_, side in shapes) ** 0.5) if shapes else 0.0
    out: dict[str, np.ndarray] = {}
    x = y = height = 0.0
    for part, shape, side in shapes:
        if x and x + side > width + 1e-9:
            x, y, height = 0.0, y + height, 0.0
        height = max(height, side)
        out |= {v: shape[i] + (x + side / 2, y + side / 2) for i, v in enumerate(part)}
        x += side
    if not out:
        return {}
    all_places = np.array(list(out.values()))
    middle = (all_places.max(axis=0) + all_places.min(axis=0)) / 2
    reach = float(np.abs(all_places - middle).max())
    scale = 1000 / reach if reach else 1.0
    return {v: (round(float(p[0] - middle[0]) * scale, 2), round(float(p[1] - middle[1]) * scale, 2)) for v, p in out.items()}
