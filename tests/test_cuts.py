"""Bridges, pairs of edges that part a graph, and nested blocks, against removal of each edge."""

import os
import random

import pytest

from loomspan.operators import graph

EDGES = "a string, b string, rank long"


def components(nodes, edges):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b, _ in edges:
        parent[root(a)] = root(b)
    return len({root(x) for x in nodes})


def plain_cuts(edges):
    nodes = {x for a, b, _ in edges for x in (a, b)}
    whole = components(nodes, edges)
    without = lambda *gone: components(nodes, [e for e in edges if e not in gone])
    bridges = {e[2] for e in edges if without(e) > whole}
    found = {}
    for e in edges:
        if e[2] not in bridges:
            partners = [f[2] for f in edges if f != e and f[2] not in bridges and without(e, f) > whole]
            found[e[2]] = min([e[2], *partners])
    return bridges, found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_removal(spark, seed):
    rng = random.Random(seed)
    n = [9, 14, 20][seed - 1]
    ends = [(f"v{rng.randrange(n)}", f"v{rng.randrange(n)}") for _ in range(n + 4)]
    edges = [(a, b, 10 * k + rng.randrange(10)) for k, (a, b) in enumerate(ends)]
    bridges, cuts = plain_cuts(edges)
    got = graph.edge_cuts(spark.createDataFrame(edges, EDGES)).collect()
    assert {r["rank"] for r in got if r.bridge} == bridges
    assert {r["rank"]: r.cut for r in got if not r.bridge} == cuts
    assert len(got) == len(edges)


def test_a_long_path_a_star_and_a_ring(spark):
    path = [(f"p{k}", f"p{k + 1}", k) for k in range(200)]
    star = [("hub", f"s{k}", 1000 + k) for k in range(50)]
    ring = [(f"r{k}", f"r{(k + 1) % 40}", 2000 + k) for k in range(40)]
    got = {r["rank"]: (r.bridge, r.cut) for r in graph.edge_cuts(spark.createDataFrame(path + star + ring, EDGES)).collect()}
    assert all(got[e[2]] == (True, None) for e in path + star) and all(got[e[2]] == (False, 2000) for e in ring)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no tables here")
def test_the_query_of_nested_blocks(spark):
    """The graph of the query's blocks by plain walks: ends in groups, blocks as edges, each removed in turn."""
    from loomspan.plans import blocks, catalog

    sf = "/root/testdata/sf0.001"
    rows = sorted(tuple(r) for r in blocks.threads(spark, sf).select("seq", "start", "block", "strand").collect())
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    before, facing = None, {"+": ("L", "R"), "-": ("R", "L")}
    for seq, _, block, strand in rows:
        enter, leave = ((block, side) for side in facing[strand])
        if before is None or before[0] != seq:
            parent[root(enter)] = root("*")
            if before:
                parent[root(before[1])] = root("*")
        else:
            parent[root(before[1])] = root(enter)
        before = (seq, leave)
    parent[root(before[1])] = root("*")
    names = sorted({r[2] for r in rows})
    edges = [(root((b, "L")), root((b, "R")), b) for b in names]
    nodes = {x for a, b, _ in edges for x in (a, b)}
    whole = components(nodes, edges)
    bridges = {e[2] for e in edges if components(nodes, [f for f in edges if f is not e]) > whole}
    got = catalog.queries()["g9_nested_blocks"](spark, sf).collect()
    assert {r["block"] for r in got} == set(names) and {r["block"] for r in got if r["bridge"]} == bridges
    groups = {}
    for r in got:
        groups.setdefault(r["left"], set()).add(root((r["block"], "L")))
        groups.setdefault(r["right"], set()).add(root((r["block"], "R")))
    assert all(len(v) == 1 for v in groups.values()) and len(groups) == len(nodes)
