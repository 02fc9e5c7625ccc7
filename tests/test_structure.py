import random

import pytest

from loomspan.operators import alignments as al
from loomspan.operators import graph, relational, trees

def test_tree_distances_and_newick(spark):
    """A random tree, 150 deep, against walks to the root."""
    rng = random.Random(12)
    parent = {f"v{i}": (f"v{i - 1}" if i < 150 else f"v{rng.randrange(i)}") if i else None for i in range(200)}
    length = {k: rng.randint(1, 9) / 4 for k in parent}
    tree = spark.createDataFrame([(k, p, length[k]) for k, p in parent.items()], "id string, parent string, length double")

    def way(x):
        out = [(x, 0.0)]
        while parent[out[-1][0]] is not None:
            out.append((parent[out[-1][0]], out[-1][1] + length[out[-1][0]]))
        return dict(out)

    pairs = [(rng.choice(list(parent)), rng.choice(list(parent))) for _ in range(40)]
    got = {(r["a"], r["b"]): (r["lca"], r["dist"]) for r in trees.ancestors_in_common(tree, spark.createDataFrame(pairs, "a string, b string").distinct()).collect()}
    for a, b in pairs:
        up = way(a)
        lca = next(x for x in way(b) if x in up)
        assert got[a, b] == (lca, pytest.approx(up[lca] + way(b)[lca]))
    assert trees.closure(tree).count() == sum(len(way(x)) for x in parent)


def test_newick(spark):
    text = "((p:1.5,q:2)r:0.25,(s,t:3)u:4)w;"
    rows = trees.parse_newick(text)
    assert sorted(trees.parse_newick(trees.write_newick(trees.read_newick(spark, text)).first()["newick"])) == sorted(rows) and len(rows) == 7
    with pytest.raises(ValueError, match="unbalanced"):
        trees.parse_newick("((p,q);")


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for e in edges for x in e}


def test_greedy_break_up(spark):
    edges = spark.createDataFrame([(1, 2, 9.0), (2, 3, 8.0), (3, 4, 7.0), (4, 1, 6.0)], "a long, b long, score double")
    out = graph.break_up_greedily(edges, graph.connected_components(edges), 3)
    assert {(r["a"], r["b"]): r["kept"] for r in out.collect()} == {(1, 2): True, (2, 3): True, (3, 4): False, (4, 1): False}


def test_chains_and_levels(spark):
    rows = [(1, "q", 100, 0, 10, "+", "t", 0, 10, 5.0), (2, "q", 100, 12, 20, "+", "t", 15, 23, 4.0), (3, "q", 100, 50, 60, "+", "t", 5, 15, 1.0), (4, "q", 100, 0, 20, "+", "u", 0, 20, 2.0)]
    df = spark.createDataFrame(rows, "id long, query string, qlen long, qstart long, qend long, strand string, target string, tstart long, tend long, score double")
    got = {r["id"]: (r["chain_id"], r["chain_score"]) for r in al.chain(df, 10).collect()}
    assert got == {1: (2, 9.0), 2: (2, 9.0), 3: (3, 1.0), 4: (4, 2.0)}
    assert {r["id"]: r["level"] for r in al.tile(df).collect()} == {1: 1, 2: 1, 3: 1, 4: 2}


def test_parent_cycle(spark):
    links = spark.createDataFrame([(1, 2), (2, 1)], "c long, p long")
    with pytest.raises(ValueError, match="cycle"):
        relational.follow_parents(links, "c", "p", rounds=3)


def test_must_match(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(Exception, match="no match"):
        relational.require_match(a, b, ["k"], "thing").collect()


def test_sides_choose_their_own_first_level(spark):
    """a and b lie on the same bases of q; o, an outgroup's, lies there too. Together the best one of three is
    left, apart the best of a and b, and o."""
    row = lambda i, target, matches: (i, "q", 1000, 100, 200, "+", target, 5000, 10 * i, 10 * i + 100, matches, 100, float(matches))
    schema = "id long, query string, qlen long, qstart long, qend long, strand string, target string, tlen long, tstart long, tend long, matches long, block long, score double"
    df = spark.createDataFrame([row(1, "a", 90), row(2, "b", 80), row(3, "o", 95)], schema)
    together = {r["id"] for r in al.select_primary(df, 100, 0.0).collect()}
    apart = {(r["id"], r["outgroup"]) for r in al.select_primary_by_side(df, ["o"], 100, 0.0).collect()}
    assert together == {3} and apart == {(1, False), (3, True)}


def plain_chains(rows, max_gap):
    """Every row against every earlier one: id -> (chain, score)."""
    out = {}
    for key in {(r["query"], r["target"], r["strand"]) for r in rows}:
        own = sorted((r for r in rows if (r["query"], r["target"], r["strand"]) == key), key=lambda r: (r["tstart"], r["qstart"], r["id"]))
        at = [(r["tstart"], r["tend"], *((r["qstart"], r["qend"]) if key[2] == "+" else (r["qlen"] - r["qend"], r["qlen"] - r["qstart"]))) for r in own]
        total, before = [r["score"] for r in own], [None] * len(own)
        for i in range(len(own)):
            gains = [(total[j], -j) for j in range(i) if 0 <= at[i][0] - at[j][1] <= max_gap and 0 <= at[i][2] - at[j][3] <= max_gap]
            if gains:
                total[i], before[i] = total[i] + max(gains)[0], -max(gains)[1]
        for i in sorted(range(len(own)), key=lambda k: (-total[k], k)):
            k = i
            while k is not None and own[k]["id"] not in out:
                out[own[k]["id"]] = (own[i]["id"], total[i])
                k = before[k]
    return out


def plain_levels(rows):
    return {r["id"]: 1 + max((sum(o["qstart"] <= p < o["qend"] for o in rows if o["query"] == r["query"] and (-o["score"], o["id"]) < (-r["score"], r["id"])) for p in range(r["qstart"], r["qend"])), default=0) for r in rows}


def test_chains_and_levels_in_parts(spark, monkeypatch):
    """Keys whose rows part into many groups, with clusters, empty ranges and a column of a clashing name."""
    monkeypatch.setattr(al, "PART", 16)
    rng, rows = random.Random(3), []
    for i in range(150):
        q, t, n = rng.randrange(6) * 200 + rng.randrange(40), rng.randrange(5) * 300 + rng.randrange(60), rng.randrange(12)
        rows.append({"id": i, "query": rng.choice("ab"), "qlen": 2000, "qstart": q, "qend": q + n, "strand": rng.choice("++-"), "target": "t", "tstart": t, "tend": t + n, "score": float(rng.randrange(1, 9)), "start": i})
    df = spark.createDataFrame(rows, "id long, query string, qlen long, qstart long, qend long, strand string, target string, tstart long, tend long, score double, start long")
    got = al.chain(df, 25)
    assert got.columns == [*df.columns, "chain_id", "chain_score"]
    assert {r["id"]: (r["chain_id"], r["chain_score"]) for r in got.collect()} == plain_chains(rows, 25)
    assert {r["id"]: r["level"] for r in al.tile(df).collect()} == plain_levels(rows)
    parts = al._parted(df, ["query"], "qstart", "qend", 0)
    assert parts.select("query", "_part").distinct().count() > 6
