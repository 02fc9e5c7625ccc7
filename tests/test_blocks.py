"""Blocks, chains, filters and clipped alignments against brute force."""

import random

import pytest

from loomspan.functions import bases
from loomspan.operators import alignments as al
from loomspan.operators import blocks, clipping, trees
from loomspan.operators import intervals as iv
from loomspan.operators import relational as rel

MATCH = "a_seq string, a_start long, b_seq string, b_start long, length long, strand string"
BLOCK = "block string, seq string, start long, end long, strand string"


def closure_by_bases(matches):
    """Classes of (seq, pos, sign), base by base."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, i, b, j, n, s in matches:
        for k in range(n):
            for sign in "+-":
                x = (a, i + k, sign)
                y = (b, j + k if s == "+" else j + n - 1 - k, sign if s == "+" else "+-".replace(sign, ""))
                parent[root(x)] = root(y)
    classes = {}
    for x in list(parent):
        classes.setdefault(root(x), set()).add(x)
    return {x: frozenset(c) for c in classes.values() for x in c}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_anneal_is_the_closure(spark, seed):
    rng = random.Random(seed)
    matches = [(rng.choice("ab"), rng.randrange(40), rng.choice("bc"), rng.randrange(40), rng.randrange(1, 9), rng.choice("++-")) for _ in range(8)]
    found = [tuple(r) for r in blocks.anneal(spark.createDataFrame(matches, MATCH)).select("block", "seq", "start", "end", "strand").collect()]
    want = closure_by_bases(matches)
    members = {}
    for b, seq, start, end, strand in found:
        members.setdefault(b, []).append((seq, start, end, strand))
    assert {(s, p) for s, p, _ in want} == {(s, p) for ms in members.values() for s, a, e, _ in ms for p in range(a, e)}
    for ms in members.values():
        assert len({e - a for _, a, e, _ in ms}) == 1
        for k in range(ms[0][2] - ms[0][1]):
            column = {(s, a + k if t == "+" else e - 1 - k, t) for s, a, e, t in ms}
            classes = {want[x] for x in column}
            assert len(classes) == 1
            assert {x[:2] for x in next(iter(classes))} == {x[:2] for x in column}


def test_anneal_of_nothing(spark):
    assert blocks.anneal(spark.createDataFrame([], MATCH)).collect() == []


def test_within_components(spark):
    matches = spark.createDataFrame([("a", 0, "b", 100, 20, "+"), ("a", 0, "b", 100, 20, "-")], MATCH)
    labels = spark.createDataFrame([("a", 0, 10, 1), ("a", 10, 30, 2), ("b", 100, 105, 1), ("b", 105, 120, 2)], "seq string, start long, end long, label long")
    got = sorted(tuple(r) for r in blocks.within_components(matches, labels).collect())
    # Forward: a 0-5 with b 100-105 (label 1), a 10-20 with b 110-120 (label 2); reverse: a 10-15 faces b 105-110.
    assert got == [("a", 0, "b", 100, 5, "+"), ("a", 10, "b", 105, 5, "-"), ("a", 10, "b", 110, 10, "+")]


ROWS = [
    ("x", "s", 0, 10, "+"), ("y", "s", 12, 20, "+"), ("n", "s", 25, 27, "+"), ("z", "s", 30, 50, "+"),
    ("x", "t", 0, 10, "+"), ("y", "t", 10, 18, "+"), ("n", "t", 20, 22, "+"), ("z", "t", 60, 80, "+"),
    ("y", "u", 0, 8, "-"), ("x", "u", 9, 19, "-"), ("z", "u", 40, 60, "+"),
]


def test_adjacencies_chains_and_melting(spark):
    df = spark.createDataFrame(ROWS, BLOCK)
    near = {tuple(r) for r in blocks.adjacencies(df).collect()}
    assert ("u", "y", "L", "x", "R", 1) in near and ("s", "x", "R", "y", "L", 2) in near and len(near) == 8
    groups = {r["end"]: (r["group"], r["ends"]) for r in blocks.adjacency_groups(df).collect()}
    assert groups["x/R"] == groups["y/L"] == ("x/R", 2) and groups["n/R"] == groups["z/L"] and groups["z/L"][1] == 3
    assert {r["block"]: (r["chain"], r["length"]) for r in blocks.chains(df).collect()} == {"x": ("n", 20), "y": ("n", 20), "n": ("n", 20), "z": ("z", 20)}
    kept = {r["block"] for r in blocks.melt(df, 20, 3).collect()}
    assert kept == {"z"}  # n has two members; x and y make 18
    assert {r["block"] for r in blocks.melt_rounds(df, [3, 18], 2).collect()} == {"x", "y", "z", "n"}
    assert min(r["end"] - r["start"] for r in blocks.melt(df, 1, 2, trim=3).collect()) == 2


def test_recoverable(spark):
    rows = [(b, s, k * 10, k * 10 + n, "+") for s in "pq" for k, (b, n) in enumerate([("l", 8), ("m", 2), ("r", 8)])]
    rows += [("l", "o", 0, 8, "+"), ("o", "o", 20, 24, "+"), ("r", "v", 5, 13, "+"), ("o", "v", 0, 4, "+")]
    got = {r["block"] for r in blocks.recoverable(spark.createDataFrame(rows, BLOCK), 5).collect()}
    assert got == {"m"}


TREE = [("top", None, None), ("in", "top", 2.0), ("a", "in", 1.0), ("b", "in", 3.0), ("c", "top", 4.0)]


def test_tree_filters(spark):
    tree = spark.createDataFrame(TREE, "id string, parent string, length double")
    members = spark.createDataFrame([("k", "a"), ("k", "b"), ("l", "a"), ("l", "c"), ("l", "c"), ("m", "a")], "block string, event string")
    got = {r["block"]: r["coverage"] for r in blocks.tree_coverage(members, tree).collect()}
    assert got == {"k": pytest.approx(0.4), "l": pytest.approx(0.7), "m": 0.0}
    assert [r[0] for r in blocks.supported(members, tree, 2, 2, 0.5, ["c"], 1).collect()] == ["l"]
    assert {r["id"]: r["parent"] for r in trees.spanning(tree, spark.createDataFrame([("a",), ("b",)], "id string")).collect()} == {"in": None, "a": "in", "b": "in"}
    leaves = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    assert [tuple(r) for r in trees.assign_outgroups(tree, leaves, 1).collect()] == [("in", "c", 6.0, 1)]
    grown = {r["id"]: (r["parent"], r["length"]) for r in trees.insert_on_branch(tree, "b", "new", 0.25).collect()}
    assert grown["b"] == ("new", 0.75) and grown["new"] == ("in", 2.25)


def test_outgroups_never_wait_for_themselves(spark):
    tree = spark.createDataFrame([("r", None, None), ("p", "r", 1.0), ("q", "r", 1.0), ("a", "p", 1.0), ("b", "p", 1.0), ("c", "q", 1.0), ("d", "q", 1.0)], "id string, parent string, length double")
    got = [(r["node"], r["outgroup"]) for r in trees.assign_outgroups(tree, tree.select("id"), 1).collect()]
    assert got[0] == ("p", "q") and ("q", "p") not in got and len(got) == 2


def test_pair_filters(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(["o", "a"], ["o"]), (["a"], ["b"]), (["a", "b"], ["b", "c"])], "a array<string>, b array<string>")
    kinds = ["outgroup", "relaxed_outgroup", "repeat", "relaxed_repeat", "several", "single_copy", "relaxed_single_copy"]
    got = [tuple(r) for r in df.select(*(blocks.pair_rejected(k, F.col("a"), F.col("b"), ["o"]) for k in kinds)).collect()]
    assert got == [(True, True, True, False, True, True, False), (False,) * 7, (False, False, True, True, True, False, False)]


def test_thread_strings(spark):
    rows = [("r", None, 0, None), ("b", "r", 2, "TT"), ("a", "r", 1, None), ("x", "a", 1, "C"), ("y", "a", 0, "A"), ("e", "r", 3, None)]
    got = blocks.thread_strings(spark.createDataFrame(rows, "id string, parent string, place int, text string")).collect()
    assert [tuple(r) for r in got] == [("r", "ACTT")]


def test_clipping_by_bases(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for i in range(60):
        ops = [(rng.randrange(1, 6), rng.choice("M=XID")) for _ in range(rng.randrange(1, 8))]
        t0, q0, strand, lo = rng.randrange(20), rng.randrange(20), rng.choice("+-"), rng.randrange(35)
        hi = lo + rng.randrange(1, 15)
        q_len = sum(n for n, o in ops if o in "M=XI")
        rows.append((i, "t", strand, q0, q0 + q_len, t0, t0 + sum(n for n, o in ops if o in "M=XD"), "".join(f"{n}{o}" for n, o in ops), lo, hi))
        t, q, cells = t0, 0, []
        for n, o in ops:
            for _ in range(n):
                cells.append((o, t, q))
                t, q = t + (o in "M=XD"), q + (o in "M=XI")
        inside = [c for c in cells if (lo <= c[1] < hi if c[0] != "I" else lo < c[1] < hi)]
        while inside and inside[0][0] in "ID":
            inside.pop(0)
        while inside and inside[-1][0] in "ID":
            inside.pop()
        if inside:
            qa, qb = inside[0][2], inside[-1][2] + 1
            span = (q0 + qa, q0 + qb) if strand == "+" else (q0 + q_len - qb, q0 + q_len - qa)
            want[i] = (*span, inside[0][1], inside[-1][1] + 1, sum(c[0] in "M=" for c in inside), len(inside))
    df = spark.createDataFrame(rows, "id long, target string, strand string, qstart long, qend long, tstart long, tend long, cigar string, lo long, hi long")
    got = clipping.clip(df, ["id"], "lo", "hi").collect()
    assert {r["id"]: tuple(r)[1:7] for r in got} == want
    regions = spark.createDataFrame([("t", 10, 30), ("t", 25, 40)], "target string, start long, end long")
    assert all(r["region_start"] <= r["tstart"] < r["tend"] <= r["region_end"] for r in clipping.clip_to_regions(df, regions, 16).collect())
    assert clipping.trim_ends(df, 0.0).count() == sum(any(o in r[7] for o in "M=X") for r in rows)


def test_clusters_names_and_chunks(spark):
    rows = [(1, "c", 0, 100), (2, "c", 5, 104), (3, "c", 10, 108), (4, "c", 60, 160), (5, "d", 0, 100)]
    got = {r["id"]: r["site"] for r in iv.cluster(spark.createDataFrame(rows, "id long, key string, start long, end long"), ["key"], 0.9, 64).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    names = spark.createDataFrame([("a.b",), ("a-b",), ("ab1",), ("ab",), ("c",), (None,), ("c",)], "n string")
    alias = {r["name"]: r["alias"] for r in rel.rename_uniquely(names, "n").collect()}
    assert len(set(alias.values())) == 5 and alias["ab1"] == "ab1" and alias["a-b"] == "ab" and alias["c"] == "c"
    from pyspark.sql import functions as F

    chunks = rel.chunked(spark.range(10), [F.col("id").desc()], 4).collect()
    assert {(r["id"], r["chunk"]) for r in chunks} == {(9 - i, i // 4) for i in range(10)}


def test_levels_and_parts(spark):
    df = spark.createDataFrame([("p", 1, 5.0), ("p", 2, 9.0), ("q", 1, None)], "query string, level int, chain_score double")
    assert al.filter_levels(df, 1, 5.0).count() == 1 and al.filter_levels(df, 1, 5.0, invert=True).count() == 2
    big = spark.createDataFrame([("p",)] * 5 + [("q",), ("r",)], "query string")
    parts = {(r["query"], r["part"]) for r in al.split_by_query(big, 4).collect()}
    assert ("p", "query-p") in parts and {p for q, p in parts if q != "p"} == {"rest-0"}


def test_long_gap_scores():
    got = bases.long_gap_scores({"AA": 10, "AC": -5, "open": 40, "extend": 2}, 3, 4)
    assert got == {"AA": 40, "AC": -20, "open": 160, "extend": 8, "open2": 480, "extend2": 2}
    with pytest.raises(ValueError, match="long gap"):
        bases.long_gap_scores({"open": 1, "extend": 1}, 1, 1)


def carried_points(matches):
    """All cut points, one carry after the other."""
    sides = [(a, i, n, b, j, s) for a, i, b, j, n, s in matches] + [(b, j, n, a, i, s) for a, i, b, j, n, s in matches]
    todo = {(a, p) for a, i, n, *_ in sides for p in (i, i + n)}
    known = set()
    while todo:
        seq, p = todo.pop()
        known.add((seq, p))
        for a, i, n, b, j, s in sides:
            if a == seq and i < p < i + n:
                q = (b, j + p - i if s == "+" else j + i + n - p)
                if q not in known:
                    todo.add(q)
    return known


@pytest.mark.parametrize(
    "matches",
    [
        [("a", 0, "a", 7, 9993, "+")],
        [("a", 0, "b", 0, 2000, "+"), ("a", 0, "b", 7, 2000, "+")],
        [("a", 0, "b", 0, 900, "+"), ("b", 5, "c", 0, 800, "-"), ("c", 0, "a", 11, 700, "-")],
    ],
    ids=["tandem repeat", "shifted copies", "round three sequences"],
)
def test_cut_points_of_repeats_settle(spark, monkeypatch, matches):
    rounds = []
    plain = blocks.materialize
    monkeypatch.setattr(blocks, "materialize", lambda df, name, keep=False: (rounds.append(name), plain(df, name, keep))[1])
    got = {(r["seq"], r["pos"]) for r in blocks.cut_points(spark.createDataFrame(matches, MATCH)).collect()}
    assert got == carried_points(matches)
    assert rounds.count("cuts") < 30


def plain_rounds(spark, matches, lengths):
    """The same schedule, each step by positions: (seq, pos) to the class of aligned positions that is left."""
    at = {}
    seqs = {(s, i + k) for a, i, b, j, n, _ in matches for s, x in ((a, i), (b, j)) for k in range(n) for i in [x]}
    left = None
    for least in lengths:
        if left is None:
            allowed = matches
            frame = blocks.anneal(spark.createDataFrame(allowed, MATCH))
        else:
            extents = {s: (min(p for t, p in seqs if t == s), max(p for t, p in seqs if t == s) + 1) for s, _ in seqs}
            found = blocks.gaps(spark.createDataFrame(left, BLOCK), spark.createDataFrame([(s, *e) for s, e in extents.items()], "seq string, start long, end long")).collect()
            label = {(r["seq"], p): r["label"] for r in found for p in range(r["start"], r["end"])}
            covered = {(s, p) for _, s, a, e, _ in left for p in range(a, e)}
            assert set(label) == {(s, p) for s, (lo, hi) in extents.items() for p in range(lo, hi)} - covered
            single = [(a, i + k, b, j + (k if t == "+" else n - 1 - k), 1, t) for a, i, b, j, n, t in matches for k in range(n)]
            allowed = [m for m in single if label.get((m[0], m[1]), 1) == label.get((m[2], m[3]), 2)]
            frame = blocks.anneal(spark.createDataFrame(allowed, MATCH)).union(spark.createDataFrame(left, BLOCK))
        left = [tuple(r) for r in blocks.melt(frame, least, 2).select("block", "seq", "start", "end", "strand").collect()]
    for b, s, a, e, _ in left:
        at |= {(s, p): b for p in range(a, e)}
    return at


def test_annealing_rounds(spark):
    rng = random.Random(12)
    matches = [("a", 0, "b", 0, 12, "+"), ("a", 20, "b", 22, 12, "+")] + [(rng.choice("ab"), rng.randrange(30), rng.choice("bc"), rng.randrange(30), rng.randrange(1, 5), "+") for _ in range(6)]
    got = [tuple(r) for r in blocks.anneal_rounds(spark.createDataFrame(matches, MATCH), [6, 1]).select("seq", "start", "end").collect()]
    places = [(s, p) for s, a, e in got for p in range(a, e)]
    assert len(places) == len(set(places)) and set(places) == set(plain_rounds(spark, matches, [6, 1]))
    assert set(places) >= {(r["seq"], p) for r in blocks.melt(blocks.anneal(spark.createDataFrame(matches, MATCH)), 6).collect() for p in range(r["start"], r["end"])}


def test_no_chain_stays_recoverable(spark):
    """m and n, side by side in one place and apart in others, may not go both at once; after that all are judged again."""
    inner = [("l", 8), ("m", 2), ("n", 3), ("r", 8)]
    rows = [(b, s, k * 10, k * 10 + n, "+") for s in "pq" for k, (b, n) in enumerate(inner)]
    rows += [("l", "o", 0, 8, "+"), ("o", "o", 20, 24, "+"), ("r", "v", 5, 13, "+"), ("o", "v", 0, 4, "+")]
    rows += [("l", "w", 0, 8, "+"), ("n", "w", 10, 13, "+"), ("r", "w", 20, 28, "+")]
    df = spark.createDataFrame(rows, BLOCK)
    assert blocks.recoverable(df, 5).count() > 0
    left = blocks.drop_recoverable(df, 5)
    kept = {r["block"] for r in left.collect()}
    assert blocks.recoverable(left, 5).count() == 0 and {"l", "r", "o"} <= kept and kept != {"l", "m", "n", "r", "o"}


def test_nested_blocks(spark):
    """k leads from the outside to m and back by r: a chain of the outer ring. u and v, each in one thread between the
    same ends, hang in one group of that chain. h hangs by itself, between the outside and nothing else."""
    rows = [(b, s, 10 * k, 10 * k + 5, "+") for s, way in (("s", "kumr"), ("t", "kvmr"), ("w", "kumr")) for k, b in enumerate(way)]
    got = {r["block"]: (r["bridge"], r["chain"]) for r in blocks.nested_blocks(spark.createDataFrame(rows, BLOCK)).collect()}
    # A ring through *: k, then u or v side by side, then m and r.
    assert got == {"k": (False, "k"), "m": (False, "k"), "r": (False, "k"), "u": (False, "u"), "v": (False, "v")}


def test_placeholder_names(spark):
    given = ["a_1", "x.y", "g0", "g2", "g3", "b-c", "é9", "_", "g007", "z z", "g1x", "q?", "g6"]
    got = {r["name"]: r["alias"] for r in rel.placeholder_names(spark.createDataFrame([(n,) for n in [*given, "x.y"]] + [(None,)], "n string"), "n").collect()}
    want, counter = {}, 0
    for name in sorted(given):
        if name.replace("_", "").isalnum():
            want[name] = name
            continue
        while f"g{counter}" in given:
            counter += 1
        want[name], counter = f"g{counter}", counter + 1
    assert got == want


def test_segment_lines_are_written_in_order(spark, tmp_path):
    from loomspan.sources import sinks

    rows = [("x", "r", 2, 6, "-"), ("x", "q", 0, 4, "+"), ("y", "q", 4, 7, "+"), ("x", "p", 5, 9, "-")]
    sequences = spark.createDataFrame([("p", "leaf", 9), ("q", "leaf", 8), ("r", "anc", 9), ("none", "anc", 0)], "seq string, event string, length long")
    sinks.write_segments(spark.createDataFrame(rows, BLOCK), sequences, "anc", str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("part-*"))
    assert "".join(f.read_text() for f in files).splitlines() == [
        "s\t'anc'\t'r'\t1", "a\t1\t0\t2", "a\t2\t2\t4", "a\t3\t6\t3",
        "s\t'leaf'\t'p'\t0", "a\t0\t5", "a\t5\t4\t2\t1",
        "s\t'leaf'\t'q'\t0", "a\t0\t4\t2\t0", "a\t4\t3", "a\t7\t1",
    ]


def walked(segments, threads, min_length, min_new):
    """Threads of each component one after another, with the blocks that were met before."""
    out = {}
    for component in {t[1] for t in threads}:
        seen, any_before = {}, False
        own = sorted((t for t in threads if t[1] == component), key=lambda t: (not t[3], -t[2], t[0]))
        for seq, _, length, attached in own:
            mine = [(b, e - a) for b, s, a, e in segments if s == seq]
            out[seq] = False
            if any_before and length < min_length and not attached:
                continue
            known = sum(n for b, n in mine if b in seen)
            seen.update((b, seq) for b, _ in mine)
            total = sum(n for _, n in mine)
            out[seq] = not attached and (not any_before or total - known >= min_new * total)
            any_before = True
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_threads_attached_as_in_a_walk(spark, seed):
    rng = random.Random(seed)
    threads = [(f"t{i}", i % 4, rng.choice([30, 60, 90]), rng.random() < 0.2) for i in range(20)]
    segments = [(f"b{i % 4}.{rng.randrange(7)}", f"t{i}", 10 * k, 10 * k + 1 + i % 4) for i in range(20) for k in range(rng.randrange(6))]
    found = blocks.attach_threads(spark.createDataFrame(segments, "block string, seq string, start long, end long"), spark.createDataFrame(threads, "seq string, component long, length long, attached boolean"), 60, 0.5)
    assert {r["seq"]: r["attach"] for r in found.collect()} == walked(segments, threads, 60, 0.5)


def test_no_threads_to_attach(spark):
    none = spark.createDataFrame([], "seq string, component long, length long, attached boolean")
    assert blocks.attach_threads(spark.createDataFrame([], BLOCK), none, 1, 0.1).collect() == []
