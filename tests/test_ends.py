"""Ends, rescue and broken adjacencies by plain loops; joined id spaces through GFA text."""

import random

import pytest

from loomspan.operators import ends, graphpaths


def test_dominant_ends(spark):
    """hub: all adjacencies at one end; pair: a self loop; far: too long; two: no end takes part in all."""
    links = {"hub": [("a", "b", 5), ("c", "a", 9), ("a", "b", 1)], "pair": [("a", "a", 1), ("a", "b", 1)], "far": [("a", "b", 50)], "two": [("a", "b", 1), ("c", "d", 1)], "tie": [("b", "a", 3)]}
    rows = [(f, x, y, n) for f, ls in links.items() for a, b, n in ls for x, y in ((a, b), (b, a))]
    got = {}
    for r in ends.ends_to_align(spark.createDataFrame(rows, "flower string, end string, other string, length long"), 10).collect():
        got.setdefault(r.flower, set()).add((r.end, r.dominant))
    assert got == {"hub": {("a", True)}, "tie": {("a", True)}, "pair": {("a", False), ("b", False)}, "far": {("a", False), ("b", False)}, "two": {(x, False) for x in "abcd"}}


def test_rescue_by_positions(spark):
    rng = random.Random(3)
    beds = [(rng.choice("ab"), s, s + rng.randint(0, 12)) for s in (rng.randrange(200) for _ in range(25))]
    segments = [(k, s, s + rng.randint(1, 40)) for k in "abc" for s in sorted(rng.sample(range(220), 12))]
    cover = {(k, p) for k, a, b in beds for p in range(a, b)}
    want = {(k, a, b, n) for k, a, b in segments if b - a >= 5 and (n := sum((k, p) in cover for p in range(a, b))) / (b - a) > 0.3}
    schema = "k string, start long, end long"
    assert {tuple(r) for r in ends.rescued(spark.createDataFrame(segments, schema), spark.createDataFrame(beds, schema), ["k"], 5, 0.3).collect()} == want and want


def test_breaks(spark):
    rng = random.Random(8)
    flowers = [(0, None, 10_000, None, False)]
    flowers += [(k, rng.randrange(k), rng.choice([5, 5, 500]), rng.choice([None, 10, 300]), rng.random() < 0.7) for k in range(1, 30)]
    by = {f[0]: f for f in flowers}

    def breakable(k):
        while by[k][1] is not None:
            if by[k][2] > 100:
                return True
            if (by[k][3] or 0) >= 100:
                return False
            k = by[k][1]
        return True

    schema = "id long, parent long, bases long, chain_bases long, leaf boolean"
    frame = spark.createDataFrame(flowers, schema)
    assert {r["id"]: r.breakable for r in ends.breakable(frame, 100, 100).collect()} == {k: breakable(k) for k in by}
    order = [(ref, p, rng.randrange(6), rng.randrange(30)) for ref in "xy" for p in sorted(rng.sample(range(90), 40))]
    support = [(a, b, rng.randrange(4)) for a in range(6) for b in range(6) if rng.random() < 0.6]
    weight = {}
    for a, b, n in support:
        weight[min(a, b), max(a, b)] = weight.get((min(a, b), max(a, b)), 0) + n
    want = {}
    for ref in "xy":
        rows, piece = [o for o in order if o[0] == ref], 0
        for here, after in zip(rows, [*rows[1:], None], strict=True):
            want[here[:2]] = piece
            if after and by[here[3]][4] and breakable(here[3]) and weight.get((min(here[2], after[2]), max(here[2], after[2])), 0) < 3:
                piece += 1
    got = ends.break_adjacencies(spark.createDataFrame(order, "ref string, place long, node long, flower long"), spark.createDataFrame(support, "a long, b long, n long"), frame, 3, 100, 100)
    assert {(r.ref, r.place): r.piece for r in got.collect()} == want and max(want.values()) > 3


def test_joined_ids(spark):
    files = {
        "f1": ["H\tVN:Z:1.1", "S\ts2\tAC", "S\ts10\tG\tSN:Z:x", "L\ts2\t+\ts10\t-\t0M", "W\tx\t0\tc\t0\t3\t>s2<s10>s2"],
        "f2": ["S\ts2\tTT", "S\tutg7\tA", "P\tp\ts2+,utg7-,s2+\t*", "# note"],
    }
    rows = [(f, n, t) for f, ts in files.items() for n, t in enumerate(ts)]
    got = {(r.file, r.n): r.text for r in graphpaths.join_ids(spark.createDataFrame(rows, "file string, n long, text string")).collect()}
    assert [got["f1", n] for n in range(5)] == ["H\tVN:Z:1.1", "S\ts1\tAC", "S\ts2\tG\tSN:Z:x", "L\ts1\t+\ts2\t-\t0M", "W\tx\t0\tc\t0\t3\t>s1<s2>s1"]
    assert {got["f2", 0], got["f2", 1]} == {"S\ts3\tTT", "S\ts4\tA"} and got["f2", 3] == "# note"
    two, seven = got["f2", 0].split("\t")[1], got["f2", 1].split("\t")[1]
    assert got["f2", 2] == f"P\tp\t{two}+,{seven}-,{two}+\t*"
    lost = spark.createDataFrame([("f", 0, "S\ts1\tA"), ("f", 1, "L\ts1\t+\ts9\t+\t0M")], "file string, n long, text string")
    with pytest.raises(Exception, match="no segment s9"):
        graphpaths.join_ids(lost).collect()
