import random

import pytest
from pyspark.sql import functions as F

from loomspan.operators import intervals as iv

SCHEMA = "k string, start long, end long"
K = ["k"]


def frame(spark, spans, key="a"):
    return spark.createDataFrame([(key, a, b) for a, b in spans], SCHEMA)


def spans(df):
    return sorted((r["start"], r["end"]) for r in df.collect())


def test_merge(spark):
    """Touching ranges join; those a gap apart only if it is allowed."""
    given = frame(spark, [(40, 47), (11, 18), (18, 19), (21, 22), (33, 33), (60, 52)])
    assert spans(iv.merge(given, K)) == [(11, 19), (21, 22), (40, 47)]
    assert spans(iv.merge(given, K, gap=2)) == [(11, 22), (40, 47)]


def brute(a, b):
    cover = lambda s: {p for x, y in s for p in range(x, y)}
    return cover(a), cover(b)


@pytest.mark.parametrize("seed", range(3))
def test_against_positions(spark, seed):
    rng = random.Random(seed)
    make = lambda: [(s, s + rng.randint(0, 9)) for s in (rng.randrange(60) for _ in range(12))]
    a, b = make(), make()
    pa, pb = brute(a, b)
    points = lambda df: {p for x, y in spans(df) for p in range(x, y)}
    fa, fb = frame(spark, a), frame(spark, b)
    assert points(iv.subtract(fa, fb, K)) == pa - pb
    assert points(iv.intersect(fa, fb, K)) == pa & pb
    depth = {p: sum(x <= p < y for x, y in a) for p in range(80)}
    assert points(iv.covered_at_least(fa, K, 2)) == {p for p, d in depth.items() if d >= 2}
    assert points(iv.single_cover(fa, K)) == {p for p, d in depth.items() if d == 1}
    lengths = spark.createDataFrame([("a", 80)], "k string, length long")
    assert points(iv.complement(fa, lengths, K)) == set(range(80)) - pa
    joined = iv.overlap_join(fa, fb, K, 7).collect()
    want = sorted((x, y, u, v) for x, y in a for u, v in b if x < v and u < y and x < y and u < v)
    assert sorted((r["start"], r["end"], r["b_start"], r["b_end"]) for r in joined) == want
    semi = spans(iv.overlap_join(fa, fb, K, 7, how="left_semi"))
    anti = spans(iv.overlap_join(fa, fb, K, 7, how="left_anti"))
    assert sorted(semi + anti) == sorted(a)


def test_losses_add_up(spark):
    rng = random.Random(5)
    make = lambda n: [(s, s + rng.randint(1, 30)) for s in (rng.randrange(200) for _ in range(n))]
    base, phases = make(20), [("full", make(15)), ("clip", make(12)), ("filter", make(12))]
    out = iv.exclusions(frame(spark, base), [(n, frame(spark, s)) for n, s in phases], K)
    left = brute(base, [])[0]
    for name, s in phases:
        lost = {p for r in out.filter(F.col("phase") == name).collect() for p in range(r["start"], r["end"])}
        assert lost == left - brute(s, [])[0]
        left -= lost


def test_as_of_and_slices(spark):
    ranges = spark.createDataFrame([("a", 0, 5, "x"), ("a", 10, 12, "y")], "k string, start long, end long, label string")
    points = spark.createDataFrame([("a", p) for p in (0, 4, 5, 11, 12)] + [("b", 1)], "k string, pos long")
    got = {(r["k"], r["pos"]): r["label"] for r in iv.as_of(points, ranges, K, "label").collect()}
    assert got == {("a", 0): "x", ("a", 4): "x", ("a", 5): None, ("a", 11): "y", ("a", 12): None, ("b", 1): None}
    assert spans(iv.slice_spans(frame(spark, [(0, 25)]), K, 10)) == [(0, 10), (10, 25)]
    assert spans(iv.slice_spans(frame(spark, [(0, 26)]), K, 10)) == [(0, 10), (10, 20), (20, 26)]
    assert spans(iv.slice_spans(frame(spark, [(3, 7)]), K, 10)) == [(3, 7)]
    assert spans(iv.fragments(frame(spark, [(0, 5)]), K, 4, 2)) == [(0, 4), (2, 5), (4, 5)]


def test_running_values_cross_tiles(spark, monkeypatch):
    """Tiles of a few positions give what one tile gives, for ranges longer than many tiles."""
    rng = random.Random(8)
    make = lambda: [(rng.choice("ab"), s, s + rng.choice([1, 3, 40])) for s in (rng.randrange(200) for _ in range(60))]
    a, b = (spark.createDataFrame(make(), SCHEMA) for _ in range(2))
    points = spark.createDataFrame([(k, p) for k in "abc" for p in range(0, 260, 3)], "k string, pos long")
    valued = b.withColumn("v", F.col("start") * 10 + F.col("end"))

    def everything():
        yield iv.merge(a, K), iv.merge(a, K, gap=2), iv.depth(a, K), iv.subtract(a, b, K), iv.intersect(a, b, K), iv.islands(a, K)
        yield (iv.exclusions(a, [("x", b), ("y", iv.intersect(a, b, K))], K), iv.as_of(points, valued.groupBy("k", "start").agg(F.max("end").alias("end"), F.max("v").alias("v")), K, "v"))

    def run():
        return [sorted(tuple(map(str, sorted(r.asDict().items()))) for r in df.collect()) for group in everything() for df in group]

    want = run()
    monkeypatch.setattr(iv, "TILE", 4)
    assert run() == want


@pytest.mark.parametrize("key", ["a", None])
@pytest.mark.parametrize("operator", [lambda df: iv.depth(df, K), lambda df: iv.merge(df, K)], ids=["depth", "merge"])
def test_one_key_spreads_over_tasks(spark, key, operator):
    """All rows, disjoint ranges, have one key, a constant or from data; no task of the window reads a tenth of them."""
    k = F.lit(key) if key else F.concat(F.lit("a"), F.floor(F.col("id") / 1_000_000))
    df = spark.range(40_000).select(k.alias("k"), (F.col("id") * 400).alias("start"), (F.col("id") * 400 + 300).alias("end"))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = operator(df).groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in got) == 40_000 and max(r["count"] for r in got) < 4000


def test_left_join_keeps_repeated_rows(spark):
    a = frame(spark, [(0, 5), (0, 5), (9, 12), (3, 3), (9, 12)])
    got = iv.overlap_join(a, frame(spark, [(4, 6)]), K, 2, how="left").collect()
    assert sorted((r["start"], r["b_start"] or -1) for r in got) == [(0, 4), (0, 4), (3, -1), (9, -1), (9, -1)]
    assert iv.overlap_join(a, frame(spark, [(4, 6)]), K, 2, how="left_anti").count() == 3


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_wide_bins_find_the_same_pairs(spark, how):
    """Ranges of a few positions and of whole axes on both sides."""
    rng = random.Random(5)
    some = lambda n: [(a, a + rng.choice([0, 1, 3, 20, 70, 900])) for a in (rng.randrange(-50, 1000) for _ in range(n))]
    a, b = frame(spark, some(60)), frame(spark, some(40))
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    narrow = rows(iv.overlap_join(a, b, K, 4, how))
    assert narrow == rows(iv.overlap_join(a, b, K, 4, how, wide_width=256)) and len(narrow) > 3


def test_variant_sites(spark):
    """Insertions join by distance and size, others by cover within their kind; a null kind is one more."""
    rng = random.Random(9)
    given = [(i, rng.choice("ab"), rng.choice(["INS", "INS", "DEL", "INV"]), rng.randrange(400), rng.randrange(30, 90)) for i in range(60)]
    rows = [(i, k, kind, s, s + (1 if kind == "INS" else n), n) for i, k, kind, s, n in given]
    parent = list(range(60))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i, k, kind, s, e, n in rows:
        for j, k2, kind2, s2, e2, n2 in rows[:i]:
            cover = min(e, e2) - max(s, s2)
            alike = abs(s - s2) <= 20 and min(n, n2) >= 0.8 * max(n, n2) if kind == "INS" else cover >= 0.8 * max(n, n2)
            if k == k2 and kind == kind2 and alike:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    df = spark.createDataFrame(rows, "id long, k string, kind string, start long, end long, size long")
    assert {r["id"]: r["site"] for r in iv.variant_sites(df, K, 0.8, 20, 16).collect()} == {i: root(i) for i in range(60)}


def test_survival_counts_bases_and_pieces(spark):
    rng = random.Random(2)
    some = lambda: [(rng.choice("abz"), a, a + rng.randrange(-2, 9)) for a in (rng.randrange(-5, 60) for _ in range(15))]
    sizes, phases = {"a": 50, "b": 40, "c": 7}, {"first": some(), "second": some(), "none": []}
    got = iv.survival(spark.createDataFrame(list(sizes.items()), "k string, length long"), [(n, spark.createDataFrame(r, SCHEMA)) for n, r in phases.items()], K)
    for r in got.collect():
        for n, ranges in phases.items():
            held = {p for k, a, b in ranges if k == r["k"] for p in range(max(a, 0), min(b, sizes[k]))}
            assert (r[f"{n}_bp"], r[f"{n}_frags"]) == (len(held), len([p for p in held if p - 1 not in held]))
    total = iv.survival_by(got.withColumn("g", F.lit(1)), ["g"]).first()
    assert (total["contigs"], total["input_bp"], total["none_bp"]) == (3, 97, 0)


def test_signal_blocks_start_within_the_bounds(spark):
    signal = spark.createDataFrame([("a", p, float(p)) for p in (1, 2, 3, 5, 6, 9)] + [("b", 3, 0.5), ("b", None, 1.0)], "contig string, pos long, score double")
    got = sorted((r["contig"], r["start"], r["values"]) for r in iv.signal_blocks(signal, 2, 6).collect())
    assert got == [("a", 2, [2.0, 3.0]), ("a", 5, [5.0]), ("b", 3, [0.5])]
    assert iv.signal_blocks(signal, 4, 4).collect() == []
