"""Small cases of reviewed faults: means at a bound, halves, neighbours on a line."""

import functools
import operator
import random

from pyspark.sql import functions as F

import __spark_entry__
from loomspan.operators import blocks, graph, trees


def run(spark, name, sf_dir):
    return __spark_entry__.queries()[name](spark, str(sf_dir))


def test_f17_mean_at_the_bound(spark, tmp_path):
    """A mean of exactly 0.05 is not below it, in whatever order its parts come."""
    values = [k / 100 for k in range(11)] * 6
    rng = random.Random(5)
    rows, low = [], 0
    for part in range(200):
        rng.shuffle(values)
        low += functools.reduce(operator.add, values) / len(values) < 0.05
        rows += [(part, v) for v in values]
    rows += [(1000, 0.04)] * 31 + [(1001, 0.04)] * 30 + [(1002, float("nan"))] * 31
    spark.createDataFrame(rows, "l_partkey long, l_discount double").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert low > 0  # sums of doubles would err
    assert [tuple(r) for r in run(spark, "f17_megablocks", tmp_path).collect()] == [(1000, 31)]


def test_k9_halves_round_to_even(spark, tmp_path):
    price = [0.5, 1.5, 2.5, 900.5, 901.5, 1000.5, 7.4999]
    rows = spark.createDataFrame([(k, 1, p) for k, p in enumerate(price)], "l_orderkey long, l_linenumber int, l_extendedprice double")
    rows = rows.withColumns({"l_partkey": F.lit(4).cast("long"), "l_suppkey": F.lit(1).cast("long"), "l_quantity": F.lit(50.0), "l_linestatus": F.lit("O")})
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {int(r["name"]): r["score"] for r in run(spark, "k9_reordered_columns", tmp_path).collect()}
    assert [got[k] for k in range(len(price))] == [0, 2, 2, 900, 902, 1000, 7]


def test_nearest_on_a_line(spark):
    """Against all pairs; and without them: 40,000 points of one key."""
    rng = random.Random(3)
    rows = [(rng.randrange(4), n, rng.choice([rng.randrange(9), rng.randrange(10_000)])) for n in range(150)] + [(9, 900, 1), (None, 901, 2)]
    for k in (1, 2, 5):
        got = {(r["a"], r["rank"]): (r["b"], r["dist"]) for r in trees.nearest_on_line(spark.createDataFrame(rows, "key int, name long, x long"), "key", "name", "x", k).collect()}
        want = {}
        for key, a, x in rows:
            near = sorted((abs(x - y), b) for other, b, y in rows if other == key and key is not None and b != a)[:k]
            want |= {(a, i + 1): (b, d) for i, (d, b) in enumerate(near)}
        assert got == want
    many = spark.range(40_000).select(F.lit(1).alias("key"), F.col("id").alias("name"), (F.col("id") * 37 % 101).alias("x"))
    found = trees.nearest_on_line(many, "key", "name", "x", 2)
    assert found.count() == 80_000 and found.agg(F.max("dist")).first()[0] == 0


def broken_up(edges, cap):
    """One edge after the other."""
    part = {}
    kept = []
    for a, b, s in sorted(edges, key=lambda e: (e[2] is None, -(e[2] or 0), e[0], e[1])):
        x, y = part.setdefault(a, {a}), part.setdefault(b, {b})
        fits = len(x | y) <= cap
        kept.append((a, b, s, fits))
        if fits and x is not y:
            both = x | y
            for n in both:
                part[n] = both
    return sorted(kept, key=str)


def test_break_up_in_rounds(spark):
    """Against one edge after the other: hubs, ties, repeated and own edges, a falling path; in no group but of few edges."""
    rng = random.Random(8)
    hubs = [(rng.randrange(60), -1 - rng.randrange(6), float(rng.randrange(40))) for _ in range(400)]
    pairs = [(100 + rng.randrange(80), 100 + rng.randrange(80), rng.choice([None, float(rng.randrange(9))])) for _ in range(120)]
    path = [(300 + k, 301 + k, 90.0 - k) for k in range(12)]
    edges = hubs + pairs + path + hubs[:20]
    frame = spark.createDataFrame(edges, "a long, b long, score double")
    for cap, group in ((5, 40), (3, 10_000), (1, 10)):
        got = graph.break_up_greedily(frame, None, cap, group)
        assert sorted((tuple(r) for r in got.collect()), key=str) == broken_up(edges, cap)


def test_stars_need_no_round(spark, monkeypatch):
    """Edges that are stars around their least nodes are components as they are; own edges keep their nodes."""
    monkeypatch.setattr(graph, "_neighbours_least", None)
    edges = [(9, 1), (1, 8), (7, 1), (9, 1), (6, 2), (5, 5), (1, 1), (6, 6)]
    got = sorted(tuple(r) for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == [(1, 1), (2, 2), (5, 5), (6, 2), (7, 1), (8, 1), (9, 1)]
    none = spark.createDataFrame([(None, 3)], "a long, b long")
    assert graph.connected_components(none).collect() == []


def test_chains_once_a_round(spark, monkeypatch):
    """drop_recoverable() finds the chains of a round once, with the rows of a search of recoverable chains of its own."""
    rows = [(f"b{k}", s, 10 * k, 10 * k + 5, "+") for s in ("x", "y") for k in range(4)] + [("b0", "z", 0, 5, "+"), ("b3", "z", 10, 15, "+")]
    frame = spark.createDataFrame(rows, "block string, seq string, start long, end long, strand string")
    calls, chains = [], blocks.chains
    monkeypatch.setattr(blocks, "chains", lambda b: calls.append(1) or chains(b))
    alone = sorted(r["block"] for r in blocks.recoverable(frame, 50).collect())
    assert sorted(r["block"] for r in blocks.recoverable(frame, 50, chains(frame)).collect()) == alone and len(calls) == 1
    calls.clear()
    left = blocks.drop_recoverable(frame, 0)
    assert left.count() == len(rows) and len(calls) == 1
