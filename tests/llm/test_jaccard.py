import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspan.llm.jaccard import JaccardConfig, Links, candidate_edges, from_planes, join_region, join_regions, near_duplicates, planes, prefix_cells, shared_cells
from loomspan.llm.sketch import parted
from loomspan.llm.text import words
from loomspan.session import scratch


def brute(pairs):
    """Least id reachable, over (id, set of shingles)."""
    parent = {i: i for i, _ in pairs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (a, x) in enumerate(pairs):
        for b, y in pairs[:k]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i, _ in pairs}


def shingles(text):
    w = words(text, lower=True)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([JaccardConfig(), JaccardConfig(small_cell=2, pivots=3), JaccardConfig(small_cell=3, pivots=8, shrink=0.95, growth=4.0)]))
def test_region_join_is_exact(seed, config):
    rng = random.Random(seed)
    sets = []
    for _ in range(rng.randint(2, 70)):
        if sets and rng.random() < 0.8:
            s = set(rng.choice(sets))
            for _ in range(rng.randint(0, 5)):
                s.discard(rng.choice(sorted(s)))
                s.add(rng.randrange(10**6))
        else:
            s = {rng.randrange(10**6) for _ in range(rng.randint(1, 40))}
        sets.append(s)
    ids = rng.sample(range(1000), len(sets))
    got = join_region(ids, [np.array(sorted(s), np.uint64) for s in sets], config)
    assert dict(zip(ids, got, strict=True)) == brute(sorted(zip(ids, sets, strict=True)))


@pytest.mark.parametrize("config", [JaccardConfig(bins=1 << 16), JaccardConfig(bins=1 << 14, small_cell=1, region_weight=300, pivots=3), JaccardConfig(bins=1 << 14, small_cell=1, region_weight=2000, shrink=0.95), JaccardConfig(bins=1 << 14, region_weight=100, least_weight=1, growth=0.0)])
def test_components_match_brute_force(spark, config):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 90))] for _ in range(15)]
    texts = [" ".join(b) for b in base]
    for _ in range(90):
        w = list(rng.choice(base[:6]))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    texts += [None, "", " \n", texts[3].upper(), texts[3]]
    ids = rng.sample(range(10_000), len(texts))
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, config).collect()}
    sets = sorted((i, shingles(t)) for i, t in zip(ids, texts, strict=True))
    want = brute(sets)
    assert got == {i: (len(s), want[i]) for i, s in sets}


def test_odd_rows(docs, rows, repeated, empty):
    assert near_duplicates(empty, JaccardConfig(bins=1 << 14)).count() == 0
    want = brute(sorted((r[0], shingles(r[1])) for r in rows))
    got = near_duplicates(repeated, JaccardConfig(bins=1 << 14)).collect()
    assert len(got) == repeated.count()
    assert all(r["component_id"] == want.get(r["doc_id"]) for r in got)


def families(members, size, rng, common=0):
    """Sets in families with links, far from each other but for some shingles that all share."""
    everyone = rng.choice(1 << 40, common, replace=False)
    out = []
    while len(out) < members:
        own = rng.integers(1 << 41, 1 << 60, size)
        for _ in range(int(rng.integers(1, 200))):
            s = own.copy()
            s[rng.integers(0, size, 2)] = rng.integers(1 << 41, 1 << 60, 2)
            out.append(np.unique(np.append(s, everyone)).astype(np.uint64))
    return out[:members]


def test_splits_shrink():
    """20,000 sets that share a passage: no split makes three times its members, and it takes under a minute."""
    rng = np.random.default_rng(2)
    sets = families(20_000, 40, rng, common=10)
    began, splits = time.process_time(), []
    got = join_region(list(range(len(sets))), sets, JaccardConfig(), splits)
    assert time.process_time() - began < 60
    assert splits and all(total <= 3 * m and largest < m for m, total, largest in splits)
    assert 100 < len(set(got)) < 1000


def test_large_regions_are_split_by_spark(spark):
    """At the default bounds, a region of more than one task: the plan's splits give the same as one in memory."""
    rng = np.random.default_rng(3)
    sets = families(6000, 100, rng, common=25)
    frame = spark.createDataFrame([(1, i, s.tobytes()) for i, s in enumerate(sets)], "region long, doc_id long, shingles binary").repartition(8)
    with scratch(spark):
        edges = join_regions(frame, JaccardConfig()).collect()
    got = Links(len(sets))
    for a, b in edges:
        got.join(a, np.array([b]))
    assert got.roots().tolist() == join_region(list(range(len(sets))), sets, JaccardConfig())


def test_a_shingle_in_every_document(spark):
    """A shingle that all documents have in their prefix comes to its cell once for each batch."""
    rows = [(i, 3, [7, 1000 + i]) for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id long, n long, prefix array<long>").coalesce(2)
    cells = prefix_cells(frame, JaccardConfig()).collect()
    assert sum(r["shingle"] == 7 for r in cells) == 2 and sum(r["tied"] is not None for r in cells) == 498
    with scratch(spark):
        got = candidate_edges(frame, JaccardConfig()).collect()
    assert {b for _, b in got} == set(range(1, 500))


def test_prefix_rows_travel_in_blocks(spark):
    """Cells of two documents come back as they were, and a row takes less than half of its four numbers."""
    rng = np.random.default_rng(4)
    shared = rng.integers(-(1 << 63), 1 << 63, 500)
    rows = [(i * 7, 90, [int(x) for x in np.append(rng.integers(-(1 << 63), 1 << 63, 90), shared[i % 500])]) for i in range(1000)]
    frame = spark.createDataFrame(rows, "doc_id long, n long, prefix array<long>").coalesce(1)
    for parts in (1, 7):
        got = sorted((r["least"], r["doc_id"], r["n"], r["tied"], r["large"]) for r in shared_cells(frame, JaccardConfig(), parts).collect())
        assert got == sorted((i % 500 * 7, i * 7, 90, None, False) for i in range(1000))
    for x in (shared, np.arange(9), np.array([], np.int64)):
        assert from_planes(planes(x)).view(np.int64).tolist() == x.tolist()
    packed = zlib.compress(planes(np.array([r[0] for r in rows for _ in range(91)])))
    assert len(packed) < 3 * 91_000


def test_rows_without_a_partner_stay(spark):
    """No row with a partner is among those that stay, whatever the bitmap holds; most others are."""
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    keys = spark.range(0, 40_000, 10).select(F.col("id").alias("q"))
    may, stay = parted(rows, [F.col("k")], keys, [F.col("q")])
    assert may.columns == stay.columns == ["k", "v"] and may.count() + stay.count() == 20_000
    assert stay.filter("k % 10 = 0").count() == 0 and stay.count() > 17_000
    nothing = parted(rows, [F.col("v")], keys.filter("q < 0"), [F.col("q")])
    assert nothing[0].count() == 0 and nothing[1].count() == 20_000


def test_texts_of_no_region_are_not_dealt(spark, tmp_path):
    """2,000 texts of which 4 are in regions: the join's tables are far smaller than the texts."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(60))) for i in range(2000)]
    rows += [(5000, rows[0][1] + " end"), (5001, rows[1][1] + " end"), (5002, rows[2][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    regions = spark.createDataFrame([(i, 0) for i in (0, 5000, 1, 5001)], "id long, region long")
    near, far = parted(df, [F.col("doc_id")], regions, [F.col("id")])
    assert {0, 1, 5000, 5001} <= {r["doc_id"] for r in near.collect()} and near.count() < 20 and far.count() > 1980
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(df, JaccardConfig(bins=1 << 14)).collect()}
    assert {i for i, c in got.items() if i != c} == {5000, 5001, 5002} and got[5002] == 2
