"""Steps whose cost has to grow no faster than their input."""

from __future__ import annotations

import time

import numpy as np
import pytest

from loomspan.operators import alignments as al
from loomspan.operators import ancestral, blocks, graph, trees
from loomspan.operators import intervals as iv
from loomspan.plans import catalog
from loomspan.sources import sinks


def _plain(t0, t1, q0, q1, w, max_gap, gap_open, gap_extend):
    """Each row's best predecessor by looking at all rows before it."""
    total, before = w.copy(), [-1] * len(w)
    for i in range(len(w)):
        gt, gq = t0[i] - t1[:i], q0[i] - q1[:i]
        ok = (gt >= 0) & (gq >= 0) & (gt <= max_gap) & (gq <= max_gap)
        if ok.any():
            gap = gt + gq
            gain = np.where(ok, total[:i] - np.where(gap > 0, gap_open + gap_extend * gap, 0.0), -np.inf)
            j = int(gain.argmax())
            if gain[j] > 0:
                total[i], before[i] = w[i] + gain[j], j
    return total, before


def _rows(rng, n, span, least):
    t0, q0 = np.sort(rng.integers(0, span, n)), rng.integers(0, span, n)
    return t0, t0 + rng.integers(least, 8, n), q0, q0 + rng.integers(least, 8, n), rng.integers(-2, 9, n) / 2


@pytest.mark.parametrize("costs", [(0.0, 0.0), (1.0, 0.1), (0.5, 0.0), (2.0, 0.5)])
def test_best_predecessors_are_those_of_a_plain_walk(costs):
    rng = np.random.default_rng(5)
    for _ in range(120):
        rows = _rows(rng, int(rng.integers(1, 60)), int(rng.choice([10, 30, 200])), int(rng.choice([1, 0, -4])))
        gap = int(rng.choice([0, 3, 10, 50]))
        total, before = al._best_before(*rows, gap, *costs)
        plain, ways = _plain(*rows, gap, *costs)
        assert np.array_equal(total, plain) and before == ways


def test_chains_do_not_grow_with_the_square_of_rows_in_reach():
    rng = np.random.default_rng(6)

    def seconds(n):
        rows = _rows(rng, n, 900, 1)
        begin = time.process_time()
        al._best_before(*rows, 400, 1.0, 0.1)
        return time.process_time() - begin

    assert seconds(32_000) < 24 * seconds(4_000)


def test_a_bed_folder_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(4000).selectExpr("concat('c', id % 7) AS contig", "id AS start", "id + 5 AS end", "'full' AS phase")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_bed(rows, str(tmp_path / "b"), by=["phase"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "b" / "phase=full").glob("part-*"))
    assert len(files) > 1
    lines = [(c, int(a), int(b)) for c, a, b in (x.split("\t") for f in files for x in f.read_text().splitlines())]
    assert lines == sorted((f"c{i % 7}", i, i + 5) for i in range(4000))


NESTED = [("r", None, 0, None), ("b", "r", 2, None), ("a", "r", 1, None), ("x", "b", 1, 4), ("y", "a", 2, 3), ("z", "a", 1, 2), ("e", "r", 3, 5), ("o", "gone", 1, 7), ("p", "gone", 2, 1), ("s", None, 0, 9)]


def test_nested_records_need_no_pairs_of_ancestors(spark, monkeypatch):
    """Each record goes through a join for each level, not once for each record around it."""
    monkeypatch.setattr(trees, "closure", None)
    rows = spark.createDataFrame(NESTED, "id string, parent string, place long, length long")
    levels = [sorted(r["id"] for r in d.collect()) for d in trees.by_level(rows)]
    assert levels == [["o", "p", "r", "s"], ["a", "b", "e"], ["x", "y", "z"]]
    found = {r["id"]: (r["start"], r["end"]) for r in ancestral.nested_coordinates(rows).collect()}
    assert found == {"r": (0, 14), "a": (0, 5), "z": (0, 2), "y": (2, 5), "b": (5, 9), "x": (5, 9), "e": (9, 14), "o": (0, 7), "p": (7, 8), "s": (0, 9)}
    texts = rows.selectExpr("id", "parent", "place", "IF(length IS NULL, NULL, id) AS text")
    assert {tuple(r) for r in blocks.thread_strings(texts).collect()} == {("r", "zyxe"), ("o", "o"), ("p", "p"), ("s", "s")}


def test_segment_lines_look_at_blocks_twice(spark):
    """Once for the blocks and once for what lies between them."""
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            seen.add(1)
            yield row

    kind = "block string, seq string, start long, end long, strand string"
    rows = [("x", "r", 2, 6, "-"), ("x", "q", 0, 4, "+"), ("y", "q", 4, 7, "+")]
    counted = spark.createDataFrame(spark.sparkContext.parallelize(rows, 1).mapPartitions(count), kind)
    sequences = spark.createDataFrame([("q", "leaf", 8), ("r", "anc", 9)], "seq string, event string, length long")
    assert sinks.segment_lines(counted, sequences, "anc").count() == 8
    assert seen.value <= 2 * len(rows)


def test_outliers_need_no_merged_runs(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    lost = catalog.queries()["a16_exclusion_summary"](spark, sf).filter("event <> 'TOTAL' AND reason = 'TOTAL'")
    expected = {int(r["event"]): r["bp"] for r in lost.collect()}
    monkeypatch.setattr(iv, "merge", None)
    got = {r["event"]: r["lost"] for r in catalog.queries()["i16_outliers"](spark, sf).collect()}
    assert {k: v for k, v in got.items() if v} == expected


def test_coverage_joins_no_members_by_branch(spark):
    tree = spark.createDataFrame([("w", None, None), ("r", "w", 1.0), ("a", "r", 2.0), ("b", "r", 3.0), ("c", "w", 4.0)], "id string, parent string, length double")
    members = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "a"), (2, "c"), (3, "a")], "block long, event string")
    found = blocks.tree_coverage(members, tree)
    assert {r["block"]: r["coverage"] for r in found.collect()} == {1: 0.5, 2: 0.7, 3: 0.0}
    above = found._jdf.queryExecution().optimizedPlan().toString().split("count(1) AS k")[0]
    assert not [line for line in above.splitlines() if "Join" in line and "branch" in line]


def test_a_forest_carries_on_edges_between_components_alone(spark, monkeypatch):
    seen, store = [], graph.materialize

    def kept(df, name, **options):
        table = store(df, name, **options)
        if name == "forest-apart":
            seen.append(table.count())
        return table

    monkeypatch.setattr(graph, "materialize", kept)
    edges = [(f"n{k}", f"n{(k + 1) % 60}", 7 * k % 61 + 100 * copy) for k in range(60) for copy in range(4)] + [("n1", "n1", 999)]
    states = graph.isolated(spark.createDataFrame(edges, "a string, b string, rank long"), spark.createDataFrame([], "id string"))
    assert {r["state"]: r["count"] for r in states.groupBy("state").count().collect()} == {"joined": 59, "within": 182}
    assert seen[0] == 60 and seen[-1] == 0 and all(b <= a / 2 for a, b in zip(seen, seen[1:], strict=False))
