import json
import os
import random

import pytest

from loomspan.operators import intervals as iv
from loomspan.streaming import coverage, depth, upserts


def test_stream_equals_batch(spark, tmp_path):
    rows = [(u, f"2024-01-01 {h:02d}:{m:02d}:00", v) for u in (1, 2) for h, m, v in ((0, 0, 1), (0, 5, 2), (3, 0, 3), (3, 10, 4), (20, 0, 5))]
    df = spark.createDataFrame(rows, "u int, t string, v int").selectExpr("u", "to_timestamp(t) AS ts", "v")
    df.write.parquet(str(tmp_path / "in"))
    batch = sorted(tuple(r) for r in coverage.sessions(df, "u", "ts", "10 minutes", "1 minute").collect())
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = coverage.sessions(stream, "u", "ts", "10 minutes", "1 minute").writeStream.format("memory").queryName("sess").outputMode("complete" if False else "append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted(tuple(r) for r in spark.table("sess").collect())
    assert set(got) <= set(batch) and len(got) >= len(batch) - 2  # the last session of each key is still open
    assert [b[3] for b in batch if b[0] == 1] == [2, 2, 1]


def test_upserts(spark, tmp_path):
    spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, n int, v string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k int, n int, v string").parquet(str(tmp_path / "in"))
    coverage.upsert_batches(stream, str(tmp_path / "out"), ["k"], "n", str(tmp_path / "c")).start().awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out/gen-0")).collect()) == [(1, 2, "b"), (2, 1, "c")]


def batches_of(spark, tmp_path, rows, schema, size):
    """A stream that takes `size` rows a batch, in the order of the rows."""
    names = [part.split()[0] for part in schema.split(",")]
    for k in range(0, len(rows), size):
        path = tmp_path / "in" / f"part-{k:06d}.json"
        path.parent.mkdir(exist_ok=True)
        path.write_text("".join(json.dumps(dict(zip(names, row, strict=True))) + "\n" for row in rows[k : k + size]))
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))


def run_depth(spark, tmp_path, stream, name, **options):
    query = depth.depth_stream(stream, **options).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted(tuple(r) for r in spark.table(name).collect())


def shuffled(seed, window):
    rng = random.Random(seed)
    rows = [(c, s, s + rng.randint(0, 40)) for c in "ab" for s in (rng.randrange(300) for _ in range(60))]
    rows.sort(key=lambda r: r[1] + rng.randrange(window // 2))  # at most a window behind the furthest
    return rows + [("a", None, None), ("b", None, None)]


def test_depth_of_a_stream_is_that_of_the_batch(spark, tmp_path):
    rows = shuffled(1, 40)
    schema = "contig string, start long, end long"
    want = sorted(tuple(r) for r in iv.depth(spark.createDataFrame(rows, schema), ["contig"]).select("contig", "start", "end", "depth").collect())
    assert run_depth(spark, tmp_path, batches_of(spark, tmp_path, rows, schema, 31), "depth_all", window=40) == want


def test_late_ranges(spark, tmp_path):
    rows, schema = [("a", 100, 120), ("a", 10, 500), ("a", 90, 95), ("a", None, None)], "contig string, start long, end long"
    stream = batches_of(spark, tmp_path, rows, schema, 1)
    assert run_depth(spark, tmp_path, stream, "depth_late", window=50, late="drop") == [("a", 90, 95, 1), ("a", 100, 120, 1)]
    (tmp_path / "again").mkdir()
    with pytest.raises(Exception, match="begins before 50"):
        run_depth(spark, tmp_path / "again", stream, "depth_error", window=50)


def test_upserts_rewrite_touched_buckets_only(spark, tmp_path):
    target, schema = str(tmp_path / "table"), "k long, n long, v string"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    upserts.merge_batch(frame([(k, 1, "old") for k in range(300)]), 0, target, ["k"], "n", 64)
    before = upserts._read(spark, target, 0)
    for _ in range(2):  # a batch that is run again gives the same
        upserts.merge_batch(frame([(7, 2, "new"), (7, 0, "older"), (999, 1, "more")]), 1, target, ["k"], "n", 64)
    after = upserts._read(spark, target, 1)
    assert 0 < sum(before.get(b) != f for b, f in after.items()) <= 2
    got = {r.k: (r.n, r.v) for r in upserts.current(spark, target, schema).collect()}
    assert got == {**{k: (1, "old") for k in range(300)}, 7: (2, "new"), 999: (1, "more")}
    upserts.merge_batch(frame([]), 2, target, ["k"], "n", 64)
    assert upserts.current(spark, target, schema).count() == 301


def test_upserts_of_a_stream(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.randrange(40), n, f"v{n}") for n in range(120)]
    rng.shuffle(rows)
    schema = "k long, n long, v string"
    upserts.upserts(batches_of(spark, tmp_path, rows, schema, 40), str(tmp_path / "t"), ["k"], "n", str(tmp_path / "c"), buckets=8).start().awaitTermination()
    want = {}
    for k, n, v in rows:
        want[k] = max(want.get(k, (-1, "")), (n, v))
    assert {r.k: (r.n, r.v) for r in upserts.current(spark, str(tmp_path / "t"), schema).collect()} == want
