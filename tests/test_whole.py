import glob

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from loomspan.operators import relational

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="no tables here")


def run(spark, name):
    return __spark_entry__.queries()[name](spark, SF)


def ids(frame, column):
    return sorted(r[0] for r in frame.select(column).collect())


def test_p2_maps_every_document(spark):
    assert ids(run(spark, "p2_plain_bases_whole"), "doc_id") == ids(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")


def test_o6_and_o7_order_every_row(spark):
    parts = run(spark, "o7_order_by_distance_whole").collect()
    assert sorted(r["place"] for r in parts) == list(range(1, spark.read.parquet(f"{SF}/part.parquet").count() + 1))
    pages = [(-r["size"], r["page_id"]) for r in run(spark, "o6_longest_first_whole").collect()]
    assert pages == sorted(pages) and [p[1] for p in sorted(pages, key=lambda p: p[1])] == ids(spark.read.parquet(f"{SF}/pages.parquet"), "page_id")


def test_o6_has_no_limit(spark, tmp_path):
    frame = spark.range(120).select(F.col("id").alias("page_id"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("html"))
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    got = [r["page_id"] for r in __spark_entry__.queries()["o6_longest_first_whole"](spark, str(tmp_path)).collect()]
    assert got == sorted(range(120), key=lambda i: (-(i % 7), i))


def test_places_are_numbered_in_blocks(spark):
    rows = spark.range(0, 1000, 1, 5).select("id", (F.col("id") * 37 % 11).alias("x"))
    got = relational.numbered(rows, [F.col("x").desc(), F.col("id")], "place")
    want = sorted(range(1000), key=lambda i: (-(i * 37 % 11), i))
    assert [r["id"] for r in sorted(got.collect(), key=lambda r: r["place"])] == want
    assert got.columns == ["id", "x", "place"]


def test_numbering_uses_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = relational.numbered(spark.range(0, 1000, 1, 5), [F.col("id")], "place")
        assert [r["place"] for r in got.orderBy("id").collect()] == list(range(1, 1001))
        assert len(got.inputFiles()) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
