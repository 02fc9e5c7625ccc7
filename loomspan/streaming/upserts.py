"""A table of newest rows kept by a stream, of which a batch rewrites the touched parts only.

Rows lie in buckets of their keys. A batch writes new versions of the buckets that it touches, and then
a manifest of every bucket's folder. The manifest is written aside and renamed, so readers see a batch
whole or not at all, and a batch that is run again writes the same.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _manifests(spark: SparkSession, target: str) -> list[int]:
    fs, where = _files(spark, f"{target}/manifests")
    if not fs.exists(where):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(where) if s.getPath().getName().isdigit())


def _read(spark: SparkSession, target: str, n: int) -> dict[str, str]:
    return json.loads("".join(r.value for r in spark.read.text(f"{target}/manifests/{n}").collect()))


def _write(spark: SparkSession, target: str, n: int, folders: dict[str, str]) -> None:
    fs, aside = _files(spark, f"{target}/manifests/.{n}.tmp")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(folders).encode()))
    out.close()
    _, place = _files(spark, f"{target}/manifests/{n}")
    if fs.exists(place):
        fs.delete(place, False)
    if not fs.rename(aside, place):
        raise OSError(f"manifest {n} of {target} was not put in place")


def current(spark: SparkSession, target: str, schema) -> DataFrame:
    """The table as the newest manifest has it."""
    known = _manifests(spark, target)
    folders = list(_read(spark, target, known[-1]).values()) if known else []
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def merge_batch(batch: DataFrame, batch_id: int, target: str, keys: list[str], order: str, buckets: int) -> None:
    """Take a batch in: of each key the row with the largest `order` stays (ties: the largest row)."""
    spark = batch.sparkSession
    known = [n for n in _manifests(spark, target) if n < batch_id]
    folders = _read(spark, target, known[-1]) if known else {}
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    batch.persist()
    try:
        touched = sorted(r[0] for r in batch.select(bucket.alias("k")).distinct().collect())  # at most `buckets` numbers
        if not touched:
            return
        old = [folders[str(k)] for k in touched if str(k) in folders]
        both = batch if not old else batch.unionByName(spark.read.schema(batch.schema).parquet(*old))
        newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), F.struct(*batch.columns).desc()))
        kept = both.withColumn("_n", newest).filter("_n = 1").drop("_n").withColumn("_bucket", bucket)
        place = f"{target}/data/batch-{batch_id}"
        kept.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(place)
    finally:
        batch.unpersist()
    _write(spark, target, batch_id, folders | {str(k): f"{place}/_bucket={k}" for k in touched})


def upserts(stream: DataFrame, target: str, keys: list[str], order: str, checkpoint: str, buckets: int = 1000):
    """A query, to be started, that keeps the newest row of each key under `target`; current() reads it."""

    def take(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, target, keys, order, buckets)

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True)
