"""Streaming forms of run merging, depth and windows.

The batch operators' results are those of the whole input; here late rows are dropped by the
watermark instead of being an error, and a window is emitted once it is closed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions(stream: DataFrame, key: str, ts: str, gap: str, delay: str) -> DataFrame:
    """(key, start, end, rows): runs of events at most `gap` apart; end is the last event's time."""
    grouped = stream.withWatermark(ts, delay).groupBy(key, F.session_window(ts, gap).alias("w"))
    return grouped.agg(F.count("*").alias("rows"), F.min(ts).alias("start"), F.max(ts).alias("end")).select(key, "start", "end", "rows")


def tumbling(stream: DataFrame, key: str, ts: str, size: str, delay: str) -> DataFrame:
    """(key, start, rows) by fixed tiles of time."""
    return stream.withWatermark(ts, delay).groupBy(key, F.window(ts, size).alias("w")).agg(F.count("*").alias("rows")).select(key, F.col("w.start").alias("start"), "rows")


def hopping(stream: DataFrame, key: str, ts: str, size: str, step: str, delay: str) -> DataFrame:
    """(key, start, rows) by overlapping windows."""
    return stream.withWatermark(ts, delay).groupBy(key, F.window(ts, size, step).alias("w")).agg(F.count("*").alias("rows")).select(key, F.col("w.start").alias("start"), "rows")


def first_seen(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Rows whose key has not come before, within the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def upsert_batches(stream: DataFrame, target: str, keys: list[str], order: str, checkpoint: str):
    """A query that keeps the newest row of each key in Parquet generations under `target`.

    Each batch writes generation n + 1 from generation n; a reader takes the newest complete one.
    """
    from pyspark.sql import Window

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        both = batch
        if batch_id > 0:
            both = spark.read.schema(batch.schema).parquet(f"{target}/gen-{batch_id - 1}").unionByName(batch)
        newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
        both.withColumn("_k", newest).filter("_k = 1").drop("_k").write.mode("overwrite").parquet(f"{target}/gen-{batch_id}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True)
