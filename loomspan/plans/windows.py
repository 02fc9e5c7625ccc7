"""Time-window queries over events: the batch forms of the streaming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.plans.catalog import query, table
from loomspan.streaming import coverage


@query(
    "s213_sessions",
    """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, epoch_us(min(ts)) AS start, epoch_us(max(ts)) AS "end", count(*) AS rows FROM g GROUP BY user_id, k""",
)
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = coverage.sessions(table(spark, sf_dir, "events"), "user_id", "ts", "6 hours", "1 day")
    return found.select("user_id", *(F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in ("start", "end")), "rows")


@query("s213_tumbling", "SELECT event_type, epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS start, count(*) AS rows FROM events GROUP BY 1, 2")
def tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = coverage.tumbling(table(spark, sf_dir, "events"), "event_type", "ts", "1 day", "1 day")
    return found.select("event_type", F.unix_micros(F.col("start").cast("timestamp")).alias("start"), "rows")


@query(
    "s213_hopping",
    "SELECT event_type, epoch_us(time_bucket(INTERVAL 12 HOUR, ts)) - h * 43200000000 AS start, count(*) AS rows FROM events, (VALUES (0), (1)) v(h) GROUP BY 1, 2",
)
def hopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = coverage.hopping(table(spark, sf_dir, "events"), "event_type", "ts", "1 day", "12 hours", "1 day")
    return found.select("event_type", F.unix_micros(F.col("start").cast("timestamp")).alias("start"), "rows")
