"""Session and storage helpers shared by operators, tests and the benchmark."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "loomspan", cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the operators expect (UTC, AQE)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LOOMSPAN_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, as in tests, a
    local session gets a folder of its own; on a cluster that is an error."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    return configured or os.path.join(tempfile.gettempdir(), f"loomspan-{os.getuid()}")


_local = threading.local()


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Within it, tables that materialize() writes in the same thread are temporary: they are
    deleted at its end, but for those written with keep=True. Nothing lazy that reads the
    others may leave it."""
    stack = _local.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            remove(spark, path)


#: Stored tables that are still there: path to (file system, the path there).
_stored: dict[str, tuple] = {}


def _files(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder wherever Spark's paths lead."""
    files, where = _stored.pop(path, None) or _files(spark, path)
    files.delete(where, True)


@atexit.register
def remove_stored() -> None:
    """Delete all tables of materialize() that are still there. It runs when the process ends, as results
    are read from them until then; a process that is killed leaves its tables."""
    for path in list(_stored):
        files, where = _stored.pop(path)
        with contextlib.suppress(Exception):  # the session's JVM may have ended
            files.delete(where, True)


def discard(table: DataFrame) -> None:
    """Delete a table of materialize() that nothing will read again."""
    if path := table.__dict__.get("_stored_at"):
        remove(table.sparkSession, path)


def materialize(df: DataFrame, name: str, keep: bool = False, **options: str) -> DataFrame:
    """Write df as Parquet, by Spark's writer options if any, in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation
    of everything before it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    stack = _local.__dict__.get("stack")
    if stack and not keep:
        stack[-1].append(path)
    _stored[path] = _files(spark, path)
    df.write.mode("overwrite").options(**options).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored
