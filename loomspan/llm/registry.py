"""Registry of the training-data queries: op1 to op13 and the pipeline."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: One module for each query; each has NAME, query(spark, sf_dir) and, where SQL can express it, SQL.
MODULES = ["op01_query", "op02_query", "op03_query", "op04_query", "op05_query", "op06_query", "op07_query", "op08_query", "op09_query", "op10_query", "op11_query", "op12_query", "op13_query"]


def _all():
    for name in MODULES:
        yield importlib.import_module(f"loomspan.llm.{name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    found = {m.NAME: m.query for m in _all()}
    found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {m.NAME: m.SQL for m in _all() if getattr(m, "SQL", None)}
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
