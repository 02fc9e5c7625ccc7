"""op3: base and model log10 probability of every document, learned outside one of five folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm import lm
from loomspan.llm.langid import fold

NAME = "op3_lm_scoring"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(fold(F.col("doc_id"), 5), F.lit(0)) == 1
    scored = lm.score(docs, docs.filter(~held_out), lm.LmConfig(deep=True))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
