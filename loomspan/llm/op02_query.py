"""op2: predicted language of every document, learned outside one of four folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm import langid

NAME = "op2_language_id"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = F.coalesce(langid.fold(F.col("doc_id"), 4), F.lit(0))
    model = langid.train(docs.filter(fold != 2))
    return langid.predict(docs, model).select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score", "accepted")
