"""op5: digests of BPE ids and of their decoded bytes for every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.bpe import token_digests

NAME = "op5_bpe_encode_decode"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
