"""op6: place, length and checksum of every document's ids, read back from token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.tokenfile import token_digests

NAME = "op6_token_files"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), 2)
