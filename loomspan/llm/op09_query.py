"""op9: every document as a FLAC stream, read back and digested."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.media import media_digests, store_media
from loomspan.session import materialize

NAME = "op9_flac_media"

#: Streams of near texts lie in one page, which the codec of the files can make use of.
STORED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6", "parquet.page.size": str(8 << 20), "parquet.enable.dictionary": "false"}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams are stored in the shared folder; the digests are of what is read back from there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return media_digests(materialize(store_media(docs), "media", **STORED))
