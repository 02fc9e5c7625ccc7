"""Corpus pipeline: quality rules, near duplicates, repeated passages, mixing, tokens.

Each stage works on all rows its predecessor kept. All but the last return the columns of
documents. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspan.llm import bpe, jaccard, mixing, quality, repeats
from loomspan.llm.sketch import parted
from loomspan.session import materialize

#: The mix keeps most tokens: near the natural shares, four fifths of the corpus.
MIX = mixing.MixConfig(temper=(0.9, 0.9, 1.0), budget=0.8)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits leave those that stay. Null and empty texts
    are rejected; repeated rows share a verdict; an empty table stays empty."""
    return quality.remove_rejected(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays.

    Rows without a doc_id stay; of rows that repeat a doc_id one stays.
    """
    found = jaccard.near_duplicates(docs).select("doc_id", "component_id")
    rows = docs.select(F.struct("*").alias("row"))  # whatever the columns are called
    losers = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("id")).distinct()
    near, far = parted(rows, [F.col("row.doc_id").cast("long")], losers, [F.col("id")])  # whole rows: only those that may go are dealt
    kept = far.union(near.join(losers, F.col("row.doc_id") == F.col("id"), "left_anti"))
    repeated = found.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).count().filter("count > 1").select("id")
    if not repeated.isEmpty():
        first = F.row_number().over(Window.partitionBy("row.doc_id").orderBy("row.text")) == 1
        several = kept.join(repeated, F.col("row.doc_id") == F.col("id"), "left_semi").withColumn("first", first).filter("first").select("row")
        kept = kept.join(repeated, F.col("row.doc_id") == F.col("id"), "left_anti").union(several)
    return kept.select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut, and a text that is nothing else goes. Null and
    empty texts stay; rows of one doc_id repeat nothing of each other."""
    return repeats.remove_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled towards the target weights. A null source or language is a value of
    its own; texts without words stay by chance alone; repeated rows share their fate."""
    return mixing.sample(docs, MIX)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, ids (binary, little-endian u32) and n_tokens. A null text is empty,
    and has no ids; repeated rows stay repeated."""
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=("doc_id", "source", "lang"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources", source_mixing),
    ("byte-level BPE", tokens),
]

#: The last stage's ids come from a tokenizer library, which SQL cannot call.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{i}")
    return docs
