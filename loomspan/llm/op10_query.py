"""op10: words left in every document when passages of earlier documents go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.repeats import removal_digests

NAME = "op10_substring_dedup"

SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS s FROM p),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS q FROM f WHERE first < doc_id),
k AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS q FROM w),
s AS (SELECT k.doc_id, count(c.q) AS n_removed, coalesce(string_agg(k.x, ' ' ORDER BY k.q) FILTER (WHERE c.q IS NULL), '') AS kept
 FROM k LEFT JOIN c ON k.doc_id = c.doc_id AND k.q = c.q GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN s USING (doc_id)
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
