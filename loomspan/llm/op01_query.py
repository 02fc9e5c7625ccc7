"""op1: base figures and the cross-document line rule's verdict for every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.quality import apply_rules

NAME = "op1_quality_rules"

SQL = r"""
WITH d AS (SELECT doc_id, source, text, row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM d),
pos AS (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS p FROM w WHERE len(ws) >= 3),
tri AS (SELECT rid, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS g FROM pos),
rep AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS n FROM tri) WHERE n >= 2),
cov AS (SELECT rid, count(DISTINCT q) AS n_repeat_words FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY rid),
ln AS (SELECT rid, source, text, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d WHERE text IS NOT NULL),
dup AS (SELECT rid, count(*) AS n_dup_lines FROM (SELECT rid, raw, row_number() OVER (PARTITION BY rid, raw ORDER BY i) AS k FROM ln)
 WHERE k > 1 AND regexp_matches(raw, '[^\x20\x09-\x0D]') GROUP BY rid),
norm AS (SELECT rid, source, text, trim(regexp_replace(lower(raw), '[\x20\x09-\x0D]+', ' ', 'g')) AS line FROM ln),
nb AS (SELECT * FROM norm WHERE line <> ''),
df AS (SELECT source, line, count(DISTINCT text) AS line_docs FROM nb GROUP BY 1, 2),
host AS (SELECT source, count(DISTINCT text) AS host_docs FROM nb GROUP BY 1),
bad AS (SELECT df.source, df.line FROM df JOIN host ON df.source IS NOT DISTINCT FROM host.source WHERE line_docs >= 10 AND line_docs > 0.01 * host_docs),
lost AS (SELECT nb.rid, sum(len(string_split(nb.line, ' '))) AS n_line_words FROM nb JOIN bad ON nb.source IS NOT DISTINCT FROM bad.source AND nb.line = bad.line GROUP BY 1),
base AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
 CAST(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
 CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
 CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
 CAST(coalesce(n_line_words, 0) AS BIGINT) AS n_line_words
 FROM d JOIN w USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN lost USING (rid))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
 NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_line_words >= 0.2 * n_words AS kept FROM base
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
