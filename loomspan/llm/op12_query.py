"""op12: near words, form and root of every frequent word."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.spelling import SpellingConfig, variants
from loomspan.llm.text import CRC_TABLE_SQL, crc32_sql

NAME = "op12_spelling_variants"
CONFIG = SpellingConfig()

SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
o AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS r FROM documents),
p AS (SELECT doc_id, r, count(*) AS n FROM o GROUP BY 1, 2),
h AS (SELECT r, n, {crc32_sql("doc_id || ':' || r")} AS h FROM p, crc_table),
x AS (SELECT n, CASE WHEN h % {CONFIG.damage} = 0 THEN left(r, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word FROM h),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM x WHERE length(word) >= {CONFIG.min_length} GROUP BY 1 HAVING sum(n) >= {CONFIG.min_count}),
c AS MATERIALIZED (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS v FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
e AS (SELECT a.word, b.word AS near FROM c a JOIN c b ON a.i = b.i AND a.v = b.v AND a.word <> b.word UNION SELECT c.word, w.word FROM c JOIN w ON c.v = w.word UNION SELECT w.word, c.word FROM c JOIN w ON c.v = w.word),
f AS (SELECT e.word, w.word AS near, w.n, row_number() OVER (PARTITION BY e.word ORDER BY w.n DESC, w.word) AS k, count(*) OVER (PARTITION BY e.word) AS n_near FROM e JOIN w ON e.near = w.word),
g AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN f.n >= {CONFIG.ratio} * w.n THEN near END AS form, CASE WHEN f.n >= {CONFIG.ratio} * w.n THEN f.n END AS form_n FROM w LEFT JOIN f ON f.word = w.word AND k = 1),
t AS (SELECT word, word AS last FROM g UNION ALL SELECT t.word, g.form FROM t JOIN g ON t.last = g.word WHERE g.form IS NOT NULL)
SELECT g.word, form, last AS root, n, n_near, form_n FROM g JOIN t ON t.word = g.word WHERE last IN (SELECT word FROM g WHERE form IS NULL)
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"), CONFIG)
