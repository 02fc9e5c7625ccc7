"""op11: weight, score and rank of every document when a tenth is drawn to resemble the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.resampling import ResampleConfig, resample
from loomspan.llm.text import CRC_TABLE_SQL, crc32_sql

NAME = "op11_importance_resampling"
CONFIG = ResampleConfig()

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH {CRC_TABLE_SQL},
d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
w AS (SELECT unnest(ws) AS w, doc_id FROM d),
q AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
v AS (SELECT w FROM w UNION SELECT w FROM q),
b AS MATERIALIZED (SELECT w, {crc32_sql('w')} % {CONFIG.buckets} AS k FROM v, crc_table),
s AS (SELECT k, count(*) AS s FROM w JOIN b USING (w) GROUP BY 1),
t AS (SELECT k, count(*) AS t FROM q JOIN b USING (w) GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM w)::DOUBLE AS s, (SELECT count(*) FROM q)::DOUBLE AS t),
g AS (SELECT k.k, floor(1000 * ln((coalesce(t.t, 0) + 1)::DOUBLE * (n.s + {CONFIG.buckets}) / ((coalesce(s.s, 0) + 1)::DOUBLE * (n.t + {CONFIG.buckets})))) AS gain FROM (SELECT DISTINCT k FROM b) k LEFT JOIN s USING (k) LEFT JOIN t USING (k), n),
x AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM w JOIN b USING (w) JOIN g USING (k) GROUP BY 1),
y AS (SELECT d.doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, CAST('0x' || substr(sha256('{CONFIG.seed}:' || d.doc_id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN x USING (doc_id)),
z AS (SELECT doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score FROM y),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM z WHERE n_features >= {CONFIG.min_words})
SELECT z.*, CASE WHEN rank <= {CONFIG.percent} * n // 100 THEN rank END AS rank FROM z LEFT JOIN r USING (doc_id)
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), CONFIG, "item_id")
