"""op13: phrases and licence notices of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.licenses import NOTICES, PHRASES, ScanConfig, scan

NAME = "op13_license_scan"
CONFIG = ScanConfig()


def _sql(config: ScanConfig) -> str:
    """The same votes on the runs' words instead of their hashes."""

    def words(text: str) -> str:
        return f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

    notices = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(NOTICES))
    phrases = ", ".join(f"('{label}', string_split('{phrase}', ' '))" for phrase, label in PHRASES.items())
    k = config.k
    return f"""
WITH d AS (SELECT doc_id, {words('text')} AS ws FROM documents),
w AS MATERIALIZED (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) - 1 AS p FROM d),
g AS MATERIALIZED (SELECT doc_id, ws[i : i + {k - 1}] AS run, i - 1 AS pos FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {k - 2})) AS i FROM d WHERE len(ws) >= {k})),
phrase AS (SELECT * FROM (VALUES {phrases}) v(label, ps)),
b AS (SELECT w.doc_id, label, p FROM phrase JOIN w ON w.x = ps[1] JOIN d ON d.doc_id = w.doc_id AND d.ws[p + 1 : p + len(ps)] = ps),
bb AS (SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY 1),
notice AS (SELECT notice, label, {words('text')} AS ns FROM (VALUES {notices}) v(notice, label, text)),
r AS (SELECT notice, ns[i : i + {k - 1}] AS run, i - 1 AS place FROM (SELECT notice, ns, unnest(range(1, len(ns) - {k - 2})) AS i FROM notice)),
h AS (SELECT doc_id, notice, pos - place AS diagonal, count(DISTINCT pos) AS votes FROM g JOIN r USING (run) GROUP BY ALL),
f AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, notice ORDER BY diagonal) <= {config.shift} THEN 0 ELSE 1 END AS apart FROM h),
s AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, notice ORDER BY diagonal) AS span FROM f),
l AS (SELECT doc_id, notice, span FROM s JOIN notice USING (notice) GROUP BY doc_id, notice, span, ns HAVING sum(votes) >= {config.least_votes} * (len(ns) - {k - 1})),
m AS (SELECT notice, label, unnest(ns) AS x, generate_subscripts(ns, 1) - 1 AS i, len(ns) AS size FROM notice),
v AS (SELECT l.doc_id, l.notice, l.span, m.label, count(DISTINCT m.i) / m.size AS share FROM l JOIN s USING (doc_id, notice, span) JOIN m USING (notice) JOIN w ON w.doc_id = l.doc_id AND w.p = m.i + diagonal AND w.x = m.x GROUP BY l.doc_id, l.notice, l.span, m.label, m.size HAVING count(DISTINCT m.i) / m.size >= {config.least_words}),
n AS (SELECT doc_id, label, share FROM v),
a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM n UNION SELECT doc_id, label FROM b) GROUP BY 1),
x AS (SELECT doc_id, max(share) AS share FROM n GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
 round(CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END, 9) AS score
FROM d LEFT JOIN bb USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN x USING (doc_id)
"""


SQL = _sql(CONFIG)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), config=CONFIG)
