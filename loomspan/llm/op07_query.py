"""op7: near-duplicate component of every document, by an exact Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.jaccard import near_duplicates

NAME = "op7_jaccard_join"

SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[p : p + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS p FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS k FROM g GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.k + y.k - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id)
SELECT w.doc_id, CAST(coalesce(n.k, 0) AS BIGINT) AS n_shingles, CAST(coalesce(m.root, w.doc_id) AS BIGINT) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT id, min(root) AS root FROM r GROUP BY 1) m ON m.id = w.doc_id
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
