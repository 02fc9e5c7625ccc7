"""op4: raked weight, sampling probability and decision for every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm.mixing import MARGINS, MixConfig, mix

NAME = "op4_source_mixing"
CONFIG = MixConfig()


def _sql(config: MixConfig) -> str:
    """Fitting as one common table expression for each step, over the cell table."""
    steps = [
        r"""d AS (SELECT doc_id, source, lang,
 CASE WHEN text IS NULL OR length(text) = 0 THEN 'empty'
  WHEN length(text) < 80 * (length(text) - length(replace(text, chr(10), '')) + 1) THEN 'list'
  WHEN length(text) < 1500 THEN 'brief' ELSE 'prose' END AS topic,
 CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens FROM documents)""",
        "c AS (SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens FROM d GROUP BY 1, 2, 3)",
        "w0 AS (SELECT *, tokens / (SELECT sum(tokens) FROM c) AS weight FROM c)",
    ]
    for m, p in zip(MARGINS, config.temper, strict=True):
        steps.append(f"n_{m} AS (SELECT {m}, CASE WHEN sum(weight) > 0 THEN pow(sum(weight), {p}) ELSE 0.0 END AS t FROM w0 GROUP BY 1)")
        steps.append(f"t_{m} AS (SELECT {m}, t / (SELECT sum(t) FROM n_{m}) AS target FROM n_{m})")
    k = 0
    for _ in range(config.rounds):
        for m in MARGINS:
            steps.append(
                f"w{k + 1} AS MATERIALIZED (SELECT w.* REPLACE (CASE WHEN sum(weight) OVER (PARTITION BY w.{m}) > 0 THEN weight * target / sum(weight) OVER (PARTITION BY w.{m}) ELSE 0.0 END AS weight)"
                f" FROM w{k} w JOIN t_{m} ON w.{m} IS NOT DISTINCT FROM t_{m}.{m})"
            )
            k += 1
    steps += [
        f"b AS (SELECT *, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0.0 END AS boost FROM w{k})",
        # Cells sorted by boost: the certain ones are a prefix, the scale belongs to the first prefix that is consistent.
        "o AS (SELECT *, coalesce(sum(tokens) OVER h, 0) AS before, sum(tokens * boost) OVER (ORDER BY boost, source, lang, topic) AS rest FROM b WHERE tokens > 0"
        " WINDOW h AS (ORDER BY boost DESC, source DESC, lang DESC, topic DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))",
        f"s AS (SELECT arg_max(scale, boost) AS scale FROM (SELECT *, ({config.budget} * (SELECT sum(tokens) FROM c) - before) / rest AS scale FROM o) WHERE scale * boost < 1)",
        f"p AS (SELECT *, CASE WHEN tokens > 0 THEN least(1.0, boost * (SELECT scale FROM s)) ELSE {config.budget} END AS probability FROM b)",
    ]
    return (
        "WITH " + ",\n".join(steps) + " SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, round(d.tokens * boost, 12) AS weight, round(probability, 9) AS probability,"
        " CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) / 4503599627370496.0 < probability AS kept"
        " FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang AND d.topic = p.topic"
    )


SQL = _sql(CONFIG)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), CONFIG)
    return mixed.withColumn("weight", F.round("weight", 12)).withColumn("probability", F.round("probability", 9))
