"""op8: shard and slot of every document under the law of near equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.sharding import shard

NAME = "op8_minimax_sharding"
SHARDS = 8


def _sql() -> str:
    """The capacity by dynamic programming over group ends, then a greedy fill; crc32 from its table."""
    steps = [
        "d AS (SELECT doc_id, text, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size, coalesce(md5(text), '') AS g FROM documents)",
        "f AS (SELECT g, min(doc_id) AS first FROM d GROUP BY g)",
        "r AS (SELECT d.*, first, row_number() OVER w - 1 AS rank, sum(size) OVER (w ROWS UNBOUNDED PRECEDING) AS upto FROM d JOIN f USING (g)"
        " WINDOW w AS (ORDER BY first NULLS FIRST, g, doc_id NULLS FIRST))",
        "e AS MATERIALIZED (SELECT CAST(max(upto) AS BIGINT) AS p, max(rank) + 1 AS n FROM r GROUP BY g UNION ALL SELECT 0, 0)",
        "f1 AS MATERIALIZED (SELECT p, p AS c FROM e)",
    ]
    for k in range(2, SHARDS + 1):
        steps.append(f"f{k} AS MATERIALIZED (SELECT e.p, min(greatest(x.c, e.p - x.p)) AS c FROM e JOIN f{k - 1} x ON x.p <= e.p GROUP BY e.p)")
    steps += [
        f"cap AS (SELECT c FROM f{SHARDS} ORDER BY p DESC LIMIT 1)",
        "s0 AS (SELECT CAST(0 AS BIGINT) AS p, CAST(0 AS BIGINT) AS n)",
    ]
    for k in range(1, SHARDS + 1):
        steps.append(f"s{k} AS MATERIALIZED (SELECT p, n FROM e WHERE p <= (SELECT s{k - 1}.p + c FROM s{k - 1}, cap) ORDER BY p DESC LIMIT 1)")
    cuts = " UNION ALL ".join(f"SELECT {k} AS shard, p, n FROM s{k}" for k in range(SHARDS))
    steps.append(f"cuts AS ({cuts})")
    steps.append(
        "tab AS (SELECT list(list_reduce([CAST(n AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) x(n))"
    )
    steps.append(
        "b AS (SELECT doc_id, size, t, hex(encode(coalesce(text, ''))) AS h FROM d, tab)"
    )
    steps.append(
        "z AS (SELECT DISTINCT doc_id, size, xor(list_reduce([4294967295] || list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),"
        " lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) AS text_crc32 FROM b)"
    )
    steps.append("a AS (SELECT r.doc_id, r.text, r.size, r.rank, max(cuts.shard) AS shard, max(cuts.n) AS n FROM r JOIN cuts ON r.upto > cuts.p GROUP BY ALL)")
    return "WITH " + ",\n".join(steps) + " SELECT a.doc_id, a.size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard, CAST(rank - n AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM a JOIN z USING (doc_id)"


SQL = _sql()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), SHARDS)
