"""Alignment, tree and graph queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.operators import alignments as al
from loomspan.operators import graph, trees
from loomspan.plans.catalog import query, table


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as alignments: the order is the query, the part the target."""
    n = F.col("l_quantity").cast("long")
    return table(spark, sf_dir, "lineitem").select(
        (((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")) * 1000 + F.floor("l_extendedprice") % 1000).alias("id"),
        (F.col("l_orderkey") % 500).cast("string").alias("query"),
        F.lit(1000).cast("long").alias("qlen"),
        (F.col("l_suppkey") * 7 % 900).alias("qstart"),
        (F.col("l_suppkey") * 7 % 900 + n).alias("qend"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        (F.col("l_partkey") % 4).cast("string").alias("target"),
        F.lit(5000).cast("long").alias("tlen"),
        (F.col("l_partkey") * 3 % 4900).alias("tstart"),
        (F.col("l_partkey") * 3 % 4900 + n).alias("tend"),
        (n - F.col("l_linenumber")).alias("matches"),
        n.alias("block"),
        (F.col("l_orderkey") % 61).alias("mapq"),
        F.when(F.col("l_linenumber") % 3 > 0, F.col("l_extendedprice")).alias("score"),
    )


ALN = """WITH aln AS (SELECT ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 1000 + CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS id, CAST(l_orderkey % 500 AS VARCHAR) AS query, 1000 AS qlen, l_suppkey * 7 % 900 AS qstart, l_suppkey * 7 % 900 + CAST(l_quantity AS BIGINT) AS qend,
 CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, CAST(l_partkey % 4 AS VARCHAR) AS target, l_partkey * 3 % 4900 AS tstart, l_partkey * 3 % 4900 + CAST(l_quantity AS BIGINT) AS tend,
 CAST(l_quantity AS BIGINT) - l_linenumber AS matches, CAST(l_quantity AS BIGINT) AS block, l_orderkey % 61 AS mapq, CASE WHEN l_linenumber % 3 > 0 THEN l_extendedprice END AS score FROM lineitem)"""

KEEP = "query = '7' OR coalesce(mapq >= 20 AND block >= 10 AND matches / (block + 1e-8) >= 0.7 AND (score IS NULL OR score >= 5000), false)"


def _keep():
    return al.quality(min_mapq=20, min_block=10, min_identity=0.7, min_score=5000, is_reference=F.col("query") == "7")


@query("f1_alignment_quality", f"{ALN} SELECT id, query FROM aln WHERE {KEEP}")
def f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(spark, sf_dir).filter(_keep()).select("id", "query")


@query("f2_eliminated_queries", f"{ALN}, o AS (SELECT * REPLACE (CAST(id // 10000000000 AS VARCHAR) AS query) FROM aln) SELECT query, count(*) AS rows FROM o GROUP BY 1 HAVING count(*) FILTER ({KEEP}) = 0")
def f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, as queries, that lose every row."""
    rows = alignments(spark, sf_dir).withColumn("query", F.expr("id div 10000000000").cast("string"))
    return al.eliminated(rows, _keep())


@query("f4_large_mappings", f"{ALN} SELECT id FROM aln WHERE mapq <> 55 AND mapq >= 5 AND tend - tstart >= 40")
def f4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(spark, sf_dir).filter("mapq <> 55 AND mapq >= 5 AND tend - tstart >= 40").select("id")


@query("a1_mapping_profile", f"{ALN} SELECT mapq, matches = block AS perfect, block, count(*) AS n FROM aln GROUP BY 1, 2, 3")
def a1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(spark, sf_dir).groupBy("mapq", (F.col("matches") == F.col("block")).alias("perfect"), "block").agg(F.count("*").alias("n"))


@query("u2_inverted_alignments", f"{ALN} SELECT id, target AS query, query AS target, tstart AS qstart, qstart AS tstart FROM aln")
def u2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.invert(alignments(spark, sf_dir)).select("id", "query", "target", "qstart", "tstart")


@query(
    "c10_gap_free_runs",
    f"{ALN}, r AS (SELECT *, unnest([{{q: 0, t: 0, n: 5}}, {{q: 7, t: 5, n: 4}}, {{q: 11, t: 12, n: 1}}]) AS r FROM aln)"
    " SELECT id, CASE WHEN strand = '+' THEN qstart + r.q ELSE qend - r.q - r.n END AS qpos, tstart + r.t AS tpos, CAST(r.n AS BIGINT) AS length FROM r",
)
def c10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignments(spark, sf_dir).withColumn("query", F.col("id"))
    return al.to_matches(rows, F.lit("3M2X2I4=3D1M")).select(F.col("query").alias("id"), "qpos", "tpos", "length")


@query(
    "c10_runs_of_own_cigars",
    f"{ALN}, r AS (SELECT *, unnest(CASE WHEN block < 8 THEN [{{q: 0, t: 0, n: block}}] ELSE [{{q: 0, t: 0, n: 3}}, {{q: 5, t: 3, n: 1}}, {{q: 6, t: 6, n: block - 6}}] END) AS r FROM aln)"
    " SELECT id, CAST(CASE WHEN strand = '+' THEN qstart + r.q ELSE qend - r.q - r.n END AS BIGINT) AS qpos, CAST(tstart + r.t AS BIGINT) AS tpos, CAST(r.n AS BIGINT) AS length FROM r",
)
def c10_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each alignment by a CIGAR of its own length."""
    n = F.col("block")
    cigar = F.when(n < 8, F.concat(n.cast("string"), F.lit("M"))).otherwise(F.concat(F.lit("3M2I1=2D"), (n - 6).cast("string"), F.lit("X")))
    rows = alignments(spark, sf_dir).withColumn("query", F.col("id")).withColumn("cigar", cigar)
    return al.to_matches(rows, F.col("cigar")).select(F.col("query").alias("id"), "qpos", "tpos", "length")


@query("c1_collinear_chains")
def c1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignments(spark, sf_dir).withColumn("score", F.coalesce("score", F.lit(1.0)))
    return al.chain(rows, max_gap=400, gap_open=1.0, gap_extend=0.1).select("id", "chain_id", F.round("chain_score", 4).alias("chain_score"))


TILE = """, s AS (SELECT id, query, qstart, qend, coalesce(score, 1.0) AS score FROM aln),
p AS (SELECT a.id, b.d, count(*) AS k FROM s a JOIN (SELECT query, id, score, unnest(range(qstart, qend)) AS d FROM s) b ON a.query = b.query AND b.d >= a.qstart AND b.d < a.qend AND (b.score > a.score OR b.score = a.score AND b.id < a.id) GROUP BY 1, 2)
SELECT s.id, CAST(1 + coalesce(max(p.k), 0) AS BIGINT) AS level FROM s LEFT JOIN p USING (id) GROUP BY s.id"""


@query("c2_tile_levels", ALN + TILE)
def c2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.tile(alignments(spark, sf_dir).withColumn("score", F.coalesce("score", F.lit(1.0)))).select("id", "level")


@query("c4_primary_selection")
def c4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignments(spark, sf_dir).withColumn("score", F.coalesce("score", F.lit(1.0)))
    return al.select_primary(rows, 400, 20_000.0).select("id", "tag", "level")


@query(
    "c12_consistency_cut",
    """WITH s AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, event_id % 17 AS l, event_id % 13 AS r FROM events),
c AS (SELECT user_id, k AS cut FROM s UNION ALL SELECT user_id, max(k) + 1 FROM s GROUP BY 1),
v AS (SELECT c.user_id, c.cut, CAST(coalesce(sum(l) FILTER (s.k < c.cut), 0) + coalesce(sum(r) FILTER (s.k >= c.cut), 0) AS BIGINT) AS score FROM c JOIN s USING (user_id) GROUP BY 1, 2)
SELECT user_id, arg_max(cut, (score, -cut)) AS cut, max(score) AS score FROM v GROUP BY 1""",
)
def c12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    k = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long")
    scored = table(spark, sf_dir, "events").select("user_id", k.alias("k"), (F.col("event_id") % 17).alias("l"), (F.col("event_id") % 13).alias("r"))
    return al.consistency_cut(scored, ["user_id"], "k", "l", "r")


@query(
    "c14_gapless_blocks",
    """WITH b AS (SELECT l_partkey AS msa, CAST(l_suppkey % 40 AS BIGINT) AS col, l_linenumber AS r FROM lineitem), p AS (SELECT msa, col, list_sort(list(DISTINCT r)) AS rows FROM b GROUP BY 1, 2),
f AS (SELECT *, CASE WHEN lag(col) OVER w = col - 1 AND lag(rows) OVER w = rows THEN 0 ELSE 1 END AS fresh FROM p WINDOW w AS (PARTITION BY msa ORDER BY col)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY msa ORDER BY col ROWS UNBOUNDED PRECEDING) AS k FROM f)
SELECT msa, min(col) AS start, max(col) + 1 AS "end", CAST(any_value(len(rows)) AS INTEGER) AS rows FROM g WHERE len(rows) >= 2 GROUP BY msa, k""",
)
def c14(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("msa"), (F.col("l_suppkey") % 40).alias("col"), F.col("l_linenumber").alias("r"))
    return al.gapless_blocks(cells, ["msa"], "col", "r").withColumn("rows", F.size("rows"))


# -- trees: region -> nation -> customer


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, parent, length): world, regions, nations and suppliers."""
    world = spark.createDataFrame([("world", None, None)], "id string, parent string, length double")
    regions = table(spark, sf_dir, "region").select("r_name", F.lit("world").alias("p"), (F.col("r_regionkey") / 10 + 0.5).alias("l"))
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name", (F.col("n_nationkey") / 100).alias("l"))
    suppliers = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_name", "n_name", (F.col("s_suppkey") % 7 / 10).alias("l"))
    return world.union(regions).union(nations).union(suppliers)


TREE = """tree AS (SELECT 'world' AS id, NULL AS parent, CAST(NULL AS DOUBLE) AS length UNION ALL SELECT r_name, 'world', r_regionkey / 10 + 0.5 FROM region
 UNION ALL SELECT n_name, r_name, n_nationkey / 100 FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT s_name, n_name, s_suppkey % 7 / 10 FROM supplier JOIN nation ON s_nationkey = n_nationkey),
up AS (SELECT id AS ancestor, id AS descendant, 0 AS hops, CAST(0 AS DOUBLE) AS dist FROM tree UNION ALL SELECT t.parent, up.descendant, up.hops + 1, up.dist + coalesce(t.length, 0) FROM up JOIN tree t ON up.ancestor = t.id WHERE t.parent IS NOT NULL)"""


@query("t3_ancestors", f"WITH RECURSIVE {TREE} SELECT ancestor, descendant, hops, round(dist, 9) AS dist FROM up")
def t3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.closure(tree(spark, sf_dir)).withColumn("dist", F.round("dist", 9))


@query(
    "t1_pairwise_distances",
    f"WITH RECURSIVE {TREE}, n AS (SELECT n_name AS id FROM nation), m AS (SELECT x.descendant AS a, y.descendant AS b, x.ancestor AS lca, x.dist + y.dist AS dist, row_number() OVER (PARTITION BY x.descendant, y.descendant ORDER BY x.hops) AS k FROM up x JOIN up y ON x.ancestor = y.ancestor AND x.descendant < y.descendant WHERE x.descendant IN (FROM n) AND y.descendant IN (FROM n)) SELECT a, b, lca, round(dist, 9) AS dist FROM m WHERE k = 1",
)
def t1(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    pairs = n.select(F.col("n_name").alias("a")).join(n.select(F.col("n_name").alias("b")), F.col("a") < F.col("b"))
    return trees.ancestors_in_common(tree(spark, sf_dir), pairs).withColumn("dist", F.round("dist", 9))


@query("t5_heights", f"WITH RECURSIVE {TREE}, leaf AS (SELECT id FROM tree WHERE id NOT IN (SELECT parent FROM tree WHERE parent IS NOT NULL)) SELECT ancestor AS id, round(max(dist) FILTER (descendant IN (FROM leaf)), 9) AS height, count(*) FILTER (descendant IN (FROM leaf)) AS leaves, round(coalesce(sum(length) FILTER (hops > 0), 0.0), 9) AS branch_length FROM up JOIN tree ON tree.id = descendant GROUP BY 1")
def t5(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = trees.heights(tree(spark, sf_dir))
    return h.select("id", F.round("height", 9).alias("height"), "leaves", F.round("branch_length", 9).alias("branch_length"))


@query(
    "t6_event_weights",
    f"""WITH RECURSIVE {TREE}, c AS (SELECT s_name AS id FROM supplier WHERE s_suppkey % 5 = 0), s AS (SELECT ancestor AS branch, count(*) AS paths FROM up WHERE descendant IN (FROM c) GROUP BY 1),
w AS (SELECT up.descendant AS id, t.length, s.paths FROM up JOIN tree t ON t.id = up.ancestor JOIN s ON s.branch = up.ancestor WHERE up.descendant IN (FROM c) AND t.parent IS NOT NULL)
SELECT id, round(exp(-0.5 * sum(length)) * CASE WHEN sum(length) > 0 THEN sum(length / paths) / sum(length) ELSE 1 END, 9) AS weight FROM w GROUP BY 1""",
)
def t6(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "supplier").filter("s_suppkey % 5 = 0").select(F.col("s_name").alias("id"))
    return trees.event_weights(tree(spark, sf_dir), chosen, "world", 0.5).withColumn("weight", F.round("weight", 9))


@query("t9_pruned_tree", f"WITH RECURSIVE {TREE} SELECT id, coalesce(parent, '-') AS parent, round(coalesce(length, 0.0), 9) AS length FROM tree WHERE id IN (SELECT ancestor FROM up WHERE descendant IN (SELECT s_name FROM supplier WHERE s_acctbal > 5000))")
def t9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rich = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select(F.col("s_name").alias("id"))
    return trees.prune(tree(spark, sf_dir), rich).select("id", F.coalesce("parent", F.lit("-")).alias("parent"), F.round(F.coalesce("length", F.lit(0.0)), 9).alias("length"))


def _inside(level: str, of: str, name: str, label: str) -> str:
    """SQL of a level's texts, those of the level below in brackets before each."""
    return f"{level} AS (SELECT {name} AS id, coalesce('(' || (SELECT string_agg(t, ',' ORDER BY x.id, t) FROM {of} x WHERE x.parent = {name}) || ')', '') || {label} AS t"


@query(
    "k12_newick",
    f"""WITH s AS (SELECT s_name AS id, s_name || ':' || CAST(s_suppkey % 7 / 10 AS VARCHAR) AS t, n_name AS parent FROM supplier JOIN nation ON s_nationkey = n_nationkey),
{_inside('n', 's', 'n_name', "n_name || ':' || CAST(n_nationkey / 100 AS VARCHAR)")}, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey),
{_inside('r', 'n', 'r_name', "r_name || ':' || CAST(r_regionkey / 10 + 0.5 AS VARCHAR)")}, 'world' AS parent FROM region)
SELECT 'world' AS id, '(' || string_agg(t, ',' ORDER BY id, t) || ')world;' AS newick FROM r""",
)
def k12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.write_newick(tree(spark, sf_dir))


# -- graphs


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(a, b, score): parts and suppliers of all items; suppliers numbered below 0."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), (-1 - F.col("l_orderkey") % 1000).alias("b"), F.col("l_extendedprice").alias("score"))


def _labels(rounds: int) -> str:
    """SQL of the least node around each node, taken over and over; the parts of this graph are a few links wide."""
    steps = ["e AS MATERIALIZED (SELECT DISTINCT l_partkey AS a, -1 - l_orderkey % 1000 AS b FROM lineitem)", "x AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e UNION SELECT a, a FROM e UNION SELECT b, b FROM e)", "m0 AS MATERIALIZED (SELECT a AS id, min(b) AS m FROM x GROUP BY 1)"]
    steps += [f"m{k} AS MATERIALIZED (SELECT x.a AS id, min(y.m) AS m FROM x JOIN m{k - 1} y ON y.id = x.b GROUP BY 1)" for k in range(1, rounds + 1)]
    return "WITH " + ", ".join(steps) + f" SELECT id, m AS component FROM m{rounds}"


@query("g6_connected_components", _labels(12))
@query("g6_connected_components_whole", _labels(12))
def g6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.connected_components(links(spark, sf_dir))


@query("g8_greedy_break_up")
def g8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.break_up_greedily(links(spark, sf_dir), None, 10)


DEGREES = "WITH l AS (SELECT DISTINCT l_partkey AS a, -1 - l_orderkey % 1000 AS b FROM lineitem) SELECT id, count(*) AS degree FROM (SELECT a AS id FROM l UNION ALL SELECT b FROM l) GROUP BY 1"


@query("v1_node_degree", DEGREES)
@query("v1_node_degree_whole", DEGREES)
def v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.degrees(links(spark, sf_dir))


@query("g18_hierarchy_levels", f"WITH RECURSIVE {TREE} SELECT descendant AS id, max(hops) AS level FROM up GROUP BY 1")
def g18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.closure(tree(spark, sf_dir)).groupBy(F.col("descendant").alias("id")).agg(F.max("hops").alias("level"))


@query("g10_degree_one_blocks", "SELECT p_partkey AS cell, CAST(p_size AS BIGINT) AS length FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def g10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that no block covers become blocks of their own."""
    covered = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select("l_partkey")
    return table(spark, sf_dir, "part").join(covered, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select(F.col("p_partkey").alias("cell"), F.col("p_size").cast("long").alias("length"))
