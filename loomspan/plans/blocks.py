"""Queries over blocks, chains, clipped alignments and their filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspan.operators import alignments as al
from loomspan.operators import blocks, clipping, trees
from loomspan.operators import intervals as iv
from loomspan.operators import relational as rel
from loomspan.plans.catalog import query, table
from loomspan.plans.intervals import SPANS
from loomspan.plans.structure import ALN, TREE, alignments, tree
from loomspan.sources import sinks


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a sequence of its own, aligned to some place of its customer's; every third reversed."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("c"), "o_custkey").alias("a_seq"), (k * 7 % 50).alias("a_start"), F.concat(F.lit("o"), k).alias("b_seq"), F.lit(0).cast("long").alias("b_start"), (k % 20 + 1).alias("length"), F.when(k % 3 == 0, "-").otherwise("+").alias("strand")
    )


#: Base by base: a customer's bases with equal sets of orders, cut where any order begins or ends.
CELLS = """m AS (SELECT 'c' || o_custkey AS seq, o_orderkey * 7 % 50 AS s, o_orderkey * 7 % 50 + o_orderkey % 20 + 1 AS e, o_orderkey AS k FROM orders),
p AS (SELECT DISTINCT seq, s AS pos FROM m UNION SELECT seq, e FROM m), g AS (SELECT seq, pos AS s, lead(pos) OVER (PARTITION BY seq ORDER BY pos) AS e FROM p),
b AS (SELECT g.seq, g.s, g.e, count(*) + 1 AS degree FROM g JOIN m ON m.seq = g.seq AND m.s <= g.s AND g.e <= m.e GROUP BY ALL)"""


@query("g1_annealed_blocks", f"WITH {CELLS} SELECT seq, s AS start, e AS \"end\", degree FROM b")
def g1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of the closure, by their place on the customer's sequence."""
    found = blocks.anneal(matches(spark, sf_dir))
    degree = found.groupBy(F.col("block").alias("b")).agg(F.count("*").alias("degree"))
    return found.filter("seq LIKE 'c%'").join(degree, F.col("block") == F.col("b")).select("seq", "start", "end", "degree")


@query(
    "g2_annealed_in_components",
    "SELECT 'c' || o_custkey AS seq, sum(n) AS bases, count(*) AS matches FROM (SELECT o_custkey, o_orderkey, count(*) AS n FROM (SELECT *, unnest(range(o_orderkey % 20 + 1)) AS i FROM orders) WHERE (o_orderkey * 7 % 50 + i) // 25 = o_orderkey % 3 GROUP BY 1, 2) GROUP BY 1",
)
def g2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches cut to where the order's label is that of the customer's half."""
    k, zero = F.col("o_orderkey"), F.lit(0).cast("long")
    halves = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("seq"), F.explode(F.sequence(zero, F.lit(2).cast("long"))).alias("label"))
    halves = halves.select("seq", (F.col("label") * 25).alias("start"), (F.col("label") * 25 + 25).alias("end"), "label")
    own = table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), k).alias("seq"), zero.alias("start"), F.lit(100).cast("long").alias("end"), (k % 3).alias("label"))
    cut = blocks.within_components(matches(spark, sf_dir), halves.unionByName(own))
    return cut.groupBy(F.col("a_seq").alias("seq")).agg(F.sum("length").alias("bases"), F.count("*").alias("matches"))


@query("g3_melted_blocks", f"WITH {CELLS} SELECT seq, s + 1 AS start, e - 1 AS \"end\" FROM b WHERE degree >= 3 AND e - s > 2 QUALIFY sum(e - s - 2) OVER (PARTITION BY seq) > 0")
def g3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with at least three members after a base is trimmed from both ends."""
    left = blocks.melt(blocks.anneal(matches(spark, sf_dir)), min_length=1, min_degree=3, trim=1)
    return left.filter("seq LIKE 'c%'").select("seq", "start", "end")


#: Blocks along threads: a customer's orders by day are a thread, their statuses and priorities the blocks.
THREADS = "SELECT 'c' || o_custkey AS seq, o_orderkey * 100 AS start, o_orderkey * 100 + 10 AS \"end\", o_orderpriority || o_custkey // 3 AS block, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM orders"


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("c"), "o_custkey").alias("seq"), (k * 100).alias("start"), (k * 100 + 10).alias("end"), F.concat("o_orderpriority", F.floor(F.col("o_custkey") / 3)).alias("block"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand")
    )


NEAR = f"t AS ({THREADS}), n AS (SELECT *, lead(block) OVER w AS nb, lead(strand) OVER w AS ns, lead(start) OVER w - \"end\" AS gap FROM t WINDOW w AS (PARTITION BY seq ORDER BY start)), a AS (SELECT seq, block AS \"left\", CASE strand WHEN '+' THEN 'R' ELSE 'L' END AS left_side, nb AS \"right\", CASE ns WHEN '+' THEN 'L' ELSE 'R' END AS right_side, gap FROM n WHERE nb IS NOT NULL)"


@query("j28_adjacencies", f"WITH {NEAR} SELECT * FROM a")
def j28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.adjacencies(threads(spark, sf_dir))


ENDS = f"{NEAR}, e AS (SELECT \"left\" || '/' || left_side AS x, \"right\" || '/' || right_side AS y FROM a UNION ALL SELECT \"right\" || '/' || right_side, \"left\" || '/' || left_side FROM a)"


@query("g9_adjacency_groups", f"WITH RECURSIVE {ENDS}, r AS (SELECT x, x AS y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x), g AS (SELECT x, min(y) AS grp, count(*) AS ends FROM r GROUP BY 1) SELECT x AS \"end\", grp AS \"group\", ends FROM g")
def g9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and tangles: the components of block ends."""
    return blocks.adjacency_groups(threads(spark, sf_dir))


@query(
    "g5_chains",
    f"""WITH RECURSIVE {ENDS}, o AS (SELECT x, min(y) AS y FROM e GROUP BY 1 HAVING min(y) = max(y)), l AS (SELECT regexp_replace(a.x, '/.$', '') AS a, regexp_replace(a.y, '/.$', '') AS b FROM o a JOIN o b ON a.x = b.y AND a.y = b.x),
s AS (SELECT DISTINCT block FROM t), r AS (SELECT block AS x, block AS y FROM s UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a) SELECT x AS block, min(y) AS chain, count(*) * 10 AS length FROM r GROUP BY 1""",
)
def g5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of blocks whose facing ends have no other neighbour."""
    return blocks.chains(threads(spark, sf_dir))


@query("g4_recoverable_chains")
def g4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.recoverable(threads(spark, sf_dir), 50)


@query(
    "k2_segment_lines",
    f"""WITH t AS ({THREADS}), sq AS (SELECT 'c' || o_custkey AS seq, CASE WHEN o_custkey % 3 = 0 THEN 'ref' ELSE 'e' || o_custkey % 3 END AS event, max(o_orderkey) * 100 + 20 AS length FROM orders GROUP BY o_custkey),
g AS (SELECT seq, coalesce(lag("end") OVER (PARTITION BY seq ORDER BY start), 0) AS start, start AS e FROM t UNION ALL SELECT seq, length - 10, length FROM sq),
a AS (SELECT block, seq, start, "end" AS e, strand FROM t UNION ALL SELECT NULL, seq, start, e, '+' FROM g WHERE e > start), x AS (SELECT a.*, event, CASE WHEN event = 'ref' THEN 0 ELSE 1 END AS above FROM a JOIN sq USING (seq)),
b AS (SELECT *, row_number() OVER (ORDER BY seq, start) AS number FROM x WHERE above = 0), f AS (SELECT block, arg_min(number, (seq, start)) AS number, arg_min(strand, (seq, start)) AS way FROM b WHERE block IS NOT NULL GROUP BY 1)
SELECT CAST(CASE WHEN event = 'ref' THEN 0 ELSE 1 END AS INTEGER) AS above, event, seq, CAST(-1 AS BIGINT) AS start, concat_ws(chr(9), 's', chr(39) || event || chr(39), chr(39) || seq || chr(39), CASE WHEN event = 'ref' THEN 1 ELSE 0 END) AS text FROM sq
UNION ALL SELECT above, event, seq, start, concat_ws(chr(9), 'a', number, start, e - start) FROM b
UNION ALL SELECT above, event, seq, start, concat_ws(chr(9), 'a', start, e - start, f.number, CASE WHEN f.way = strand THEN 1 WHEN f.way IS NOT NULL THEN 0 END) FROM x LEFT JOIN f USING (block) WHERE above = 1""",
)
def k2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as sequences, every third of the reference; their blocks as bottom and top segments."""
    c = F.col("o_custkey")
    event = F.when(c % 3 == 0, "ref").otherwise(F.concat(F.lit("e"), c % 3))
    sequences = table(spark, sf_dir, "orders").groupBy("o_custkey").agg((F.max("o_orderkey") * 100 + 20).alias("length")).select(F.concat(F.lit("c"), c).alias("seq"), event.alias("event"), "length")
    return sinks.segment_lines(threads(spark, sf_dir), sequences, "ref")


@query("g4_no_chain_recoverable")
def g4_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks left when recoverable chains are removed until there is none."""
    return blocks.drop_recoverable(threads(spark, sf_dir), 50).select("block", "seq", "start")


@query("g5_annealing_rounds")
def g5_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' matches annealed and melted by a schedule of least chain lengths."""
    return blocks.anneal_rounds(matches(spark, sf_dir), [12, 3]).select("seq", "start", "end")


@query("g9_nested_blocks")
def g9_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks as bridges and in chains of the graph of their ends' groups."""
    return blocks.nested_blocks(threads(spark, sf_dir))


@query("g15_thread_strings", "SELECT o_custkey AS id, string_agg(t, '' ORDER BY o_orderkey) AS text FROM (SELECT o_custkey, o_orderkey, string_agg(l_returnflag || l_linestatus, '' ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag || l_linestatus) AS t FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2) GROUP BY 1")
def g15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of lines, joined to orders', joined to customers'."""
    order, customer = F.concat(F.lit("o"), "o_orderkey"), F.concat(F.lit("c"), "o_custkey")
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    text, none = F.concat("l_returnflag", "l_linestatus"), F.lit(None).cast("string")
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey", text.alias("t"))
    used = orders.join(lines.select("l_orderkey").distinct(), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    numbered = lines.join(used.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("n", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(place)).cast("long"))
    leaves = numbered.select(F.concat(F.lit("l"), "l_orderkey", F.lit("_"), "n").alias("id"), order.alias("parent"), F.col("n").alias("place"), text.alias("text"))
    middle = used.select(order.alias("id"), customer.alias("parent"), F.col("o_orderkey").cast("long").alias("place"), none.alias("text"))
    top = used.select(customer.alias("id"), none.alias("parent"), F.lit(0).cast("long").alias("place"), none.alias("text")).distinct()
    found = blocks.thread_strings(leaves.union(middle).union(top))
    return found.select(F.substring("id", 2, 30).cast("long").alias("id"), "text")


@query(
    "g11_attached_threads",
    f"""WITH t AS ({THREADS}), th AS (SELECT 'c' || o_custkey AS seq, o_custkey // 3 AS component, max(o_orderkey) * 100 + 20 AS length, o_custkey % 7 = 0 AS attached FROM orders GROUP BY o_custkey),
n AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY attached DESC, length DESC, seq) AS k FROM th), w AS (SELECT *, attached OR k = 1 OR length >= 100000 AS taken FROM n),
f AS (SELECT block, min(k) AS first FROM t JOIN w USING (seq) WHERE taken GROUP BY 1), s AS (SELECT seq, count(*) * 10 AS aligned, count(*) FILTER (first < k) * 10 AS known FROM t JOIN w USING (seq) JOIN f USING (block) GROUP BY 1)
SELECT seq, component, NOT attached AND taken AND (k = 1 OR coalesce(aligned, 0) - coalesce(known, 0) >= 0.3 * coalesce(aligned, 0)) AS attach, coalesce(aligned, 0) AS aligned, coalesce(known, 0) AS known FROM w LEFT JOIN s USING (seq)""",
)
def g11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads of three customers as a component, every seventh customer attached before."""
    c = F.col("o_custkey")
    own = table(spark, sf_dir, "orders").groupBy("o_custkey").agg((F.max("o_orderkey") * 100 + 20).alias("length"))
    own = own.select(F.concat(F.lit("c"), c).alias("seq"), F.floor(c / 3).alias("component"), "length", (c % 7 == 0).alias("attached"))
    return blocks.attach_threads(threads(spark, sf_dir), own, 100_000, 0.3)


# -- filters of blocks

MEMBERS = "SELECT l_partkey AS block, s_name AS event FROM lineitem JOIN supplier ON s_suppkey = l_suppkey"


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(block, event): parts and the suppliers that deliver them."""
    return table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_partkey").alias("block"), F.col("s_name").alias("event"))


COVERAGE = f"""{TREE}, mem AS ({MEMBERS}), ev AS (SELECT DISTINCT block, event FROM mem), cnt AS (SELECT block, count(*) AS n FROM ev GROUP BY 1),
bel AS (SELECT block, ancestor, count(*) AS k FROM ev JOIN up ON descendant = event GROUP BY 1, 2), own AS (SELECT block, sum(coalesce(length, 0)) AS own FROM bel JOIN cnt USING (block) JOIN tree ON tree.id = ancestor WHERE k < n GROUP BY 1),
cov AS (SELECT block, coalesce(own, 0) / (SELECT sum(length) FROM tree) AS coverage FROM cnt LEFT JOIN own USING (block))"""


@query("f12_tree_coverage", f"WITH RECURSIVE {COVERAGE} SELECT block, round(coverage, 9) AS coverage FROM cov")
def f12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.tree_coverage(members(spark, sf_dir), tree(spark, sf_dir)).withColumn("coverage", F.round("coverage", 9))


@query("f13_supported_blocks", f"WITH RECURSIVE {COVERAGE} SELECT block FROM mem JOIN cov USING (block) GROUP BY block, coverage HAVING count(*) >= 20 AND count(DISTINCT event) >= 8 AND coverage >= 0.1234567")
def f13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.supported(members(spark, sf_dir), tree(spark, sf_dir), 20, 8, 0.1234567)


@query(
    "f14_pair_filters",
    """WITH s AS (SELECT o_custkey AS k, list('p' || o_orderkey % 7) AS a, list('p' || o_orderkey % 5) AS b, count(*) FILTER (o_orderkey % 7 = 1) + count(*) FILTER (o_orderkey % 5 = 1) AS n1, count(*) FILTER (o_orderkey % 7 = 2) + count(*) FILTER (o_orderkey % 5 = 2) AS n2 FROM orders GROUP BY 1)
SELECT k, list_has_any(a, ['p1', 'p2']) AND list_has_any(b, ['p1', 'p2']) AS outgroup, list_has_any(a, b) AS repeat, len(list_distinct(a || b)) < len(a || b) AS several, n1 > 1 OR n2 > 1 AS single_copy FROM s""",
)
def f14(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda n: F.collect_list(F.concat(F.lit("p"), F.col("o_orderkey") % n))
    pairs = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(name(7).alias("a"), name(5).alias("b"))
    return pairs.select("k", *(blocks.pair_rejected(kind, F.col("a"), F.col("b"), ["p1", "p2"]).alias(kind) for kind in ("outgroup", "repeat", "several", "single_copy")))


# -- alignments

EDITED = "SELECT o_orderkey AS id, 'c' || o_custkey AS target, o_orderkey * 7 % 300 AS tstart, o_orderkey % 9 + 1 AS a, o_orderkey % 4 + 1 AS ins, o_orderkey % 11 + 1 AS c, o_orderkey % 5 + 1 AS d, o_orderkey % 13 + 1 AS z, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM orders"


def edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as alignments to their customer with an insertion and a deletion."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("id"), F.concat(F.lit("c"), "o_custkey").alias("target"), (k * 7 % 300).alias("tstart"), *((k % m + 1).alias(n) for n, m in (("a", 9), ("i", 4), ("c", 11), ("d", 5), ("z", 13))), F.when(k % 2 == 0, "+").otherwise("-").alias("strand"))
    text = F.concat(*(x for n, op in (("a", "="), ("i", "I"), ("c", "X"), ("d", "D"), ("z", "M")) for x in (F.col(n).cast("string"), F.lit(op))))
    return rows.select("id", "target", "strand", "tstart", F.expr("tstart + a + c + d + z").alias("tend"), F.lit(0).cast("long").alias("qstart"), F.expr("a + i + c + z").alias("qend"), text.alias("cigar"))


#: Aligned bases of the target one by one, with their query positions and whether they match.
BASES = f"""e AS ({EDITED}), b AS (SELECT *, unnest(range(a + c + d + z)) AS t FROM e), q AS (SELECT id, target, strand, tstart, a, ins, c, d, z, tstart + t AS pos, CASE WHEN t < a THEN t WHEN t < a + c THEN t + ins ELSE t + ins - d END AS q, t < a OR t >= a + c + d AS same, t BETWEEN a + c AND a + c + d - 1 AS gone, t FROM b)"""
CLIPPED = "min(CASE WHEN strand = '+' THEN q ELSE a + ins + c + z - q - 1 END) AS qstart, max(CASE WHEN strand = '+' THEN q ELSE a + ins + c + z - q - 1 END) + 1 AS qend, min(pos) AS tstart, max(pos) + 1 AS tend, count(*) FILTER (same) AS matches, max(pos) + 1 - min(pos) + CASE WHEN min(t) < a AND max(t) >= a THEN ins ELSE 0 END AS block, concat(nullif(count(*) FILTER (t < a), 0) || '=', CASE WHEN min(t) < a AND max(t) >= a THEN ins || 'I' END, nullif(count(*) FILTER (t >= a AND t < a + c), 0) || 'X', CASE WHEN min(t) < a + c AND max(t) >= a + c + d THEN d || 'D' END, nullif(count(*) FILTER (t >= a + c + d), 0) || 'M') AS cigar"


@query(
    "j15_clipped_to_single_cover",
    f"""WITH {BASES}, depth AS (SELECT target, pos, count(*) AS k FROM q GROUP BY 1, 2), ends AS (SELECT DISTINCT target, tstart AS pos FROM e UNION SELECT target, tstart + a + c + d + z FROM e),
one AS (SELECT d.target, d.pos, d.pos - row_number() OVER (PARTITION BY d.target ORDER BY d.pos) + 1000000 * (SELECT count(*) FROM ends x WHERE x.target = d.target AND x.pos <= d.pos) AS run FROM depth d WHERE k = 1), reg AS (SELECT target, min(pos) AS lo, max(pos) + 1 AS hi FROM one GROUP BY target, run)
SELECT id, lo AS region_start, hi AS region_end, {CLIPPED} FROM q JOIN reg ON q.target = reg.target AND pos >= lo AND pos < hi WHERE NOT gone GROUP BY id, lo, hi, a, ins, c, d""",
)
def j15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments cut to the regions that one alignment alone covers."""
    rows = edited(spark, sf_dir)
    alone = iv.single_cover(rows.select("target", F.col("tstart").alias("start"), F.col("tend").alias("end")), ["target"])
    return clipping.clip_to_regions(rows, alone)


@query("i19_trimmed_ends", f"WITH {BASES} SELECT id, {CLIPPED} FROM q WHERE NOT gone AND t >= floor((a + c + d + z) * 0.25) AND t < a + c + d + z - floor((a + c + d + z) * 0.25) GROUP BY id, a, ins, c, d")
def i19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clipping.trim_ends(edited(spark, sf_dir), 0.25)


@query("f19_first_levels", f"{ALN}, s AS (SELECT id, query, qstart, qend, coalesce(score, 1.0) AS score FROM aln), p AS (SELECT a.id, b.d, count(*) AS k FROM s a JOIN (SELECT query, id, score, unnest(range(qstart, qend)) AS d FROM s) b ON a.query = b.query AND b.d >= a.qstart AND b.d < a.qend AND (b.score > a.score OR b.score = a.score AND b.id < a.id) GROUP BY 1, 2), l AS (SELECT s.id, 1 + coalesce(max(p.k), 0) AS level FROM s LEFT JOIN p USING (id) GROUP BY s.id) SELECT id FROM l WHERE level > 2")
def f19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are not of the first two levels."""
    tiled = al.tile(alignments(spark, sf_dir).withColumn("score", F.coalesce("score", F.lit(1.0))))
    return al.filter_levels(tiled, max_level=2, invert=True).select("id")


@query("c5_parts_by_query", f"{ALN}, n AS (SELECT query, count(*) AS n FROM aln GROUP BY 1) SELECT query, n AS rows, n > 125 AS own FROM n")
def c5(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = al.split_by_query(alignments(spark, sf_dir), 125)
    return dealt.groupBy("query").agg(F.count("*").alias("rows"), F.min(F.col("part").startswith("query-")).alias("own"))


@query("c7_primary_by_side")
def c7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignments(spark, sf_dir).withColumn("score", F.coalesce("score", F.lit(1.0)))
    return al.select_primary_by_side(rows, ["7", "9", "11"], 400, 20_000.0).select("id", "tag", "level", "outgroup")


# -- trees, names, variants


@query(
    "t4_spanning_tree",
    f"WITH RECURSIVE {TREE}, c AS (SELECT n_name AS leaf FROM nation WHERE n_regionkey IN (1, 2) AND n_nationkey % 2 = 0), b AS (SELECT ancestor, count(*) AS n FROM up WHERE descendant IN (FROM c) GROUP BY 1), k AS (SELECT ancestor FROM b WHERE n < (SELECT count(*) FROM c) UNION ALL SELECT 'world') SELECT id, coalesce(parent, '-') AS parent FROM tree WHERE id IN (FROM k)",
)
def t4(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "nation").filter("n_regionkey IN (1, 2) AND n_nationkey % 2 = 0").select(F.col("n_name").alias("id"))
    return trees.spanning(tree(spark, sf_dir), chosen).select("id", F.coalesce("parent", F.lit("-")).alias("parent"))


@query("f21_outgroup_candidates", f"WITH RECURSIVE {TREE} SELECT n_name AS node, r_name AS outgroup FROM nation, region WHERE n_regionkey <> r_regionkey AND n_name IN (SELECT parent FROM tree) UNION ALL SELECT a.r_name, b.r_name FROM region a, region b WHERE a.r_name <> b.r_name AND a.r_name IN (SELECT parent FROM tree)")
def f21(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as outgroups of nations and of each other."""
    regions = table(spark, sf_dir, "region").select(F.col("r_name").alias("id"))
    return trees.outgroup_candidates(tree(spark, sf_dir), regions).select("node", "outgroup")


@query("t7_assigned_outgroups")
def t7(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("id"))
    return trees.assign_outgroups(tree(spark, sf_dir), nations, 2).select("node", "outgroup", "rank")


@query("t10_inserted_node", f"WITH RECURSIVE {TREE} SELECT id, CASE WHEN id = 'ASIA' THEN 'new' ELSE coalesce(parent, '-') END AS parent, round(CASE WHEN id = 'ASIA' THEN length / 4 ELSE coalesce(length, 0) END, 9) AS length FROM tree UNION ALL SELECT 'new', parent, round(length * 0.75, 9) FROM tree WHERE id = 'ASIA'")
def t10(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = trees.insert_on_branch(tree(spark, sf_dir), "ASIA", "new", 0.25)
    return grown.select("id", F.coalesce("parent", F.lit("-")).alias("parent"), F.round(F.coalesce("length", F.lit(0.0)), 9).alias("length"))


NAMES = "SELECT DISTINCT substr(p_name, 1, 4) || '.' || p_brand || '-' || p_size AS name FROM part"


@query("p24_unique_names", f"WITH n AS ({NAMES}), f AS (SELECT name, regexp_replace(name, '[^A-Za-z0-9]', '', 'g') || 'e' AS form FROM n) SELECT name, form || CASE WHEN k > 0 THEN CAST(k AS VARCHAR) ELSE '' END AS alias FROM (SELECT *, row_number() OVER (PARTITION BY form ORDER BY name) - 1 AS k FROM f)")
def p24(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that end in a letter, so that counters alone keep them apart."""
    name = F.concat(F.substring("p_name", 1, 4), F.lit("."), "p_brand", F.lit("-"), "p_size", F.lit("-e"))
    aliases = rel.rename_uniquely(table(spark, sf_dir, "part").select(name.alias("name")), "name")
    return aliases.select(F.regexp_replace("name", "-e$", "").alias("name"), "alias")


GENOMES = "SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN 'g' || p_partkey % 50 WHEN 1 THEN replace(p_brand, '#', '_') || p_size ELSE p_brand || '.' || p_partkey END AS name FROM part"


@query(
    "p24_placeholder_names",
    f"""WITH n AS ({GENOMES}), o AS (SELECT name, row_number() OVER (ORDER BY name) AS k FROM n WHERE name LIKE '%#%'), f AS (SELECT i, row_number() OVER (ORDER BY i) AS k FROM range((SELECT count(*) FROM n)) r(i) WHERE 'g' || i NOT IN (FROM n))
SELECT name, name AS alias FROM n WHERE name NOT LIKE '%#%' UNION ALL SELECT name, 'g' || i FROM o JOIN f USING (k)""",
)
def p24_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with other signs than letters, digits and underscores, past the placeholders that are names themselves."""
    key = F.col("p_partkey")
    name = F.when(key % 4 == 0, F.concat(F.lit("g"), key % 50)).when(key % 4 == 1, F.concat(F.replace("p_brand", F.lit("#"), F.lit("_")), "p_size")).otherwise(F.concat("p_brand", F.lit("."), key))
    return rel.placeholder_names(table(spark, sf_dir, "part").select(name.alias("name")), "name")


@query("v8_sorted_chunks", "SELECT l_orderkey, l_linenumber, l_partkey, (row_number() OVER (ORDER BY l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1) // 1000 AS chunk FROM lineitem")
def v8(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c) for c in ("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")]
    return rel.chunked(table(spark, sf_dir, "lineitem"), order, 1000).select("l_orderkey", "l_linenumber", "l_partkey", "chunk")


@query(
    "v11_variant_sites",
    f"""WITH RECURSIVE s AS (SELECT o_orderkey AS id, contig, start, "end" FROM ({SPANS.replace('SELECT', 'SELECT o_orderkey,', 1)}) WHERE "end" - start >= 20),
p AS (SELECT a.id AS a, b.id AS b FROM s a JOIN s b ON a.contig = b.contig AND a.id <> b.id AND least(a."end", b."end") - greatest(a.start, b.start) > 0 AND least(a."end", b."end") - greatest(a.start, b.start) >= 0.5 * greatest(a."end" - a.start, b."end" - b.start)),
r AS (SELECT id AS x, id AS y FROM s UNION SELECT r.x, p.b FROM r JOIN p ON r.y = p.a), c AS (SELECT x AS id, min(y) AS site FROM r GROUP BY 1) SELECT site, count(*) AS variants, min(start) AS start, max("end") AS "end" FROM s JOIN c USING (id) GROUP BY 1""",
)
def v11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of at least 20 positions, joined to sites by half their width."""
    day = F.unix_date(F.to_date("o_orderdate")).cast("long")
    spans = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("contig"), day.alias("start"), (day + F.col("o_orderkey") % 60).alias("end")).filter("end - start >= 20")
    found = iv.cluster(spans, ["contig"], 0.5, 64)
    return found.groupBy("site").agg(F.count("*").alias("variants"), F.min("start").alias("start"), F.max("end").alias("end"))


INSERTED = "SELECT o_orderkey AS id, o_custkey AS contig, CASE o_orderkey % 3 WHEN 0 THEN 'INS' WHEN 1 THEN 'DEL' ELSE 'INV' END AS kind, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS start, 30 + o_orderkey * 7 % 400 AS size FROM orders"


@query(
    "v11_sites_by_kind",
    f"""WITH RECURSIVE v AS (SELECT *, start + CASE kind WHEN 'INS' THEN 1 ELSE size END AS e FROM ({INSERTED})),
p AS (SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON a.contig = b.contig AND a.kind = b.kind AND a.id <> b.id AND CASE a.kind WHEN 'INS' THEN abs(a.start - b.start) <= 100 AND least(a.size, b.size) >= 0.6 * greatest(a.size, b.size) ELSE least(a.e, b.e) > greatest(a.start, b.start) AND least(a.e, b.e) - greatest(a.start, b.start) >= 0.6 * greatest(a.size, b.size) END),
r AS (SELECT id AS x, id AS y FROM v UNION SELECT r.x, p.b FROM r JOIN p ON r.y = p.a), c AS (SELECT x AS id, min(y) AS site FROM r GROUP BY 1) SELECT site, kind, count(*) AS variants, CAST(max(size) AS BIGINT) AS size FROM v JOIN c USING (id) GROUP BY 1, 2""",
)
def v11_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insertions at most 100 apart and alike in size, deletions and inversions by mutual cover, as sites."""
    k, day = F.col("o_orderkey"), F.unix_date(F.to_date("o_orderdate")).cast("long")
    kind = F.when(k % 3 == 0, "INS").when(k % 3 == 1, "DEL").otherwise("INV")
    rows = table(spark, sf_dir, "orders").select(k.alias("id"), F.col("o_custkey").alias("contig"), kind.alias("kind"), day.alias("start"), (30 + k * 7 % 400).alias("size"))
    rows = rows.withColumn("end", F.col("start") + F.when(F.col("kind") == "INS", 1).otherwise(F.col("size")))
    return iv.variant_sites(rows, ["contig"], 0.6, 100, 256).groupBy("site", "kind").agg(F.count("*").alias("variants"), F.max("size").alias("size"))
