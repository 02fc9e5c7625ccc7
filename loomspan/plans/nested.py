"""Queries over nested sites, graph coordinates and nested structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspan.operators import ancestral, ends, graph, graphpaths, nested
from loomspan.operators import intervals as iv
from loomspan.plans.catalog import query, table
from loomspan.plans.structure import tree

# -- traversals: an order's items are the reference's steps; some are lost, replaced, turned or doubled in the alternative

BASES = "translate(substr(md5(CAST(p_partkey AS VARCHAR)), 1, 1 + p_partkey % 3), '0123456789abcdef', 'ACGTACGTACGTACGT')"

ALLELES = """l AS (SELECT l_orderkey AS id, CAST(l_partkey AS VARCHAR) AS p, l_partkey % 100 + 1 AS other, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS k FROM lineitem),
al AS (SELECT id, ['>1'] || list('>' || p ORDER BY k) || ['>2'] AS ref, ['>1'] || flatten(list(CASE (k + id) % 7 WHEN 0 THEN [] WHEN 1 THEN ['>' || other] WHEN 2 THEN ['<' || p] WHEN 3 THEN ['>' || p, '>' || p] ELSE ['>' || p] END ORDER BY k)) || ['>2'] AS alt FROM l GROUP BY 1)"""


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(node, seq): parts, each of one to three bases."""
    key = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(key.alias("node"), F.translate(F.substring(F.md5(key), F.lit(1), (1 + F.col("p_partkey") % 3).cast("int")), "0123456789abcdef", "ACGTACGTACGTACGT").alias("seq"))


def alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, contig, pos, ref, alt)."""
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    p, k = F.col("l_partkey").cast("string"), F.col("k")
    of = (k + F.col("l_orderkey")) % 7
    one = lambda c: F.array(c)
    ahead = F.concat(F.lit(">"), p)
    alt: Column = F.when(of == 0, F.array().cast("array<string>")).when(of == 1, one(F.concat(F.lit(">"), (F.col("l_partkey") % 100 + 1).cast("string")))).when(of == 2, one(F.concat(F.lit("<"), p)))
    alt = alt.when(of == 3, F.array(ahead, ahead)).otherwise(one(ahead))
    rows = table(spark, sf_dir, "lineitem").withColumn("k", place).select(F.col("l_orderkey").alias("id"), F.struct("k", ahead.alias("ref"), alt.alias("alt")).alias("s"))
    held = rows.groupBy("id").agg(F.array_sort(F.collect_list("s")).alias("s"))
    ends = lambda inner: F.concat(F.array(F.lit(">1")), inner, F.array(F.lit(">2")))
    return held.select("id", (F.col("id") % 5).cast("string").alias("contig"), (F.col("id") * 10).alias("pos"), ends(F.transform("s", lambda x: x["ref"])).alias("ref"), ends(F.flatten(F.transform("s", lambda x: x["alt"]))).alias("alt"))


PARTS = f"""{ALLELES}, e AS (SELECT id, ref, alt, list_position([ref[len(ref) - x] = alt[len(alt) - x] for x in range(least(len(ref), len(alt)))], false) - 1 AS same FROM al),
c AS (SELECT id, ref, ref[1 : len(ref) - greatest(coalesce(same, 0) - 1, 0)] AS r, alt[1 : len(alt) - greatest(coalesce(same, 0) - 1, 0)] AS a FROM e),
w AS (SELECT id, r, a, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS si, CAST(0 AS BIGINT) AS sj, CAST(NULL AS BIGINT) AS fi, CAST(NULL AS BIGINT) AS fj FROM c
 UNION ALL SELECT id, r, a, i + 1, CASE WHEN j > 0 THEN i + 1 ELSE si END, sj + j, si, sj FROM (SELECT *, CAST(coalesce(list_position(a[sj + 2 : len(a) - 1], r[i + 2]), 0) AS BIGINT) AS j FROM w WHERE i + 1 <= len(r) - 2)),
x AS (SELECT id, r, a, fi AS i0, fj AS j0, si AS i1, sj AS j1 FROM w WHERE si > fi UNION ALL SELECT id, r, a, si, sj, len(r) - 1, len(a) - 1 FROM w WHERE i = greatest(len(r) - 2, 0)),
y AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY i0) - 1 AS part, i0, r[i0 + 2 : i1] AS rs, a[j0 + 2 : j1] AS als FROM x WHERE i1 - i0 > 1 OR j1 - j0 > 1),
n AS (SELECT CAST(p_partkey AS VARCHAR) AS node, {BASES} AS seq FROM part),
q AS (SELECT '>' || node AS step, seq AS bases FROM n UNION ALL SELECT '<' || node, reverse(translate(seq, 'ACGT', 'TGCA')) FROM n),
s AS (SELECT id, part, side, string_agg(bases, '' ORDER BY at_) AS t FROM (SELECT id, part, 'r' AS side, unnest(rs) AS step, generate_subscripts(rs, 1) AS at_ FROM y UNION ALL SELECT id, part, 'a', unnest(als), generate_subscripts(als, 1) FROM y) JOIN q USING (step) GROUP BY 1, 2, 3),
o AS (SELECT id, at_ - 1 AS at_, right(bases, 1) AS before, sum(CASE WHEN at_ > 1 THEN length(bases) ELSE 0 END) OVER (PARTITION BY id ORDER BY at_) AS offs FROM (SELECT id, unnest(ref) AS step, generate_subscripts(ref, 1) AS at_ FROM al) JOIN q USING (step)),
v AS (SELECT y.id, y.part, coalesce(sr.t, '') AS rb, coalesce(sa.t, '') AS ab, before, offs, len([z for z in rs if list_contains(als, translate(z, '<>', '><'))]) > 0 AS inv FROM y LEFT JOIN s sr ON sr.id = y.id AND sr.part = y.part AND sr.side = 'r' LEFT JOIN s sa ON sa.id = y.id AND sa.part = y.part AND sa.side = 'a' JOIN o ON o.id = y.id AND o.at_ = y.i0),
z AS (SELECT *, length(rb) = length(ab) AND NOT inv AS plain FROM v)"""


@query(
    "v9_nested_variants",
    f"""WITH RECURSIVE {PARTS} SELECT id, CAST(part AS INTEGER) AS part, CAST(id % 5 AS VARCHAR) AS contig, CAST(id * 10 + offs - CASE WHEN plain THEN 0 ELSE 1 END AS BIGINT) AS pos,
CASE WHEN plain THEN CASE WHEN length(rb) = 1 THEN 'SNP' ELSE 'MNP' END WHEN inv THEN 'INV' WHEN length(ab) < length(rb) THEN 'DEL' ELSE 'INS' END AS kind,
CASE WHEN plain THEN '' ELSE before END || rb AS ref_bases, CASE WHEN plain THEN '' ELSE before END || ab AS alt_bases, CAST(CASE WHEN plain OR inv THEN length(rb) ELSE length(ab) - length(rb) END AS INTEGER) AS length,
CASE WHEN NOT plain THEN CAST(id * 10 + offs - 1 + length(rb) AS BIGINT) END AS "end" FROM z""",
)
def v9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple variants of orders' traversals, typed and placed."""
    return nested.typed_variants(alleles(spark, sf_dir), nodes(spark, sf_dir))


# -- sites: an event of a user lies within the user's event before it; a seventh of them begin anew

SITES = """b AS (SELECT user_id, event_id, event_id % 11 AS a, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events),
sites AS (SELECT event_id AS id, CASE WHEN k % 7 <> 1 THEN before END AS parent, ['>' || a || '>' || (a + 1), '>' || a || '>' || (a + 1) || '>' || (a + 2) || '>' || (a + 3), '>' || (a + 1) || '>' || (a + 2) || '>' || (a + 30)] AS alleles FROM b)"""


@query(
    "f23_nested_sites",
    f"""WITH RECURSIVE {SITES}, r AS (SELECT id, id AS top FROM sites WHERE parent IS NULL UNION ALL SELECT s.id, r.top FROM sites s JOIN r ON s.parent = r.id),
c AS (SELECT s.id, s.parent, r.top, s.alleles, t.alleles[2:] AS alts FROM sites s JOIN r USING (id) JOIN sites t ON t.id = r.top)
SELECT id, coalesce(parent, -1) AS parent, top, id = top OR len([x for x in alleles if len([y for y in alts if regexp_matches(y || '$', x || '[^0-9]')]) > 0]) >= len(list_distinct(alts)) AS consistent FROM c""",
)
def f23(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sites in chains of up to seven; a site's alleles have to run within the outermost one's."""
    order = Window.partitionBy("user_id").orderBy("event_id")
    a = F.col("event_id") % 11
    step = lambda d: F.concat(F.lit(">"), (a + d).cast("string"))
    texts = F.array(F.concat(step(0), step(1)), F.concat(step(0), step(1), step(2), step(3)), F.concat(step(1), step(2), step(30)))
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), texts.alias("alleles"), F.row_number().over(order).alias("k"), F.lag("event_id").over(order).alias("before"))
    sites = rows.select("id", F.when(F.col("k") % 7 != 1, F.col("before")).alias("parent"), "alleles")
    return nested.nested_consistency(sites).select("id", F.coalesce("parent", F.lit(-1)).alias("parent"), "top", "consistent")


# -- graph coordinates: a customer's orders are pieces of the customer's sequence; an order's items walk over some of them

NODES = """nd AS (SELECT CAST(o_orderkey AS VARCHAR) AS node, 'c' || o_custkey AS name, o_orderkey % 9 + 1 AS length, sum(o_orderkey % 9 + 1) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - (o_orderkey % 9 + 1) AS start FROM orders)"""
READS = """k AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS back FROM orders),
rd AS (SELECT o_custkey AS id, list(CASE WHEN o_custkey % 3 = 0 THEN '<' ELSE '>' END || o_orderkey ORDER BY CASE WHEN o_custkey % 3 = 0 THEN back ELSE k END) FILTER (k % 6 > 0) AS path, CAST(1 AS BIGINT) AS path_start, CAST(count(*) AS BIGINT) AS path_end FROM k GROUP BY 1)"""


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(node, name, start, length)."""
    length = F.col("o_orderkey") % 9 + 1
    pieces = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("node"), F.concat(F.lit("c"), "o_custkey").alias("name"), "o_orderkey", length.alias("length"))
    return iv.running_sum(pieces, ["name"], "o_orderkey", "length", "start").select("node", "name", "start", "length")


def graph_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, path, path_start, path_end): a customer's nodes but for every sixth, a third of the customers backwards."""
    k = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", k.alias("k"))
    back = F.col("o_custkey") % 3 == 0
    step = F.struct(F.when(back, -F.col("k")).otherwise(F.col("k")).alias("at"), F.concat(F.when(back, "<").otherwise(">"), "o_orderkey").alias("step"))
    held = rows.groupBy(F.col("o_custkey").alias("id")).agg(F.array_sort(F.collect_list(F.when(F.col("k") % 6 > 0, step))).alias("s"), F.count("*").alias("path_end"))
    return held.select("id", F.transform("s", lambda x: x["step"]).alias("path"), F.lit(1).cast("long").alias("path_start"), "path_end")


@query(
    "c11_stable_coordinates",
    f"""WITH {NODES}, {READS}, s AS (SELECT id, unnest(path) AS step, generate_subscripts(path, 1) AS at_ FROM rd), j AS (SELECT s.*, left(step, 1) AS way, name, start, start + length AS e FROM s JOIN nd ON nd.node = substr(step, 2)),
f AS (SELECT *, CASE WHEN lag(name) OVER w = name AND (CASE WHEN way = '>' THEN lag(e) OVER w = start ELSE lag(start) OVER w = e END) THEN 0 ELSE 1 END AS fresh FROM j WINDOW w AS (PARTITION BY id ORDER BY at_)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY id ORDER BY at_) AS run FROM f), g AS (SELECT id, run, way || name || ':' || min(start) || '-' || max(e) AS t FROM r GROUP BY id, run, way, name)
SELECT id, string_agg(t, '' ORDER BY run) AS path, any_value(path_start) AS path_start, any_value(path_end) AS path_end FROM g JOIN rd USING (id) GROUP BY 1""",
)
def c11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walks over nodes as intervals of the customers' sequences."""
    return graphpaths.to_stable(graph_reads(spark, sf_dir), graph_nodes(spark, sf_dir)).withColumn("path", F.array_join("path", ""))


@query("c11_there_and_back", f"WITH {READS} SELECT id, array_to_string(path, '') AS path, path_start, path_end FROM rd WHERE len(path) > 0")
def c11_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To stable coordinates and back: the nodes that were walked."""
    pieces = graph_nodes(spark, sf_dir)
    return graphpaths.to_unstable(graphpaths.to_stable(graph_reads(spark, sf_dir), pieces), pieces).withColumn("path", F.array_join("path", ""))


@query(
    "c11_overlap_filter",
    """WITH a AS (SELECT o_orderkey AS id, o_custkey AS q, CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS s, CAST(o_orderdate AS DATE) - DATE '1970-01-01' + o_orderkey % 97 + 1 AS e FROM orders)
SELECT id, CAST(s AS BIGINT) AS start, CAST(e AS BIGINT) AS "end" FROM a WHERE NOT EXISTS (SELECT 1 FROM a b WHERE b.q = a.q AND b.id <> a.id AND least(a.e, b.e) - greatest(a.s, b.s) > 2 AND least(a.e, b.e) - greatest(a.s, b.s) >= 0.25 * least(a.e - a.s, b.e - b.s) AND a.e - a.s < 2.0 * (b.e - b.s))""",
)
def c11_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, k = F.unix_date(F.to_date("o_orderdate")).cast("long"), F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("id"), F.col("o_custkey").alias("query"), day.alias("start"), (day + k % 97 + 1).alias("end"))
    return graphpaths.drop_overlapped(rows, ratio=2.0, min_share=0.25, min_overlap=2).select("id", "start", "end")


# -- ancestors: items are letters at a part's places, seen in suppliers, the leaves of the tree

OBSERVED = "obs AS (SELECT l_partkey AS block, CAST(l_linenumber AS BIGINT) AS pos, l_suppkey, substr('ACGTacgtNn', CAST((l_orderkey + l_suppkey) % 10 + 1 AS BIGINT), 1) AS letter FROM lineitem)"


def _sent(logs: list[str], length: str) -> str:
    """SQL for the log likelihoods p0 to p3 at the other end of a branch."""
    most = f"greatest({', '.join(logs)})"
    same = f"(0.25 + 0.75 * exp(-4.0::DOUBLE / 3.0 * ({length})))"
    other = f"((1 - {same}) / 3)"
    total = " + ".join(f"exp({x} - {most})" for x in logs)
    return ", ".join(f"ln(greatest({other} * ({total}) + ({same} - {other}) * exp({x} - {most}), 1e-30)) AS p{k}" for k, x in enumerate(logs))


OWN = [f"CASE WHEN upper(letter) = '{c}' THEN 0.0::DOUBLE WHEN upper(letter) IN ('A', 'C', 'G', 'T') THEN ln(1e-30) ELSE 0.0 END" for c in "ACGT"]
SUMS = ", ".join(f"sum(p{k}) AS p{k}" for k in range(4))
LOGS = [f"p{k}" for k in range(4)]


@query(
    "g17_ancestral_letters",
    f"""WITH {OBSERVED}, o AS (SELECT *, s_suppkey % 7 / 10 AS ls, n_nationkey, n_nationkey / 100 AS ln_, n_regionkey FROM obs JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
l AS (SELECT block, pos, n_nationkey, n_regionkey, ln_, {_sent(OWN, 'ls')} FROM o), n AS (SELECT block, pos, n_nationkey, n_regionkey, ln_, {SUMS} FROM l GROUP BY ALL),
r AS (SELECT block, pos, n_regionkey, {SUMS} FROM (SELECT block, pos, n_regionkey, {_sent(LOGS, 'ln_')} FROM n) GROUP BY ALL),
w AS (SELECT block, pos, {SUMS} FROM (SELECT block, pos, {_sent(LOGS, 'n_regionkey / 10 + 0.5')} FROM r) GROUP BY ALL),
b AS (SELECT block, pos, least({', '.join(f"(-round(p{k} - greatest(p0, p1, p2, p3), 6), '{c}')" for k, c in enumerate('ACGT'))})[2] AS c FROM w),
m AS (SELECT block, pos, count(*) AS n, count(*) FILTER (letter = upper(letter)) AS up, count(*) FILTER (upper(letter) = 'N') AS unknown FROM obs GROUP BY ALL)
SELECT block, pos, 'world' AS id, CASE WHEN up <= n // 2 THEN lower(CASE WHEN unknown = n THEN 'N' ELSE c END) WHEN unknown = n THEN 'N' ELSE c END AS letter FROM b JOIN m USING (block, pos)""",
)
def g17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The letters at the root, from those of all suppliers."""
    items = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    letter = F.substring(F.lit("ACGTacgtNn"), ((F.col("l_orderkey") + F.col("l_suppkey")) % 10 + 1).cast("int"), F.lit(1))
    observed = items.select(F.col("l_partkey").alias("block"), F.col("l_linenumber").cast("long").alias("pos"), F.col("s_name").alias("event"), letter.alias("letter"))
    return ancestral.ancestral_letters(observed, tree(spark, sf_dir)).filter("id = 'world'")


@query(
    "g16_nested_coordinates",
    """WITH l AS (SELECT o_custkey, l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS k, CAST(l_quantity AS BIGINT) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
p AS (SELECT *, sum(n) OVER (PARTITION BY o_custkey ORDER BY l_orderkey, k) AS e FROM l)
SELECT 'l' || l_orderkey || '_' || k AS id, CAST(e - n AS BIGINT) AS start, CAST(e AS BIGINT) AS "end" FROM p UNION ALL SELECT 'o' || l_orderkey, CAST(min(e - n) AS BIGINT), CAST(max(e) AS BIGINT) FROM p GROUP BY l_orderkey UNION ALL SELECT 'c' || o_custkey, CAST(0 AS BIGINT), CAST(max(e) AS BIGINT) FROM p GROUP BY o_custkey""",
)
def g16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items within orders within customers, each laid out on its customer's axis."""
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")).cast("long")
    items = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("k", place)
    order, customer, none = F.concat(F.lit("o"), "l_orderkey"), F.concat(F.lit("c"), "o_custkey"), F.lit(None).cast("string")
    leaves = items.select(F.concat(F.lit("l"), "l_orderkey", F.lit("_"), "k").alias("id"), order.alias("parent"), F.col("k").alias("place"), F.col("l_quantity").cast("long").alias("length"))
    middle = items.select(order, customer, F.col("l_orderkey"), F.lit(None).cast("long")).distinct()
    top = items.select(customer, none, F.lit(0).cast("long"), F.lit(None).cast("long")).distinct()
    return ancestral.nested_coordinates(leaves.union(middle).union(top))


def thread_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rank, a_thread, a_segment, b_thread, b_segment): an order aligns a quarter of its customer with one of a clerk's."""
    k, c = F.col("o_orderkey"), F.concat(F.lit("c"), "o_custkey")
    other = F.when(k % 5 == 0, F.concat(F.lit("c"), F.col("o_custkey") % 97 + 1)).otherwise(F.concat(F.lit("t"), k * 31 % 4001))
    segment = lambda t, n: F.concat(t, F.lit("/"), (k % n).cast("string"))
    return table(spark, sf_dir, "orders").select(k.alias("rank"), c.alias("a_thread"), segment(c, 4).alias("a_segment"), other.alias("b_thread"), segment(other, 3).alias("b_segment"))


@query("f15_cycle_free_threads")
def f15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches in order of their orders; every tenth customer is a thread that stays apart and free of cycles."""
    special = table(spark, sf_dir, "customer").filter("c_custkey % 10 = 0").select(F.concat(F.lit("c"), "c_custkey").alias("id"))
    return graph.cycle_free(thread_matches(spark, sf_dir), special).select("rank", "state")


# -- files of a graph: each nation's customers are segments s1, s2, ..., so all files' names clash

GFA = r"""c AS (SELECT c_nationkey AS file, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k, count(*) OVER (PARTITION BY c_nationkey) AS m FROM customer)"""


def gfa_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, n, text): segments, links to the next one and back, a path and a walk over all of them, and a header."""
    place = Window.partitionBy("c_nationkey").orderBy("c_custkey")
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("file"), F.row_number().over(place).cast("long").alias("k"), F.lead("c_custkey").over(place).isNotNull().alias("more"))
    s = lambda d: F.concat(F.lit("s"), (F.col("k") + d).cast("string"))
    tabs = lambda *parts: F.concat_ws("\t", *(F.lit(p) if isinstance(p, str) else p for p in parts))
    segments = rows.select("file", F.col("k").alias("n"), tabs("S", s(0), "ACGT").alias("text"))
    links = rows.filter("more").select("file", (F.col("k") + 100_000_000).alias("n"), tabs("L", s(0), "+", s(1), "-", "0M").alias("text"))
    whole = rows.groupBy("file").agg(F.array_sort(F.collect_list("k")).alias("ks"))
    joined = lambda f, by: F.array_join(F.transform("ks", lambda k: f(k.cast("string"))), by)
    path = whole.select("file", F.lit(200_000_000).cast("long"), tabs("P", "p", joined(lambda k: F.concat(F.lit("s"), k, F.lit("+")), ","), "*"))
    walk = whole.select("file", F.lit(300_000_000).cast("long"), tabs("W", "x", "0", "c", "0", "9", joined(lambda k: F.concat(F.lit("<s"), k), "")))
    head = whole.select("file", F.lit(0).cast("long"), F.lit("H\tVN:Z:1.1"))
    return segments.union(links).union(path).union(walk).union(head)


@query(
    "v3_joined_ids",
    rf"""WITH {GFA}, d AS (SELECT file, k, m, row_number() OVER (ORDER BY file, k) AS g FROM c), t AS (SELECT 's' || g AS s, * FROM d)
SELECT file, k AS n, 'S' || chr(9) || s || chr(9) || 'ACGT' AS text FROM t UNION ALL SELECT file, k + 100000000, 'L' || chr(9) || s || chr(9) || '+' || chr(9) || 's' || (g + 1) || chr(9) || '-' || chr(9) || '0M' FROM t WHERE k < m
UNION ALL SELECT file, 200000000, 'P' || chr(9) || 'p' || chr(9) || string_agg(s || '+', ',' ORDER BY k) || chr(9) || '*' FROM t GROUP BY file
UNION ALL SELECT file, 300000000, 'W' || chr(9) || 'x' || chr(9) || '0' || chr(9) || 'c' || chr(9) || '0' || chr(9) || '9' || chr(9) || string_agg('<' || s, '' ORDER BY k) FROM t GROUP BY file
UNION ALL SELECT DISTINCT file, 0, 'H' || chr(9) || 'VN:Z:1.1' FROM t""",
)
def v3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphpaths.join_ids(gfa_lines(spark, sf_dir))


# -- ends

CAPS = """a AS (SELECT o_custkey AS flower, CASE WHEN o_custkey % 3 = 0 THEN 'hub' ELSE 'e' || o_orderkey % 5 END AS x, 'f' || o_orderkey % 4 AS y, o_orderkey % 90 AS length FROM orders),
caps AS (SELECT flower, x AS "end", y AS other, length FROM a UNION ALL SELECT flower, y, x, length FROM a)"""


@query(
    "c16_ends_to_align",
    f"""WITH {CAPS}, n AS (SELECT flower, "end", count(*) AS k FROM caps GROUP BY ALL), t AS (SELECT flower, sum(k) AS total, arg_min("end", (-k, "end")) AS top, max(k) AS most FROM n GROUP BY 1), m AS (SELECT flower, max(length) AS longest FROM caps GROUP BY 1),
g AS (SELECT t.flower, top FROM t JOIN m USING (flower) WHERE most * 2 >= total AND longest <= 80 AND NOT EXISTS (SELECT 1 FROM caps c WHERE c.flower = t.flower AND ((c."end" <> top AND c.other <> top) OR c."end" = c.other)))
SELECT n.flower, n."end", g.top IS NOT NULL AS dominant FROM n LEFT JOIN g USING (flower) WHERE g.top IS NULL OR g.top = n."end\"""",
)
def c16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the customers have an end that takes part in all their adjacencies."""
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    x = F.when(c % 3 == 0, "hub").otherwise(F.concat(F.lit("e"), (k % 5).cast("string")))
    rows = table(spark, sf_dir, "orders").select(c.alias("flower"), x.alias("x"), F.concat(F.lit("f"), (k % 4).cast("string")).alias("y"), (k % 90).alias("length"))
    both = rows.select("flower", F.col("x").alias("end"), F.col("y").alias("other"), "length").unionByName(rows.select("flower", F.col("y").alias("end"), F.col("x").alias("other"), "length"))
    return ends.ends_to_align(both, 40)


@query(
    "c17_rescued_segments",
    """WITH d AS (SELECT DISTINCT o_custkey AS seq, CAST(o_orderdate AS DATE) - DATE '1970-01-01' + 15 + i AS p FROM (SELECT *, unnest(range(o_orderkey % 23)) AS i FROM orders WHERE o_orderkey % 3 = 0)),
s AS (SELECT o_custkey AS seq, min(CAST(o_orderdate AS DATE) - DATE '1970-01-01') AS s0, max(CAST(o_orderdate AS DATE) - DATE '1970-01-01') + 1 AS e0 FROM orders GROUP BY 1), w AS (SELECT seq, unnest(range(s0, e0, 30)) AS s, e0 FROM s), g AS (SELECT seq, s, least(s + 30, e0) AS e FROM w)
SELECT g.seq, CAST(s AS BIGINT) AS start, CAST(e AS BIGINT) AS "end", count(*) AS covered FROM g JOIN d ON d.seq = g.seq AND p >= s AND p < e WHERE e - s >= 10 GROUP BY g.seq, s, e HAVING count(*) / (e - s) > 0.4""",
)
def c17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of customers' axes of which the masks cover more than two fifths."""
    day = F.unix_date(F.to_date("o_orderdate")).cast("long")
    whole = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("seq")).agg(F.min(day).alias("start"), (F.max(day) + 1).alias("end"))
    months = iv.fragments(whole, ["seq"], 30, 30)
    k = F.col("o_orderkey")
    beds = table(spark, sf_dir, "orders").filter(k % 3 == 0).select(F.col("o_custkey").alias("seq"), (day + 15).alias("start"), (day + 15 + k % 23).alias("end"))
    return ends.rescued(months, beds, ["seq"], 10, 0.4)


@query(
    "g14_broken_references",
    """WITH RECURSIVE fl AS (SELECT n_nationkey + 10 AS id, n_regionkey AS parent, n_nationkey * 10 AS bases, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey * 7 END AS chain, true AS leaf FROM nation UNION ALL SELECT r_regionkey, 99, r_regionkey * 60, CASE WHEN r_regionkey % 3 = 1 THEN 100 END, false FROM region UNION ALL SELECT 99, NULL, 1000, NULL, false),
says AS (SELECT id, parent, CASE WHEN parent IS NULL THEN NULL WHEN bases > 150 THEN true WHEN chain >= 80 THEN false END AS s FROM fl), walk AS (SELECT id, id AS at_, s, parent FROM says UNION ALL SELECT w.id, y.id, y.s, y.parent FROM walk w JOIN says y ON y.id = w.parent WHERE w.s IS NULL),
br AS (SELECT id, coalesce(bool_or(s), true) AS breakable FROM walk GROUP BY 1), o AS (SELECT o_orderstatus || o_custkey % 20 AS ref, o_orderkey AS place, o_custkey % 50 AS node, c_nationkey + 10 AS flower FROM orders JOIN customer ON c_custkey = o_custkey),
sup AS (SELECT least(l_suppkey % 50, l_partkey % 50) AS a, greatest(l_suppkey % 50, l_partkey % 50) AS b, count(*) AS n FROM lineitem WHERE l_quantity > 25 GROUP BY 1, 2), x AS (SELECT *, lead(node) OVER (PARTITION BY ref ORDER BY place) AS nn FROM o),
c AS (SELECT x.ref, x.place, x.node, x.flower, CASE WHEN nn IS NOT NULL AND breakable AND coalesce(n, 0) < (SELECT count(*) FROM lineitem WHERE l_quantity > 25) // 1275 THEN 1 ELSE 0 END AS cut FROM x JOIN br ON br.id = flower LEFT JOIN sup ON a = least(node, nn) AND b = greatest(node, nn))
SELECT ref, place, node, flower, CAST(sum(cut) OVER (PARTITION BY ref ORDER BY place) - cut AS BIGINT) AS piece FROM c""",
)
def g14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of orders, cut where fewer items than the mean put two customers' numbers side by side."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key, r, none = F.col("n_nationkey").cast("long"), F.col("r_regionkey").cast("long"), F.lit(None).cast("long")
    flowers = nation.select((key + 10).alias("id"), F.col("n_regionkey").cast("long").alias("parent"), (key * 10).alias("bases"), F.when(key % 2 == 0, key * 7).alias("chain_bases"), F.lit(True).alias("leaf"))
    flowers = flowers.union(region.select(r, F.lit(99).cast("long"), r * 60, F.when(r % 3 == 1, F.lit(100).cast("long")), F.lit(False))).union(spark.range(99, 100).select("id", none, F.lit(1000).cast("long"), none, F.lit(False)))
    items = table(spark, sf_dir, "lineitem").filter("l_quantity > 25")
    support = items.groupBy((F.col("l_suppkey") % 50).alias("a"), (F.col("l_partkey") % 50).alias("b")).agg(F.count("*").alias("n"))
    order = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    order = order.select(F.concat("o_orderstatus", (F.col("o_custkey") % 20).cast("string")).alias("ref"), F.col("o_orderkey").alias("place"), (F.col("o_custkey") % 50).alias("node"), (F.col("c_nationkey") + 10).cast("long").alias("flower"))
    return ends.break_adjacencies(order, support, flowers, items.count() // 1275, 150, 80)
