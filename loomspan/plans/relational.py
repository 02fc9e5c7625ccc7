"""Join, aggregate, window, order and set queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspan.operators import relational as rel
from loomspan.plans.catalog import query, table


@query("j1_must_match", "SELECT l_orderkey, l_linenumber, o_custkey, s_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey")
def j1(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return rel.require_match(rel.require_match(lines, orders, ["l_orderkey"], "order"), suppliers, ["l_suppkey"], "supplier").drop("l_suppkey")


@query(
    "j2_left_lookup_zero",
    "SELECT c_custkey, coalesce(n, 0) AS n, coalesce(total, 0.0) AS total FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, round(sum(CAST(o_totalprice AS DECIMAL(18,2))), 2)::DOUBLE AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey",
)
def j2(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    return rel.lookup(table(spark, sf_dir, "customer").select("c_custkey"), done, ["c_custkey"], {"n": 0, "total": 0.0})


@query("j4_inner", "SELECT n_name, r_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def j4(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_nation = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return nations.join(per_nation, "n_nationkey").select("n_name", "r_name", "customers")


@query("j6_semi", "SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def j6(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select("l_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")


@query("j7_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def j7(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("j9_orphans", "SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1")
def j9(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "part").filter("p_size > 10").select("p_partkey")
    return table(spark, sf_dir, "lineitem").join(known, F.col("l_partkey") == F.col("p_partkey"), "left_anti").groupBy("l_partkey").agg(F.count("*").alias("n"))


@query(
    "j10_key_alignment",
    "SELECT k AS suppkey, CAST(coalesce(sum(q) FILTER (f = 'N'), 0) AS BIGINT) AS open, CAST(coalesce(sum(q) FILTER (f = 'R'), 0) AS BIGINT) AS returned, CAST(coalesce(sum(q) FILTER (f = 'A'), 0) AS BIGINT) AS accepted FROM (SELECT l_suppkey AS k, CAST(l_quantity AS BIGINT) AS q, l_returnflag AS f FROM lineitem) GROUP BY 1",
)
def j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("suppkey"), F.col("l_quantity").cast("long").alias("q"), "l_returnflag")
    return rel.aligned_keys({n: lines.filter(F.col("l_returnflag") == f) for n, f in (("open", "N"), ("returned", "R"), ("accepted", "A"))}, ["suppkey"], "q")


@query(
    "j11_first_match",
    "SELECT o_orderkey, coalesce(l_partkey, -1) AS l_partkey, coalesce(l_linenumber, -1) AS l_linenumber FROM orders LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag, l_linenumber, l_partkey) AS k FROM lineitem WHERE l_discount > 0.05) ON l_orderkey = o_orderkey AND k = 1",
)
def j11(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter("l_discount > 0.05").withColumnRenamed("l_orderkey", "o_orderkey")
    found = rel.first_match(table(spark, sf_dir, "orders").select("o_orderkey"), lines, ["o_orderkey"], ["l_returnflag", "l_linenumber", "l_partkey"], ["l_partkey", "l_linenumber"])
    return found.select("o_orderkey", F.coalesce("l_partkey", F.lit(-1).cast("long")).alias("l_partkey"), F.coalesce("l_linenumber", F.lit(-1)).alias("l_linenumber"))


@query("j12_fallback_lookup", "SELECT c_custkey, CASE WHEN r_name IS NULL THEN 'other' ELSE r_name END AS graph FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT * FROM region WHERE r_regionkey IN (0, 2)) ON n_regionkey = r_regionkey")
def j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("r_regionkey"))
    known = table(spark, sf_dir, "region").filter(F.col("r_regionkey").isin(0, 2))
    placed = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(nations, "c_nationkey", "left").join(known, "r_regionkey", "left")
    return placed.select("c_custkey", F.coalesce("r_name", F.lit("other")).alias("graph"))


@query("j22_ordered_pairs", "SELECT x.n_name AS a, y.n_name AS b FROM nation x JOIN nation y ON x.n_name < y.n_name")
def j22(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.ordered_pairs(table(spark, sf_dir, "nation"), "n_name")


@query("j21_all_pairs_but_self", "SELECT x.r_name AS q, y.n_name AS t FROM region x JOIN nation y ON y.n_regionkey <> x.r_regionkey")
def j21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("n_regionkey") != F.col("r_regionkey")).select(F.col("r_name").alias("q"), F.col("n_name").alias("t"))


@query(
    "j25_pointer_chase",
    "WITH RECURSIVE p AS (SELECT event_id AS id, CASE WHEN event_id % 16 = 0 THEN NULL ELSE event_id - 1 END AS parent FROM events), r AS (SELECT id, id AS top, 0 AS hops FROM p WHERE parent IS NULL UNION ALL SELECT p.id, r.top, r.hops + 1 FROM p JOIN r ON p.parent = r.id) SELECT id, top, CAST(hops AS BIGINT) AS hops FROM r",
)
def j25(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 16 != 0, F.col("event_id") - 1).alias("parent"))
    return rel.follow_parents(links, "id", "parent")


@query("j26_group_max_on_rows", "SELECT l_orderkey, l_linenumber, max(l_quantity) OVER (PARTITION BY l_suppkey) AS most FROM lineitem")
def j26(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.max("l_quantity").over(Window.partitionBy("l_suppkey")).alias("most"))


@query("j27_splice", "SELECT p_partkey, p_name AS v FROM part WHERE p_size <= 40 UNION ALL SELECT p_partkey, p_brand FROM part WHERE p_size > 40")
def j27(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    a, b = (part.select("p_partkey", F.col(c).alias("v")) for c in ("p_name", "p_brand"))
    return rel.splice(a, b, part.filter("p_size > 40").select("p_partkey"), ["p_partkey"])


@query(
    "j30_missing_completion",
    "SELECT r_name, s.seg, count(c_custkey) AS n FROM region CROSS JOIN (SELECT DISTINCT c_mktsegment AS seg FROM customer) s LEFT JOIN (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < -900) ON n_regionkey = r_regionkey AND c_mktsegment = s.seg GROUP BY 1, 2",
)
def j30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts for every (region, segment), also those without customers."""
    customer = table(spark, sf_dir, "customer")
    segments = customer.select(F.col("c_mktsegment").alias("seg")).distinct()
    placed = customer.filter("c_acctbal < -900").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    counted = placed.groupBy(F.col("n_regionkey").alias("r_regionkey"), F.col("c_mktsegment").alias("seg")).agg(F.count("*").alias("n"))
    frame = table(spark, sf_dir, "region").join(segments, F.lit(True))
    return frame.join(counted, ["r_regionkey", "seg"], "left").select("r_name", "seg", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


# -- aggregates


@query("a3_group_totals", "SELECT l_shipmode AS mode, n, total, round(total / n, 6) AS mean FROM (SELECT l_returnflag || l_linestatus AS l_shipmode, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1)")
def a3(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("mode")).agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("total"))
    return g.withColumn("mean", F.round(F.col("total") / F.col("n"), 6))


COUNTS = "SELECT lang, source, count(*) FILTER (quality = 1 AND toxic = 0) AS tp, count(*) FILTER (quality = 1 AND toxic = 1) AS fp, count(*) FILTER (quality = 0 AND toxic = 1) AS fn FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2"


@query(
    "a4_precision_recall_f1",
    f"WITH c AS ({COUNTS}), p AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS p, coalesce(tp / nullif(tp + fn, 0), 0.0) AS r FROM c) SELECT lang, source, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0.0), 6) AS f1 FROM p",
)
def a4(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    q, t = F.col("quality") == 1, F.col("toxic") == 1
    counts = labelled.groupBy("lang", "source").agg(F.count_if(q & ~t).alias("tp"), F.count_if(q & t).alias("fp"), F.count_if(~q & t).alias("fn"))
    return counts.select("*", *rel.quality_metrics(F.col("tp"), F.col("fp"), F.col("fn")))


@query("a5_conditional_ratio", "SELECT l_suppkey, round(count(*) FILTER (l_returnflag = 'R') / count(*), 9) AS returned, round(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'R') / sum(CAST(l_quantity AS BIGINT)), 9) AS returned_qty FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_returnflag = 'R') > 0")
def a5(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, q = F.col("l_returnflag") == "R", F.col("l_quantity").cast("long")
    g = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count_if(r).alias("k"), F.count("*").alias("n"), F.sum(F.when(r, q)).alias("rq"), F.sum(q).alias("q"))
    return g.filter("k > 0").select("l_suppkey", F.round(F.col("k") / F.col("n"), 9).alias("returned"), F.round(F.col("rq") / F.col("q"), 9).alias("returned_qty"))


@query("a6_count_distinct", "SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT (l_returnflag, l_linestatus)) AS states FROM lineitem GROUP BY 1")
def a6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_returnflag", "l_linestatus").alias("states"))


@query("a7_extremes", "SELECT l_orderkey, min(l_partkey) AS low, max(l_partkey) AS high, arg_max(l_quantity, (l_extendedprice, -l_linenumber)) AS quantity_of_dearest FROM lineitem GROUP BY 1")
def a7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("low"), F.max("l_partkey").alias("high"), F.max_by("l_quantity", F.struct("l_extendedprice", -F.col("l_linenumber"))).alias("quantity_of_dearest")
    )


@query("a8_median", "SELECT l_returnflag, median(l_quantity) AS median FROM lineitem GROUP BY 1")
def a8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.median("l_quantity").alias("median"))


@query("a9_lower_median", "SELECT l_suppkey, list_sort(list(l_quantity))[(count(*) + 1) // 2] AS lower FROM lineitem GROUP BY 1")
def a9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(rel.lower_median("l_quantity").alias("lower"))


@query("a10_upper_median", "SELECT l_suppkey, list_sort(list(l_quantity))[count(*) // 2 + 1] AS upper FROM lineitem GROUP BY 1")
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(rel.upper_median("l_quantity").alias("upper"))


@query(
    "a11_n50",
    "WITH r AS (SELECT source, n_chars, sum(n_chars) OVER (PARTITION BY source ORDER BY n_chars DESC) AS run, sum(n_chars) OVER (PARTITION BY source) AS total FROM documents) SELECT source, count(*) AS n, CAST(max(total) AS BIGINT) AS total, max(n_chars) FILTER (run >= total // 2) AS n50 FROM r GROUP BY 1",
)
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.n50(table(spark, sf_dir, "documents"), ["source"], "n_chars")


@query(
    "a12_block_statistics",
    "WITH b AS (SELECT l_partkey, count(*) AS degree, CAST(max(l_quantity) AS BIGINT) AS length FROM lineitem GROUP BY 1) SELECT count(*) AS blocks, CAST(sum(length * degree) AS BIGINT) AS aligned, min(degree) AS least, round(avg(degree), 6) AS mean, list_sort(list(degree))[(count(*) + 1) // 2] AS median, max(degree) AS most FROM b",
)
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("degree"), F.max("l_quantity").cast("long").alias("length"))
    d = F.col("degree")
    return blocks.agg(F.count("*").alias("blocks"), F.sum(F.col("length") * d).alias("aligned"), F.min(d).alias("least"), F.round(F.avg(d), 6).alias("mean"), rel.lower_median("degree").cast("long").alias("median"), F.max(d).alias("most"))


@query("a14_event_reason_tally", "SELECT user_id, event_type, count(*) AS intervals, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS bp FROM events GROUP BY 1, 2")
def a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("intervals"), F.sum(F.floor("value")).alias("bp"))


@query(
    "a23_adjacency_bases",
    "WITH g AS (SELECT user_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) - event_id - 1 AS gap FROM events) SELECT user_id, CAST(coalesce(sum(gap), 0) AS BIGINT) AS bases, count(gap) AS gaps FROM g GROUP BY 1",
)
def a23(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = F.lead("event_id").over(Window.partitionBy("user_id").orderBy("event_id")) - F.col("event_id") - 1
    return table(spark, sf_dir, "events").select("user_id", gap.alias("gap")).groupBy("user_id").agg(F.coalesce(F.sum("gap"), F.lit(0).cast("long")).alias("bases"), F.count("gap").alias("gaps"))


@query("a25_threshold_sweep", "SELECT l_returnflag, t AS threshold, count(*) AS n FROM lineitem, (VALUES (10.0::DOUBLE), (25.0), (40.0)) v(t) WHERE l_quantity > t GROUP BY 1, 2")
def a25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.thresholds(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", [10.0, 25.0, 40.0])


@query("a30_top_or_other", "WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 5) SELECT CASE WHEN p_brand IN (SELECT p_brand FROM c) THEN p_brand ELSE 'other' END AS p_brand_top, count(*) AS n FROM part GROUP BY 1")
def a30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.top_or_other(table(spark, sf_dir, "part").select("p_brand"), "p_brand", 5).groupBy("p_brand_top").agg(F.count("*").alias("n"))


# -- windows


@query("w1_share_of_group", "SELECT l_returnflag, l_linestatus, n, round(n / sum(n) OVER (PARTITION BY l_returnflag), 9) AS share FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2)")
def w1(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return g.withColumn("share", F.round(rel.share_of(F.col("n"), ["l_returnflag"]), 9))


@query("w2_top_one", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1")
def w2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.top_k(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("w3_average_rank", "SELECT p_partkey, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2 AS r FROM part")
def w3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", rel.average_rank(F.col("p_size").desc(), ["p_brand"], ["p_size"]).alias("r"))


@query("w4_fill_forward", "SELECT event_id, coalesce(last_value(CASE WHEN event_id % 5 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), '-') AS last_type FROM events")
def w4(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_id") % 5 == 0, F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(rel.fill_forward(value, ["user_id"], ["event_id"]), F.lit("-")).alias("last_type"))


@query(
    "w6_two_way_running_sums",
    "SELECT l_orderkey, l_linenumber, CAST(sum(q) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, q ROWS UNBOUNDED PRECEDING) AS BIGINT) AS forward, CAST(sum(q) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS backward FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q FROM lineitem)",
)
def w6(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    q = F.col("l_quantity").cast("long")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.sum(q).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("forward"), F.sum(q).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("backward")
    )


@query("w9_capped_runs", "SELECT event_id, CAST(floor((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) / 10) AS BIGINT) AS batch FROM events")
def w9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", rel.consecutive_groups(["user_id"], ["event_id"], 10).alias("batch"))


@query("w11_groups_with_several", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1)")
def w11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.with_distinct_count(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_custkey"], "o_orderstatus", "k").filter("k > 1").select("o_orderkey")


@query("w13_share_of_maximum", "SELECT p_partkey, round(p_size / max(p_size) OVER (), 9) AS ratio FROM part")
def w13(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    most = part.agg(F.max("p_size").alias("most"))
    return part.join(F.broadcast(most)).select("p_partkey", F.round(F.col("p_size") / F.col("most"), 9).alias("ratio"))


@query(
    "w14_bounded_forward_walk",
    "SELECT a.user_id, a.event_id, b.event_id AS next_value, CAST(b.k - a.k AS INTEGER) AS ahead FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) a JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) b ON a.user_id = b.user_id AND b.k - a.k BETWEEN 1 AND 3",
)
def w14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.next_within(table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], ["event_id"], "event_id", 3)


@query(
    "w15_running_offset",
    "WITH m AS (SELECT n_regionkey AS f, max(n_nationkey) AS most FROM nation GROUP BY 1), o AS (SELECT f, coalesce(sum(most) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM m) SELECT n_name, CAST(n_nationkey + off AS BIGINT) AS id FROM nation JOIN o ON f = n_regionkey",
)
def w15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of several files put one after another: each file's start past the greatest so far."""
    nation = table(spark, sf_dir, "nation")
    greatest = nation.groupBy("n_regionkey").agg(F.max("n_nationkey").alias("most"))
    off = F.coalesce(F.sum("most").over(Window.orderBy("n_regionkey").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return nation.join(greatest.withColumn("off", off), "n_regionkey").select("n_name", (F.col("n_nationkey") + F.col("off")).cast("long").alias("id"))


# -- order and sets


@query("o5_position_sort", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place FROM orders")
def o5(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w).cast("long").alias("place"))


@query("o6_longest_first", "SELECT page_id, length(html) AS size FROM pages ORDER BY size DESC, page_id")
@query("o6_longest_first_whole", "SELECT page_id, length(html) AS size FROM pages ORDER BY size DESC, page_id")
def o6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.length("html").cast("long").alias("size")).orderBy(F.col("size").desc(), "page_id")


@query("u1_union_all", "SELECT c_custkey AS k, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier")
def u1(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("kind"))
    return c.unionByName(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.lit("supplier").alias("kind")))


@query("u2_with_inverse", "SELECT l_orderkey AS q, l_partkey AS t FROM lineitem UNION ALL SELECT l_partkey, l_orderkey FROM lineitem")
def u2(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("q"), F.col("l_partkey").alias("t"))
    return a.unionByName(a.select(F.col("t").alias("q"), F.col("q").alias("t")))


@query("u4_set_algebra", "(SELECT c_nationkey AS k, 'both' AS kind FROM customer INTERSECT SELECT s_nationkey, 'both' FROM supplier) UNION ALL (SELECT c_nationkey, 'customer' FROM customer EXCEPT SELECT s_nationkey, 'customer' FROM supplier)")
def u4(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    return c.intersect(s).withColumn("kind", F.lit("both")).unionByName(c.subtract(s).withColumn("kind", F.lit("customer")))


@query("u5_distinct", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def u5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("u6_other_bucket", "SELECT CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE 'other' END AS kind, count(*) AS n FROM events GROUP BY 1")
def u6(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type").isin("click", "view"), F.col("event_type")).otherwise("other")
    return table(spark, sf_dir, "events").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("u8_pivot", "SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1")
def u8(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority")).pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)
    return wide.select("priority", F.col("F").alias("f"), F.col("O").alias("o"), F.col("P").alias("p"))


@query("u8_unpivot", "SELECT s_suppkey, name, value FROM (SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS nation, s_name AS label FROM supplier) UNPIVOT (value FOR name IN (nation, label))")
def u8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("nation"), F.col("s_name").alias("label"))
    return s.unpivot("s_suppkey", ["nation", "label"], "name", "value")


@query("k7_size_matrix", "SELECT event_type, CAST(min(v) AS BIGINT) AS least, CAST(max(v) AS BIGINT) AS most, CAST(floor(avg(v)) AS BIGINT) AS mean FROM (SELECT event_type, user_id, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS v FROM events GROUP BY 1, 2) GROUP BY 1")
def k7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least, greatest and whole mean of each category's size by member."""
    sizes = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.sum(F.floor("value")).alias("v"))
    return sizes.groupBy("event_type").agg(F.min("v").alias("least"), F.max("v").alias("most"), F.floor(F.avg("v")).alias("mean"))


@query(
    "p20_right_closed_bins",
    "SELECT p_partkey, coalesce(CASE WHEN p_size > 0 AND p_size <= 10 THEN 'small' WHEN p_size > 10 AND p_size <= 30 THEN 'medium' WHEN p_size > 30 AND p_size <= 45 THEN 'large' END, 'none') AS bin FROM part",
)
def p20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.coalesce(rel.binned(F.col("p_size"), [0, 10, 30, 45], ["small", "medium", "large"]), F.lit("none")).alias("bin"))
