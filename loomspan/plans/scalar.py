"""Scalar-function and filter queries over the driver tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspan.functions import bases, names
from loomspan.plans.catalog import query, table

#: A header made of a supplier's row, and its SQL.
HEADER = "s_name || ':' || s_nationkey || '-' || (s_nationkey + s_suppkey) || ' length=' || s_suppkey"


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.concat("s_name", F.lit(":"), F.col("s_nationkey").cast("string"), F.lit("-"), (F.col("s_nationkey") + F.col("s_suppkey")).cast("string"), F.lit(" length="), F.col("s_suppkey").cast("string"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", h.alias("header"))


@query(
    "p1_sanitize_header",
    f"""WITH h AS (SELECT s_suppkey, regexp_extract({HEADER}, '^(\\S*)', 1) AS h FROM supplier)
SELECT s_suppkey, 'id=e' || s_suppkey % 5 || '|' || replace(regexp_extract(h, '^(.*):(\\d+)-(\\d+)$', 1) || '_sub_' || greatest(CAST(regexp_extract(h, '^(.*):(\\d+)-(\\d+)$', 2) AS BIGINT) - 1, 0) || '_' || regexp_extract(h, '^(.*):(\\d+)-(\\d+)$', 3), ':', '_') AS name FROM h""",
)
def p1(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.concat(F.lit("e"), (F.col("s_suppkey") % 5).cast("string"))
    return headers(spark, sf_dir).select("s_suppkey", names.sanitize(F.col("header"), event).alias("name"))


@query("p2_plain_bases", "SELECT doc_id, translate(regexp_replace(text, '[^ACGTNacgtnuwsmkrybdhvUWSMKRYBDHV]', '', 'g'), 'uwsmkrybdhvUWSMKRYBDHV', 'nnnnnnnnnnnNNNNNNNNNNN') AS seq FROM documents")
@query("p2_plain_bases_whole", "SELECT doc_id, translate(regexp_replace(text, '[^ACGTNacgtnuwsmkrybdhvUWSMKRYBDHV]', '', 'g'), 'uwsmkrybdhvUWSMKRYBDHV', 'nnnnnnnnnnnNNNNNNNNNNN') AS seq FROM documents")
def p2(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = F.regexp_replace("text", "[^ACGTNacgtnuwsmkrybdhvUWSMKRYBDHV]", "")
    return table(spark, sf_dir, "documents").select("doc_id", bases.plain_bases(letters).alias("seq"))


SEQ = "translate(text, translate(text, 'ACGTacgt', ''), '')"


@query(
    "p4_nested_subpath",
    "SELECT s_suppkey, s_name AS base, CAST(s_suppkey + s_nationkey AS BIGINT) AS off, CAST(7 AS BIGINT) AS length FROM supplier",
)
def p4(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    name = F.concat("s_name", F.lit("_sub_"), k.cast("string"), F.lit("_"), (k + 500).cast("string"), F.lit("_sub_"), n.cast("string"), F.lit("_"), (n + 7).cast("string"))
    return s.select("s_suppkey", names.subpath(name).alias("p")).select("s_suppkey", "p.base", F.col("p.offset").alias("off"), "p.length")


@query("p5_event_prefix", "SELECT s_suppkey, 'x' || s_suppkey || '#' || s_nationkey AS prefix, CASE WHEN s_nationkey = 0 THEN 'x' || s_suppkey ELSE 'x' || s_suppkey || '.' || s_nationkey END AS event FROM supplier")
def p5(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.concat(F.lit("x"), F.col("s_suppkey").cast("string"), F.lit(".0"), F.col("s_nationkey").cast("string"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.event_to_prefix(event).alias("prefix")).withColumn("event", names.prefix_to_event(F.col("prefix")))


@query("p6_path_name", "SELECT s_suppkey, 's#' || s_nationkey AS prefix, s_name AS contig, CAST(s_suppkey AS BIGINT) AS start, CAST(s_suppkey + 100 AS BIGINT) AS \"end\" FROM supplier")
def p6(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A contig may hold further separators: only the first two divide.
    name = F.concat(F.lit("s#"), F.col("s_nationkey").cast("string"), F.lit("#"), "s_name", F.lit("["), F.col("s_suppkey").cast("string"), F.lit("]"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.path_name(name, F.lit(100).cast("long")).alias("p")).select("s_suppkey", "p.*")


@query("p7_reverse_complement", "SELECT item_id, reverse(translate(text, 'ACGTacgt', 'TGCAtgca')) AS rc FROM benchmark")
def p7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", bases.reverse_complement(F.col("text")).alias("rc"))


@query("p9_mask_ranges", "SELECT item_id, substr(text, 1, 2) || lower(substr(text, 3, 4)) || substr(text, 7, 3) || lower(substr(text, 10, 5)) || substr(text, 15) AS masked FROM benchmark")
def p9(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = F.array(*(F.struct(F.lit(a).cast("long").alias("start"), F.lit(b).cast("long").alias("end")) for a, b in ((2, 6), (9, 14))))
    return table(spark, sf_dir, "benchmark").select("item_id", bases.mask_ranges(F.col("text"), ranges).alias("masked"))


@query(
    "p10_masked_runs",
    """WITH c AS (SELECT item_id, unnest(range(1, length(text) + 1)) AS i, text FROM benchmark), m AS (SELECT item_id, i FROM c WHERE regexp_matches(substr(text, i, 1), '[a-z]')),
r AS (SELECT item_id, min(i) - 1 AS start, max(i) AS "end" FROM (SELECT *, i - row_number() OVER (PARTITION BY item_id ORDER BY i) AS k FROM m) GROUP BY item_id, k)
SELECT item_id, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end" FROM r WHERE "end" - start > 3""",
)
def p10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", F.explode(bases.runs(F.col("text"), "[a-z]")).alias("r")).select("item_id", "r.start", "r.end").filter("end - start > 3")


@query("p11_low_entropy", "SELECT doc_id, round(greatest(length(text) - length(replace(lower(text), 'a', '')), length(text) - length(replace(lower(text), 'c', '')), length(text) - length(replace(lower(text), 'g', '')), length(text) - length(replace(lower(text), 't', ''))) / greatest(length(text), 1), 9) AS share FROM documents")
def p11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.round(bases.most_frequent_share(F.col("text")), 9).alias("share"))


#: An alignment's operations made of a line item, and their SQL.
CIGAR = "l_linenumber || 'M' || l_suppkey % 9 || 'I' || CAST(l_quantity AS BIGINT) || '=' || l_partkey % 7 || 'D3X'"


def cigars(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.col("l_linenumber").cast("string"), F.lit("M"), (F.col("l_suppkey") % 9).cast("string"), F.lit("I"), F.col("l_quantity").cast("long").cast("string"), F.lit("="), (F.col("l_partkey") % 7).cast("string"), F.lit("D3X"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", text.alias("cigar"))


@query(
    "p12_cigar_spans",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_linenumber + l_suppkey % 9 + CAST(l_quantity AS BIGINT) + 3 AS BIGINT) AS query, CAST(l_linenumber + l_partkey % 7 + CAST(l_quantity AS BIGINT) + 3 AS BIGINT) AS target, CAST(l_linenumber + l_suppkey % 9 + l_partkey % 7 AS BIGINT) AS variation FROM lineitem",
)
def p12(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("cigar")
    return cigars(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", bases.query_span(c).alias("query"), bases.target_span(c).alias("target"), bases.variation_length(c).alias("variation"))


@query(
    "p13_difference_score",
    "SELECT o_orderkey, (o_orderkey % 50) || '=1X2I1D' AS cigar, CAST((o_orderkey % 50) * 2.0 - 3.0 - (4.0 + 1.0) - 4.0 AS DOUBLE) AS score FROM orders",
)
def p13(spark: SparkSession, sf_dir: str) -> DataFrame:
    cs = F.concat(F.lit(":"), (F.col("o_orderkey") % 50).cast("string"), F.lit("*ac+tt-g"))
    return table(spark, sf_dir, "orders").select("o_orderkey", bases.cs_to_cigar(cs).alias("cigar"), bases.cs_score(cs, 2.0, -1.0, 4.0, 1.0, {"ac": -3.0}).alias("score"))


@query("p17_trim_both_sides", "SELECT o_orderkey, o_custkey + 2 AS start, o_orderkey % 20 - 4 AS length FROM orders WHERE o_orderkey % 20 - 4 > 0")
def p17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") + 2).alias("start"), (F.col("o_orderkey") % 20 - 4).alias("length")).filter("length > 0")


@query("p18_flag_bits", "SELECT event_id FROM events WHERE event_id & 256 = 0 AND event_id & 2048 = 0")
def p18(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").filter(~bases.has_flag(e, 256) & ~bases.has_flag(e, 2048)).select("event_id")


@query("p22_sample_parts", "SELECT s_suppkey, 'hg' || s_suppkey AS base, CAST(s_nationkey AS INTEGER) AS hap FROM supplier")
def p22(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("hg"), F.col("s_suppkey").cast("string"), F.lit("."), F.col("s_nationkey").cast("string"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.sample_base(name).alias("base"), names.sample_haplotype(name).alias("hap"))


@query("p23_alphanumeric", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9]', '', 'g') AS name, regexp_matches(url, '^[A-Za-z0-9_.-]+$') AS legal FROM pages")
def p23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", names.alphanumeric(F.col("url")).alias("name"), names.legal_header(F.col("url")).alias("legal"))


@query(
    "p25_genotype_classes",
    "WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey % 3 AS a, l_partkey % 2 AS b FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, CAST((a > 0)::INT + (b > 0)::INT AS INTEGER) AS alts, CASE WHEN a <> b THEN 'het' ELSE 'hom' END AS zygosity FROM g",
)
def p25(spark: SparkSession, sf_dir: str) -> DataFrame:
    gt = F.concat((F.col("l_suppkey") % 3).cast("string"), F.lit("|"), (F.col("l_partkey") % 2).cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", bases.alt_count(gt).alias("alts"), bases.zygosity(gt).alias("zygosity"))


@query("p26_reverse_traversal", "SELECT s_suppkey, '>' || s_nationkey || '<' || s_suppkey AS back FROM supplier")
def p26(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit(">"), F.col("s_suppkey").cast("string"), F.lit("<"), F.col("s_nationkey").cast("string"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.reverse_path(path).alias("back"))


@query(
    "p27_variant_types",
    "SELECT kind, count(*) AS n, CAST(sum(d) AS BIGINT) AS d FROM (SELECT CASE WHEN length(a) = 1 AND length(b) = 1 THEN 'SNP' WHEN length(a) < length(b) THEN 'INS' WHEN length(a) > length(b) THEN 'DEL' WHEN b = reverse(translate(a, 'ACGTacgt', 'TGCAtgca')) THEN 'INV' ELSE 'MNP' END AS kind, length(b) - length(a) AS d FROM (SELECT substr(p_name, 1, CAST(1 + p_size % 4 AS INTEGER)) AS a, substr(p_brand, 1, CAST(1 + p_partkey % 3 AS INTEGER)) AS b FROM part)) GROUP BY 1",
)
def p27(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.substring("p_name", F.lit(1), (1 + F.col("p_size") % 4).cast("int")), F.substring("p_brand", F.lit(1), (1 + F.col("p_partkey") % 3).cast("int"))
    return table(spark, sf_dir, "part").select(bases.variant_type(a, b).alias("kind"), bases.signed_length(a, b).alias("d")).groupBy("kind").agg(F.count("*").alias("n"), F.sum("d").alias("d"))


@query("p28_jukes_cantor", "SELECT p_partkey, round(0.25 + 0.75 * exp(-4.0 / 3.0 * (p_size / 100)), 9) AS same FROM part")
def p28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.round(bases.same_base_probability(F.col("p_size") / 100), 9).alias("same"))


@query("p29_support", "SELECT l_partkey, round(count(*) / (2 * (i * (i - 1) / 2) + i * o), 9) AS support FROM (SELECT l_partkey, count(*) FILTER (l_suppkey % 4 > 0) OVER (PARTITION BY l_partkey) AS i, count(*) FILTER (l_suppkey % 4 = 0) OVER (PARTITION BY l_partkey) AS o FROM lineitem) WHERE i > 1 GROUP BY l_partkey, i, o")
def p29(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = F.col("l_suppkey") % 4 > 0
    g = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), F.count_if(inside).alias("i"), F.count_if(~inside).alias("o"))
    return g.filter("i > 1").select("l_partkey", F.round(bases.support(F.col("n"), F.col("i"), F.col("o")), 9).alias("support"))


@query("p32_rename_prefix", "SELECT c_custkey, regexp_replace(c_name, '^Customer#0*', 'chr') AS name FROM customer")
def p32(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.regexp_replace("c_name", "^Customer#0*", "chr").alias("name"))


@query("c8_divergence_class", "SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'one' WHEN p_size <= 20 THEN 'two' WHEN p_size <= 30 THEN 'three' ELSE 'five' END AS loose, CASE WHEN p_size < 10 THEN 'one' WHEN p_size < 20 THEN 'two' WHEN p_size < 30 THEN 'three' ELSE 'five' END AS strict FROM part")
def c8(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = {"one": 10, "two": 20, "three": 30, "five": 1000}
    s = F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", bases.divergence_class(s, bounds).alias("loose"), bases.divergence_class(s, bounds, strict=True).alias("strict"))


# -- filters


@query("f6_length_and_content", "SELECT page_id FROM pages WHERE length(html) >= 500 AND NOT regexp_matches(html, '^[nN]*$')")
def f6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").filter((F.length("html") >= 500) & ~F.col("html").rlike("^[nN]*$")).select("page_id")


@query("f7_small_by_whole_contig", "SELECT conv_id, turn FROM (SELECT *, max(turn * 100 + length(text)) OVER (PARTITION BY conv_id) AS whole FROM conversations) WHERE whole >= 400")
def f7(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.max(F.col("turn") * 100 + F.length("text")).over(Window.partitionBy("conv_id"))
    return table(spark, sf_dir, "conversations").withColumn("whole", whole).filter("whole >= 400").select("conv_id", "turn")


@query("f9_over_masked", "SELECT doc_id FROM documents WHERE length(text) >= 100 AND length(regexp_replace(text, '[^A-Z]', '', 'g')) < least(length(text), greatest(20, CAST(floor(0.01 * length(text)) AS BIGINT)))")
def f9(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text")
    upper = F.length(F.regexp_replace("text", "[^A-Z]", ""))
    return table(spark, sf_dir, "documents").filter((n >= 100) & (upper < F.least(n.cast("long"), F.greatest(F.lit(20).cast("long"), F.floor(0.01 * n))))).select("doc_id")


@query("f10_coding_only", "SELECT o_orderkey FROM orders WHERE o_orderkey % 13 > o_custkey % 7")
def f10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 13 > F.col("o_custkey") % 7).select("o_orderkey")


@query("f11_required_members", "SELECT l_partkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1 HAVING count(*) FILTER (s_nationkey < 20) >= 5 AND count(*) FILTER (s_nationkey >= 20) >= 2 AND count(*) >= 8 AND count(DISTINCT s_nationkey) >= 6")
def f11(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    n = F.col("s_nationkey")
    g = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").join(s, "l_suppkey").groupBy("l_partkey")
    return g.agg(F.count_if(n < 20).alias("i"), F.count_if(n >= 20).alias("o"), F.count("*").alias("d"), F.countDistinct(n).alias("k")).filter("i >= 5 AND o >= 2 AND d >= 8 AND k >= 6").select("l_partkey")


@query("f17_megablocks", "SELECT l_partkey, count(*) AS degree FROM lineitem GROUP BY 1 HAVING count(*) > 30 AND sum(l_discount) / count(*) < 0.05")
def f17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounts are summed as decimals, so that a mean at the bound does not depend on the order of the
    sum; where one is not finite, or too large for that, the sum is one of doubles."""
    d, n = F.col("l_discount"), F.col("degree")
    exact = d.try_cast("decimal(28,18)")
    g = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("degree"), F.sum(exact).alias("s"), F.sum(d).alias("plain"), F.count_if(d.isNotNull() & exact.isNull()).alias("odd"))
    low = F.when(F.col("odd") > 0, F.col("plain") / n < 0.05).otherwise(F.col("s") < F.lit(Decimal("0.05")) * n.cast("decimal(18,0)"))
    return g.filter((n > 30) & low).select("l_partkey", "degree")


@query("f18_unequal_copies", "SELECT o_custkey FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1 HAVING min(n) <> max(n) OR count(*) < 5")
def f18(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    return copies.groupBy("o_custkey").agg(F.min("n").alias("a"), F.max("n").alias("b"), F.count("*").alias("k")).filter("a <> b OR k < 5").select("o_custkey")


@query("f20_indexed_only", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#12')")
def f20(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "part").filter(F.col("p_brand") == "Brand#12").select("p_partkey")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(known, F.col("l_partkey") == F.col("p_partkey"), "left_semi").select("l_orderkey", "l_linenumber")


@query("f22_full_match_and_drop_off", "SELECT s_suppkey FROM supplier WHERE regexp_full_match(s_name, 'Supplier.*[05]') AND s_acctbal >= 0.1 * (SELECT max(s_acctbal) FROM supplier)")
def f22(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    most = s.agg(F.max("s_acctbal").alias("most"))
    return s.filter(F.col("s_name").rlike("^(?:Supplier.*[05])$")).join(F.broadcast(most), F.col("s_acctbal") >= 0.1 * F.col("most")).select("s_suppkey")


@query("f25_first_of_key", "SELECT event_type, user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS k FROM events) WHERE k = 1")
def f25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.min("event_id").alias("event_id"))


@query("f26_duplicate_headers", "SELECT text, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def f26(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("text").agg(F.count("*").alias("n")).filter("n > 1")


@query("f27_sanity_warnings", "SELECT doc_id, length(regexp_replace(text, '[^a-z]', '', 'g')) / length(text) > 0.7 AS masked, (length(text) - length(replace(lower(text), 'n', ''))) / length(text) > 0.08 AS n_rich FROM documents WHERE length(text) > 0")
def f27(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text")
    masked = F.length(F.regexp_replace("text", "[^a-z]", "")) / n
    rich = (n - F.length(F.replace(F.lower("text"), F.lit("n"), F.lit("")))) / n
    return table(spark, sf_dir, "documents").filter(n > 0).select("doc_id", (masked > 0.7).alias("masked"), (rich > 0.08).alias("n_rich"))
