"""Interval queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.operators import intervals as iv
from loomspan.operators import relational as rel
from loomspan.plans.catalog import query, table


def order_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contig, start, end): each order covers some days of its customer's axis."""
    day = F.unix_date(F.to_date("o_orderdate")).cast("long")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("contig"), day.alias("start"), (day + F.col("o_orderkey") % 60).alias("end")
    )


SPANS = """SELECT o_custkey AS contig, CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS start,
 CAST(o_orderdate AS DATE) - DATE '1970-01-01' + o_orderkey % 60 AS "end" FROM orders"""

MERGED = """SELECT contig, min(start) AS start, max("end") AS "end" FROM (
 SELECT *, sum(fresh) OVER (PARTITION BY contig ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM (
  SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY contig ORDER BY start, "end"
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
  FROM spans WHERE "end" > start)) GROUP BY contig, island"""


@query("i1_merge_intervals", f"WITH spans AS ({SPANS}) {MERGED}")
def i1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.merge(order_spans(spark, sf_dir), ["contig"])


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contig, start, end): a second, sparser set of ranges on the same axes."""
    day = F.unix_date(F.to_date("o_orderdate")).cast("long") + 15
    return table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 3 == 0).select(
        F.col("o_custkey").alias("contig"), day.alias("start"), (day + F.col("o_orderkey") % 23).alias("end")
    )


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contig, length) of every customer's axis."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("contig"), (F.lit(9000) + F.col("c_custkey") % 500).alias("length"))


MASKS = """SELECT o_custkey AS contig, CAST(o_orderdate AS DATE) - DATE '1970-01-01' + 15 AS start,
 CAST(o_orderdate AS DATE) - DATE '1970-01-01' + 15 + o_orderkey % 23 AS "end" FROM orders WHERE o_orderkey % 3 = 0"""
LENGTHS = "SELECT c_custkey AS contig, 9000 + c_custkey % 500 AS length FROM customer"

#: Every covered day of a range as a row: an oracle that shares nothing with sweeps and windows.
DAYS = """WITH spans AS ({spans}), masks AS ({masks}), len AS ({lengths}),
a AS (SELECT DISTINCT contig, unnest(range(start, "end")) AS d FROM spans WHERE "end" > start),
b AS (SELECT DISTINCT contig, unnest(range(start, "end")) AS d FROM masks WHERE "end" > start),
n AS (SELECT contig, d, count(*) AS k FROM (SELECT contig, unnest(range(start, "end")) AS d FROM spans WHERE "end" > start) GROUP BY 1, 2)""".format(
    spans=SPANS, masks=MASKS, lengths=LENGTHS
)


def runs(days: str) -> str:
    """SQL for the runs of consecutive days of a (contig, d) query."""
    return (
        f"{DAYS}, x AS ({days}) SELECT contig, CAST(min(d) AS BIGINT) AS start, CAST(max(d) + 1 AS BIGINT) AS \"end\""
        " FROM (SELECT contig, d, d - row_number() OVER (PARTITION BY contig ORDER BY d) AS run FROM x) GROUP BY contig, run"
    )


KEY = ["contig"]


@query(
    "i2_merge_with_gap",
    f"""WITH spans AS ({SPANS}) SELECT contig, min(start) AS start, max("end") AS "end" FROM (
 SELECT *, sum(fresh) OVER (PARTITION BY contig ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM (
  SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY contig ORDER BY start, "end"
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 30 THEN 0 ELSE 1 END AS fresh
  FROM spans WHERE "end" - start > 5)) GROUP BY contig, island""",
)
def i2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.merge(order_spans(spark, sf_dir).filter("end - start > 5"), KEY, gap=30)


@query("i3_intersect", runs("SELECT * FROM a INTERSECT SELECT * FROM b"))
def i3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.intersect(order_spans(spark, sf_dir), masks(spark, sf_dir), KEY)


@query("i4_subtract", runs("SELECT * FROM a EXCEPT SELECT * FROM b"))
def i4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.subtract(order_spans(spark, sf_dir), masks(spark, sf_dir), KEY)


@query(
    "i5_single_cover",
    f"""WITH spans AS ({SPANS}), e AS (SELECT contig, p, CAST(sum(d) AS BIGINT) AS d FROM (
 SELECT contig, start AS p, 1 AS d FROM spans WHERE "end" > start UNION ALL SELECT contig, "end", -1 FROM spans WHERE "end" > start) GROUP BY 1, 2),
s AS (SELECT contig, p AS start, lead(p) OVER w AS "end", sum(d) OVER (w ROWS UNBOUNDED PRECEDING) AS k FROM e WINDOW w AS (PARTITION BY contig ORDER BY p))
SELECT contig, start, "end" FROM s WHERE k = 1 AND "end" IS NOT NULL""",
)
def i5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.single_cover(order_spans(spark, sf_dir), KEY)


@query("i6_depth_at_least", runs("SELECT contig, d FROM n WHERE k >= 2"))
def i6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.covered_at_least(order_spans(spark, sf_dir), KEY, 2)


@query("i7_total_length", f"WITH spans AS ({SPANS}), m AS ({MERGED}) SELECT contig, count(*) AS intervals, CAST(sum(\"end\" - start) AS BIGINT) AS bp FROM m GROUP BY 1")
def i7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.total_length(iv.merge(order_spans(spark, sf_dir), KEY), KEY)


@query(
    "i8_runs_with_offset",
    f"WITH spans AS ({SPANS}), m AS ({MERGED}) SELECT contig, start + contig % 7 AS start, \"end\" + contig % 7 AS \"end\" FROM m WHERE \"end\" - start >= 20",
)
def i8(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = F.col("contig") % 7
    merged = iv.merge(order_spans(spark, sf_dir), KEY).filter("end - start >= 20")
    return merged.withColumn("start", F.col("start") + shift).withColumn("end", F.col("end") + shift)


@query("i9_zero_depth", runs("SELECT contig, unnest(range(CAST(8035 AS BIGINT), CAST(8100 AS BIGINT))) AS d FROM (SELECT DISTINCT contig FROM a) EXCEPT SELECT * FROM a"))
def i9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of positions of depth 0 from a stream of (contig, position, depth)."""
    spans = order_spans(spark, sf_dir)
    stretch = spans.filter("end > start").select("contig").distinct().select("contig", F.lit(8035).cast("long").alias("start"), F.lit(8100).cast("long").alias("end"))
    return iv.subtract(stretch, spans, KEY)


@query(
    "i10_clamp",
    f"WITH spans AS ({SPANS}), len AS ({LENGTHS}) SELECT contig, greatest(start, 0) AS start, least(\"end\", length) AS \"end\", \"end\" > length AS clamped FROM spans JOIN len USING (contig) WHERE least(\"end\", length) > greatest(start, 0)",
)
def i10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.clamp(order_spans(spark, sf_dir), lengths(spark, sf_dir), KEY)


@query(
    "i11_slice_region",
    f"""WITH len AS ({LENGTHS}), n AS (SELECT contig, length, greatest(1, (2 * length + 999) // 2000) AS n FROM len), e AS (SELECT *, unnest(range(0, n)) AS i FROM n)
SELECT contig, i * 1000 AS start, CASE WHEN i = n - 1 THEN length ELSE (i + 1) * 1000 END AS "end" FROM e""",
)
def i11(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = lengths(spark, sf_dir).select("contig", F.lit(0).cast("long").alias("start"), F.col("length").alias("end"))
    return iv.slice_spans(whole, KEY, 1000)


@query(
    "i12_fragments",
    f"WITH len AS ({LENGTHS}), e AS (SELECT contig, length, unnest(range(0, length, 500)) AS s FROM len) SELECT contig, s AS start, least(s + 1000, length) AS \"end\" FROM e",
)
def i12(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = lengths(spark, sf_dir).select("contig", F.lit(0).cast("long").alias("start"), F.col("length").alias("end"))
    return iv.fragments(whole, KEY, 1000, 500)


@query(
    "i14_uncovered_with_flank",
    f"""WITH spans AS ({SPANS}), len AS ({LENGTHS}), m AS ({MERGED}),
g AS (SELECT len.contig, coalesce(lag(m."end") OVER w, 0) AS start, m.start AS "end", length FROM len JOIN m USING (contig) WINDOW w AS (PARTITION BY len.contig ORDER BY m.start)
 UNION ALL SELECT len.contig, coalesce(max(m."end"), 0), length, length FROM len LEFT JOIN m USING (contig) GROUP BY len.contig, length),
f AS (SELECT contig, greatest(start - 10, 0) AS start, least(least("end", length) + 10, length) AS "end" FROM g WHERE least("end", length) - start > 100),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY contig ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS k FROM (
 SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY contig ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM f WHERE "end" > start))
SELECT contig, min(start) AS start, max("end") AS "end" FROM i GROUP BY contig, k""",
)
def i14(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = lengths(spark, sf_dir)
    return iv.widen(iv.complement(order_spans(spark, sf_dir), known, KEY), KEY, 10, known, min_length=100)


def _phase_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[tuple[str, DataFrame]]]:
    orders = table(spark, sf_dir, "orders")
    day = F.unix_date(F.to_date("o_orderdate")).cast("long")

    def spans(extra: int, modulo: int) -> DataFrame:
        return orders.filter(F.col("o_orderkey") % modulo != 0).select(F.col("o_custkey").alias("contig"), (day + extra).alias("start"), (day + 60 - extra).alias("end"))

    everything = orders.select(F.col("o_custkey").alias("contig"), day.alias("start"), (day + 60).alias("end"))
    return everything, [("full", spans(0, 11)), ("clip", spans(3, 7)), ("filter", spans(5, 5))]


PHASES = """WITH o AS (SELECT o_custkey AS contig, o_orderkey AS k, CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS s FROM orders),
b AS (SELECT DISTINCT contig, unnest(range(s, s + 60)) AS d FROM o),
p1 AS (SELECT DISTINCT contig, unnest(range(s, s + 60)) AS d FROM o WHERE k % 11 <> 0),
p2 AS (SELECT DISTINCT contig, unnest(range(s + 3, s + 57)) AS d FROM o WHERE k % 7 <> 0),
p3 AS (SELECT DISTINCT contig, unnest(range(s + 5, s + 55)) AS d FROM o WHERE k % 5 <> 0),
k1 AS (SELECT * FROM b INTERSECT SELECT * FROM p1), k2 AS (SELECT * FROM k1 INTERSECT SELECT * FROM p2),
lost AS (SELECT 'full' AS phase, * FROM (SELECT * FROM b EXCEPT SELECT * FROM p1) UNION ALL SELECT 'clip', * FROM (SELECT * FROM k1 EXCEPT SELECT * FROM p2)
 UNION ALL SELECT 'filter', * FROM (SELECT * FROM k2 EXCEPT SELECT * FROM p3)),
ex AS (SELECT contig, phase, CAST(min(d) AS BIGINT) AS start, CAST(max(d) + 1 AS BIGINT) AS "end" FROM (
 SELECT *, d - row_number() OVER (PARTITION BY contig, phase ORDER BY d) AS run FROM lost) GROUP BY contig, phase, run)"""


@query("i15_exclusions", f"{PHASES} SELECT contig, phase, start, \"end\" FROM ex")
def i15(spark: SparkSession, sf_dir: str) -> DataFrame:
    baseline, phases = _phase_frames(spark, sf_dir)
    return iv.exclusions(baseline, phases, KEY)


@query(
    "a16_exclusion_summary",
    f"{PHASES} SELECT coalesce(CAST(contig % 25 AS VARCHAR), 'TOTAL') AS event, coalesce(phase, 'TOTAL') AS reason, count(*) AS intervals, CAST(sum(\"end\" - start) AS BIGINT) AS bp FROM ex GROUP BY ROLLUP (contig % 25, phase)",
)
def a16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail, a TOTAL row for each event and a grand TOTAL."""
    lost = i15(spark, sf_dir).withColumn("event", F.col("contig") % 25)
    return lost.rollup("event", "phase").agg(F.count("*").alias("intervals"), F.sum(F.col("end") - F.col("start")).alias("bp")).select(
        F.coalesce(F.col("event").cast("string"), F.lit("TOTAL")).alias("event"), F.coalesce("phase", F.lit("TOTAL")).alias("reason"), "intervals", "bp"
    )


@query(
    "i16_outliers",
    f"""{PHASES}, t AS (SELECT contig % 25 AS event, CAST(sum("end" - start) AS BIGINT) AS lost FROM ex GROUP BY 1), i AS (SELECT contig % 25 AS event, count(*) AS input_bp FROM b GROUP BY 1),
j AS (SELECT i.event, input_bp, coalesce(lost, 0) AS lost FROM i LEFT JOIN t USING (event)), m AS (SELECT list_sort(list(lost))[count(*) // 2 + 1] AS upper FROM j)
SELECT event, input_bp, lost, lost > 0.05 * input_bp AS dropped, lost > 3 * upper AND lost > 0.1 * input_bp AS outlier FROM j, m""",
)
def i16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that lost much of their input, or far more than the upper median of all."""
    baseline, phases = _phase_frames(spark, sf_dir)
    event = (F.col("contig") % 25).alias("event")
    # Sums of bases need no merged runs: those of the disjoint pieces of one sweep are the same.
    bases, none = F.col("end") - F.col("start"), F.lit(0).cast("long")
    both = iv.charged(baseline, phases, KEY).groupBy(event).agg(F.sum(bases).alias("input_bp"), F.sum(F.when(F.col("phase").isNotNull(), bases).otherwise(none)).alias("lost"))
    upper = both.agg(rel.upper_median("lost").alias("upper"))
    return both.join(F.broadcast(upper)).select(
        "event", "input_bp", "lost", (F.col("lost") > 0.05 * F.col("input_bp")).alias("dropped"), ((F.col("lost") > 3 * F.col("upper")) & (F.col("lost") > 0.1 * F.col("input_bp"))).alias("outlier")
    )


@query("i18_mask_complement", runs("SELECT contig, unnest(range(0, length)) AS d FROM len EXCEPT SELECT * FROM b").replace("GROUP BY contig, run", "GROUP BY contig, run HAVING count(*) > 50"))
def i18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What masking leaves of each axis, longer than the least length."""
    return iv.complement(masks(spark, sf_dir), lengths(spark, sf_dir), KEY).filter("end - start > 50")


@query("i20_tiles", "SELECT user_id AS contig, CAST(floor(event_id / 100.0) * 100 AS BIGINT) AS tile, count(*) AS n FROM events GROUP BY 1, 2")
def i20(spark: SparkSession, sf_dir: str) -> DataFrame:
    tile = (F.floor(F.col("event_id") / 100) * 100).alias("tile")
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("contig"), tile).agg(F.count("*").alias("n"))


PAIRS = f"WITH a AS (SELECT o_orderkey AS id, s.* FROM orders o JOIN ({SPANS.replace('SELECT o_custkey', 'SELECT o_orderkey AS k, o_custkey')}) s ON o.o_orderkey = s.k), b AS ({MASKS})"


def _with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.unix_date(F.to_date("o_orderdate")).cast("long")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("contig"), day.alias("start"), (day + F.col("o_orderkey") % 60).alias("end"))


OVERLAP = "a.contig = b.contig AND a.start < b.\"end\" AND b.start < a.\"end\" AND a.\"end\" > a.start AND b.\"end\" > b.start"


@query("j13_overlap_join", f"{PAIRS} SELECT a.id, a.contig, greatest(a.start, b.start) AS start, least(a.\"end\", b.\"end\") AS \"end\" FROM a JOIN b ON {OVERLAP}")
def j13(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = iv.overlap_join(_with_ids(spark, sf_dir), masks(spark, sf_dir), KEY, 64)
    return hit.select("id", "contig", F.greatest("start", "b_start").alias("start"), F.least("end", "b_end").alias("end"))


@query("j16_overlaps_any", f"{PAIRS} SELECT a.id, a.contig, a.start, a.\"end\" FROM a WHERE EXISTS (SELECT 1 FROM b WHERE {OVERLAP})")
def j16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.overlap_join(_with_ids(spark, sf_dir), masks(spark, sf_dir), KEY, 64, how="left_semi").select("id", "contig", "start", "end")


@query("j17_count_overlaps", f"{PAIRS} SELECT a.id, count(b.contig) AS n FROM a LEFT JOIN b ON {OVERLAP} GROUP BY a.id")
def j17(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = iv.overlap_join(_with_ids(spark, sf_dir), masks(spark, sf_dir), KEY, 64, how="left")
    return hit.groupBy("id").agg(F.count("b_start").alias("n"))


@query(
    "j18_reciprocal_overlap",
    f"{PAIRS} SELECT a.id AS left_id, x.id AS right_id, least(a.\"end\", x.\"end\") - greatest(a.start, x.start) AS overlap FROM a JOIN a x ON a.contig = x.contig AND a.id < x.id AND a.start < x.\"end\" AND x.start < a.\"end\""
    " WHERE least(a.\"end\", x.\"end\") - greatest(a.start, x.start) >= 0.5 * greatest(a.\"end\" - a.start, x.\"end\" - x.start) AND a.\"end\" > a.start AND x.\"end\" > x.start",
)
def j18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.reciprocal_pairs(_with_ids(spark, sf_dir), KEY, 0.5, 64)


@query(
    "j19_rescue_by_coverage",
    f"{PAIRS}, m AS (SELECT contig, min(start) AS start, max(\"end\") AS \"end\" FROM (SELECT *, sum(f) OVER (PARTITION BY contig ORDER BY start, \"end\" ROWS UNBOUNDED PRECEDING) AS k FROM ("
    "SELECT *, CASE WHEN start <= max(\"end\") OVER (PARTITION BY contig ORDER BY start, \"end\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS f FROM b WHERE \"end\" > start)) GROUP BY contig, k),"
    f" h AS (SELECT a.id, CAST(sum(least(a.\"end\", b.\"end\") - greatest(a.start, b.start)) AS BIGINT) AS covered, any_value(a.\"end\" - a.start) AS length FROM a JOIN m b ON {OVERLAP} GROUP BY a.id)"
    " SELECT id, covered, length FROM h WHERE covered > 0.25 * length",
)
def j19(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = iv.overlap_join(_with_ids(spark, sf_dir), iv.merge(masks(spark, sf_dir), KEY), KEY, 64)
    return hit.groupBy("id").agg(F.sum("overlap").alias("covered"), F.first(F.col("end") - F.col("start")).alias("length")).filter("covered > 0.25 * length")


@query(
    "j20_containing_interval",
    f"WITH spans AS ({SPANS}), m AS ({MERGED}), p AS (SELECT o_orderkey AS id, o_custkey AS contig, CAST(o_orderdate AS DATE) - DATE '1970-01-01' + o_orderkey % 90 AS pos FROM orders)"
    " SELECT p.id, p.contig, p.pos, coalesce(m.start, -1) AS label FROM p LEFT JOIN m ON p.contig = m.contig AND p.pos >= m.start AND p.pos < m.\"end\"",
)
def j20(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.unix_date(F.to_date("o_orderdate")).cast("long")
    points = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("contig"), (day + F.col("o_orderkey") % 90).alias("pos"))
    labelled = iv.merge(order_spans(spark, sf_dir), KEY).withColumn("label", F.col("start"))
    return iv.as_of(points, labelled, KEY, "label").select("id", "contig", "pos", F.coalesce("label", F.lit(-1).cast("long")).alias("label"))


SURVIVAL = f"""{PHASES}, days AS (SELECT 'full' AS phase, * FROM p1 UNION ALL SELECT 'clip', * FROM p2 UNION ALL SELECT 'filter', * FROM p3), len AS ({LENGTHS}), c AS (SELECT phase, contig, d FROM days JOIN len USING (contig) WHERE d >= 0 AND d < length),
r AS (SELECT phase, contig, count(*) AS n FROM (SELECT *, d - row_number() OVER (PARTITION BY phase, contig ORDER BY d) AS run FROM c) GROUP BY phase, contig, run),
s AS (SELECT contig, max(length) AS length, {", ".join(f"CAST(coalesce(sum(n) FILTER (phase = '{p}'), 0) AS BIGINT) AS {p}_bp, count(*) FILTER (phase = '{p}') AS {p}_frags" for p in ("full", "clip", "filter"))} FROM len LEFT JOIN r USING (contig) GROUP BY contig)"""


@query("k6_survival_by_contig", f"{SURVIVAL} SELECT * FROM s")
def k6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of each input is left after each phase, and in how many pieces."""
    return iv.survival(lengths(spark, sf_dir), _phase_frames(spark, sf_dir)[1], KEY)


@query("k6_survival_by_chromosome", f"{SURVIVAL} SELECT contig % 7 AS chromosome, contig % 25 AS genome, count(*) AS contigs, CAST(sum(length) AS BIGINT) AS input_bp, {', '.join(f'CAST(sum({p}_{w}) AS BIGINT) AS {p}_{w}' for p in ('full', 'clip', 'filter') for w in ('bp', 'frags'))} FROM s GROUP BY 1, 2")
def k6_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by chromosome and genome, written as a report and read back."""
    from loomspan.plans.files import round_trip
    from loomspan.sources import formats, sinks

    rows = k6(spark, sf_dir).withColumns({"chromosome": F.col("contig") % 7, "genome": F.col("contig") % 25})
    report = iv.survival_by(rows, ["chromosome", "genome"])
    schema = ", ".join(f"{c} long" for c in report.columns)
    return round_trip(spark, "k6.tsv", lambda p: sinks.write_summary(report, p, report.columns), lambda p: formats.read_table(spark, p, schema, comment=None, header=report.columns))
