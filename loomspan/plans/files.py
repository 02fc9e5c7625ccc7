"""Queries over file formats: a table is written in a format, read back by its scan, and compared."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.operators import intervals as iv
from loomspan.plans.catalog import query, table
from loomspan.plans.intervals import MASKS, SPANS, masks, order_spans
from loomspan.plans.structure import ALN, alignments
from loomspan.session import materialize, remove, shared_dir
from loomspan.sources import formats, sinks


def round_trip(spark: SparkSession, name: str, write: Callable[[str], None], read: Callable[[str], DataFrame]) -> DataFrame:
    """What `read` finds at a fresh path that `write` has filled; the files are deleted."""
    path = f"{shared_dir(spark)}/files-{uuid.uuid4().hex}/{name}"
    write(path)
    try:
        return materialize(read(path), name.replace(".", "-"))
    finally:
        remove(spark, path.rpartition("/")[0])


def write_lines(df: DataFrame, *cells: Column | str) -> Callable[[str], None]:
    """A writer of tab-separated lines of these cells."""
    return lambda path: df.select(F.concat_ws("\t", *(c if isinstance(c, Column) else F.col(c).cast("string") for c in cells)).alias("value")).write.text(path)


LETTERS = "regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')"


@query("s1_fasta_round_trip", f"SELECT CAST(doc_id AS VARCHAR) AS name, doc_id || ' ' || coalesce(source, '') AS header, length({LETTERS}) AS length, md5({LETTERS}) AS digest FROM documents")
def s1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts' letters as wrapped sequences."""
    seq = F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "")
    docs = table(spark, sf_dir, "documents").select(F.concat_ws(" ", F.col("doc_id").cast("string"), F.coalesce("source", F.lit(""))).alias("header"), seq.alias("seq"))
    back = round_trip(spark, "s1.fa", lambda p: sinks.write_fasta(docs, p), lambda p: formats.read_fasta(spark, p))
    return back.select("name", "header", F.length("seq").cast("long").alias("length"), F.md5("seq").alias("digest"))


PAF = "CAST(tags['id'] AS BIGINT) AS id, query, target, strand, qlen, qstart, qend, tlen, tstart, tend, matches, block, mapq"


@query("s3_paf_round_trip", f"{ALN} SELECT id, query, target, strand, qlen, qstart, qend, 5000 AS tlen, tstart, tend, matches, block, mapq FROM aln")
def s3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignments(spark, sf_dir).withColumn("tags", F.create_map(F.lit("id"), F.col("id").cast("string")))
    return round_trip(spark, "s3.paf", lambda p: sinks.write_paf(rows, p), lambda p: formats.read_paf(spark, p)).selectExpr(*PAF.split(", "))


@query("s4_bed_round_trip", f"SELECT 'full' AS name, contig, start, \"end\" FROM ({SPANS}) UNION ALL SELECT 'mask', * FROM ({MASKS})")
def s4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of two phases, a folder for each, read as one."""
    both = order_spans(spark, sf_dir).withColumn("name", F.lit("full")).unionByName(masks(spark, sf_dir).withColumn("name", F.lit("mask"))).withColumn("phase", F.col("name"))
    back = round_trip(spark, "s4.bed", lambda p: sinks.write_bed(both, p, ["contig", "start", "end", "name"], by=["phase"]), lambda p: formats.read_bed(spark, p))
    return back.select("name", F.col("contig").cast("long").alias("contig"), "start", "end")


@query("s5_fai_round_trip", "SELECT p_name || '_' || p_partkey AS contig, CAST(p_size AS BIGINT) * 100 AS length FROM part")
def s5(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.concat_ws("_", "p_name", F.col("p_partkey").cast("string")).alias("contig"), (F.col("p_size").cast("long") * 100).alias("length"))
    return round_trip(spark, "s5.fai", write_lines(parts, "contig", "length", F.lit("0"), F.lit("80"), F.lit("81")), lambda p: formats.read_fai(spark, p))


@query("s6_baseline_table", "SELECT 'e' || o_custkey % 25 AS event, 'c' || o_custkey AS contig, o_orderkey AS \"offset\", o_orderkey % 60 AS length FROM orders")
def s6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose header is checked in each file."""
    header = ["event", "contig", "offset", "length"]
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("e"), F.col("o_custkey") % 25).alias("event"), F.concat(F.lit("c"), "o_custkey").alias("contig"), F.col("o_orderkey").alias("offset"), (F.col("o_orderkey") % 60).alias("length"))
    write = lambda p: rows.write.csv(p, sep="\t", header=True)
    return round_trip(spark, "s6.tsv", write, lambda p: formats.read_table(spark, p, "event string, contig string, offset long, length long", comment=None, header=header))


@query(
    "s7_split_log",
    "SELECT 'c' || o_custkey AS contig, min('chr' || o_orderkey % 24) FILTER (o_orderkey % 7 > 0) AS assigned, bool_or(o_orderkey % 7 = 0) AS ambiguous FROM orders WHERE o_orderkey % 7 < 5 GROUP BY 1",
)
def s7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs' fates from a log's lines, amid others."""
    k, contig = F.col("o_orderkey"), F.concat(F.lit("c"), "o_custkey")
    line = F.when(k % 7 == 0, F.concat(F.lit("Query contig is ambiguous: "), contig)).when(k % 7 < 5, F.concat(F.lit("Assigned contig "), contig, F.lit(" to chr"), k % 24)).otherwise(F.lit("progress"))
    return round_trip(spark, "s7.log", write_lines(table(spark, sf_dir, "orders"), line), lambda p: formats.read_split_log(spark, p, r"^Assigned contig (\S+) to (\S+)$", r"ambiguous: (\S+)$"))


@query("s9_wig_round_trip", "SELECT CAST(o_custkey AS VARCHAR) AS contig, o_orderkey * 3 + k AS pos, CAST(o_orderkey % 100 AS DOUBLE) / 4 + k AS score FROM orders, (VALUES (0), (1)) v(k)")
def s9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two consecutive positions for each order, runs under headers of their own."""
    k = F.explode(F.array(F.lit(0), F.lit(1)))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("contig"), "o_orderkey", k.alias("k"))
    rows = rows.select("contig", (F.col("o_orderkey") * 3 + F.col("k")).alias("pos"), ((F.col("o_orderkey") % 100) / 4 + F.col("k")).alias("score"))
    return round_trip(spark, "s9.wig", lambda p: sinks.write_wig(rows, p), lambda p: formats.read_wig(spark, p))


@query(
    "i17_clipped_blocks",
    "WITH s AS (SELECT CAST(o_custkey AS VARCHAR) AS contig, o_orderkey * 3 + k AS pos, CAST(o_orderkey % 100 AS DOUBLE) / 4 + k AS score FROM orders, (VALUES (0), (1)) v(k)), r AS (SELECT *, pos - row_number() OVER (PARTITION BY contig ORDER BY pos) AS run FROM s WHERE pos >= 1001 AND pos < 4000) SELECT contig, min(pos) AS start, CAST(count(*) AS INTEGER) AS size, arg_min(score, pos) AS first, sum(score) AS total FROM r GROUP BY contig, run",
)
def i17_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A signal read from its blocks, clipped, and put into blocks again."""
    found = iv.signal_blocks(s9(spark, sf_dir), 1001, 4000)
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    return found.select("contig", "start", F.size("values").alias("size"), F.element_at("values", 1).alias("first"), total.alias("total"))


GENES = "SELECT 'g' || p_partkey AS name, 'chr' || p_size AS contig, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, p_partkey * 10 AS start, p_partkey * 10 + p_size AS \"end\" FROM part"


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, contig, strand, start, end) of parts."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(F.concat(F.lit("g"), k).alias("name"), F.concat(F.lit("chr"), "p_size").alias("contig"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand"), (k * 10).alias("start"), (k * 10 + F.col("p_size")).alias("end"))


PRED = ["name", "contig", "strand", "start", "end", "start", "end"]


@query("s10_genepred", f"SELECT name, contig, strand, start, \"end\", 2 AS exons, start + 1 AS second FROM ({GENES})")
def s10(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = lambda a, b: F.concat(a, F.lit(","), b, F.lit(","))
    write = write_lines(genes(spark, sf_dir), *PRED, F.lit("2"), both(F.col("start"), F.col("start") + 1), both(F.col("start") + 1, F.col("end")))
    back = round_trip(spark, "s10.gp", write, lambda p: formats.read_genepred(spark, p))
    return back.select("name", "contig", "strand", F.col("tx_start").alias("start"), F.col("tx_end").alias("end"), F.size("exons").alias("exons"), F.col("exons")[1]["start"].alias("second"))


@query("s10_genes_by_extension", " UNION ALL ".join(f"SELECT '{k}' AS kind, * FROM ({GENES})" for k in ("gff3", "gtf", "txt", "gp")))
def s10_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same genes from four formats, told apart by extension."""
    rows = genes(spark, sf_dir)
    dot = F.lit(".")
    feature = lambda text: write_lines(rows, "contig", F.lit("x"), F.lit("gene"), (F.col("start") + 1).cast("string"), "end", dot, "strand", dot, text)
    writers = {
        "gff3": feature(F.concat(F.lit("ID="), "name", F.lit(";Note=a"))),
        "gtf": feature(F.concat(F.lit('gene_id "'), "name", F.lit('"; tag "b";'))),
        "txt": write_lines(rows, F.lit("585"), *PRED, F.lit("0"), F.lit(""), F.lit("")),
        "gp": write_lines(rows, *PRED, F.lit("0"), F.lit(""), F.lit("")),
    }
    out = None
    for kind, write in writers.items():
        back = round_trip(spark, f"s10.{kind}", write, lambda p: formats.read_genes(spark, p)).withColumn("kind", F.lit(kind))
        out = back if out is None else out.unionByName(back)
    return out


@query("s11_sample_manifest", "SELECT 'n' || s_suppkey AS name, '/data/' || s_suppkey || '.fa' AS path, s_suppkey % 9 = 0 AS outgroup FROM supplier")
def s11(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey").cast("string")
    line = F.concat(F.when(F.col("s_suppkey") % 9 == 0, "*").otherwise(""), F.lit("n"), k, F.lit(" /data/"), k, F.lit(".fa"))
    return round_trip(spark, "s11.txt", write_lines(table(spark, sf_dir, "supplier"), line), lambda p: formats.read_seqfile(spark, p)[1])


@query("s13_sam_scan", f"{ALN} SELECT CAST(id AS VARCHAR) AS read, CASE WHEN strand = '-' THEN 16 ELSE 0 END AS flag, target AS contig, tstart AS pos, mapq, block || 'M' AS cigar, 4 AS length, CAST(matches AS VARCHAR) AS nm FROM aln")
def s13(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, rows = F.lit("*"), alignments(spark, sf_dir)
    cells = ["id", F.when(F.col("strand") == "-", "16").otherwise("0"), "target", (F.col("tstart") + 1).cast("string"), "mapq", F.concat("block", F.lit("M")), star, F.lit("0"), F.lit("0"), F.lit("ACGT"), star, F.concat(F.lit("NM:i:"), "matches")]
    back = round_trip(spark, "s13.sam", write_lines(rows, *cells), lambda p: formats.read_sam(spark, p))
    return back.select("read", "flag", "contig", "pos", F.col("mapq").cast("long").alias("mapq"), "cigar", "length", F.col("tags")["NM"].alias("nm"))


@query("s13_gaf_scan", f"{ALN} SELECT id, '>s' || target || '>s' || query AS path, tstart, tend FROM aln")
def s13_gaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignments(spark, sf_dir).withColumn("target", F.concat(F.lit(">s"), "target", F.lit(">s"), "query")).withColumn("query", F.col("id").cast("string"))
    back = round_trip(spark, "s13.gaf", lambda p: sinks.write_paf(rows, p), lambda p: formats.read_gaf(spark, p))
    return back.select(F.col("query").cast("long").alias("id"), "path", "tstart", "tend")


@query(
    "s14_vcf_round_trip",
    "SELECT 'chr' || l_suppkey % 24 AS contig, l_orderkey * 10 + l_linenumber AS pos, 'A' AS ref, CASE WHEN l_partkey % 3 = 0 THEN 2 ELSE 1 END AS alts, CAST(l_partkey AS VARCHAR) AS part, l_suppkey % 2 || '|' || l_partkey % 2 AS s1, CASE WHEN l_linenumber > 1 THEN '0/1' ELSE '.' END AS s2 FROM lineitem",
)
def s14(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    text = lambda v: v.cast("string")
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("chr"), c("l_suppkey") % 24).alias("contig"),
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("pos"),
        F.lit(None).cast("string").alias("id"),
        F.lit("A").alias("ref"),
        F.when(c("l_partkey") % 3 == 0, F.array(F.lit("C"), F.lit("GT"))).otherwise(F.array(F.lit("C"))).alias("alts"),
        F.lit(None).cast("double").alias("qual"),
        F.lit("PASS").alias("filter"),
        F.create_map(F.lit("PART"), text(c("l_partkey"))).alias("info"),
        F.create_map(F.lit("s1"), F.concat(c("l_suppkey") % 2, F.lit("|"), c("l_partkey") % 2), F.lit("s2"), F.when(c("l_linenumber") > 1, "0/1")).alias("genotypes"),
    )
    back = round_trip(spark, "s14.vcf", lambda p: sinks.write_vcf(rows, p, ["s1", "s2"]), lambda p: formats.read_vcf(spark, p, ["s1", "s2"]))
    return back.select("contig", "pos", "ref", F.size("alts").alias("alts"), F.col("info")["PART"].alias("part"), F.col("genotypes")["s1"].alias("s1"), F.col("genotypes")["s2"].alias("s2"))


@query(
    "s15_gfa_round_trip",
    "SELECT 'node' AS kind, CAST(p_partkey AS VARCHAR) AS a, CAST(length(p_name) AS VARCHAR) AS b FROM part UNION ALL SELECT 'edge', l_partkey || '+', l_orderkey || '-' FROM lineitem UNION ALL SELECT 'walk', 'w' || o_custkey, '>' || o_orderkey || '<' || o_custkey FROM orders",
)
def s15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and edges from the writer, walks as lines beside them."""
    nodes = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("seq"))
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), F.lit("+").alias("a_strand"), F.col("l_orderkey").alias("b"), F.lit("-").alias("b_strand"))
    orders = table(spark, sf_dir, "orders")
    walks = [F.lit("W"), F.concat(F.lit("w"), "o_custkey"), F.lit("0"), F.lit("c"), F.lit("0"), F.lit("9"), F.concat(F.lit(">"), "o_orderkey", F.lit("<"), "o_custkey")]

    def write(path: str) -> None:
        sinks.write_gfa(nodes, edges, f"{path}/a")
        write_lines(orders, *walks)(f"{path}/b")

    def read(path: str) -> DataFrame:
        n, e, w = formats.read_gfa(spark, [f"{path}/a", f"{path}/b"])
        n = n.select(F.lit("node").alias("kind"), F.col("id").alias("a"), F.col("length").cast("string").alias("b"))
        e = e.select(F.lit("edge").alias("kind"), F.concat("a", "a_strand").alias("a"), F.concat("b", "b_strand").alias("b"))
        return n.union(e).union(w.select(F.lit("walk").alias("kind"), F.col("sample").alias("a"), F.array_join("steps", "").alias("b")))

    return round_trip(spark, "s15.gfa", write, read)


@query("k5_summary_report", "SELECT coalesce('r' || n_regionkey, 'TOTAL') AS region, coalesce('n' || n_nationkey, 'TOTAL') AS genome, count(*) AS intervals, CAST(sum(c_custkey % 100) AS BIGINT) AS bp FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_regionkey, n_nationkey)")
def k5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, their totals and the grand total, written as a report and read back."""
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    totals = rows.rollup("n_regionkey", "n_nationkey").agg(F.count("*").alias("intervals"), F.sum(F.col("c_custkey") % 100).alias("bp"))
    named = lambda p, c: F.coalesce(F.concat(F.lit(p), c), F.lit("TOTAL"))
    report = totals.select(named("r", "n_regionkey").alias("region"), named("n", "n_nationkey").alias("genome"), "intervals", "bp")
    header = ["region", "genome", "intervals", "bp"]
    return round_trip(spark, "k5.tsv", lambda p: sinks.write_summary(report, p, header), lambda p: formats.read_table(spark, p, "region string, genome string, intervals long, bp long", comment=None, header=header))
