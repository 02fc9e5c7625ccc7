"""Scans of line-based formats into DataFrames, with explicit schemas.

All scans read with Spark's own readers, so a path may be a file, a folder, a list or a
glob in any store Spark reads, and compressed files are opened by their extension.
Coordinates are turned into half-open ones from 0 at the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Path = str | list[str]


def lines(spark: SparkSession, path: Path) -> DataFrame:
    """(value) of every line."""
    return spark.read.text(path)


def numbered(spark: SparkSession, path: Path) -> DataFrame:
    """(file, block, line, value) with lines numbered from 0 in each file, in the order they stand.

    For formats whose header lines rule what follows. Lines are numbered within the blocks that
    Spark's reader deals files into, and blocks' sizes are summed up, so a long file uses many tasks.
    """
    meta = F.col("_metadata")
    rows = spark.read.text(path).select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("_at"), "value")
    before = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(F.col("file").alias("f"), F.col("block").alias("b")).agg(F.count("*").alias("n"))
    offsets = sizes.select("f", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("file", "block").orderBy("_at")) - 1
    placed = rows.withColumn("_within", within).join(offsets, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    return placed.select("file", "block", (F.col("_offset") + F.col("_within")).alias("line"), "value")


def first_lines(spark: SparkSession, path: Path) -> DataFrame:
    """(file, value): the first line of each file."""
    meta = F.col("_metadata")
    rows = spark.read.text(path).select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("_at"), "value")
    return rows.filter("block = 0").groupBy("file").agg(F.min_by("value", "_at").alias("value"))


def _integer(value: Column, what: str) -> Column:
    number = F.expr("try_cast(NULL AS BIGINT)") if value is None else value.try_cast("long")
    return F.when(value.isNull() | number.isNotNull(), number).otherwise(F.raise_error(F.concat(F.lit(f"{what} is not an integer: "), value)).cast("long"))


def read_fasta(spark: SparkSession, path: Path) -> DataFrame:
    """(file, header, name, seq): a record for each `>` at the begin of a line."""
    records = spark.read.text(path, lineSep="\n>")
    text = F.regexp_replace("value", "^>", "")
    header = F.regexp_extract(text, r"^([^\r\n]*)", 1)
    seq = F.regexp_replace(F.regexp_replace(text, r"^[^\r\n]*", ""), r"\s", "")
    return records.filter(F.trim("value") != "").select(F.input_file_name().alias("file"), header.alias("header"), F.regexp_extract(header, r"^(\S*)", 1).alias("name"), seq.alias("seq"))


PAF_COLUMNS = ["query", "qlen", "qstart", "qend", "strand", "target", "tlen", "tstart", "tend", "matches", "block", "mapq"]


def read_paf(spark: SparkSession, path: Path) -> DataFrame:
    """The 12 columns and `tags`, a map from a tag's name to its text; `*` is null."""
    parts = F.split(F.col("value"), "\t")
    texts = {"query", "strand", "target"}

    def field(i: int, name: str) -> Column:
        v = F.nullif(F.get(parts, F.lit(i)), F.lit("*"))
        return (v if name in texts else _integer(v, name)).alias(name)

    tags = F.transform(F.filter(F.slice(parts, 13, 10_000), lambda t: t.rlike("^..:.:")), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, F.lit(6), F.length(t))))
    return lines(spark, path).filter(F.size(parts) >= 12).select(*(field(i, n) for i, n in enumerate(PAF_COLUMNS)), F.map_from_entries(tags).alias("tags"))


def read_bed(spark: SparkSession, path: Path) -> DataFrame:
    """(contig, start, end, name); comments, track and browser lines and short lines are left out."""
    first = F.regexp_extract(F.trim("value"), r"^(\S*)", 1)
    parts = F.split("value", r"\t| +")
    keep = (first != "") & ~first.startswith("#") & ~first.isin("track", "browser") & (F.size(parts) >= 3)
    return lines(spark, path).filter(keep).select(F.get(parts, F.lit(0)).alias("contig"), _integer(F.get(parts, F.lit(1)), "start").alias("start"), _integer(F.get(parts, F.lit(2)), "end").alias("end"), F.get(parts, F.lit(3)).alias("name"))


def read_fai(spark: SparkSession, path: Path) -> DataFrame:
    """(contig, length) of an index of sequence sizes."""
    return spark.read.csv(path, sep="\t", schema="contig string, length long, offset long, line_bases int, line_width int").select("contig", "length")


def read_table(spark: SparkSession, path: Path, schema: str, comment: str | None = "#", header: list[str] | None = None) -> DataFrame:
    """A tab-separated table; with `header`, each file's first line must be exactly that."""
    if header is not None:
        wrong = first_lines(spark, path).filter(F.regexp_replace("value", "^#", "") != "\t".join(header)).first()
        if wrong is not None:
            raise ValueError(f"{wrong['file']} has the header {wrong['value']!r}")
    options = {"comment": comment} if comment else {}
    df = spark.read.csv(path, sep="\t", schema=schema, mode="FAILFAST", header=header is not None and comment is None, **options)
    return df


def read_wig(spark: SparkSession, path: Path) -> DataFrame:
    """(contig, pos, score) of fixedStep blocks; pos from 0. The header that rules a line is sought in
    its own block of the file, then among the blocks before."""
    value = F.col("value")
    part = lambda name: F.nullif(F.regexp_extract(value, rf"\b{name}=(\S+)", 1), F.lit(""))
    head = F.struct("line", part("chrom").alias("contig"), part("start").cast("long").alias("start"), F.coalesce(part("step").cast("long"), F.lit(1).cast("long")).alias("step"))
    rows = numbered(spark, path).withColumn("head", F.when(value.startswith("fixedStep"), head))
    last = rows.groupBy(F.col("file").alias("f"), F.col("block").alias("b")).agg(F.max_by("head", F.when(F.col("head").isNotNull(), F.col("line"))).alias("last"))
    before = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("f", "b", F.last("last", ignorenulls=True).over(before).alias("carried"))
    w = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumn("own", F.last("head", ignorenulls=True).over(w))
    ruled = own.join(carried, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))).withColumn("h", F.coalesce("own", "carried"))
    pos = F.col("h.start") - 1 + F.col("h.step") * (F.col("line") - F.col("h.line") - 1)
    return ruled.filter(F.col("head").isNull() & F.col("h").isNotNull() & value.rlike(r"^\s*[-+0-9.]")).select("h.contig", pos.alias("pos"), F.trim("value").cast("double").alias("score"))


GENEPRED = "name string, contig string, strand string, tx_start long, tx_end long, cds_start long, cds_end long, exons int, exon_starts string, exon_ends string"


def read_genepred(spark: SparkSession, path: Path) -> DataFrame:
    """Gene annotation; exons as an array of struct(start, end)."""
    numbers = [F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("long")) for c in ("exon_starts", "exon_ends")]
    df = spark.read.csv(path, sep="\t", schema=GENEPRED)
    return df.select(*[c.split()[0] for c in GENEPRED.split(", ")[:7]], F.zip_with(*numbers, lambda a, b: F.struct(a.alias("start"), b.alias("end"))).alias("exons"))


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """(name, contig, strand, start, end) of a gene annotation, by the path's extension: `.gff`, `.gff3`
    and `.gtf` give their gene features, a browser's dump `.txt` drops its bin column, all else is genePred."""
    kind = re.sub(r"(\.gz|\.bz2)?/?$", "", path.lower()).rpartition(".")[2]
    if kind in ("gff", "gff3", "gtf"):
        names = F.coalesce(*(F.try_element_at("attributes", F.lit(k)) for k in ("gene_id", "ID", "Name")))
        return read_gff(spark, path).filter("feature = 'gene'").select(names.alias("name"), "contig", "strand", "start", "end")
    if kind == "txt":
        dump = spark.read.csv(path, sep="\t", schema="bin int, " + GENEPRED)
        return dump.select("name", "contig", "strand", F.col("tx_start").alias("start"), F.col("tx_end").alias("end"))
    return read_genepred(spark, path).select("name", "contig", "strand", F.col("tx_start").alias("start"), F.col("tx_end").alias("end"))


def read_gff(spark: SparkSession, path: Path) -> DataFrame:
    """GFF3 or GTF features with their attributes as a map; start from 0."""
    parts = F.split("value", "\t")
    texts = F.filter(F.split(F.get(parts, F.lit(8)), r"\s*;\s*"), lambda x: x != "")
    entry = F.transform(texts, lambda x: F.struct(F.regexp_extract(x, r"^([^= ]+)", 1), F.regexp_replace(F.regexp_replace(x, r"^[^= ]+[= ]\s*", ""), '^"|"$', "")))
    names = ["contig", "source", "feature", "start", "end", "score", "strand", "phase"]
    cols = [F.nullif(F.get(parts, F.lit(i)), F.lit(".")).alias(n) for i, n in enumerate(names)]
    df = lines(spark, path).filter(~F.col("value").startswith("#") & (F.size(parts) >= 9)).select(*cols, F.map_from_entries(entry).alias("attributes"))
    return df.withColumns({"start": F.col("start").cast("long") - 1, "end": F.col("end").cast("long"), "score": F.col("score").cast("double"), "phase": F.col("phase").cast("int")})


def read_sam(spark: SparkSession, path: Path) -> DataFrame:
    """(read, flag, contig, pos, mapq, cigar, length, tags); pos from 0, `*` is null."""
    parts = F.split("value", "\t")
    at = lambda i: F.nullif(F.get(parts, F.lit(i)), F.lit("*"))
    tags = F.map_from_entries(F.transform(F.slice(parts, 12, 10_000), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, F.lit(6), F.length(t)))))
    return lines(spark, path).filter(~F.col("value").startswith("@") & (F.size(parts) >= 11)).select(
        at(0).alias("read"), at(1).cast("int").alias("flag"), at(2).alias("contig"), (at(3).cast("long") - 1).alias("pos"), at(4).cast("int").alias("mapq"), at(5).alias("cigar"), F.length(at(9)).alias("length"), tags.alias("tags")
    )


def read_gaf(spark: SparkSession, path: Path) -> DataFrame:
    """Graph alignments: the PAF columns with the path in place of the target."""
    return read_paf(spark, path).withColumnRenamed("target", "path")


def read_vcf(spark: SparkSession, path: Path, sample_names: list[str] | None = None) -> DataFrame:
    """(file, contig, pos, id, ref, alts, qual, filter, info, genotypes): pos from 0, info as a map,
    genotypes as a map from sample to its GT text. Samples are named by each file's own header, or,
    for parts without one, by `sample_names`."""
    rows = spark.read.text(path).select(F.input_file_name().alias("file"), "value")
    samples = rows.filter(F.col("value").startswith("#CHROM")).select(F.col("file").alias("f"), F.slice(F.split("value", "\t"), 10, 1_000_000).alias("samples"))
    parts = F.split("value", "\t")
    at = lambda i: F.nullif(F.get(parts, F.lit(i)), F.lit("."))
    body = rows.filter(~F.col("value").startswith("#") & (F.size(parts) >= 8))
    if sample_names is None:
        body = body.join(samples, F.col("file") == F.col("f"), "left")
    else:
        body = body.withColumn("samples", F.array(*(F.lit(n) for n in sample_names)))
    gt = F.array_position(F.split(F.coalesce(at(8), F.lit("")), ":"), "GT")
    calls = F.transform(F.slice(parts, 10, 1_000_000), lambda c: F.get(F.split(c, ":"), (gt - 1).cast("int")))
    return body.select(
        "file",
        at(0).alias("contig"),
        (at(1).cast("long") - 1).alias("pos"),
        at(2).alias("id"),
        at(3).alias("ref"),
        F.split(at(4), ",").alias("alts"),
        at(5).cast("double").alias("qual"),
        at(6).alias("filter"),
        F.str_to_map(F.coalesce(at(7), F.lit("")), F.lit(";"), F.lit("=")).alias("info"),
        F.map_from_arrays("samples", calls).alias("genotypes"),
    )


def read_gfa(spark: SparkSession, path: Path) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, walks) of a graph file."""
    parts = F.split("value", "\t")
    at = lambda i: F.get(parts, F.lit(i))
    rows = lines(spark, path)
    nodes = rows.filter(at(0) == "S").select(at(1).alias("id"), at(2).alias("seq"), F.length(at(2)).cast("long").alias("length"))
    edges = rows.filter(at(0) == "L").select(at(1).alias("a"), at(2).alias("a_strand"), at(3).alias("b"), at(4).alias("b_strand"))
    walks = rows.filter(at(0) == "W").select(at(1).alias("sample"), at(2).cast("int").alias("hap"), at(3).alias("contig"), at(4).try_cast("long").alias("start"), at(5).try_cast("long").alias("end"), F.regexp_extract_all(at(6), F.lit("([<>][^<>]+)"), 1).alias("steps"))
    return nodes, edges, walks


def read_split_log(spark: SparkSession, path: Path, assigned: str, ambiguous: str) -> DataFrame:
    """(contig, assigned, ambiguous) of a log: `assigned` matches (contig, target), `ambiguous` (contig).

    A contig without a line that matches is absent; one that is ambiguous anywhere is ambiguous.
    """
    v = F.col("value")
    hit, vague = v.rlike(assigned), v.rlike(ambiguous)
    contig = F.when(hit, F.regexp_extract(v, assigned, 1)).when(vague, F.regexp_extract(v, ambiguous, 1))
    found = lines(spark, path).filter(hit | vague).select(contig.alias("contig"), F.when(hit, F.regexp_extract(v, assigned, 2)).alias("to"), (vague & ~hit).alias("vague"))
    return found.groupBy("contig").agg(F.min("to").alias("assigned"), F.max("vague").alias("ambiguous"))


def read_seqfile(spark: SparkSession, path: str) -> tuple[str | None, DataFrame]:
    """(Newick text or None, (name, path, outgroup)) of a sample manifest; a name twice is an error."""
    newick, rows = None, []
    for r in lines(spark, path).toLocalIterator():
        text = r["value"].strip()
        if not text or text.startswith("#"):
            continue
        if newick is None and not rows and re.match(r"^\(.*;$", text):
            newick = text
            continue
        name, _, where = text.partition(" ") if " " in text else text.partition("\t")
        rows.append((name.lstrip("*"), where.strip(), name.startswith("*")))
    if len({r[0] for r in rows}) < len(rows):
        raise ValueError(f"{path} has a name twice")
    return newick, spark.createDataFrame(rows, "name string, path string, outgroup boolean")


def read_score_matrix(spark: SparkSession, path: str) -> dict[tuple[str, str], float]:
    """A square matrix of substitution scores; it must be symmetric, also for complements."""
    rows = [r["value"].split() for r in lines(spark, path).collect() if r["value"].strip() and not r["value"].startswith("#")]
    heads, scores = rows[0], {}
    for row in rows[1:]:
        for h, v in zip(heads, row[1:], strict=True):
            scores[row[0], h] = float(v)
    pair = str.maketrans("ACGT", "TGCA")
    for (a, b), v in scores.items():
        if scores[b, a] != v or scores[a.translate(pair), b.translate(pair)] != v:
            raise ValueError(f"scores of {a} and {b} are not symmetric")
    return scores
