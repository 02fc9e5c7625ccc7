"""Writers of line-based formats. Each writes a folder of part files, in order where it matters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _write(df: DataFrame, text: Column, path: str) -> None:
    df.select(text.alias("value")).write.mode("overwrite").text(path)


def write_fasta(df: DataFrame, path: str, width: int = 80, order: Sequence[Column] = ()) -> None:
    """(header, seq) records with wrapped lines; sorted if an order is given."""
    wrapped = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    out = df.orderBy(*order) if order else df
    _write(out, F.concat(F.lit(">"), "header", F.lit("\n"), wrapped), path)


def write_bed(df: DataFrame, path: str, columns: Sequence[str] = ("contig", "start", "end"), by: Sequence[str] = ()) -> None:
    """Tab-separated rows, sorted by contig and start; one folder for each value of `by`,
    whose files follow each other in that order, so that a folder of very many rows spreads."""
    row = F.concat_ws("\t", *(F.col(c).cast("string") for c in columns))
    if by:
        sorted_rows = df.repartitionByRange(*by, "contig", "start", "end").sortWithinPartitions(*by, "contig", "start", "end")
        sorted_rows.select(*by, row.alias("value")).write.mode("overwrite").partitionBy(*by).text(path)
    else:
        _write(df.orderBy("contig", "start", "end"), row, path)


def write_paf(df: DataFrame, path: str) -> None:
    """The 12 columns, and `tags` (map from name to text) as string tags if there."""
    from loomspan.sources.formats import PAF_COLUMNS

    cols = [F.coalesce(F.col(c).cast("string"), F.lit("*")) for c in PAF_COLUMNS]
    if "tags" in df.columns:
        tags = F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.concat(e["key"], F.lit(":Z:"), e["value"]))
        cols.append(F.nullif(F.array_join(tags, "\t"), F.lit("")))
    _write(df, F.concat_ws("\t", *cols), path)


def write_wig(df: DataFrame, path: str, tile: int = 1 << 16) -> None:
    """(contig, pos, score) as fixedStep blocks, a new one wherever positions are not consecutive
    and at each tile's begin. A tile is never parted, so each file's first line is a header."""
    from pyspark.sql import Window

    tiled = df.withColumn("_tile", F.floor(F.col("pos") / tile))
    w = Window.partitionBy("contig", "_tile").orderBy("pos")
    fresh = F.coalesce(F.lag("pos").over(w) != F.col("pos") - 1, F.lit(True))
    head = F.concat(F.lit("fixedStep chrom="), "contig", F.lit(" start="), (F.col("pos") + 1).cast("string"), F.lit(" step=1\n"))
    ordered = tiled.withColumn("_fresh", fresh).repartitionByRange("contig", "_tile").sortWithinPartitions("contig", "pos")
    _write(ordered, F.concat(F.when(F.col("_fresh"), head).otherwise(""), F.col("score").cast("string")), path)


def write_vcf(df: DataFrame, path: str, samples: Sequence[str]) -> None:
    """Rows of read_vcf's columns, sorted, after one header file `_header` beside the parts."""
    calls = [F.coalesce(F.try_element_at("genotypes", F.lit(s)), F.lit(".")) for s in samples]
    info = F.coalesce(F.nullif(F.array_join(F.transform(F.array_sort(F.map_entries("info")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";"), F.lit("")), F.lit("."))
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    row = F.concat_ws("\t", "contig", (F.col("pos") + 1).cast("string"), dot("id"), "ref", F.array_join("alts", ","), dot("qual"), dot("filter"), info, F.lit("GT"), *calls)
    _write(df.orderBy("contig", "pos", "ref"), row, path)
    head = ["##fileformat=VCFv4.2", "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples])]
    df.sparkSession.createDataFrame([("\n".join(head),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}_header")


def write_gfa(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Segments, then links."""
    s = nodes.select(F.lit(0).alias("k"), F.col("id").cast("string").alias("o"), F.concat_ws("\t", F.lit("S"), F.col("id").cast("string"), "seq").alias("value"))
    e = edges.select(F.lit(1).alias("k"), F.col("a").cast("string").alias("o"), F.concat_ws("\t", F.lit("L"), F.col("a").cast("string"), "a_strand", F.col("b").cast("string"), "b_strand", F.lit("0M")).alias("value"))
    _write(s.unionByName(e).orderBy("k", "o", "value"), F.col("value"), path)


def segment_lines(blocks: DataFrame, sequences: DataFrame, reference: str) -> DataFrame:
    """Lines of aligned genomes, one above the others: (above, event, seq, start, text), to be written in this order.

    blocks is (block, seq, start, end, strand), sequences (seq, event, length). A header of each sequence stands at start -1:
    its event, its name, and 1 for the reference's. Bottom segments, the reference's and what lies between
    them, have a number, counted in the order of the lines, start and length. Top segments have start, length,
    and, if the reference is in their block, the number of its first segment there and 1 if both have one strand.
    """
    from loomspan.operators import intervals as iv
    from loomspan.operators.relational import numbered
    from loomspan.session import materialize

    known = sequences.filter("length > 0").select(F.col("seq").alias("_s"), "event", "length")
    own = blocks.join(known.select("_s"), F.col("seq") == F.col("_s"), "left_semi").select("block", "seq", "start", "end", "strand")
    gaps = iv.complement(own, known.select(F.col("_s").alias("seq"), "length"), ["seq"]).select(F.lit(None).cast("string").alias("block"), "seq", "start", "end", F.lit("+").alias("strand"))
    # Stored, as bottom and top are made of it, and the numbers look at it twice.
    every = own.unionByName(gaps).join(known.select("_s", "event"), F.col("seq") == F.col("_s")).drop("_s").withColumn("above", (F.col("event") != reference).cast("int"))
    every = materialize(every, "segment-rows")
    bottom = numbered(every.filter("above = 0"), [F.col("seq"), F.col("start")], "number")
    first = bottom.filter("block IS NOT NULL").groupBy(F.col("block").alias("_b")).agg(F.min_by(F.struct("number", F.col("strand").alias("way")), F.struct("seq", "start")).alias("under"))
    top = every.filter("above = 1").join(first, F.col("block") == F.col("_b"), "left")
    order = ["above", "event", "seq", "start"]
    line = lambda *parts: F.concat_ws("\t", *(p.cast("string") for p in parts)).alias("text")
    size = F.col("end") - F.col("start")
    same = F.when(F.col("under").isNotNull(), (F.col("strand") == F.col("under.way")).cast("int"))
    quoted = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    above = (F.col("event") != reference).cast("int")
    heads = sequences.filter("length > 0").select(above.alias("above"), "event", "seq", F.lit(-1).cast("long").alias("start"), line(F.lit("s"), quoted("event"), quoted("seq"), 1 - above))
    return heads.union(bottom.select(*order, line(F.lit("a"), F.col("number"), F.col("start"), size))).union(top.select(*order, line(F.lit("a"), F.col("start"), size, F.col("under.number"), same)))


def write_segments(blocks: DataFrame, sequences: DataFrame, reference: str, path: str) -> None:
    """segment_lines() as text, the reference's first."""
    _write(segment_lines(blocks, sequences, reference).orderBy("above", "event", "seq", "start"), F.col("text"), path)


def write_summary(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """A small report as one tab-separated file with a header."""
    df.select(*columns).coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True)
