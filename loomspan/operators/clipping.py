"""Alignments cut to regions of their targets, operation by operation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions.bases import cigar
from loomspan.operators import intervals as iv


def clip(df: DataFrame, ids: Sequence[str], lo: str, hi: str) -> DataFrame:
    """Alignments cut to [lo, hi) of the target: (ids, qstart, qend, tstart, tend, matches, block, cigar).

    df has ids, strand, qstart, qend, tstart, cigar, lo and hi. The rest begins and ends with aligned
    bases: insertions and deletions at the edges go, and so does a row without aligned bases in the
    region. Matches are the bases of M and =, the block is the sum of all operations.
    """
    c = F.col
    each = df.select(*ids, "strand", "qstart", "qend", "tstart", c(lo).alias("_lo"), c(hi).alias("_hi"), F.posexplode(cigar(c("cigar"))).alias("i", "x")).select("*", c("x.op").alias("op"), c("x.len").alias("n"))
    whole = Window.partitionBy(*ids)
    before = whole.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    pair, zero = c("op").isin("M", "=", "X"), F.lit(0).cast("long")
    on_t, on_q = pair | c("op").isin("D", "N"), pair | c("op").isin("I", "S")
    length = lambda on: F.when(on, c("n")).otherwise(zero)
    at = each.withColumns({"t": c("tstart") + F.coalesce(F.sum(length(on_t)).over(before), zero), "q": F.coalesce(F.sum(length(on_q)).over(before), zero)})
    skipped = F.greatest(c("_lo") - c("t"), zero)
    spanned = F.greatest(F.least(c("t") + c("n"), c("_hi")) - F.greatest(c("t"), c("_lo")), zero)
    cut = at.withColumns({"skip": F.when(on_t, skipped).otherwise(zero), "kept": F.when(on_t, spanned).when((c("t") > c("_lo")) & (c("t") < c("_hi")), c("n")).otherwise(zero)})
    aligned = F.when(pair & (c("kept") > 0), c("i"))
    inner = cut.withColumns({"_first": F.min(aligned).over(whole), "_last": F.max(aligned).over(whole)}).filter("i BETWEEN _first AND _last AND kept > 0")
    t0, q0 = c("t") + c("skip"), c("q") + F.when(pair, c("skip")).otherwise(zero)
    merged = inner.groupBy(*ids).agg(
        F.first("strand").alias("strand"),
        F.first("qstart").alias("_qs"),
        F.first("qend").alias("_qe"),
        F.min(t0).alias("tstart"),
        F.max(F.when(on_t, t0 + c("kept"))).alias("tend"),
        F.min(q0).alias("_q0"),
        F.max(q0 + F.when(on_q, c("kept")).otherwise(zero)).alias("_q1"),
        F.sum(F.when(c("op").isin("M", "="), c("kept")).otherwise(zero)).alias("matches"),
        F.sum("kept").alias("block"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "kept", "op"))), lambda x: F.concat(x["kept"].cast("string"), x["op"])), "").alias("cigar"),
    )
    forward = c("strand") == "+"
    qstart = F.when(forward, c("_qs") + c("_q0")).otherwise(c("_qe") - c("_q1"))
    qend = F.when(forward, c("_qs") + c("_q1")).otherwise(c("_qe") - c("_q0"))
    return merged.select(*ids, qstart.alias("qstart"), qend.alias("qend"), "tstart", "tend", "matches", "block", "cigar")


def clip_to_regions(df: DataFrame, regions: DataFrame, bin_width: int = 1 << 16) -> DataFrame:
    """(id, region_start, region_end, ...) of clip() for each alignment and each region (target, start, end)
    of its target that it meets."""
    spans = df.select("id", "target", "strand", "qstart", "qend", "tstart", "cigar", F.col("tstart").alias("start"), F.col("tend").alias("end"))
    met = iv.overlap_join(spans, regions.select("target", "start", "end"), ["target"], bin_width)
    return clip(met.withColumnsRenamed({"b_start": "region_start", "b_end": "region_end"}), ["id", "region_start", "region_end"], "region_start", "region_end")


def trim_ends(df: DataFrame, share: float) -> DataFrame:
    """(id, ...) of clip(): each alignment without this share of its target span at both ends."""
    by = F.floor((F.col("tend") - F.col("tstart")) * share)
    return clip(df.withColumns({"_from": F.col("tstart") + by, "_to": F.col("tend") - by}), ["id"], "_from", "_to")
