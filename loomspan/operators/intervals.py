"""Interval algebra on half-open coordinate ranges, one key at a time.

Every operator takes frames with a list of key columns and integer `start` and
`end` columns. Empty and reversed ranges (end <= start) and rows with a null
bound are dropped first; a null key is a key of its own. All work is aggregates, windows
and joins by key, so it stays inside code generation.

Running values go along a key's axis in tiles: each tile is summed up, the tiles' sums are
carried forward over the key, and a window within the tile does the rest. So a key that
holds all rows, such as one long contig, spreads over its tiles; one row for each tile goes
through a window of its key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid(df: DataFrame) -> DataFrame:
    """Rows whose range holds at least one position."""
    return df.filter(F.col("end") > F.col("start"))


#: Positions of a tile.
TILE = 1 << 16


def _tiled(df: DataFrame, pos: str) -> DataFrame:
    # The filter stands before the input is used twice, so that both uses have one exchange.
    tiled = df.withColumn("_tile", F.floor(F.col(pos) / TILE))
    return tiled.filter(F.col("_tile").isNotNull())


def _carried(df: DataFrame, keys: Sequence[str], sums: dict[str, tuple[Column, Callable[[Column], Column]]], ahead: dict[str, Column] | None = None, whole: dict[str, Column] | None = None) -> DataFrame:
    """Rows of df (`_carry` false) and one more for each tile (`_carry` true), dealt by keys and tile.

    The tile's row has the columns of `sums`, name to (aggregate of a tile, how to combine tiles), over
    the tiles before it; those of `ahead`, aggregates of the next tile; and those of `whole`,
    maxima over all tiles of an aggregate. It is the first in _in_tile().
    """
    order = Window.partitionBy(*keys).orderBy("_tile")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ahead, whole = ahead or {}, whole or {}
    per = df.groupBy(*keys, "_tile").agg(*(a.alias(n) for n, (a, _) in sums.items()), *(a.alias(n) for n, a in (ahead | whole).items()))
    known = per.select(
        *keys, "_tile", *(f(F.col(n)).over(before).alias(n) for n, (_, f) in sums.items()), *(F.lead(n).over(order).alias(n) for n in ahead), *(F.max(n).over(every).alias(n) for n in whole), F.lit(True).alias("_carry")
    )
    return df.withColumn("_carry", F.lit(False)).unionByName(known, allowMissingColumns=True).repartition(*keys, "_tile")


def _in_tile(keys: Sequence[str], *order: str):
    return Window.partitionBy(*keys, "_tile").orderBy(F.col("_carry").desc(), *order)


def pieces(edges: DataFrame, keys: Sequence[str], deltas: Sequence[str]) -> DataFrame:
    """(keys, start, end, running sums): pieces between consecutive positions of (keys, pos, deltas)
    with one row for each position; the open one after a key's last position is left out."""
    carried = _carried(_tiled(edges, "pos"), keys, {f"_b_{d}": (F.sum(d), F.sum) for d in deltas}, {"_next": F.min("pos")})
    w = _in_tile(keys, "pos")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    end = F.coalesce(F.lead("pos").over(w), F.max("_next").over(run))
    cut = carried.select("_carry", *keys, F.col("pos").alias("start"), end.alias("end"), *(F.sum(F.coalesce(d, f"_b_{d}", F.lit(0))).over(run).alias(d) for d in deltas))
    return cut.filter(~F.col("_carry") & F.col("end").isNotNull()).drop("_carry")


def running(df: DataFrame, keys: Sequence[str], pos: str, values: dict[str, Callable[[Column], Column]], order: Sequence[str] = ()) -> DataFrame:
    """df with `_before_` and the name of each of `values`, column to associative aggregate: that aggregate over the
    rows before each along the key, or null. Positions, or those with the columns of `order`, are unique in a key."""
    carried = _carried(_tiled(df, pos), keys, {f"_upto_{c}": (f(F.col(c)), f) for c, f in values.items()})
    upto = _in_tile(keys, pos, *order).rowsBetween(Window.unboundedPreceding, -1)
    before = {f"_before_{c}": f(F.coalesce(c, f"_upto_{c}")).over(upto) for c, f in values.items()}
    return carried.withColumns(before).filter(~F.col("_carry")).drop("_carry", "_tile", *(f"_upto_{c}" for c in values))


def running_sum(df: DataFrame, keys: Sequence[str], pos: str, value: str, name: str) -> DataFrame:
    """df with the sum of `value` over the rows before each along the key, as `name`; positions are unique in a key."""
    return running(df, keys, pos, {value: F.sum}).withColumn(name, F.coalesce(f"_before_{value}", F.lit(0))).drop(f"_before_{value}")


def with_next(df: DataFrame, keys: Sequence[str], pos: str, columns: Sequence[str]) -> DataFrame:
    """df with `next`, a struct of pos and the columns of the row that follows along the key, or null.
    Rows of one position stand in the order of the columns."""
    held = F.struct(pos, *columns)
    carried = _carried(_tiled(df, pos), keys, {}, {"_ahead": F.min(held)})
    w = _in_tile(keys, pos, *columns)
    ahead = F.first("_ahead").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return carried.withColumn("next", F.coalesce(F.lead(held).over(w), ahead)).filter(~F.col("_carry")).drop("_carry", "_ahead", "_tile")


def _opened(df: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """df with the largest end before each row along its key (`_before`), that of the whole key (`_last`), and
    whether the row opens a run (`_fresh`, 1 or 0); tiles stay."""
    carried = _carried(_tiled(valid(df), "start"), keys, {"_held": (F.max("end"), F.max)}, whole={"_most": F.max("end")})
    w = _in_tile(keys, "start", "end")
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    before = F.max(F.coalesce("end", "_held")).over(upto)
    found = carried.withColumn("_before", before).withColumn("_last", F.max("_most").over(upto)).filter(~F.col("_carry")).drop("_carry", "_held", "_most")
    return found.withColumn("_fresh", F.when(F.col("_before").isNull() | (F.col("start") > F.col("_before") + F.lit(gap)), 1).otherwise(0))


def islands(df: DataFrame, keys: Sequence[str], gap: int = 0) -> DataFrame:
    """Tag each range with the number of the merged run it falls in (`island`, from 1)."""
    opened = _opened(df, keys, gap).drop("_before", "_last")
    carried = _carried(opened, keys, {"_runs": (F.sum("_fresh"), F.sum)})
    run = _in_tile(keys, "start", "end").rowsBetween(Window.unboundedPreceding, 0)
    return carried.withColumn("island", F.sum(F.coalesce("_fresh", "_runs", F.lit(0))).over(run)).filter(~F.col("_carry")).drop("_carry", "_fresh", "_runs", "_tile")


def merge(df: DataFrame, keys: Sequence[str], gap: int = 0) -> DataFrame:
    """Union of the ranges of a key; touching ranges join, as do those at most `gap` apart.

    Only ranges that open a run are left after a running maximum of ends; a run ends at that maximum
    before the next one opens. Both go in tiles, so disjoint ranges of one key spread, too.
    """
    opened = _opened(df.select(*keys, "start", "end"), keys, gap).filter("_fresh = 1").select(*keys, "start", "_before", "_last", "_tile")
    carried = _carried(opened, keys, {}, {"_ahead": F.min("_before")}, {"_whole": F.max("_last")})
    w = _in_tile(keys, "start")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    end = F.coalesce(F.lead("_before").over(w), F.max("_ahead").over(upto), F.greatest("_last", F.max("_whole").over(upto)))
    return carried.select("_carry", *keys, "start", end.alias("end")).filter(~F.col("_carry")).drop("_carry")


def _sweep(df: DataFrame, keys: Sequence[str], weight: Column | None = None) -> DataFrame:
    """(keys, pos, delta): +weight at each start and -weight at each end, summed by position."""
    w = F.lit(1) if weight is None else weight
    edge = F.explode(F.array(F.struct(F.col("start").alias("pos"), w.alias("delta")), F.struct(F.col("end").alias("pos"), (-w).alias("delta"))))
    return valid(df).select(*keys, edge.alias("e")).groupBy(*keys, F.col("e.pos").alias("pos")).agg(F.sum("e.delta").alias("delta"))


def depth(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, start, end, depth): pieces between consecutive endpoints with the ranges over them; depth 0 left out."""
    return pieces(_sweep(df, keys), keys, ["delta"]).withColumnRenamed("delta", "depth").filter(F.col("depth") > 0)


def single_cover(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pieces that exactly one range covers; a new piece begins at every endpoint."""
    return depth(df, keys).filter(F.col("depth") == 1).drop("depth")


def covered_at_least(df: DataFrame, keys: Sequence[str], least: int, min_length: int = 0) -> DataFrame:
    """Merged runs that at least `least` ranges cover, longer than min_length."""
    return merge(depth(df, keys).filter(F.col("depth") >= least), keys).filter(F.col("end") - F.col("start") > min_length)


def _two_sided(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pieces with the depth of a and of b: one sweep over both, no join."""
    both = a.select(*keys, "start", "end", F.lit(1).alias("wa"), F.lit(0).alias("wb")).unionByName(b.select(*keys, "start", "end", F.lit(0).alias("wa"), F.lit(1).alias("wb")))
    edge = F.explode(
        F.array(
            F.struct(F.col("start").alias("pos"), F.col("wa").alias("da"), F.col("wb").alias("db")), F.struct(F.col("end").alias("pos"), (-F.col("wa")).alias("da"), (-F.col("wb")).alias("db"))
        )
    )
    summed = valid(both).select(*keys, edge.alias("e")).groupBy(*keys, F.col("e.pos").alias("pos")).agg(F.sum("e.da").alias("da"), F.sum("e.db").alias("db"))
    return pieces(summed, keys, ["da", "db"]).withColumnsRenamed({"da": "in_a", "db": "in_b"})


def subtract(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts of a that no range of b covers, merged."""
    return merge(_two_sided(a, b, keys).filter((F.col("in_a") > 0) & (F.col("in_b") == 0)), keys)


def intersect(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts that both a and b cover, merged. As touching ranges join, a cut where a merged run of either
    begins or ends is always the end of a part."""
    return merge(_two_sided(a, b, keys).filter((F.col("in_a") > 0) & (F.col("in_b") > 0)), keys)


def complement(df: DataFrame, lengths: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Uncovered parts of [0, length) of each key of `lengths` (keys, length)."""
    whole = lengths.select(*keys, F.lit(0).cast("long").alias("start"), F.col("length").cast("long").alias("end"))
    return subtract(whole, df, keys)


def total_length(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, intervals, bp) of the ranges as they are."""
    return valid(df).groupBy(*keys).agg(F.count("*").alias("intervals"), F.sum(F.col("end") - F.col("start")).alias("bp"))


def clamp(df: DataFrame, lengths: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ranges cut to [0, length), with `clamped`; keys without a length and emptied ranges go."""
    known = lengths.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("length").alias("_len"))
    on = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    start, end = F.greatest("start", F.lit(0)), F.least("end", "_len")
    cut = df.join(known, on).select(*keys, start.alias("start"), end.alias("end"), ((start != F.col("start")) | (end != F.col("end"))).alias("clamped"))
    return valid(cut)


def slice_spans(df: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Each range in chunks of `size`; a tail of up to half a chunk joins the chunk before it."""
    length = F.col("end") - F.col("start")
    n = F.greatest(F.lit(1), F.floor((2 * length + size - 1) / F.lit(2 * size))).cast("int")
    each = valid(df).select(*keys, "start", "end", n.alias("n")).select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    a = F.col("start") + F.col("i") * size
    return each.select(*keys, a.alias("start"), F.when(F.col("i") == F.col("n") - 1, F.col("end")).otherwise(a + size).alias("end"))


def fragments(df: DataFrame, keys: Sequence[str], size: int, step: int) -> DataFrame:
    """Overlapping windows of `size` every `step` positions, with short ones at the tail."""
    a = F.explode(F.sequence(F.col("start"), F.col("end") - 1, F.lit(step).cast("long")))
    return valid(df).select(*keys, "end", a.alias("at")).select(*keys, F.col("at").alias("start"), F.least(F.col("at") + size, F.col("end")).alias("end"))


def widen(df: DataFrame, keys: Sequence[str], flank: int, lengths: DataFrame, min_length: int = 0) -> DataFrame:
    """Ranges longer than min_length, with a flank on both sides, cut to their key's length and merged."""
    wide = df.filter(F.col("end") - F.col("start") > min_length).withColumn("start", F.col("start") - flank).withColumn("end", F.col("end") + flank)
    return merge(clamp(wide, lengths, keys), keys)


def overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str], bin_width: int, how: str = "inner", wide_width: int | None = None) -> DataFrame:
    """Pairs of overlapping ranges: columns of a, those of b with prefix `b_`, and `overlap`.

    Both sides are dealt into bins of the axis and joined on (keys, bin), so a key with very
    many ranges spreads over its bins; a pair is kept in the first bin it shares.
    `how` is `inner`, `left`, `left_semi` or `left_anti`. Null-bounded ranges match nothing.

    Where ranges may be as long as a contig, wide_width has those longer than 16 bins dealt into bins of
    that width. There are four kinds of bins then: of narrow ranges, of wide ones, and of wide ones of
    either side with narrow ones of the other. So narrow ranges never meet in wide bins.
    """
    widths = [bin_width] if wide_width is None else [bin_width, wide_width, wide_width, wide_width]
    kinds = len(widths)

    def bins(start: str, end: str, as_narrow: int, as_wide: int) -> Column:
        def of(kind: int) -> Column:
            first, last = F.floor(F.col(start) / widths[kind]), F.floor((F.col(end) - 1) / widths[kind])
            return F.sequence(first * kinds + kind, last * kinds + kind, F.lit(kinds).cast("long"))

        if kinds == 1:
            return F.explode(of(0))
        wide = F.col(end) - F.col(start) > bin_width * 16
        return F.explode(F.when(wide, F.concat(of(as_wide), of(3))).otherwise(F.concat(of(0), of(as_narrow))))

    right = valid(b).select(*(F.col(c).alias(f"b_{c}") for c in b.columns))
    left = valid(a).withColumn("_bin", bins("start", "end", 1, 2))
    other = right.withColumn("_b_bin", bins("b_start", "b_end", 2, 1))
    on = [F.col(k).eqNullSafe(F.col(f"b_{k}")) for k in keys] + [F.col("_bin") == F.col("_b_bin")]
    hit = left.join(other, on).filter((F.col("start") < F.col("b_end")) & (F.col("b_start") < F.col("end")))
    first = F.floor(F.greatest("start", "b_start") / bin_width)
    if kinds > 1:
        kind = F.pmod("_bin", F.lit(kinds))
        first = F.when(kind == 0, first * kinds).otherwise(F.floor(F.greatest("start", "b_start") / wide_width) * kinds + kind)
    hit = hit.filter(F.col("_bin") == first)
    overlap = F.least("end", "b_end") - F.greatest("start", "b_start")
    if how == "inner":
        return hit.select(*a.columns, *right.columns, overlap.alias("overlap"))
    # Whether a range is touched depends on its key and bounds alone.
    own = [*keys, "start", "end"]
    touched = hit.select(*(F.col(c).alias(f"_t{i}") for i, c in enumerate(own))).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_t{i}")) for i, c in enumerate(own)]
    if how in ("left_semi", "left_anti"):
        return a.join(touched, same, how)
    if how == "left":
        pairs = hit.select(*a.columns, *right.columns, overlap.alias("overlap"))
        return pairs.unionByName(a.join(touched, same, "left_anti"), allowMissingColumns=True)
    raise ValueError(f"unknown join kind {how!r}")


def as_of(points: DataFrame, ranges: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """points (keys, pos, ...) with the `value` of the last range that starts at or before pos, and
    null where that range has ended: one union and one window, no range join."""
    p = points.withColumn("_kind", F.lit(1)).withColumn("_end", F.lit(None).cast("long")).withColumn("_value", F.lit(None).cast(ranges.schema[value].dataType))
    r = ranges.select(*keys, F.col("start").alias("pos"), F.lit(0).alias("_kind"), F.col("end").cast("long").alias("_end"), F.col(value).alias("_value"))
    both = _tiled(p.unionByName(r, allowMissingColumns=True), "pos")
    held = F.struct("_end", "_value")
    newest = F.max_by(F.when(F.col("_kind") == 0, held), F.when(F.col("_kind") == 0, F.struct("pos", F.coalesce("_end", F.lit(0)))))
    carried = _carried(both, keys, {"_held": (newest, lambda c: F.last(c, ignorenulls=True))})
    w = _in_tile(keys, "pos", "_kind", "_end").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("_carry"), F.col("_held")).when(F.col("_kind") == 0, held), ignorenulls=True).over(w)
    found = carried.withColumn("_last", last).filter(F.col("_kind") == 1)
    return found.withColumn(value, F.when(F.col("pos") < F.col("_last._end"), F.col("_last._value"))).drop("_carry", "_kind", "_end", "_value", "_last", "_held", "_tile")


def reciprocal_pairs(a: DataFrame, keys: Sequence[str], least: float, bin_width: int, id_col: str = "id") -> DataFrame:
    """(left_id, right_id, overlap) of ranges of one frame that cover each other by at least the share."""
    hit = overlap_join(a.select(id_col, *keys, "start", "end"), a.select(id_col, *keys, "start", "end"), keys, bin_width)
    longer = F.greatest(F.col("end") - F.col("start"), F.col("b_end") - F.col("b_start"))
    return hit.filter((F.col(id_col) < F.col(f"b_{id_col}")) & (F.col("overlap") >= F.lit(least) * longer)).select(
        F.col(id_col).alias("left_id"), F.col(f"b_{id_col}").alias("right_id"), "overlap"
    )


def insertion_pairs(a: DataFrame, keys: Sequence[str], distance: int, least: float, bin_width: int, id_col: str = "id") -> DataFrame:
    """(left_id, right_id) of insertions (id, keys, start, size) at most `distance` apart, of which the
    smaller has at least this share of the larger one's size."""
    near = a.select(id_col, *keys, "size", "start", (F.col("start") + distance + 1).alias("end"))
    hit = overlap_join(near, near, keys, bin_width)
    alike = F.least("size", "b_size") >= F.lit(least) * F.greatest("size", "b_size")
    return hit.filter((F.col(id_col) < F.col(f"b_{id_col}")) & alike).select(F.col(id_col).alias("left_id"), F.col(f"b_{id_col}").alias("right_id"))


def variant_sites(variants: DataFrame, keys: Sequence[str], least: float, distance: int, bin_width: int) -> DataFrame:
    """variants (id, keys, kind, start, end, size) with `site`, the least id of those they are the same as, directly
    or by way of others: insertions (`INS`) by distance and size, other kinds by mutual cover among themselves."""
    from loomspan.operators.graph import connected_components

    inserted = F.coalesce(F.col("kind") == "INS", F.lit(False))
    pairs = insertion_pairs(variants.filter(inserted), keys, distance, least, bin_width)
    pairs = pairs.unionByName(reciprocal_pairs(variants.filter(~inserted), [*keys, "kind"], least, bin_width).drop("overlap"))
    sites = connected_components(pairs.select(F.col("left_id").alias("a"), F.col("right_id").alias("b"))).select(F.col("id").alias("_id"), F.col("component").alias("_site"))
    return variants.join(sites, F.col("id") == F.col("_id"), "left").withColumn("site", F.coalesce("_site", "id")).drop("_id", "_site")


def cluster(a: DataFrame, keys: Sequence[str], least: float, bin_width: int, id_col: str = "id") -> DataFrame:
    """a with `site`, the least id of the ranges that it covers reciprocally, directly or by way of others."""
    from loomspan.operators.graph import connected_components

    pairs = reciprocal_pairs(a, keys, least, bin_width, id_col).select(F.col("left_id").alias("a"), F.col("right_id").alias("b"))
    sites = connected_components(pairs).select(F.col("id").alias("_id"), F.col("component").alias("_site"))
    return a.join(sites, F.col(id_col) == F.col("_id"), "left").withColumn("site", F.coalesce("_site", id_col)).drop("_id", "_site")


def charged(baseline: DataFrame, phases: Sequence[tuple[str, DataFrame]], keys: Sequence[str]) -> DataFrame:
    """(keys, start, end, phase): pieces of what went in, `baseline`, each with the first of the `phases` (name, covered
    ranges) that lacks it, or null. Pieces of a key are disjoint, and one ends wherever any range does."""
    layers = [("", baseline), *phases]
    sides = [
        valid(df).select(*keys, F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(1).alias("w")), F.struct(F.col("end").alias("pos"), F.lit(-1).alias("w")))).alias("e"), F.lit(i).alias("layer"))
        for i, (_, df) in enumerate(layers)
    ]
    edges = sides[0]
    for side in sides[1:]:
        edges = edges.unionByName(side)
    names = [f"d{i}" for i in range(len(layers))]
    summed = edges.groupBy(*keys, F.col("e.pos").alias("pos")).agg(*(F.sum(F.when(F.col("layer") == i, F.col("e.w")).otherwise(0)).alias(n) for i, n in enumerate(names)))
    parts = pieces(summed, keys, names)
    phase = F.lit(None).cast("string")
    for (name, _), n in reversed(list(zip(phases, names[1:], strict=True))):
        phase = F.when(F.col(n) == 0, F.lit(name)).otherwise(phase)
    return parts.filter(F.col("d0") > 0).select(*keys, "start", "end", phase.alias("phase"))


def exclusions(baseline: DataFrame, phases: Sequence[tuple[str, DataFrame]], keys: Sequence[str]) -> DataFrame:
    """(keys, phase, start, end): what each phase lost of what the phase before it still had.

    `baseline` is what went in; `phases` are (name, covered ranges) in order. Every lost base
    is charged to the first phase that lacks it, so losses and what the last phase kept
    add up to the input. A phase's ranges outside those of the phase before count for nothing.
    """
    return merge(charged(baseline, phases, keys).filter(F.col("phase").isNotNull()), [*keys, "phase"])


def survival(inputs: DataFrame, phases: Sequence[tuple[str, DataFrame]], keys: Sequence[str]) -> DataFrame:
    """inputs (keys, length, ...) with `<phase>_bp` and `<phase>_frags` of each phase (name, ranges): what of each
    input is left, and in how many pieces. One sweep merges the ranges of all phases; ranges
    are cut to their input, and those of unknown inputs do not count."""
    tagged = [df.select(*keys, "start", "end", F.lit(name).alias("_phase")) for name, df in phases]
    every = tagged[0]
    for df in tagged[1:]:
        every = every.union(df)
    sizes = inputs.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("length").alias("_len"))
    within = every.join(sizes, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    cut = within.select(*keys, "_phase", F.greatest("start", F.lit(0)).alias("start"), F.least("end", "_len").alias("end"))
    merged = merge(cut, [*keys, "_phase"])
    of = lambda name, value: F.when(F.col("_phase") == name, value)
    sums = [c for name, _ in phases for c in (F.sum(of(name, F.col("end") - F.col("start"))).alias(f"{name}_bp"), F.count(of(name, F.lit(1))).alias(f"{name}_frags"))]
    found = merged.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(*sums)
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    names = [f"{name}_{what}" for name, _ in phases for what in ("bp", "frags")]
    return inputs.join(found, same, "left").select(*inputs.columns, *(F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in names))


def survival_by(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups, contigs, input_bp, ...): the rows of survival() summed up by groups."""
    names = [c for c in rows.columns if c.endswith(("_bp", "_frags")) and c not in groups]
    return rows.groupBy(*groups).agg(F.count("*").alias("contigs"), F.sum("length").alias("input_bp"), *(F.sum(n).alias(n) for n in names))


def signal_blocks(signal: DataFrame, lo: int, hi: int) -> DataFrame:
    """(contig, start, values): the scores of signal (contig, pos, score) from lo up to before hi, as runs of consecutive
    positions; a run that the bounds cut starts at its first position within them.

    Runs end at the tiles of the axis, too, so that no run is longer than one.
    """
    kept = signal.filter((F.col("pos") >= lo) & (F.col("pos") < hi)).select("contig", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), "score")
    runs = islands(kept, ["contig"]).groupBy("contig", "island", F.floor(F.col("start") / TILE)).agg(F.min("start").alias("start"), F.array_sort(F.collect_list(F.struct("start", "score"))).alias("_s"))
    return runs.select("contig", "start", F.col("_s.score").alias("values"))
