"""Coordinates of alignments to a variation graph: node by node, or on the sequences that the nodes are cut from.

A node is a piece (node, name, start, length) of a named sequence. An alignment's path is an array of steps, `>` or
`<` and what follows: a node (unstable) or `name:start-end` (stable). Its path_start and path_end count
along the steps taken together. A stable path may be a bare name too; then they are positions on that
sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.operators import intervals as iv
from loomspan.operators.relational import numbered
from loomspan.session import discard, materialize

#: Positions of a bin in joins of ranges.
BIN = 1 << 16


def path_index(steps: DataFrame, nodes: DataFrame) -> DataFrame:
    """steps (path, place, step) with each step's node, `start` and `end` along its path, and length.

    Lengths are summed in tiles of places, so that a path of very many steps spreads.
    """
    known = nodes.select(F.col("node").alias("_n"), F.col("length").alias("_length"))
    sized = steps.withColumn("node", F.substring("step", 2, 1 << 30)).join(known, F.col("node") == F.col("_n"))
    placed = iv.running_sum(sized.drop("_n"), ["path"], "place", "_length", "start")
    return placed.select("path", "place", "step", "node", "start", (F.col("start") + F.col("_length")).alias("end"), F.col("_length").alias("length"))


def _spelled(name: Column, start: Column, end: Column) -> Column:
    return F.concat(name, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))


def _in_order(step: Column, *order: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, step.alias("_s")))), lambda x: x["_s"])


def to_stable(alignments: DataFrame, nodes: DataFrame) -> DataFrame:
    """alignments (id, path, path_start, path_end, ...) with node steps as stable intervals.

    Steps that follow each other on one sequence in one direction become one interval. path_start and
    path_end stay, as the steps cover the same bases. An alignment with an unknown node is left out.
    """
    known = nodes.select(F.col("node").alias("_n"), "name", "start", "length")
    steps = alignments.select(F.col("id").alias("_i"), F.posexplode("path").alias("place", "step"))
    at = steps.join(known, F.substring("step", 2, 1 << 30) == F.col("_n"), "left").withColumn("way", F.left("step", F.lit(1)))
    at = at.withColumn("end", F.col("start") + F.col("length"))
    w = Window.partitionBy("_i").orderBy("place")
    follows = (F.lag("name").over(w) == F.col("name")) & (F.lag("way").over(w) == F.col("way")) & F.when(F.col("way") == ">", F.lag("end").over(w) == F.col("start")).otherwise(F.lag("start").over(w) == F.col("end"))
    runs = at.withColumn("fresh", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1)).withColumn("run", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("_i", "run", "way").agg(F.min("name").alias("name"), F.min("start").alias("start"), F.max("end").alias("end"), F.count_if(F.col("name").isNull()).alias("unknown"))
    text = F.concat("way", _spelled(F.col("name"), F.col("start"), F.col("end")))
    whole = merged.groupBy("_i").agg(_in_order(text, "run").alias("_path"), F.sum("unknown").alias("_unknown")).filter("_unknown = 0")
    return alignments.join(whole, F.col("id") == F.col("_i")).select(*(F.col("_path").alias(c) if c == "path" else F.col(c) for c in alignments.columns))


def to_unstable(alignments: DataFrame, nodes: DataFrame) -> DataFrame:
    """alignments (id, path, path_start, path_end, ...) with stable intervals, or a bare name, as node steps.

    Each interval is met with the pieces of its sequence by an overlap join. Where it begins within a node,
    path_start and path_end move by the part of that node before it. An alignment with an interval
    that no node touches is left out.
    """
    steps = alignments.select(F.col("id").alias("_i"), "path_start", "path_end", F.size("path").alias("n"), F.posexplode("path").alias("place", "step"))
    bare = ~F.left("step", F.lit(1)).isin(">", "<")
    interval = r"^[<>](.*):(\d+)-(\d+)$"
    part = lambda k: F.regexp_extract("step", interval, k)
    cut = steps.select(
        "_i", "place", "n", F.when(bare, ">").otherwise(F.left("step", F.lit(1))).alias("way"), F.when(bare, F.col("step")).otherwise(part(1)).alias("name"),
        F.when(bare, F.col("path_start")).otherwise(F.try_to_number(part(2), F.lit("9" * 18)).cast("long")).alias("start"), F.when(bare, F.col("path_end")).otherwise(F.try_to_number(part(3), F.lit("9" * 18)).cast("long")).alias("end"),
        F.when(bare, F.col("path_start")).otherwise(0).alias("from"),
    )
    pieces = nodes.select("name", "start", (F.col("start") + F.col("length")).alias("end"), "node")
    hit = iv.overlap_join(cut, pieces, ["name"], BIN)
    ahead = F.col("way") == ">"
    # Pieces of an interval in the order they are walked; what a walk of whole nodes has before it begins.
    walked = hit.withColumn("order", F.when(ahead, F.col("b_start")).otherwise(-F.col("b_start"))).withColumn("before", F.when(ahead, F.col("start") - F.col("b_start")).otherwise(F.col("b_end") - F.col("end")))
    first = F.min(F.when(F.col("place") == 0, F.struct("order", (F.col("before") - F.col("from")).alias("shift"))))
    whole = walked.groupBy("_i").agg(_in_order(F.concat("way", "b_node"), "place", "order").alias("_path"), first["shift"].alias("_shift"), (F.count_distinct("place") == F.max("n")).alias("_all")).filter("_all")
    moved = {"path": F.col("_path"), "path_start": F.col("path_start") + F.col("_shift"), "path_end": F.col("path_end") + F.col("_shift")}
    return alignments.join(whole, F.col("id") == F.col("_i")).select(*(moved.get(c, F.col(c)).alias(c) for c in alignments.columns))


def drop_overlapped(alignments: DataFrame, ratio: float, min_share: float = 0.0, min_overlap: int = 0) -> DataFrame:
    """Alignments (id, query, start, end, ...) that no other of their query contests.

    Another contests one if both overlap by more than min_overlap bases and at least min_share of the shorter, and
    the one is not `ratio` times as long as it. So the longer of two stays if it is that much longer;
    else both go.
    """
    size = F.col("end") - F.col("start")
    slim = alignments.select("id", "query", "start", "end")
    pairs = iv.overlap_join(slim, slim, ["query"], BIN).filter(F.col("id") != F.col("b_id"))
    other = F.col("b_end") - F.col("b_start")
    near = (F.col("overlap") > min_overlap) & (F.col("overlap") >= F.lit(min_share) * F.least(size, other))
    lost = pairs.filter(near & (size < F.lit(ratio) * other)).select(F.col("id").alias("_l")).distinct()
    return alignments.join(lost, F.col("id") == F.col("_l"), "left_anti")


def drop_jumps(alignments: DataFrame, max_deletion: int, rounds: int = 1000) -> DataFrame:
    """Alignments (id, query, start, end, target, strand, tstart, tend) without those that imply a long deletion.

    Two that follow each other along a query, on one target and strand, jump if the target between them is more
    than max_deletion longer than the query between. The shorter one of a jump goes (ties: the larger id), if
    it is not the longer one of another jump; this is repeated, as others then follow each other.
    """
    left = alignments
    w = Window.partitionBy("query", "target", "strand").orderBy("start", "end", "id")
    size = F.struct((F.col("end") - F.col("start")).alias("n"), (-F.col("id")).alias("o"))
    for _ in range(rounds):
        gap = F.when(F.col("strand") == "+", F.lead("tstart").over(w) - F.col("tend")).otherwise(F.col("tstart") - F.lead("tend").over(w)) - (F.lead("start").over(w) - F.col("end"))
        seen = left.select("id", size.alias("own"), F.lead(F.struct(size.alias("size"), "id")).over(w).alias("next"), gap.alias("gap")).filter(F.col("gap") > max_deletion)
        both = seen.select(F.explode(F.array(F.struct("id", (F.col("own") < F.col("next.size")).alias("short")), F.struct("next.id", (F.col("own") > F.col("next.size")).alias("short")))).alias("e"))
        gone = both.groupBy(F.col("e.id").alias("_g")).agg(F.min("e.short").alias("short")).filter("short").select("_g")
        before, left = left, materialize(left.join(gone, F.col("id") == F.col("_g"), "left_anti"), "jumps")
        changed = before.count() != left.count()
        if before is not alignments:
            discard(before)
        if not changed:
            return left
    raise RuntimeError(f"jumps did not settle in {rounds} rounds")


def join_ids(lines: DataFrame) -> DataFrame:
    """lines (file, n, text) of several GFA files as those of one graph: segments are named s1, s2, ... over all files, in
    order of files and of the numbers in their names, and every reference follows.

    References stand in S, L, C, P and W lines; other lines stay. A reference to a segment that its file
    does not have fails the job.
    """
    tok = F.split("text", "\t")
    kind = tok[0]
    name = lambda k: F.get("tok", F.lit(k))
    rows = lines.select("file", "n", tok.alias("tok"), kind.alias("kind"))
    number = F.regexp_extract("name", r"(\d+)$", 1)
    segments = rows.filter("kind = 'S'").select("file", name(1).alias("name")).distinct()
    ids = numbered(segments, [F.col("file"), F.length(number), number, F.col("name")], "new").select(F.col("file").alias("_f"), F.col("name").alias("_name"), F.concat(F.lit("s"), F.col("new").cast("string")).alias("_new"))
    steps = F.split(name(2), ",")
    used = (
        F.when(F.col("kind") == "S", F.array(name(1)))
        .when(F.col("kind").isin("L", "C"), F.array(name(1), name(3)))
        .when(F.col("kind") == "P", F.transform(steps, lambda s: F.substring(s, F.lit(1), F.length(s) - 1)))
        .when(F.col("kind") == "W", F.regexp_extract_all(name(6), F.lit("[<>]([^<>]+)"), F.lit(1)))
    )
    refs = rows.select("file", "n", F.posexplode(used).alias("at", "name"))
    known = refs.join(ids, (F.col("file") == F.col("_f")) & (F.col("name") == F.col("_name")), "left")
    found = F.coalesce("_new", F.raise_error(F.concat(F.lit("no segment "), F.col("name"), F.lit(" in "), F.col("file").cast("string"))).cast("string"))
    held = known.groupBy(F.col("file").alias("_lf"), F.col("n").alias("_ln")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", found.alias("new")))), lambda x: x["new"]).alias("new"))
    joined = rows.join(held, (F.col("file") == F.col("_lf")) & (F.col("n") == F.col("_ln")), "left")
    new = lambda k: F.get("new", F.lit(k))
    signs = F.regexp_extract_all(name(6), F.lit("([<>])[^<>]+"), F.lit(1))
    put = lambda values: F.transform("tok", lambda t, i: _chosen(i, values, t))
    text = (
        F.when(F.col("kind") == "S", F.array_join(put({1: new(0)}), "\t"))
        .when(F.col("kind").isin("L", "C"), F.array_join(put({1: new(0), 3: new(1)}), "\t"))
        .when(F.col("kind") == "P", F.array_join(put({2: F.array_join(F.zip_with("new", steps, lambda a, s: F.concat(a, F.right(s, F.lit(1)))), ",")}), "\t"))
        .when(F.col("kind") == "W", F.array_join(put({6: F.array_join(F.zip_with(signs, "new", lambda w, a: F.concat(w, a)), "")}), "\t"))
        .otherwise(F.array_join("tok", "\t"))
    )
    return joined.select("file", "n", text.alias("text"))


def _chosen(i: Column, values: dict[int, Column], otherwise: Column) -> Column:
    for k, v in values.items():
        otherwise = F.when(i == k, v).otherwise(otherwise)
    return otherwise
