"""Ends of blocks and what lies between them: which ends to align, what to rescue, which adjacencies to break."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.operators import intervals as iv
from loomspan.operators import trees

#: An end behind all positions.
FAR = (1 << 62) - 1


def ends_to_align(caps: DataFrame, max_length: int) -> DataFrame:
    """(flower, end, dominant) of the ends of each flower that need an alignment of their own.

    caps has a row (flower, end, other, length) for each cap: its end, the end of the cap that its adjacency
    leads to, and the bases between; so every adjacency is there from both sides. An end dominates if
    it has the most caps (ties: the least), takes part in all adjacencies and joins none to itself. It is
    the only one to align then, if no adjacency is longer than twice max_length; else all ends are.
    """
    ends = caps.groupBy("flower", "end").agg(F.count("*").alias("caps"), F.count_if(F.col("end") == F.col("other")).alias("loops"))
    whole = caps.groupBy(F.col("flower").alias("_f")).agg(F.count("*").alias("all"), F.max("length").alias("longest"), F.count_if(F.col("end") == F.col("other")).alias("_loops"))
    top = ends.groupBy(F.col("flower").alias("_t")).agg(F.min(F.struct((-F.col("caps")).alias("minus"), "end")).alias("top"))
    # With no loops at all, an end takes part in all adjacencies if it has half of the caps.
    dominant = (-F.col("top.minus") * 2 == F.col("all")) & (F.col("_loops") == 0) & (F.col("longest") <= 2 * max_length)
    chosen = whole.join(top, F.col("_f") == F.col("_t")).select("_f", F.when(dominant, F.col("top.end")).alias("only"))
    return ends.join(chosen, F.col("flower") == F.col("_f")).filter(F.col("only").isNull() | (F.col("end") == F.col("only"))).select("flower", "end", F.col("only").isNotNull().alias("dominant"))


def covered_before(points: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """points (keys, pos, ...) with `covered`, the bases of the ranges' union before each: an as-of search in running sums."""
    runs = iv.running_sum(iv.merge(ranges, keys).withColumn("size", F.col("end") - F.col("start")), keys, "start", "size", "before")
    held = runs.select(*keys, "start", F.lit(FAR).alias("end"), F.struct("start", F.col("end").alias("stop"), "before").alias("run"))
    found = iv.as_of(points, held, keys, "run")
    own = F.least("pos", "run.stop") - F.col("run.start")
    return found.withColumn("covered", F.coalesce(F.col("run.before") + own, F.lit(0))).drop("run")


def rescued(segments: DataFrame, ranges: DataFrame, keys: list[str], min_length: int, threshold: float) -> DataFrame:
    """(keys, start, end, covered) of the segments of at least min_length bases of which the ranges cover more than the
    threshold's share. Segments of one key begin at different places."""
    long = iv.valid(segments).filter(F.col("end") - F.col("start") >= min_length).select(*keys, "start", "end")
    ends = long.select(*keys, "start", "end", F.explode(F.array("start", "end")).alias("pos"))
    seen = covered_before(ends, ranges, keys)
    # Between its ends a segment holds the difference of what is covered before them.
    sums = seen.groupBy(*keys, "start", "end").agg((F.max("covered") - F.min("covered")).alias("covered"))
    return sums.filter(F.col("covered") / (F.col("end") - F.col("start")) > threshold)


def breakable(flowers: DataFrame, min_nested: int, max_chain: int) -> DataFrame:
    """(id, breakable) of flowers (id, parent, bases, chain_bases).

    From a flower upwards, the first that has more than min_nested bases allows a break, the first that is a link of a
    chain with at least max_chain bases (chain_bases; null: no link) forbids it. The top decides nothing,
    and nothing decided allows a break.
    """
    up = trees.closure(flowers.select("id", "parent", F.lit(1.0).alias("length")))
    says = F.when(F.col("bases") > min_nested, True).when(F.col("chain_bases") >= max_chain, False)
    deciding = flowers.filter("parent IS NOT NULL").select(F.col("id").alias("_d"), says.alias("says")).filter("says IS NOT NULL")
    nearest = up.join(deciding, F.col("ancestor") == F.col("_d")).groupBy(F.col("descendant").alias("_n")).agg(F.min_by("says", "hops").alias("says"))
    return flowers.join(nearest, F.col("id") == F.col("_n"), "left").select("id", F.coalesce("says", F.lit(True)).alias("breakable"))


def break_adjacencies(order: DataFrame, support: DataFrame, flowers: DataFrame, min_support: int, min_nested: int, max_chain: int) -> DataFrame:
    """order (ref, place, node, flower) with `piece`, from 0: each reference is cut between neighbours that fewer than
    min_support sequences put side by side, where the left one's flower is a leaf and breakable().

    support is (a, b, n), either way round; pairs without a row have none. flowers has a boolean `leaf`.
    """
    open_ = breakable(flowers, min_nested, max_chain).join(flowers.filter("leaf").select(F.col("id").alias("_l")), F.col("id") == F.col("_l")).filter("breakable").select(F.col("id").alias("_o"))
    pairs = support.select(F.least("a", "b").alias("_a"), F.greatest("a", "b").alias("_b"), "n").groupBy("_a", "_b").agg(F.sum("n").alias("n"))
    next_ = iv.with_next(order, ["ref"], "place", ["node"])
    seen = next_.join(pairs, (F.least("node", "next.node") == F.col("_a")) & (F.greatest("node", "next.node") == F.col("_b")), "left").join(open_, F.col("flower") == F.col("_o"), "left")
    cut = F.col("next").isNotNull() & F.col("_o").isNotNull() & (F.coalesce("n", F.lit(0)) < min_support)
    return iv.running_sum(seen.select("ref", "place", "node", "flower", cut.cast("long").alias("cut")), ["ref"], "place", "cut", "piece").drop("cut")
