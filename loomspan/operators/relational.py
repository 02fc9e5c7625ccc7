"""Joins, roll-ups, ranks and re-labelling that reports are built from.

All functions map DataFrames to a DataFrame, keep to built-in expressions, and have every
order fully specified, so that ties never depend on the partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.session import materialize


def require_match(left: DataFrame, right: DataFrame, on: Sequence[str], what: str) -> DataFrame:
    """Inner equi-join in which every left row must find a partner, or the job fails."""
    found = left.join(right.withColumn("_found", F.lit(True)), list(on), "left")
    checked = F.when(F.col("_found").isNull(), F.raise_error(F.concat(F.lit(f"{what}: no match for "), F.concat_ws(",", *[F.col(c).cast("string") for c in on]))).cast("boolean")).otherwise(True)
    return found.filter(checked).drop("_found")


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left join with a value in place of each missing column."""
    joined = left.join(right, list(on), "left")
    return joined.select(*left.columns, *(F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()))


def first_match(left: DataFrame, right: DataFrame, on: Sequence[str], order: Sequence[str], take: Sequence[str]) -> DataFrame:
    """Left join that takes, of several partners, the first by `order`."""
    best = right.groupBy(*on).agg(F.min_by(F.struct(*take), F.struct(*order)).alias("_best"))
    return left.join(best, list(on), "left").select(*left.columns, *(F.col(f"_best.{c}").alias(c) for c in take))


def aligned_keys(frames: Mapping[str, DataFrame], on: Sequence[str], value: str) -> DataFrame:
    """One row for each key of any frame, with each frame's summed value (0 where absent)."""
    tagged = None
    for name, df in frames.items():
        part = df.select(*on, F.lit(name).alias("_frame"), F.col(value).alias("_value"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(*on).agg(*(F.coalesce(F.sum(F.when(F.col("_frame") == n, F.col("_value"))), F.lit(0)).alias(n) for n in frames))


def splice(a: DataFrame, b: DataFrame, chosen: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of a whose key is not chosen, and rows of b whose key is."""
    return a.join(chosen, list(on), "left_anti").unionByName(b.join(chosen, list(on), "left_semi"))


def ordered_pairs(df: DataFrame, key: str) -> DataFrame:
    """All unordered pairs of a small keyed frame, the lesser key first."""
    return df.select(F.col(key).alias("a")).join(df.select(F.col(key).alias("b")), F.col("a") < F.col("b"))


def follow_parents(links: DataFrame, child: str, parent: str, rounds: int = 40) -> DataFrame:
    """(child, top, hops): the last ancestor that parent links lead to, by pointer doubling.

    Each round doubles the distance looked ahead, so a chain of n links takes log2(n) joins.
    """
    from loomspan.session import materialize

    state = links.select(F.col(child).alias("id"), F.coalesce(F.col(parent), F.col(child)).alias("top"), F.when(F.col(parent).isNull() | (F.col(parent) == F.col(child)), 0).otherwise(1).cast("long").alias("hops"))
    for _ in range(rounds):
        ahead = state.select(F.col("id").alias("_i"), F.col("top").alias("_t"), F.col("hops").alias("_h"))
        state = materialize(
            state.join(ahead, F.col("top") == F.col("_i"), "left").select("id", F.coalesce("_t", "top").alias("top"), (F.col("hops") + F.coalesce("_h", F.lit(0))).alias("hops"), (F.coalesce("_h", F.lit(0)) > 0).alias("moved")), "parents"
        )
        if state.filter("moved").isEmpty():
            return state.select("id", "top", "hops")
        state = state.drop("moved")
    raise ValueError("parent links have a cycle")


def lower_median(column: str) -> Column:
    """The lesser of the two middle values, as a double: counted by distinct value, never gathered as a list."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{column}`)")


def upper_median(column: str) -> Column:
    """The greater of the two middle values, as a double."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{column}` DESC)")


def n50(df: DataFrame, keys: Sequence[str], length: str) -> DataFrame:
    """(keys, n, total, n50): the first length, longest first, at which half the total is reached.

    Rows are counted by length first, so a key's window holds one row for each distinct length.
    """
    by = Window.partitionBy(*keys)
    w = by.orderBy(F.col("_l").desc()).rowsBetween(Window.unboundedPreceding, 0)
    counted = df.groupBy(*keys, F.col(length).alias("_l")).agg(F.count("*").alias("_n"), F.sum(length).alias("_sum"))
    run = counted.select(*keys, "_l", "_n", F.sum("_sum").over(w).alias("_run"), F.sum("_sum").over(by).alias("_total"))
    return run.groupBy(*keys).agg(F.sum("_n").alias("n"), F.max("_total").alias("total"), F.max(F.when(F.col("_run") >= F.floor(F.col("_total") / 2), F.col("_l"))).alias("n50"))


def share_of(value: Column, keys: Sequence[str]) -> Column:
    """A value's share of its group's sum."""
    return value / F.sum(value).over(Window.partitionBy(*keys))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first k rows of each group; `order` must break all ties."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_rank") <= k).drop("_rank")


def average_rank(order: Column, keys: Sequence[str], on: Sequence[str]) -> Column:
    """Rank in which ties share the mean of the places they take."""
    w = Window.partitionBy(*keys).orderBy(order)
    return F.rank().over(w) + (F.count("*").over(Window.partitionBy(*keys, *on)) - 1) / 2


def fill_forward(value: Column, keys: Sequence[str], order: Sequence[str]) -> Column:
    """The last non-null value up to the row."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def with_distinct_count(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """df with the number of distinct non-null values of the row's group, as `name`: (keys, value) are
    counted once and joined back, so no group is held at once."""
    counts = df.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col(column).alias("_v")).groupBy(*(f"_k{i}" for i in range(len(keys)))).agg(F.countDistinct("_v").cast("int").alias(name))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(counts, same).drop(*(f"_k{i}" for i in range(len(keys))))


def top_or_other(df: DataFrame, label: str, n: int, other: str = "other") -> DataFrame:
    """Adds `label_top`: the label if it is among the n most frequent (ties by name), else `other`."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    kept = counts.orderBy(F.col("_n").desc(), F.col(label)).limit(n).select(F.col(label).alias("_kept"))
    return df.join(kept, F.col(label) == F.col("_kept"), "left").withColumn(f"{label}_top", F.coalesce("_kept", F.lit(other))).drop("_kept")


def quality_metrics(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """precision, recall and f1 from sums, 0 where undefined, to 6 digits."""
    precision = F.coalesce(tp / F.nullif(tp + fp, F.lit(0)), F.lit(0.0))
    recall = F.coalesce(tp / F.nullif(tp + fn, F.lit(0)), F.lit(0.0))
    f1 = F.coalesce(2 * precision * recall / F.nullif(precision + recall, F.lit(0.0)), F.lit(0.0))
    return [F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(f1, 6).alias("f1")]


def thresholds(df: DataFrame, keys: Sequence[str], score: str, levels: Sequence[float]) -> DataFrame:
    """(keys, threshold, n): rows above each level, in one pass over the rows."""
    above = F.explode(F.filter(F.lit(list(levels)), lambda t: F.col(score) > t))
    return df.select(*keys, above.alias("threshold")).groupBy(*keys, "threshold").agg(F.count("*").alias("n"))


def next_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, k: int) -> DataFrame:
    """(keys, value, next_value, ahead): each row with each of the k rows after it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    following = F.collect_list(value).over(w.rowsBetween(1, k))
    return df.select(*keys, value, following.alias("_next")).select(*keys, value, F.posexplode("_next").alias("_i", "next_value")).withColumn("ahead", F.col("_i") + 1).drop("_i")


def consecutive_groups(keys: Sequence[str], order: Sequence[str], size: int) -> Column:
    """Number, from 0, of the run of `size` consecutive rows of a key that the row is in."""
    return F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1) / size)


def binned(value: Column, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = False) -> Column:
    """Label of the right-closed bin (edge, next edge] that holds the value; null outside."""
    out = F.lit(None).cast("string")
    for i, label in reversed(list(enumerate(labels))):
        low = (value >= edges[i]) if include_lowest and i == 0 else (value > edges[i])
        out = F.when(low & (value <= edges[i + 1]), F.lit(label)).otherwise(out)
    return out


def rename_uniquely(df: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """(name, alias): letters and digits of each distinct name, with a counter where that is taken.

    Of names with one cleaned form the least has it bare, the next ones with 1, 2, ...; where such
    an alias is another name's, the later one's counter is raised by its form's number of names
    until all differ. Counted names never move the bare ones.
    """
    from loomspan.session import materialize

    forms = Window.partitionBy("form")
    named = df.select(F.col(name).alias("name")).filter("name IS NOT NULL").distinct().select("name", F.regexp_replace("name", "[^A-Za-z0-9]", "").alias("form"))
    state = named.select("name", "form", (F.row_number().over(forms.orderBy("name")) - 1).cast("long").alias("k"), F.count("*").over(forms).alias("step"))
    alias = F.when(F.col("k") == 0, F.col("form")).otherwise(F.concat("form", F.col("k").cast("string")))
    for _ in range(rounds):
        ranked = state.withColumn("alias", alias)
        state = materialize(ranked.withColumn("place", F.row_number().over(Window.partitionBy("alias").orderBy(F.col("k") > 0, "k", "name"))), "aliases")
        if state.filter("place > 1").isEmpty():
            return state.select("name", "alias")
        state = state.select("name", "form", F.when(F.col("place") > 1, F.col("k") + F.col("step")).otherwise(F.col("k")).alias("k"), "step")
    raise RuntimeError(f"names did not settle in {rounds} rounds")


def placeholder_names(df: DataFrame, name: str, prefix: str = "g") -> DataFrame:
    """(name, alias) of each distinct name: those of letters, digits and underscores stay, with a letter or digit among
    them; the others become the prefix and a number, counted in order of names past numbers that are taken.

    The k-th of them gets k plus the taken numbers with at most k free ones below, an as-of search.
    """
    from loomspan.operators import intervals as iv

    far = (1 << 62) - 1
    names = df.select(F.col(name).alias("name")).filter("name IS NOT NULL").distinct()
    plain = F.col("name").rlike(r"^[\p{L}\p{N}_]*[\p{L}\p{N}][\p{L}\p{N}_]*$")
    odd = numbered(names.filter(~plain), [F.col("name")], "place").select(F.lit(0).alias("all"), "name", (F.col("place") - 1).alias("pos"))
    number = F.regexp_extract("name", f"^{prefix}(0|[1-9][0-9]{{0,17}})$", 1)
    taken = numbered(names.select(number.alias("t")).filter("t <> ''").select(F.col("t").cast("long").alias("t")), [F.col("t")], "rank")
    passed = taken.groupBy((F.col("t") - F.col("rank") + 1).alias("start")).agg(F.max("rank").alias("passed")).select(F.lit(0).alias("all"), "start", F.lit(far).alias("end"), "passed")
    found = iv.as_of(odd, passed, ["all"], "passed")
    aliases = found.select("name", F.concat(F.lit(prefix), (F.col("pos") + F.coalesce("passed", F.lit(0))).cast("string")).alias("alias"))
    return names.filter(plain).select("name", F.col("name").alias("alias")).unionByName(aliases)


def chunked(df: DataFrame, order: Sequence[Column], size: int) -> DataFrame:
    """df with `chunk` and `row`: rows in this order, `size` to a chunk, so that chunks and rows put it back."""
    return numbered(df, order, "row").withColumn("chunk", F.floor((F.col("row") - 1) / size))


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """df with each row's place from 1 in a total order, as column `name`.

    Two-level: places within blocks of a range partitioning, plus the rows of earlier
    blocks. Only the blocks' counts meet in one task.
    """
    blocks = materialize(df.repartitionByRange(*order).withColumn("_block", F.spark_partition_id()), "numbered-blocks")
    counts = blocks.groupBy("_block").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col("_block").alias("_b"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_block").orderBy(*order))
    placed = blocks.withColumn("_k", within).join(base, F.col("_block") == F.col("_b"))
    return placed.select(*df.columns, (F.col("_k") + F.col("_before")).cast("long").alias(name))
