"""Sharding by minimax contiguous partition.

Equal texts form an atomic group; groups stand in the order of their smallest doc_id. The
smallest shard capacity at which a greedy fill needs no more than the wanted shards
is found by a search over capacities, and the cuts are where that fill puts them. So the
largest shard is as small as any contiguous partition allows.

All of it is DataFrame work. Ranks and running sizes are two-level: within blocks of a
range partitioning, and over the blocks' totals. The search reads only prefix sums,
for many capacities at once; only those sums reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.session import materialize

#: Capacities that one pass of the search tries.
FAN = 64


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32 and the group key of each row; null texts are one group."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")).alias("group"),
    )


def ordered(rows: DataFrame) -> DataFrame:
    """Adds `rank` (from 0) and `upto` (sizes up to and with the row) in group order, and
    `closes` (the last row of its group). Written to the shared folder."""
    groups = rows.groupBy(F.col("group").alias("g")).agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    placed = rows.join(groups, F.col("group") == F.col("g")).drop("g")
    order = ["first", "group", "doc_id"]
    blocks = materialize(placed.repartitionByRange(*order).withColumn("block", F.spark_partition_id()), "shard-rows")
    totals = blocks.groupBy("block").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        F.col("block").alias("b"), F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before")
    )
    within = Window.partitionBy("block").orderBy(*order)
    numbered = (
        blocks.withColumn("k", F.row_number().over(within))
        .withColumn("s", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .join(base, F.col("block") == F.col("b"))
        .select("doc_id", "size", "text_crc32", "group", "n", (F.col("k") - 1 + F.col("rows_before")).alias("rank"), (F.col("s") + F.col("bytes_before")).alias("upto"))
    )
    return materialize(numbered, "shard-order")


def group_ends(rows: DataFrame) -> DataFrame:
    """(end, rows): running size and row count at the end of each group."""
    return rows.groupBy("group").agg(F.max("upto").alias("end"), (F.max("rank") + 1).alias("rows"))


def minimax_cuts(ends: DataFrame, shards: int, largest: int, total: int) -> list[tuple[int, int]]:
    """(end, rows) at the last group of each shard under the smallest feasible capacity.

    `ends` is read once for each step of a fill and round of the search; `largest` is the
    size of the largest group, `total` that of all. Later shards may be empty.
    """
    if not total:
        return [(0, 0)] * shards

    def reach(limits: list[int]) -> list[tuple[int, int]]:
        """For each limit, in ascending order, the last group end not above it."""
        above = F.size(F.filter(F.lit(limits).cast("array<bigint>"), lambda x: x < F.col("end")))
        found = {r["i"]: (r["m"]["end"], r["m"]["rows"]) for r in ends.groupBy(above.alias("i")).agg(F.max(F.struct("end", "rows")).alias("m")).collect()}
        out, last = [], (0, 0)
        for i in range(len(limits)):
            last = max(last, found.get(i, last))
            out.append(last)
        return out

    def fill(capacities: list[int]) -> list[list[tuple[int, int]]]:
        cuts: list[list[tuple[int, int]]] = [[] for _ in capacities]
        at = [(0, 0)] * len(capacities)
        for _ in range(shards):
            at = reach([x[0] + c for x, c in zip(at, capacities, strict=True)])
            for mine, x in zip(cuts, at, strict=True):
                mine.append(x)
        return cuts

    low, high = max(largest, -(-total // shards)), largest + -(-total // shards)  # a greedy fill never needs more
    best: list[tuple[int, int]] = []
    while True:
        tried = sorted({low + (high - low) * i // (FAN - 1) for i in range(FAN)})
        cuts = fill(tried)
        k = next(i for i, c in enumerate(cuts) if c[-1][0] == total)
        best, high = cuts[k], tried[k]
        if k == 0:
            return best
        low = tried[k - 1] + 1
        if low == high:
            return best


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of docs.

    The law is `bytes`: sizes of the shards are as equal as atomic groups in order allow.
    `slot` counts from 0 without gaps in each shard. A null text has size 1 and groups with
    other null texts; rows without a doc_id come first in their group. Repeated rows are rows
    of one group. `grown_shard` is null, as the law promises nothing on growth. Other columns
    are not read. An empty table gives an empty result.
    """
    rows = ordered(sized(docs))
    ends = materialize(group_ends(rows), "shard-groups")
    biggest = rows.groupBy("group").agg(F.sum("size").alias("s")).agg(F.max("s"), F.sum("s")).first()
    cuts = minimax_cuts(ends, shards, biggest[0] or 0, biggest[1] or 0)
    number, start = F.lit(0), F.lit(0).cast("long")
    for i, (end, count) in enumerate(cuts[:-1]):
        past = F.col("upto") > F.lit(end)
        number = F.when(past, F.lit(i + 1)).otherwise(number)
        start = F.when(past, F.lit(count).cast("long")).otherwise(start)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), number.cast("int").alias("shard"), (F.col("rank") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
