"""A bitmap of keys, of bounded size: most rows without a partner are told before a join, and stay where they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap, in words of 64: at most 4 MB are broadcast, whatever the input.
BITS = 1 << 24


def _places(key: list[Column]) -> tuple[Column, Column]:
    bit = F.pmod(F.xxhash64(*key), F.lit(BITS))
    return F.shiftright(bit, 6).cast("int"), (bit % 64).cast("int")


def _bitmap(keys: DataFrame, key: list[Column]) -> DataFrame:
    word, place = _places(key)
    bits = keys.select(word.alias("_word"), place.alias("_place"))
    return bits.groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _place))").alias("_bits"))


def parted(rows: DataFrame, key: list[Column], keys: DataFrame, keys_key: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that may have their key among keys, rows that surely have not). Keys have the types of
    rows' keys. No row of the latter has a partner in a join, so only the first need be dealt by key."""
    word, place = _places(key)
    columns = rows.columns
    known = F.broadcast(_bitmap(keys, keys_key))
    seen = rows.join(known, word == F.col("_word"), "left").withColumn("_seen", F.coalesce(F.getbit("_bits", place) == 1, F.lit(False)))
    return seen.filter("_seen").select(*columns), seen.filter("NOT _seen").select(*columns)
