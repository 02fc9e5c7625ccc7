"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). The cells' token weights are raked,
margin after margin, until each margin has its target share; documents are then sampled
with one probability for each cell, calibrated so that the expected tokens meet the
budget. Everything is DataFrame work: one pass over the texts counts tokens, the
fitting runs on the cell table, and a hash of the doc_id decides each document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.session import materialize

BREAKS = r"[\x20\x09-\x0D]+"
MARGINS = ("source", "lang", "topic")


@dataclass(frozen=True)
class MixConfig:
    """Targets are the margins' natural token shares to the power `temper` (1 keeps them, 0
    evens them out), normalised. `targets` gives a margin's shares outright, as (margin, value,
    share) triples: its other values, and those that no document has, get nothing. `budget`
    is the share of all tokens to keep in expectation. `rounds` is the number of sweeps over
    the three margins; margin_errors() tells how far they came."""

    temper: tuple[float, float, float] = (0.7, 0.7, 0.9)
    budget: float = 0.5
    rounds: int = 8
    targets: tuple[tuple[str, str | None, float], ...] = ()


def token_count(text: Column) -> Column:
    """Words of a whole text; 0 for null."""
    parts = F.size(F.split(F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     ")), " +"))
    return F.when(text.isNull() | (F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     ")) == ""), 0).otherwise(parts).cast("long")


def topic(text: Column) -> Column:
    """The topic where documents have no column for it: the form of a whole text: `empty`, `list` (under 80 characters a line), `brief` (under
    1,500 characters) or `prose`."""
    chars = F.length(text)
    lines = chars - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return (
        F.when(text.isNull() | (chars == 0), "empty").when(chars < 80 * lines, "list").when(chars < 1500, "brief").otherwise("prose")
    )


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) from the md5 of the id as text."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def cells(labelled: DataFrame) -> DataFrame:
    """(source, lang, topic, docs, tokens) of labelled documents."""
    return labelled.groupBy(*MARGINS).agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))


def rake(table: DataFrame, config: MixConfig) -> DataFrame:
    """Adds `weight`: the cell's token share after fitting. Cells without tokens weigh 0."""
    everything = Window.partitionBy("one")
    out = table.withColumn("one", F.lit(1)).withColumn("weight", F.col("tokens") / F.sum("tokens").over(everything))
    for margin, power in zip(MARGINS, config.temper, strict=True):
        natural = F.sum("weight").over(Window.partitionBy(margin))
        wanted = F.pow(natural, F.lit(power))
        if given := [(value, share) for name, value, share in config.targets if name == margin]:
            wanted = F.lit(0.0)
            for value, share in given:
                wanted = F.when(F.col(margin).eqNullSafe(F.lit(value)), F.lit(float(share))).otherwise(wanted)
        out = out.withColumn("_t", F.when(natural > 0, wanted).otherwise(F.lit(0.0)))
        first = F.row_number().over(Window.partitionBy(margin).orderBy(*MARGINS)) == 1
        out = out.withColumn("_f", F.when(first, F.col("_t")).otherwise(F.lit(0.0)))
        out = out.withColumn(f"target_{margin}", F.col("_t") / F.sum("_f").over(everything)).drop("_t", "_f")
    for _ in range(config.rounds):
        for margin in MARGINS:
            now = F.sum("weight").over(Window.partitionBy(margin))
            out = out.withColumn("weight", F.when(now > 0, F.col("weight") * F.col(f"target_{margin}") / now).otherwise(F.lit(0.0)))
    return out.drop("one")


def margin_errors(raked: DataFrame) -> DataFrame:
    """(margin, value, target, reached, error) of each value of each margin after fitting."""
    total = F.sum("weight").over(Window.partitionBy(F.lit(1)))
    shares = raked.withColumn("weight", F.when(total > 0, F.col("weight") / total).otherwise(F.lit(0.0)))
    parts = [
        shares.groupBy(F.lit(m).alias("margin"), F.col(m).alias("value")).agg(F.max(f"target_{m}").alias("target"), F.sum("weight").alias("reached")) for m in MARGINS
    ]
    return parts[0].union(parts[1]).union(parts[2]).withColumn("error", F.abs(F.col("reached") - F.col("target")))


def calibrate(raked: DataFrame, budget: float) -> DataFrame:
    """Adds `probability`: min(1, scale * weight / natural share), with the scale at which the
    expected tokens are `budget` of all tokens.

    Each step solves for the scale over the cells that are not yet certain; the certain
    ones only become more, so it ends after a few steps. Only sums reach the driver.
    """
    table = materialize(raked.withColumn("boost", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(0.0))), "raked-cells")
    total = table.agg(F.sum("tokens")).first()[0] or 0
    scale, certain = 0.0, -1
    while True:
        full = F.col("boost") * F.lit(scale) >= 1
        row = table.agg(
            F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("tokens") * F.col("boost"))), F.lit(0.0))
        ).first()
        if row[0] == certain or row[2] <= 0:
            break
        certain = row[0]
        scale = max(scale, (budget * total - row[1]) / row[2])
    return table.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("boost") * F.lit(scale))).otherwise(F.lit(float(budget))))


def label(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, tokens of each row."""
    return docs.select("doc_id", "source", "lang", topic(F.col("text")).alias("topic"), token_count(F.col("text")).alias("tokens"))


def fitted_cells(docs: DataFrame, config: MixConfig) -> DataFrame:
    """Cells with target shares, weight and probability."""
    return calibrate(rake(materialize(cells(label(docs)), "cells"), config), config.budget)


def mix(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight, probability, kept for each row of docs.

    `weight` is the document's share of its cell's raked weight (by tokens). A null source
    or lang is a category of its own; a null text has the topic `empty` and no tokens,
    and is kept with probability `budget`. Repeated rows count each and share their
    fate, as the doc_id decides. Other columns are not read. An empty table gives none.
    """
    fitted = fitted_cells(docs, config).select(*(F.col(m).alias(f"cell_{m}") for m in MARGINS), "boost", "probability")
    same = [F.col(m).eqNullSafe(F.col(f"cell_{m}")) for m in MARGINS]
    return (
        label(docs)
        .join(fitted, same[0] & same[1] & same[2])
        .select("doc_id", *MARGINS, "tokens", (F.col("tokens") * F.col("boost")).alias("weight"), "probability", (uniform(F.col("doc_id")) < F.col("probability")).alias("kept"))
    )


def sample(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The rows of docs that the mix keeps, columns unchanged."""
    fitted = fitted_cells(docs, config).select(*(F.col(m).alias(f"cell_{m}") for m in MARGINS), "probability")
    row = docs.select(F.struct("*").alias("row"), F.col("source").alias("row_source"), F.col("lang").alias("row_lang"), topic(F.col("text")).alias("row_topic"))
    same = [F.col(f"row_{m}").eqNullSafe(F.col(f"cell_{m}")) for m in MARGINS]
    return row.join(fitted, same[0] & same[1] & same[2]).filter(uniform(F.col("row.doc_id")) < F.col("probability")).select("row.*")
