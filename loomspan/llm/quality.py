"""Quality rules: cross-document line frequency by host, with per-document base figures.

A line that many documents of one host share (a menu, a licence, a footer) says
nothing about the document it stands in. Lines are normalised and hashed, distinct
documents are counted for each host and line, lines above the limits are removed,
and a document that loses nearly all its words is rejected as depleted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.llm.text import WORD_BREAKS, WORD_PATTERN
from loomspan.session import materialize

#: Characters that count as symbols (fixed by the query's contract).
SYMBOLS = "#*$%&|<>"

BREAKS = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class LineLimits:
    """A line is removed from a host's documents if at least `min_docs` distinct ones
    hold it and they are more than `max_share` of the host's distinct documents. A
    document is depleted if fewer than `min_left` of its words are left then."""

    min_docs: int = 10
    max_share: float = 0.01
    min_left: float = 0.2


def repeated_words(tokens: list[bytes], size: int = 3) -> int:
    """Words inside windows of `size` words that occur twice or more in the text."""
    n = len(tokens) - size + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in tokens), np.int64, len(tokens))
    key = seq[:n]
    for i in range(1, size):
        if len(ids) ** (i + 1) >= 1 << 62:  # keep the pair key in 64 bits
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(ids) + seq[i : i + n]
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(tokens), bool)
    for i in range(size):
        covered[i : i + n] |= twice
    return int(covered.sum())


def base_figures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    tokens = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += bool(line.strip(WORD_BREAKS))
        else:
            seen.add(line)
    return (
        len(tokens),
        len(text) - sum(text.count(c) for c in WORD_BREAKS),
        sum(text.count(c) for c in SYMBOLS),
        dup,
        repeated_words(tokens),
    )


def text_key(text: Column) -> Column:
    """64-bit identity of a text, for counting copies once; null for null."""
    return F.when(text.isNotNull(), F.xxhash64(text))


def document_figures(docs: DataFrame) -> DataFrame:
    """doc_id, source, text key and the five base figures; one row for each row of docs."""

    def run(batches):
        for batch in batches:
            rows = [base_figures(t) for t in batch.column(3).to_pylist()]
            cols = np.array(rows, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(cols[:, i]) for i in range(5))], names=names)

    names = ["doc_id", "source", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return docs.select("doc_id", "source", text_key(F.col("text")).alias("text_key"), "text").mapInArrow(
        run, "doc_id long, source string, text_key long, " + ", ".join(f"{n} long" for n in names[3:])
    )


def document_lines(docs: DataFrame) -> DataFrame:
    """(source, text_key, pos, line, words): the normalised lines of each distinct text of a
    host, `line` as a 64-bit hash.

    Lines are lower-cased, white space runs become one space, and blank lines go.
    Copies of a text within a host fall together, so they count as one document.
    """
    norm = F.trim(F.regexp_replace(F.lower(F.col("raw")), BREAKS, " "))
    spaces = F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit("")))
    return (
        docs.filter(F.col("text").isNotNull())
        .select("source", text_key(F.col("text")).alias("text_key"), F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
        .select("source", "text_key", "pos", norm.alias("norm"))
        .filter(F.col("norm") != "")
        .select("source", "text_key", "pos", F.xxhash64("norm").alias("line"), (spaces + 1).alias("words"))
        .groupBy("source", "text_key", "pos")
        .agg(F.min("line").alias("line"), F.min("words").alias("words"))
    )


def frequent_lines(docs: DataFrame, lines: DataFrame, limits: LineLimits) -> DataFrame:
    """(host, bad_line, line_docs): lines above the limits, by host. A host's documents are its
    distinct texts with a line that is not blank."""
    by_line = lines.groupBy("source", "line").agg(F.countDistinct("text_key").alias("line_docs")).filter(F.col("line_docs") >= limits.min_docs)
    hosts = docs.filter(F.col("text").rlike(WORD_PATTERN)).groupBy(F.col("source").alias("host")).agg(F.countDistinct(text_key(F.col("text"))).alias("host_docs"))
    return (
        by_line.join(hosts, F.col("source").eqNullSafe(F.col("host")))
        .filter(F.col("line_docs") > F.col("host_docs") * F.lit(limits.max_share))
        .select("host", F.col("line").alias("bad_line"), "line_docs")
    )


def removed_words(docs: DataFrame, limits: LineLimits) -> DataFrame:
    """(host, lost_key, n_line_words): words on removed lines, for texts that have any."""
    lines = materialize(document_lines(docs), "quality-lines")
    bad = frequent_lines(docs, lines, limits)
    return (
        lines.join(bad, F.col("source").eqNullSafe(F.col("host")) & (F.col("line") == F.col("bad_line")), "left_semi")
        .groupBy(F.col("source").alias("host"), F.col("text_key").alias("lost_key"))
        .agg(F.sum("words").cast("long").alias("n_line_words"))
    )


def apply_rules(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Base figures, words on removed lines and verdict for each row of docs.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_line_words, kept.

    A null or empty text has no words and fails the base rules. Rows with a null source
    form a host of their own. Repeated rows each get a row, and count once as documents
    of their host. Other columns are not read. An empty table gives an empty result.
    """
    lost = removed_words(docs, limits)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_line_words")
    return (
        document_figures(docs)
        .join(lost, F.col("source").eqNullSafe(F.col("host")) & (F.col("text_key") == F.col("lost_key")), "left")
        .withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0).cast("long")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (left >= F.lit(limits.min_left) * F.col("n_words")))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_line_words", "kept")
    )


def remove_rejected(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """docs without the rejected documents and, in those kept, without the removed lines.

    Columns stay as they are. A row is judged by its host and text, so repeated rows
    share a verdict and rows without a doc_id are judged like others.
    """
    lines = materialize(document_lines(docs), "quality-lines")
    bad = frequent_lines(docs, lines, limits)
    cut = (
        lines.join(bad, F.col("source").eqNullSafe(F.col("host")) & (F.col("line") == F.col("bad_line")), "left_semi")
        .groupBy(F.col("source").alias("host"), F.col("text_key").alias("lost_key"))
        .agg(F.collect_set("pos").alias("cut_lines"), F.sum("words").alias("line_words"))
    )
    row = docs.select(F.struct("*").alias("row"), text_key(F.col("text")).alias("row_key"))
    joined = row.join(cut, F.col("row.source").eqNullSafe(F.col("host")) & (F.col("row_key") == F.col("lost_key")), "left")
    lines_left = F.filter(F.split("row.text", "\n"), lambda _, i: ~F.array_contains(F.coalesce("cut_lines", F.array().cast("array<int>")), i))
    clean = F.when(F.col("cut_lines").isNull(), F.col("row.text")).otherwise(F.array_join(lines_left, "\n"))

    def run(batches):
        for batch in batches:
            keep = []
            for text, lost in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                n, _, _, _, repeats = base_figures(text)
                keep.append(n >= 50 and 100 * repeats <= 50 * n and n - lost >= limits.min_left * n)
            yield pa.RecordBatch.from_arrays(batch.columns[:-2], names=fields).filter(pa.array(keep, pa.bool_()))

    fields = docs.columns
    shown = [(clean if c == "text" else F.col(f"row.`{c}`")).alias(f"c{i}") for i, c in enumerate(fields)]
    judged = joined.select(*shown, F.col("row.text").alias("whole"), F.coalesce("line_words", F.lit(0).cast("long")).alias("lost"))
    return judged.mapInArrow(run, docs.schema)
