"""Spelling variants: words one edit apart, found in forward and reversed sorted dictionaries.

One inserted, deleted or replaced code point leaves a half of a word intact. So two near words
share a prefix in the forward dictionary or a suffix in the reversed one. Each dictionary is
cut into blocks of one shared half; a block with many words is cut again, as the edit leaves
a half of the open middle intact, too. Blocks are range-partitioned, scanned in order, and
the pairs within them verified.

A block is (L, left, right): words of L or L + 1 code points that begin with left and end with
right. It owns the pairs of a shorter word of L whose first difference lies at or behind
left and before right, so that each pair has one owner.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.session import discard, materialize, scratch


@dataclass(frozen=True)
class SpellingConfig:
    """Words have at least `min_length` code points and `min_count` occurrences. A near word is the form
    if it occurs at least `ratio` times as often. If `damage` divides an occurrence's hash, it
    loses a code point (None: never). A block of more than `block` words is cut again; counts are
    passed on whenever a task holds `held` words."""

    min_length: int = 6
    min_count: int = 5
    ratio: int = 5
    damage: int | None = 199
    block: int = 128
    held: int = 400_000


RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: Parts that a block's entries are dealt into while its words are counted.
SALTS = 16


def runs(text: str | None) -> list[str]:
    """Runs of Latin letters (U+00C0 to U+00FF included), A-Z lower-cased."""
    return RUN.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")) if text else []


def damaged(run: str, seed: int, every: int | None) -> str:
    """The run without a code point, if `every` divides its hash; seed is the CRC-32 of what stands before it."""
    if every is None or (h := zlib.crc32(run.encode(), seed)) % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, config: SpellingConfig) -> DataFrame:
    """(word, n): words that are long and frequent enough, over all of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seed = zlib.crc32(f"{'' if i is None else i}:".encode())
                for found, n in Counter(runs(text.as_py())).items():
                    word = damaged(found, seed, config.damage)
                    if len(word) >= config.min_length:
                        total[word] += n
                if len(total) >= config.held:
                    yield flush()
                    total.clear()
        yield flush()

    some = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return some.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= config.min_count)


# -- blocks


def _entries(words: DataFrame, config: SpellingConfig) -> DataFrame:
    """The first blocks: a word of n code points stands in those of L = n and of L = n - 1, by its first
    half in the forward dictionary and by its last in the reversed one."""
    n = F.length("word")
    size = F.explode(F.filter(F.array(n, n - 1), lambda x: x >= config.min_length))
    half = F.floor(F.col("size") / 2).cast("int")
    sides = F.explode(F.array(F.struct(half.alias("i"), F.lit(0).alias("j")), F.struct(F.lit(0).alias("i"), (F.col("size") - half).alias("j"))))
    return _keyed(words.select("word", "n", F.reverse("word").alias("back"), size.alias("size")).select("*", sides.alias("side")).select("word", "back", "n", "size", "side.i", "side.j"))


def _keyed(entries: DataFrame) -> DataFrame:
    """Entries with the place of their block in the dictionaries."""
    left, right = F.substring("word", F.lit(1), F.col("i")), F.substring("back", F.lit(1), F.col("j"))
    return entries.withColumn("key", F.concat_ws("|", F.col("size").cast("string"), left, right)).withColumn("salt", F.pmod(F.hash("word"), F.lit(SALTS)))


def _halves(entries: DataFrame) -> DataFrame:
    """The two blocks that share the pairs of a block among them: the edit is in the last half of its
    middle, or in the first."""
    middle = F.col("size") - F.col("i") - F.col("j")
    half = F.floor(middle / 2).cast("int")
    sides = F.explode(F.array(F.struct((F.col("i") + half).alias("i"), F.col("j").alias("j")), F.struct(F.col("i").alias("i"), (F.col("j") + middle - half).alias("j"))))
    return _keyed(entries.select("word", "back", "n", "size", sides.alias("side")).select("word", "back", "n", "size", "side.i", "side.j"))


def small_blocks(words: DataFrame, config: SpellingConfig) -> DataFrame:
    """Entries (key, size, i, j, word, n, ...) of blocks of at most `block` words, or of an open middle of one code
    point. The middle halves in each round, so there are about as many as a word's length has bits."""
    done: DataFrame | None = None
    entries = materialize(_entries(words, config), "spelling-entries")
    while True:
        open_ = F.col("size") - F.col("i") - F.col("j") > 1
        parts = entries.filter(open_).groupBy("key", "salt").agg(F.count("*").alias("k"))
        large = parts.groupBy("key").agg(F.sum("k").alias("k")).filter(F.col("k") > config.block)
        if large.isEmpty():
            return entries if done is None else done.union(entries)
        # A large block is spread over its salts here, and its key repeated for each.
        large = large.select(F.col("key").alias("large"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
        marked = materialize(entries.join(large, (F.col("key") == F.col("large")) & (F.col("salt") == F.col("s")), "left").withColumn("cut", F.col("large").isNotNull()).drop("large", "s"), "spelling-entries")
        discard(entries)
        small = marked.filter(~F.col("cut")).drop("cut")
        done = small if done is None else done.union(small)
        entries = materialize(_halves(marked.filter("cut")), "spelling-entries")


# -- verification


def _codes(words: list[str], start: int, end: int) -> np.ndarray:
    """Code points between start and end (from behind) of words of one length, a row each."""
    return np.array([[ord(c) for c in w[start : len(w) - end]] for w in words], np.uint32)


def near_pairs(short: list[str], long: list[str], i: int, j: int) -> Iterator[tuple[int, int, bool]]:
    """(index of a short word, index of the other, whether that is a long one) of the pairs that a block owns."""
    if not short:
        return
    a = _codes(short, i, j)
    m = a.shape[1]
    rows = max(1, (1 << 20) // max(1, len(short) * m))
    for at in range(0, len(short), rows):
        part = a[at : at + rows]
        x, y = np.nonzero((part[:, None, :] != a[None, :, :]).sum(2) == 1)
        yield from ((int(p) + at, int(q), False) for p, q in zip(x, y, strict=True) if p + at < q)
    if not long:
        return
    b = _codes(long, i, j)
    rows = max(1, (1 << 20) // max(1, len(long) * m))
    for at in range(0, len(short), rows):
        part = a[at : at + rows, None, :]
        prefix = np.cumprod(part == b[None, :, :m], axis=2, dtype=np.uint8).sum(2, dtype=np.int64)
        suffix = np.cumprod((part == b[None, :, 1:])[:, :, ::-1], axis=2, dtype=np.uint8).sum(2, dtype=np.int64)
        near = prefix + suffix >= m
        if j:  # a first difference at or behind the right part is another block's
            near &= prefix < m
        x, y = np.nonzero(near)
        yield from ((int(p) + at, int(q), True) for p, q in zip(x, y, strict=True))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, near, near_n), both ways, of entries that come in the order of their blocks."""
    out: list[tuple] = []
    key, head, block = None, None, []

    def emit():
        size, i, j = head
        short, long = [w for w in block if len(w[0]) == size], [w for w in block if len(w[0]) > size]
        for p, q, longer in near_pairs([w for w, _ in short], [w for w, _ in long], i, j):
            x, y = short[p], (long if longer else short)[q]
            out.append((*x, *y))
            out.append((*y, *x))

    def flush():
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        types = [pa.string(), pa.int64()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["word", "n", "near", "near_n"])

    for batch in batches:
        for k, size, i, j, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != key:
                if len(block) > 1:
                    emit()
                key, head, block = k, (size, i, j), []
                if len(out) > 50_000:
                    yield flush()
                    out.clear()
            block.append((word, n))
    if len(block) > 1:
        emit()
    yield flush()


def neighbours(words: DataFrame, config: SpellingConfig) -> DataFrame:
    """(word, n, near, near_n): every pair of words one edit apart, in both directions, once."""
    blocks = small_blocks(words, config).select("key", "size", "i", "j", "word", "n")
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartitionByRange(parts, "key").sortWithinPartitions("key").mapInArrow(_scan, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows that form no circle: the last of each word's forms, by doubling."""
    state = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = state.select(F.col("word").alias("w"), F.col("root").alias("next"))
        moved = materialize(state.join(ahead, F.col("root") == F.col("w"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        discard(state)
        state = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return state


def variants(docs: DataFrame, config: SpellingConfig = SpellingConfig()) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every frequent word of docs.

    Near words differ by one inserted, deleted or replaced code point. A word's form is its most
    frequent near word (ties: the smallest), if that is `ratio` times as frequent as the word;
    root is the last of the forms from the word on, or the word itself.

    A null or empty text has no words; a null doc_id is hashed as no digits; repeated rows count
    each. Other columns are not read. Without words the result is empty.
    """
    with scratch(docs.sparkSession):
        words = materialize(word_counts(docs, config), "spelling-words")
        best: Column = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
        near = neighbours(words, config).groupBy(F.col("word").alias("w")).agg(F.count("*").alias("n_near"), best.alias("best"))
        form = F.when(-F.col("best.n") >= config.ratio * F.col("n"), F.col("best"))
        found = words.join(near, F.col("word") == F.col("w"), "left").withColumn("form", form)
        found = materialize(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("form.word").alias("form"), (-F.col("form.n")).alias("form_n")), "spelling-forms")
        last = roots(found.filter("form IS NOT NULL")).select(F.col("word").alias("w"), "root")
        whole = found.join(last, F.col("word") == F.col("w"), "left").withColumn("root", F.coalesce("root", "word")).drop("w")
        return materialize(whole.select("word", "form", "root", "n", "n_near", "form_n"), "spelling", keep=True)
