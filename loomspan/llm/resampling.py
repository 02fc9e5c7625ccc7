"""Importance resampling towards a target corpus, by hashed word features.

Every text becomes a stream of 16-bit buckets. Streams are written once, several documents
a row with the documents' offsets; counts come from sorted streams as run lengths, and
weights from gains gathered through the streams and summed between offsets.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.operators.relational import numbered
from loomspan.session import materialize, scratch


@dataclass(frozen=True)
class ResampleConfig:
    """`longest`: words of the longest feature. `buckets`: at most 65,536. Of the documents with
    `min_words`, `percent` in a hundred are drawn; `seed` stands in the hash behind each draw.
    A stored row ends with the document that brings it to `block` features."""

    longest: int = 1
    buckets: int = 10_000
    min_words: int = 20
    percent: int = 10
    seed: int = 2024
    block: int = 1 << 20

    def __post_init__(self):
        if not 0 < self.buckets <= 1 << 16:
            raise ValueError("buckets have to fit 16 bits")


#: A-Z to a-z; what is neither a letter, a digit nor above ASCII ends a word.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

STREAM = "doc_id array<bigint>, words array<bigint>, ends array<bigint>, buckets binary"


def feature_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of digits, letters and characters above ASCII, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def feature_buckets(words: list[bytes], config: ResampleConfig) -> np.ndarray:
    """Buckets of all runs of 1 to `longest` words, as uint16; repeats stay."""
    features = list(words)
    for size in range(2, config.longest + 1):
        features += [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    return (np.fromiter(map(zlib.crc32, features), np.uint32, len(features)) % np.uint32(config.buckets)).astype("<u2")


def pack(docs: DataFrame, config: ResampleConfig, id_col: str = "doc_id") -> DataFrame:
    """Packed streams of docs: rows of documents' ids and words, the ends of their features, and
    the buckets as little-endian uint16."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        words: list[int] = []
        parts: list[np.ndarray] = []
        held = 0

        def flush():
            ends = np.cumsum([len(p) for p in parts], dtype=np.int64).tolist()
            columns = [pa.array([ids], pa.list_(pa.int64())), pa.array([words], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())), pa.array([np.concatenate(parts).tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "words", "ends", "buckets"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = feature_words(text.as_py())
                ids.append(i)
                words.append(len(found))
                parts.append(feature_buckets(found, config))
                held += len(parts[-1])
                if held >= config.block or len(ids) >= 1 << 14:
                    yield flush()
                    ids, words, parts, held = [], [], [], 0
        if ids:
            yield flush()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), "text").mapInArrow(run, STREAM)


def run_lengths(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a stream and how often each is in it: sorted, then run-length encoded."""
    ordered = np.sort(buckets)
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)
    return ordered[starts], np.diff(np.r_[starts, len(ordered)])


def bucket_counts(streams: DataFrame, config: ResampleConfig) -> np.ndarray:
    """Features in each bucket. Each task merges its streams' runs, Spark sums up the tasks'; the
    driver gets one row a bucket, which `buckets` bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(config.buckets, np.int64)
        for batch in batches:
            for stream in batch.column(0):
                values, lengths = run_lengths(np.frombuffer(stream.as_buffer(), "<u2"))
                total[values] += lengths
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    counts = np.zeros(config.buckets, np.int64)
    for bucket, n in streams.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[bucket] = n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares of target and source, as integers."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    ratio = ((float(b) + 1) * (s + n) / ((float(a) + 1) * (t + n)) for a, b in zip(source.tolist(), target.tolist(), strict=True))
    return np.fromiter((math.floor(1000 * math.log(r)) for r in ratio), np.int64, n)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document in thousandths, from a hash of its id (a null id: of no digits)."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def summed(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the values between ends; 0 where nothing is between two."""
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    some = ends > starts
    out = np.zeros(len(ends), np.int64)
    if some.any():
        out[some] = np.add.reduceat(values, starts[some])
    return out


def score(streams: DataFrame, gain: np.ndarray, config: ResampleConfig) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document in the streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, words, ends, stream in zip(*batch.columns, strict=True):
                stops = np.asarray(ends.values)
                weight = summed(gain[np.frombuffer(stream.as_buffer(), "<u2")], stops)
                drawn = np.fromiter((noise(i, config.seed) for i in ids.as_py()), np.int64, len(stops))
                columns = [ids.values, words.values, pa.array(np.diff(np.r_[0, stops])), pa.array(weight), pa.array(weight + drawn)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight", "score"])

    return streams.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, config: ResampleConfig = ResampleConfig(), target_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of docs; rank is null where it is not drawn.

    Of N documents with at least min_words words, the floor(percent * N / 100) with the highest
    scores are drawn and ranked from 1; ties go to the smaller doc_id, then to fewer features.

    A null or empty text has no features and weight 0. A null doc_id is hashed as no digits and
    stands behind all others in a tie. Repeated rows are documents of their own, with equal
    weights and ranks next to each other. Other columns are not read. An empty table gives an
    empty result; an empty target gives each bucket a count of 0.
    """
    with scratch(docs.sparkSession):
        streams = materialize(pack(docs, config), "bucket-streams")
        gain = gains(bucket_counts(streams, config), bucket_counts(pack(target, config, target_id), config))
        scored = materialize(score(streams, gain, config), "resample-scores")
        enough = scored.filter(F.col("n_words") >= config.min_words)
        drawn = config.percent * enough.count() // 100
        placed = numbered(enough, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()], "place")
        ranked = placed.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place")))
        short = scored.filter(F.col("n_words") < config.min_words).withColumn("rank", F.lit(None).cast("long"))
        columns = ["doc_id", "n_features", "weight", "score", "rank"]
        return materialize(ranked.select(columns).union(short.select(columns)), "resampled", keep=True)
