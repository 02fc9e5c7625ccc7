import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loomspan.llm import resampling as rs


def plain(rows, target, config):
    """The same by plain counting: {doc_id: (n_features, weight, score, rank)}."""

    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return words, [" ".join(words[i : i + k]) for k in range(1, config.longest + 1) for i in range(len(words) - k + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % config.buckets
    s = Counter(bucket(f) for _, text in rows for f in features(text)[1])
    t = Counter(bucket(f) for _, text in target for f in features(text)[1])
    S, T, B = sum(s.values()), sum(t.values()), config.buckets
    found, enough = {}, []
    for i, text in rows:
        words, fs = features(text)
        weight = sum(math.floor(1000 * math.log((t[bucket(f)] + 1) * (S + B) / ((s[bucket(f)] + 1) * (T + B)))) for f in fs)
        h = int(hashlib.sha256(f"{config.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        found[i] = [len(fs), weight, score, None]
        if len(words) >= config.min_words:
            enough.append((-score, i is None, i or 0))
    for rank, (_, null, i) in enumerate(sorted(enough)[: config.percent * len(enough) // 100], 1):
        found[None if null else i][3] = rank
    return {i: tuple(v) for i, v in found.items()}


@pytest.mark.parametrize("config", [rs.ResampleConfig(), rs.ResampleConfig(longest=2, buckets=257, min_words=5, percent=50, block=40)])
def test_against_plain_counting(spark, docs, rows, config):
    target = [(i, text) for i, text, *_ in rows[::7]]
    got = rs.resample(docs, spark.createDataFrame(target, "item_id long, text string"), config, "item_id").collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == plain([r[:2] for r in rows], target, config)
    assert len(got) == len(rows) and any(r.rank for r in got)


def test_ties_repeats_nulls_and_a_very_long_text(spark):
    long = "Wort-teil straße " * 300_000
    rows = [(i, "a b c d e f") for i in (7, 3, 3, None)] + [(1, long), (2, None), (4, "")]
    config = rs.ResampleConfig(min_words=5, percent=100)
    got = rs.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, "a")], "doc_id long, text string"), config).collect()
    assert sorted(r.rank for r in got if r.rank) == [1, 2, 3, 4, 5] and len({(r.weight, r.score) for r in got if r.doc_id == 3}) == 1
    threes = sorted(r.rank for r in got if r.doc_id == 3)
    assert threes[1] == threes[0] + 1
    assert {r.doc_id: (r.n_features, r.rank) for r in got if r.doc_id in (2, 4)} == {2: (0, None), 4: (0, None)}
    assert next(r for r in got if r.doc_id == 1).n_features == 900_000


def test_empty_tables(spark, empty, docs, rows):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert rs.resample(empty, docs).count() == 0
    got = rs.resample(docs, none).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == plain([r[:2] for r in rows], [], rs.ResampleConfig())


def test_run_lengths_and_sums():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 50, 1000).astype("<u2")
    values, lengths = rs.run_lengths(x)
    assert dict(zip(values.tolist(), lengths.tolist(), strict=True)) == Counter(x.tolist())
    ends = np.array([0, 0, 10, 10, 1000, 1000])
    assert rs.summed(x.astype(np.int64), ends).tolist() == [0, 0, x[:10].sum(), 0, x[10:].sum(), 0]
    assert rs.run_lengths(x[:0])[0].size == 0 and rs.summed(x[:0].astype(np.int64), ends[:0]).size == 0


def test_buckets_fit_16_bits():
    with pytest.raises(ValueError):
        rs.ResampleConfig(buckets=1 << 17)
