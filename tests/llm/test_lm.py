import math
from collections import Counter

import numpy as np
import pytest

from loomspan.llm import lm
from loomspan.llm.text import words

CONFIG = lm.LmConfig(head_words=150, classes=8, width=6, least_rows=1 << 8)


def base(rows):
    c = Counter()
    for r in rows:
        c.update([*words(r[1], lower=True), b" end"])
    return c


def test_base_score_is_exact(docs, rows, repeated):
    for frame, table in ((docs, rows), (repeated, [tuple(r) for r in repeated.collect()])):
        c = base(table)
        n, v = sum(c.values()), len(c)
        want = sorted(
            (str(r[0]), len(t), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for r in table for t in [[*words(r[1], lower=True), b" end"]]
        )
        got = lm.score(frame, frame, CONFIG).collect()
        assert sorted((str(r["doc_id"]), r["n_tokens"], round(r["base_score"], 6)) for r in got) == want
        assert {r["train_tokens"] for r in got} == {n} and all(r["n_known"] == r["n_tokens"] for r in got)


def trained(docs):
    counts = lm.count_tokens(docs)
    vocabulary = lm.build_vocabulary(counts, CONFIG)
    return counts, vocabulary, lm.train(docs, vocabulary, CONFIG)


def test_probabilities_sum_to_one(docs):
    counts, vocabulary, model = trained(docs)
    f = lm.weight_rows(lm.feature_hashes(np.arange(5, dtype=np.uint64)), len(model.classes))
    assert np.exp(lm.log_softmax(model.classes, model.bias, f)).sum(axis=1) == pytest.approx(np.ones(5), abs=1e-4)
    assert vocabulary.narrow.any() and not vocabulary.narrow.all()
    for c in np.flatnonzero(vocabulary.narrow):
        p = np.exp(lm.log_softmax(model.words, vocabulary.shares[[c] * 5], f % len(model.words)))
        n = (vocabulary.classes == c).sum()
        assert p[:, :n].sum(axis=1) == pytest.approx(np.ones(5), abs=1e-4) and (p[:, n:] < 1e-6).all()
    inside = np.bincount(vocabulary.classes, vocabulary.counts + 0.5, vocabulary.n_classes)
    rest = counts.count() - len(vocabulary.counts)
    others = vocabulary.total - vocabulary.counts.sum() + 0.5 * (rest + 1)
    assert np.exp(vocabulary.log_mass) == pytest.approx(inside + np.r_[np.zeros(vocabulary.n_classes - 1), others])


def test_scores_are_those_of_the_weights(docs, rows):
    """Token by token, from the trained weights."""
    counts, v, model = trained(docs)
    c = {r["h"] & (1 << 64) - 1: r["c"] for r in counts.collect()}
    want = {}
    for r in rows:
        h, total = lm.tokens(r[1]), 0.0
        f = lm.feature_hashes(h)
        for i, token in enumerate(h.tolist()):
            at = {x: k for k, x in enumerate(v.hashes.tolist())}.get(token)
            y = v.n_classes - 1 if at is None else int(v.classes[at])
            z = sum(model.classes[k].astype(float) for k in lm.weight_rows(f[:, i], len(model.classes))) + model.bias
            total += z[y] - np.log(np.exp(z).sum())
            if v.narrow[y]:
                z = sum(model.words[k].astype(float) for k in lm.weight_rows(f[:, i], len(model.words), np.array([y]))) + v.shares[y]
                total += z[v.places[at]] - np.log(np.exp(z).sum())
            else:
                total += math.log(c.get(token, 0) + 0.5) - v.log_mass[y]
        want[r[0]] = total / math.log(10)
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, docs, CONFIG).collect()}
    assert got == {k: pytest.approx(x, abs=1e-3) for k, x in want.items()}


def test_scores_do_not_depend_on_partitions(docs):
    one, many = ({r["doc_id"]: r["score"] for r in lm.score(d, d, CONFIG).collect()} for d in (docs.coalesce(1), docs.repartition(9)))
    assert one == {k: pytest.approx(x, abs=1e-3) for k, x in many.items()}


def test_long_texts_and_many_tasks(spark):
    """A text of more tokens than a batch has, and sums of more tasks than one level adds up."""
    text = " ".join(f"w{i % 97}" for i in range(200_000))
    frame = spark.createDataFrame([(i, text if i == 3 else f"w{i} w{i + 1}") for i in range(60)], "doc_id long, text string").repartition(20)
    got = {r["doc_id"]: r for r in lm.score(frame, frame, lm.LmConfig(classes=8)).collect()}
    assert got[3]["n_tokens"] == 200_001 and got[3]["score"] > 0.7 * got[3]["base_score"]


def test_model_beats_counts_on_held_out_text(spark):
    rng = np.random.default_rng(3)
    pairs = {"a": "b", "b": "c", "c": "a", "x": "y", "y": "z", "z": "x"}

    def text():
        w = [rng.choice(list(pairs))]
        for _ in range(60):
            w.append(pairs[w[-1]] if rng.random() < 0.9 else rng.choice(list(pairs)))
        return " ".join(w)

    train = spark.createDataFrame([(i, text()) for i in range(200)], "doc_id long, text string")
    test = spark.createDataFrame([(i, text()) for i in range(50)], "doc_id long, text string")
    got = lm.score(test, train, lm.LmConfig(classes=8)).collect()
    assert sum(r["score"] for r in got) > 0.6 * sum(r["base_score"] for r in got)


def test_nothing_to_learn_from(docs, empty):
    assert lm.score(empty, empty, CONFIG).count() == 0
    got = lm.score(docs, empty, CONFIG).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and abs(r["base_score"]) < 1e-9 and abs(r["score"]) < 1e-9 for r in got)
