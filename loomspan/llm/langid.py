"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's vector is the mean embedding of its hashed byte n-grams inside words; a
linear softmax over it gives the language. Embeddings and weights are trained by
stochastic gradient descent in numpy on a bounded sample of labelled documents, and a
temperature and a rejection threshold are calibrated on a part of that sample kept
out of training. Prediction covers every whole text, partition by partition.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LangConfig:
    """`sample_docs` bounds the labelled documents that are fitted on (expected number,
    drawn by hash of their id), and `sample_chars` the length of each: longer ones are not
    drawn. `buckets` is a power of two."""

    sample_docs: int = 4000
    sample_chars: int = 20_000
    buckets: int = 1 << 15
    dim: int = 16
    orders: tuple[int, ...] = (2, 4)
    epochs: int = 4
    rate: float = 0.5
    calibration_share: float = 0.2
    rejection_precision: float = 0.99
    seed: int = 17


LETTER = regex.compile(r"\p{L}")
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32


def subwords(text: str, config: LangConfig) -> np.ndarray:
    """Bucket of every byte n-gram that has no white space inside; one space at an end
    marks a word's begin or end. A-Z are folded to a-z."""
    raw = np.frombuffer(b" " + text.encode("utf-8", "surrogatepass") + b" ", np.uint8)
    raw = _FOLD[raw]
    space = raw == 32
    x = raw.astype(np.uint32)
    found = []
    for n in config.orders:
        m = len(x) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        inner = np.zeros(m, bool)
        for i in range(n):
            h = (h ^ x[i : i + m]) * np.uint32(0x01000193)
            if 0 < i < n - 1:
                inner |= space[i : i + m]
        inner |= space[:m] & space[n - 1 :]
        h ^= h >> np.uint32(15)
        found.append((h & np.uint32(config.buckets - 1))[~inner])
    return np.concatenate(found) if found else np.empty(0, np.uint32)


@dataclass
class LangModel:
    """`table` holds each bucket's contribution to the logits: embeddings times weights."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    config: LangConfig

    def logits(self, text: str) -> np.ndarray:
        grams = subwords(text, self.config)
        if not len(grams):
            return self.bias
        counts = np.bincount(grams, minlength=self.config.buckets) if len(grams) > self.config.buckets else None
        total = counts @ self.table if counts is not None else self.table[grams].sum(axis=0)
        return total / len(grams) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, accepted); `und` without a letter."""
        if not text or not self.langs or LETTER.search(text) is None:
            return "und", 0.0, False
        z = self.logits(text).astype(np.float64) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.langs[best], float(p[best]), bool(p[best] >= self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit(samples: list[tuple[str, str]], config: LangConfig) -> LangModel:
    """Train on (text, lang) pairs. Without pairs the model says `und` to everything."""
    langs = sorted({lang for _, lang in samples})
    if not langs:
        return LangModel([], np.zeros((config.buckets, 0), np.float32), np.zeros(0), 1.0, 1.0, config)
    rng = np.random.default_rng(config.seed)
    made = []
    for text, lang in samples:
        ids, n = np.unique(subwords(text, config), return_counts=True)
        if len(ids):
            made.append((ids, (n / n.sum()).astype(np.float32), langs.index(lang)))
    order = rng.permutation(len(made))
    held = max(1, int(len(made) * config.calibration_share)) if len(made) > 4 else 0
    test, train = [made[i] for i in order[:held]], [made[i] for i in order[held:]]
    emb = rng.normal(0, 1 / config.dim, (config.buckets, config.dim)).astype(np.float32)
    w = np.zeros((config.dim, len(langs)), np.float32)
    bias = np.zeros(len(langs), np.float32)
    steps, step = max(1, config.epochs * len(train)), 0
    for _ in range(config.epochs):
        for i in rng.permutation(len(train)):
            ids, share, y = train[i]
            v = share @ emb[ids]
            g = _softmax(v @ w + bias)
            g[y] -= 1
            rate = np.float32(config.rate * (1 - step / steps))
            back = w @ g
            w -= rate * np.outer(v, g)
            bias -= rate * 0.1 * g
            emb[ids] -= rate * len(ids) ** 0.5 * share[:, None] * back
            step += 1
    model = LangModel(langs, emb @ w, bias, 1.0, 0.0, config)
    return calibrate(model, test)


def calibrate(model: LangModel, test: list[tuple[np.ndarray, np.ndarray, int]]) -> LangModel:
    """Set the temperature by held-out likelihood, and the lowest threshold above which
    held-out precision reaches the configured one."""
    if not test:
        return model
    z = np.array([share @ model.table[ids] + model.bias for ids, share, _ in test], np.float64)
    y = np.array([label for _, _, label in test])

    def probabilities(t: float) -> np.ndarray:
        e = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return e / e.sum(axis=1, keepdims=True)

    def loss(t: float) -> float:
        return float(-np.log(probabilities(t)[np.arange(len(y)), y] + 1e-12).mean())

    model.temperature = min(np.geomspace(0.1, 10, 41).tolist(), key=loss)
    p = probabilities(model.temperature)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top)
    precision = np.cumsum(right[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(precision >= model.config.rejection_precision)
    model.threshold = float(top[order[good[-1]]]) if len(good) else 1.0
    return model


def draw_limit(total: int, config: LangConfig) -> int:
    """63-bit hashes up to this are drawn, of `total` labelled documents."""
    return min((1 << 63) - 1, (1 << 63) * config.sample_docs // max(total, 1))


def train(labelled: DataFrame, config: LangConfig = LangConfig()) -> LangModel:
    """Fit on labelled (doc_id, text, lang) rows with text and lang; at most about
    `config.sample_docs` of them reach the driver, drawn by hash. Repeated rows of one doc_id
    are drawn together. Empty texts are fitted on like others; without any row all
    predictions are `und`."""
    rows = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") <= config.sample_chars))
    total = labelled.filter(F.col("lang").isNotNull()).count()
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(config.seed), "doc_id"), 1) <= F.lit(draw_limit(total, config))
    sample = rows.filter(draw).select("doc_id", "text", "lang").toArrow().to_pylist()
    sample.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], r["lang"], r["text"]))
    return fit([(r["text"], r["lang"]) for r in sample], config)


def predict(docs: DataFrame, model: LangModel) -> DataFrame:
    """doc_id, lang_pred, score, accepted for each row of docs.

    A null text, and one without a letter, gets `und`, 0 and false. Only doc_id and text
    are read; repeated rows stay repeated; no shuffle.
    """

    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shipped.value
        for batch in batches:
            found = [m.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "accepted"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))
