"""Language-model scoring with a hashed maximum-entropy model.

Token counts cover every training document. Words fall into classes of about equal mass
by their count, so the most frequent classes have few words. A token's probability is
P(class | history) * P(word | class, history), and sums to 1 over all words and one unseen.
Both factors are maximum-entropy models over hashed features of the history: the word
before, the two words before, and the word before that with the nearer one skipped. The
second has weights for classes of at most `width` words. A larger class is cut into parts,
and they are, down to single words, each step with weights of its own, if the model is
`deep`; else a word has its smoothed share of it, whatever the history. So have the words
of the last class, which is that of all words outside the head.

Weights are trained by distributed gradient updates: documents are dealt to trainers by a
hash, each trainer runs AdaGrad steps over all its tokens from common weights, and the
trainers' changes are averaged, row by row, by how often each row was used. So the model does
not depend on how the input is partitioned. Scoring runs in sparse numpy batches. Counts of
frequent words, a bounded number, are shipped to the tasks; those of all others are joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.text import word_hashes, words
from loomspan.session import materialize, scratch


@dataclass(frozen=True)
class LmConfig:
    """`head_words` bounds the words whose counts are shipped to tasks. Weight rows are as many as
    one for `row_tokens` training tokens, from `least_rows` to `most_rows` (powers of two).
    A trainer has about `trainer_tokens` tokens. Each of `rounds` rounds uses every token of
    every training document once, `step_tokens` in a step. With `deep`, head words of larger classes are
    predicted from the history, too: by parts of parts of their class, `width` at most of each. Their
    steps are many, so the second factor then has `deep_rows` times as many rows, `most_rows` at most."""

    head_words: int = 200_000
    classes: int = 32
    width: int = 32
    row_tokens: int = 4096
    least_rows: int = 1 << 12
    most_rows: int = 1 << 16
    trainer_tokens: int = 1 << 22
    step_tokens: int = 2048
    rounds: int = 1
    rate: float = 0.1
    deep: bool = False
    deep_rows: int = 16

    def rows(self, tokens: int) -> int:
        return max(self.least_rows, min(self.most_rows, 1 << max(tokens // self.row_tokens - 1, 0).bit_length()))

    def word_rows(self, tokens: int) -> int:
        return min(self.most_rows, self.rows(tokens) * self.deep_rows) if self.deep else self.rows(tokens)


#: Tokens' hashes that are no word's: the end of a document, and what stands before its begin.
END = np.uint64(0x9AE16A3B2F90404F)
START = np.uint64(0xC3A5C85C97CB3127)
BLOCK_ROWS = 512
#: Tokens taken at once, unless one text has more.
BATCH_TOKENS = 1 << 16
LOG10 = math.log(10)


def tokens(text: str | None) -> np.ndarray:
    """Hashes of a whole text's lower-cased words and one end."""
    return np.append(word_hashes(words(text, lower=True)), END)


def token_batches(texts) -> Iterator[list[np.ndarray]]:
    """Tokens of consecutive texts (an Arrow column), about BATCH_TOKENS at a time."""
    held, total = [], 0
    for text in texts:
        held.append(tokens(text.as_py()))
        total += len(held[-1])
        if total >= BATCH_TOKENS:
            yield held
            held, total = [], 0
    if held:
        yield held


def count_tokens(docs: DataFrame) -> DataFrame:
    """(h, c): occurrences of each distinct token of all texts; summed in each batch first."""

    def flush(held):
        h, c = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=["h", "c"])

    def run(batches):
        held, total = [], 0
        for batch in batches:
            for some in token_batches(batch.column(0)):
                held += some
                total += sum(map(len, some))
                if total >= 16 * BATCH_TOKENS:
                    yield flush(held)
                    held, total = [], 0
        if held:
            yield flush(held)

    return docs.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Head words sorted by hash, with counts, classes and places within their classes; the
    last class holds all others. `shares` has the log shares of the words of each class of
    at most `width` words; `narrow` tells which classes these are. In a deep vocabulary a word of a
    larger class has a path from `begins` on: at each of its `nodes`, numbered from the classes
    on, it is among the words of one of the `branches`; `shares` has rows for nodes, too."""

    total: int
    distinct: int
    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    log_mass: np.ndarray
    places: np.ndarray
    shares: np.ndarray
    narrow: np.ndarray
    begins: np.ndarray | None = None
    nodes: np.ndarray | None = None
    branches: np.ndarray | None = None

    @property
    def n_classes(self) -> int:
        return len(self.log_mass)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the head, whether it is there) of each token."""
        if not len(self.hashes):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return at, self.hashes[at] == h

    def targets(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class, place within it, place in the head or -1) of each token."""
        at, known = self.find(h)
        y, place = np.full(len(h), self.n_classes - 1), np.zeros(len(h), np.int64)
        y[known], place[known] = self.classes[at[known]], self.places[at[known]]
        return y, place, np.where(known, at, -1)


#: The log share of a word that a class does not have.
ABSENT = np.float32(-1e4)


def make_vocabulary(total: int, distinct: int, h: np.ndarray, c: np.ndarray, classes: int, width: int) -> Vocabulary:
    """Classes of about equal mass for head words h with counts c; equal counts, one class."""
    order = np.lexsort((h, -c))
    mass = np.cumsum(c[order] + 0.5)
    rank = np.minimum(((mass - (c[order] + 0.5)) / mass[-1] * (classes - 1)).astype(np.int64), classes - 2) if len(h) else np.empty(0, np.int64)
    rank = np.maximum.accumulate(np.where(np.r_[True, np.diff(c[order]) != 0], rank, 0)) if len(h) else rank
    label = np.empty(len(h), np.int64)
    label[order] = np.unique(rank, return_inverse=True)[1]
    by_hash = np.argsort(h)
    h, c, label = h[by_hash], c[by_hash], label[by_hash]
    sizes = np.bincount(label, c + 0.5)
    others = total + 0.5 * (distinct + 1) - sizes.sum()
    words_of = np.bincount(label, minlength=len(sizes))
    grouped = np.argsort(label, kind="stable")
    places = np.empty(len(h), np.int64)
    places[grouped] = np.arange(len(h)) - np.repeat(np.cumsum(words_of) - words_of, words_of)
    narrow = np.append(words_of <= width, False)
    shares = np.full((len(narrow), width), ABSENT)
    mine = narrow[label] if len(h) else np.empty(0, bool)
    shares[label[mine], places[mine]] = np.log((c[mine] + 0.5) / sizes[label[mine]])
    return Vocabulary(total, distinct, h, c, label, np.log(np.append(sizes, others)), places, shares, narrow)


def deepen(v: Vocabulary, width: int) -> Vocabulary:
    """v with paths for the head words of its larger classes: a class of more than `width` words is cut into that many
    parts of about equal mass, and so are its parts, down to single words."""
    paths: list[list[tuple[int, int]]] = [[] for _ in range(len(v.hashes))]
    shares, todo = [], []
    for k in np.flatnonzero(~v.narrow[:-1]).tolist():
        mine = np.flatnonzero(v.classes == k)
        todo.append(mine[np.lexsort((v.hashes[mine], -v.counts[mine]))])
    while todo:
        mine = todo.pop()
        mass = v.counts[mine] + 0.5
        before = np.cumsum(mass) - mass
        part = np.arange(len(mine)) if len(mine) <= width else np.minimum(before / mass.sum() * width, width - 1).astype(np.int64)
        part = np.unique(part, return_inverse=True)[1]
        row = np.full(width, ABSENT, np.float32)
        row[: part[-1] + 1] = np.log(np.bincount(part, mass) / mass.sum())
        node = v.n_classes + len(shares)
        shares.append(row)
        for w, x in zip(mine.tolist(), part.tolist(), strict=True):
            paths[w].append((node, x))
        cuts = np.flatnonzero(np.diff(part)) + 1
        todo += [x for x in np.split(mine, cuts) if len(x) > 1]
    lengths = np.array([len(x) for x in paths], np.int64)
    flat = np.array([x for path in paths for x in path], np.int64).reshape(-1, 2)
    begins = np.append(0, np.cumsum(lengths))
    return replace(v, shares=np.vstack([v.shares, *shares]).astype(v.shares.dtype), begins=begins, nodes=flat[:, 0].astype(np.int32), branches=flat[:, 1].astype(np.int32))


def build_vocabulary(counts: DataFrame, config: LmConfig) -> Vocabulary:
    """Choose the head by a count threshold, from a histogram over logarithmic count bins."""
    bins = counts.groupBy(F.floor(F.log2(F.col("c").cast("double")) * 16).alias("b")).agg(F.count("*").alias("words"), F.sum("c").alias("c"), F.min("c").alias("least")).collect()
    bins.sort(key=lambda r: -r["b"])
    total, distinct = sum(r["c"] for r in bins), sum(r["words"] for r in bins)
    least, n = None, 0
    for r in bins:
        if n + r["words"] > config.head_words:
            break
        n, least = n + r["words"], r["least"]
    if least is None:
        return make_vocabulary(total, distinct, np.empty(0, np.uint64), np.empty(0, np.int64), config.classes, config.width)
    head = counts.filter(F.col("c") >= least).toArrow()
    found = make_vocabulary(total, distinct, head["h"].to_numpy().view(np.uint64), head["c"].to_numpy(), config.classes, config.width)
    return deepen(found, config.width) if config.deep else found


# -- features and factors


def feature_hashes(h: np.ndarray) -> np.ndarray:
    """Three hashes for each token of a text: the word before, the two before, the one but last."""
    one = np.concatenate(([START], h[:-1]))
    two = np.concatenate(([START, START], h[:-2]))[: len(h)]
    k = np.uint64(0x9E3779B97F4A7C15)
    return np.stack((one * k, (one * k + two) * np.uint64(0xC2B2AE3D27D4EB4F), (two ^ k) * np.uint64(0x165667B19E3779F9)))


def weight_rows(hashes: np.ndarray, rows: int, classes: np.ndarray | None = None) -> np.ndarray:
    """The weight row of each feature hash; those of the second factor are of its class, too."""
    if classes is not None:
        hashes = (hashes ^ (classes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xFF51AFD7ED558CCD)
    return (hashes >> np.uint64(64 - rows.bit_length() + 1)).astype(np.int64)


def log_softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Log probabilities of each token's outcomes, from three weight rows and a bias row each."""
    z = weights[rows[0]]
    z += weights[rows[1]]
    z += weights[rows[2]]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


@dataclass
class Model:
    """Weights of the two factors, one row for each hashed feature, and the first one's bias."""

    classes: np.ndarray
    words: np.ndarray
    bias: np.ndarray
    vocabulary: Vocabulary

    def factors(self, held: list[np.ndarray]):
        """For each factor: weights, bias rows, feature rows, outcomes, and which tokens it is for. After the
        first one come those of words in narrow classes, then those of each step of deep words' paths."""
        v = self.vocabulary
        y, place, head = v.targets(np.concatenate(held))
        f = np.concatenate([feature_hashes(h) for h in held], axis=1)
        yield self.classes, self.bias, weight_rows(f, len(self.classes)), y, None
        at = np.flatnonzero(v.narrow[y])
        if len(at):
            yield self.words, v.shares[y[at]], weight_rows(f[:, at], len(self.words), y[at]), place[at], at
        if v.begins is None:
            return
        at = np.flatnonzero(head >= 0)
        step, end = v.begins[head[at]], v.begins[head[at] + 1]
        while (on := step < end).any():
            at, step, end = at[on], step[on], end[on]
            yield self.words, v.shares[v.nodes[step]], weight_rows(f[:, at], len(self.words), v.nodes[step]), v.branches[step], at
            step = step + 1


def gradient_steps(texts, model: Model, config: LmConfig) -> list[np.ndarray]:
    """AdaGrad over all tokens of the texts (Arrow columns), in place; returns how often each row
    of each factor was used. A step's tokens lie apart, so that it sees many texts."""
    weights = (model.classes, model.words)
    used = [np.zeros(len(w), np.int64) for w in weights]
    seen = [np.full(len(w), 1e-2, np.float32) for w in weights]

    def step(k, bias, rows, y):
        n = len(y)
        g = np.exp(log_softmax(weights[k], bias, rows))
        g[np.arange(n), y] -= 1
        flat = rows.reshape(-1).astype(np.uint16)  # 16 bits sort fastest; most_rows allows for it
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        at = flat[first].astype(np.int64)
        sums = np.add.reduceat(g[order % n], first, axis=0)
        total = seen[k][at] + np.einsum("ij,ij->i", sums, sums) / np.float32(sums.shape[1])
        seen[k][at] = total
        sums *= (np.float32(config.rate) / np.sqrt(total))[:, None]
        weights[k][at] -= sums
        used[k][at] += np.diff(np.append(first, len(flat)))

    for column in texts:
        for held in token_batches(column):
            for weights_of, bias, rows, y, _ in model.factors(held):
                k = int(weights_of is model.words)
                apart = -(-len(y) // config.step_tokens)
                for i in range(apart):
                    step(k, bias if bias.ndim == 1 else bias[i::apart], rows[:, i::apart], y[i::apart])
    return used


def by_trainer(batches) -> Iterator[tuple[int, pa.Array]]:
    """(trainer, texts) of batches (trainer, text) in the order of trainers."""
    for batch in batches:
        who = batch.column(0).to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(who)) + 1).tolist(), len(who)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            if b > a:
                yield int(who[a]), batch.column(1).slice(a, b - a)


def train(docs: DataFrame, vocabulary: Vocabulary, config: LmConfig) -> Model:
    """The model after `config.rounds` rounds of local steps and averaging.

    A trainer takes its documents in the order of their ids and texts. Its changes travel in
    blocks of rows, and are added up in two levels, each of about the square root of the
    number of trainers.
    """
    if config.most_rows > 1 << 16:
        raise ValueError("weight rows are numbered by 16 bits")
    sc = docs.sparkSession.sparkContext
    rows = config.rows(vocabulary.total)
    bias = (vocabulary.log_mass - np.logaddexp.reduce(vocabulary.log_mass)).astype(np.float32)
    model = Model(np.zeros((rows, vocabulary.n_classes), np.float32), np.zeros((config.word_rows(vocabulary.total), config.width), np.float32), bias, vocabulary)
    if vocabulary.n_classes == 1:
        return model
    trainers = 1 + vocabulary.total // config.trainer_tokens
    trainer = F.pmod(F.xxhash64("doc_id", "text"), F.lit(trainers)).cast("int").alias("trainer")
    # Trainers, not partitions, make the model: however many there are, each trainer's changes are sent once.
    dealt = docs.select(trainer, "doc_id", "text").repartitionByRange(trainers, "trainer").sortWithinPartitions("trainer", "doc_id", "text").select("trainer", "text")
    schema = "factor int, block int, change binary, used binary"

    def sums(dtype):
        def run(key, group):
            change = sum(np.frombuffer(x, dtype).astype(np.float64) for x in group["change"].to_pylist())
            used = sum(np.frombuffer(x, np.int64) for x in group["used"].to_pylist())
            return pa.table({"factor": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()), "change": pa.array([change.tobytes()]), "used": pa.array([used.tobytes()])})

        return run

    for _ in range(config.rounds):
        common = sc.broadcast(model)

        def trained(start, texts):
            mine = Model(start.classes.copy(), start.words.copy(), start.bias, start.vocabulary)
            used = gradient_steps(texts, mine, config)
            for factor, (now, before, n) in enumerate(((mine.classes, start.classes, used[0]), (mine.words, start.words, used[1]))):
                blocks = [b for b in range(0, len(n), BLOCK_ROWS) if n[b : b + BLOCK_ROWS].any()]
                change = (now - before) * n[:, None]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([factor] * len(blocks), pa.int32()),
                        pa.array(blocks, pa.int32()),
                        pa.array([change[b : b + BLOCK_ROWS].astype(np.float32).tobytes() for b in blocks], pa.binary()),
                        pa.array([n[b : b + BLOCK_ROWS].tobytes() for b in blocks], pa.binary()),
                    ],
                    names=["factor", "block", "change", "used"],
                )

        def local(batches, common=common):
            for _, group in groupby(by_trainer(batches), key=lambda x: x[0]):
                yield from trained(common.value, (texts for _, texts in group))

        parts = dealt.mapInArrow(local, schema).withColumn("salt", F.spark_partition_id() % max(1, math.isqrt(trainers)))
        first = parts.groupBy("factor", "block", "salt").applyInArrow(sums(np.float32), schema)
        for row in first.groupBy("factor", "block").applyInArrow(sums(np.float64), schema).collect():
            weights = (model.classes, model.words)[row["factor"]]
            used = np.frombuffer(row["used"], np.int64)
            mean = np.frombuffer(row["change"]).reshape(len(used), -1) / np.maximum(used, 1)[:, None]
            weights[row["block"] : row["block"] + len(used)] += mean.astype(np.float32)
        common.unpersist()
    return model


def score_texts(held: list[np.ndarray], model: Model):
    """For each text: tokens, head tokens, sum of ln(c + 0.5) over head tokens, what the model
    adds to the sum over all, and the other tokens' hashes with their counts."""
    v = model.vocabulary
    ends = np.cumsum([len(h) for h in held])
    starts = ends - [len(h) for h in held]
    h = np.concatenate(held)
    y, _, at = v.targets(h)
    known = at >= 0
    log_c = np.zeros(len(h))
    log_c[known] = np.log(v.counts[at[known]] + 0.5)
    shared = np.ones(len(h), bool)
    fitted = -v.log_mass[y]  # a word's smoothed share of its class: (c + 0.5) / mass
    for weights, bias, rows, target, mine in model.factors(held):
        got = np.empty(len(target))
        for i in range(0, len(target), 8192):
            z = log_softmax(weights, bias if bias.ndim == 1 else bias[i : i + 8192], rows[:, i : i + 8192])
            got[i : i + 8192] = z[np.arange(len(z)), target[i : i + 8192]]
        fitted[... if mine is None else mine] += got
        if mine is not None:  # in place of the share, which goes with a token's first such factor
            open_ = mine[shared[mine]]
            fitted[open_] += v.log_mass[y[open_]] - log_c[open_]
            shared[mine] = False
    head = np.add.reduceat(known.astype(np.int64), starts)
    rest = [np.unique(x[~known[a:b]], return_counts=True) for x, a, b in zip(held, starts.tolist(), ends.tolist(), strict=True)]
    return ends - starts, head, np.add.reduceat(log_c, starts), np.add.reduceat(fitted, starts), rest


def score(docs: DataFrame, training: DataFrame, config: LmConfig = LmConfig()) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for each row of docs.

    Learned from the texts of `training`. A null text is empty: its one token is the end.
    Repeated rows are scored and, in training, counted each. Without training rows all
    tokens are unseen and both scores are 0. Only doc_id and text are read. The result is
    stored; all tables on the way to it are deleted.
    """
    with scratch(docs.sparkSession):
        return materialize(_score(docs, training, config), "lm-scores", keep=True)


def _score(docs: DataFrame, training: DataFrame, config: LmConfig) -> DataFrame:
    spark = docs.sparkSession
    counts = materialize(count_tokens(training), "lm-counts")
    vocabulary = build_vocabulary(counts, config)
    model = spark.sparkContext.broadcast(train(training, vocabulary, config))

    def run(batches):
        for batch in batches:
            first = 0
            for held in token_batches(batch.column(1)):
                n, head, log_c, fitted, rest = score_texts(held, model.value)
                ids = batch.column(0).slice(first, len(held))
                first += len(held)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(n.astype(np.int64)),
                        pa.array(head),
                        pa.array(log_c),
                        pa.array(fitted),
                        pa.array([x[0].view(np.int64) for x in rest], pa.list_(pa.int64())),
                        pa.array([x[1].astype(np.int32) for x in rest], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "n_tokens", "head", "log_c", "fitted", "rest", "times"],
                )

    mapped = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, head long, log_c double, fitted double, rest array<long>, times array<int>")
    parts = materialize(mapped.withColumn("rid", F.monotonically_increasing_id()), "lm-parts")
    found = parts.select("rid", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("rid", F.col("x.rest").alias("token"), F.col("x.times").alias("times"))
    joined = found.join(counts, F.col("token") == F.col("h"), "left")
    others = joined.groupBy(F.col("rid").alias("r")).agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).cast("long").alias("other_known"),
        F.sum(F.col("times") * F.ln(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("other_log_c"),
    )
    log_c = F.col("log_c") + F.coalesce("other_log_c", F.lit(0.0))
    norm = math.log(vocabulary.total + 0.5 * (vocabulary.distinct + 1))
    return parts.join(others, F.col("rid") == F.col("r"), "left").select(
        "doc_id",
        "n_tokens",
        (F.col("head") + F.coalesce("other_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        ((log_c - F.col("n_tokens") * F.lit(norm)) / F.lit(LOG10)).alias("base_score"),
        ((log_c + F.col("fitted")) / F.lit(LOG10)).alias("score"),
    )
