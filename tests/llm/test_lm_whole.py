import numpy as np
import pyarrow as pa

from loomspan.llm import lm


def test_defaults_take_a_gradient_at_every_token():
    """Long, short and one-token texts, with the production defaults."""
    config = lm.LmConfig()
    texts = ["a b c d e f g h i j k l m n o p q", "x y z", "", None, "one"] + [f"w{i} w{i + 1}" for i in range(700)]
    h, c = np.unique(np.concatenate([lm.tokens(t) for t in texts]), return_counts=True)
    v = lm.make_vocabulary(int(c.sum()), len(h), h, c, config.classes, config.width)
    rows = config.rows(v.total)
    model = lm.Model(np.zeros((rows, v.n_classes), np.float32), np.zeros((rows, config.width), np.float32), np.zeros(v.n_classes, np.float32), v)
    used = lm.gradient_steps([pa.array(texts)], model, config)
    want = [np.zeros(rows, np.int64), np.zeros(rows, np.int64)]
    for t in texts:
        f, (y, _, _) = lm.feature_hashes(lm.tokens(t)), v.targets(lm.tokens(t))
        np.add.at(want[0], lm.weight_rows(f, rows).reshape(-1), 1)
        mine = v.narrow[y]
        np.add.at(want[1], lm.weight_rows(f[:, mine], rows, y[mine]).reshape(-1), 1)
    assert (used[0] == want[0]).all() and (used[1] == want[1]).all() and want[1].any()


def test_defaults_learn_from_short_texts(spark):
    """Texts of two words: the second is certain from the first."""
    pairs = [("a", "b"), ("c", "d"), ("e", "f"), ("g", "h")]
    rows = [(i, " ".join(pairs[i % 4])) for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = lm.score(frame, frame).collect()
    assert sum(r["score"] for r in got) > 0.7 * sum(r["base_score"] for r in got)


def deep_vocabulary(width=4, words=300):
    rng = np.random.default_rng(5)
    h, c = np.unique(rng.integers(1, 1 << 62, words).astype(np.uint64)), rng.integers(1, 9, words)
    v = lm.make_vocabulary(int(c.sum()), words, h, c, 8, width)
    return v, lm.deepen(v, width)


def test_deep_paths_lead_to_single_words():
    """Every head word of a larger class has a path of its own, and its shares multiply to the word's of its class."""
    v, d = deep_vocabulary()
    inside = np.bincount(v.classes, v.counts + 0.5)
    paths = [tuple(zip(d.nodes[a:b].tolist(), d.branches[a:b].tolist(), strict=True)) for a, b in zip(d.begins, d.begins[1:], strict=False)]
    wide = [i for i in range(len(paths)) if not v.narrow[v.classes[i]]]
    assert len(wide) > 100 and len({paths[i] for i in wide}) == len(wide) and max(map(len, paths)) > 2
    assert all(bool(paths[i]) == (i in set(wide)) for i in range(len(paths)))
    for i in wide:
        assert np.isclose(sum(float(d.shares[n, x]) for n, x in paths[i]), np.log((v.counts[i] + 0.5) / inside[v.classes[i]]), atol=1e-4)


def test_deep_probabilities_sum_to_one():
    """Over all words after one history, with weights of any kind; a batch takes a gradient at each step of each path."""
    v, d = deep_vocabulary()
    rng = np.random.default_rng(6)
    model = lm.Model(rng.normal(size=(256, v.n_classes)).astype(np.float32), rng.normal(size=(256, 4)).astype(np.float32), v.log_mass.astype(np.float32), d)
    texts = [np.array([7, x], np.uint64) for x in d.hashes]
    one = lm.score_texts([np.array([7], np.uint64)], model)
    n, _, log_c, fitted, _ = lm.score_texts(texts, model)
    p = np.exp(log_c + fitted - one[3][0])
    z = lm.log_softmax(model.classes, model.bias, lm.weight_rows(lm.feature_hashes(np.array([7, 8], np.uint64)), 256)[:, 1:])
    assert np.isclose(p.sum(), 1 - np.exp(z[0, -1]), atol=1e-4)
    used = lm.gradient_steps([pa.array(["a b c"])], model, lm.LmConfig(classes=8, width=4, deep=True))
    assert len(used) == 2


def test_words_of_large_classes_are_learned(spark):
    """2,000 words in pairs, all of about one count: the second is certain from the first, whatever its class's size."""
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"a{k} b{k}" for k in rng.integers(0, 1000, 30))) for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(4)
    plain, deep = (sum(r["score"] for r in lm.score(frame, frame, lm.LmConfig(deep=d)).collect()) for d in (False, True))
    assert deep > 0.8 * plain


def test_query_predicts_words_of_all_classes(spark, monkeypatch):
    from loomspan.llm import op03_query

    seen, score = [], lm.score
    monkeypatch.setattr(lm, "score", lambda docs, training, config=lm.LmConfig(): seen.append(config) or score(docs, training, config))
    op03_query.query(spark, "/root/testdata/sf0.001").count()
    assert seen[0].deep


def test_trainers_of_one_partition_are_kept_apart():
    batch = lambda who, texts: pa.RecordBatch.from_arrays([pa.array(who, pa.int32()), pa.array(texts)], names=["trainer", "text"])
    got = [(k, t.to_pylist()) for k, t in lm.by_trainer([batch([0, 0, 2], ["a", None, "c"]), batch([], pa.array([], pa.string())), batch([2, 5], ["d", "e"])])]
    assert got == [(0, ["a", None]), (2, ["c"]), (2, ["d"]), (5, ["e"])]
