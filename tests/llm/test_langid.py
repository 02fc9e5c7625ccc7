import math
import os
import random
import unicodedata
import zlib

import pytest

from loomspan.llm import langid

WORDS = {"en": ["the", "and", "thing", "with", "shore"], "de": ["der", "und", "nicht", "ich", "straße"], "fr": ["été", "que", "dans", "leur", "où"]}


def texts(n, seed):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "s", "en"]) for _ in range(rng.randint(5, 60))), lang) for i, lang in enumerate(rng.choice(list(WORDS)) for _ in range(n))]


def test_held_out_accuracy_and_calibration(spark):
    train = spark.createDataFrame(texts(300, 1) + [(-1, None, "en"), (-2, "x", None)], "doc_id long, text string, lang string")
    model = langid.train(train)
    assert model.langs == ["de", "en", "fr"] and 0 < model.threshold <= 1
    test = spark.createDataFrame(texts(200, 2), "doc_id long, text string, lang string")
    got = langid.predict(test, model).join(test, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_texts(docs, empty, repeated):
    model = langid.train(docs)
    by_id = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    for i in (1, 2, 4, 8):  # null, empty, blank, no letter
        assert by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 and not by_id[i]["accepted"]
    assert {r["lang_pred"] for i, r in by_id.items() if i not in (1, 2, 4, 8)} <= {"en", "de", "fr"}
    assert langid.predict(repeated, model).count() == repeated.count()
    assert langid.predict(empty, model).count() == 0
    nothing = langid.train(empty)
    assert {r["lang_pred"] for r in langid.predict(docs, nothing).collect()} == {"und"}


def test_the_draw_holds_at_any_size():
    config = langid.LangConfig()
    for total in (10, 10**6, 10**10, 10**13):
        share = langid.draw_limit(total, config) / 2**63
        assert abs(share * total - min(total, config.sample_docs)) < 1


def plain_prediction(text, model):
    """(language, probability) by loops over n-grams, their buckets and the model's numbers."""
    if not text or not any(unicodedata.category(c).startswith("L") for c in text):
        return "und", 0.0
    raw = [32, *(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in text.encode()), 32]
    total, n_grams = [0.0] * len(model.langs), 0
    for n in model.config.orders:
        for i in range(len(raw) - n + 1):
            gram = raw[i : i + n]
            if 32 in gram[1:-1] or gram[0] == gram[-1] == 32:
                continue
            h = n * 0x9E3779B1 % 2**32
            for b in gram:
                h = (h ^ b) * 0x01000193 % 2**32
            h ^= h >> 15
            n_grams += 1
            for k, x in enumerate(model.table[h % model.config.buckets]):
                total[k] += float(x)
    z = [(t / n_grams + float(b)) / model.temperature for t, b in zip(total, model.bias, strict=True)]
    e = [math.exp(x - max(z)) for x in z]
    best = max(range(len(e)), key=e.__getitem__)
    return model.langs[best], e[best] / sum(e)


def test_predictions_by_plain_loops(spark, docs, rows):
    model = langid.train(spark.createDataFrame(texts(200, 3), "doc_id long, text string, lang string"))
    given = {r[0]: r[1] for r in rows}
    for r in langid.predict(docs, model).collect():
        lang, score = plain_prediction(given[r["doc_id"]], model)
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-3
        assert r["accepted"] == (r["score"] >= model.threshold and lang != "und")


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no tables here")
def test_the_query_holds_out_by_crc32(spark):
    from loomspan.llm import op02_query

    got = op02_query.query(spark, "/root/testdata/sf0.001").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert len(got) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
