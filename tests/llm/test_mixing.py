import pytest
from pyspark.sql import functions as F

from loomspan.llm import mixing

CONFIG = mixing.MixConfig(budget=0.4, rounds=40)


def test_margins_and_budget(spark):
    kinds = {"list": "a b c\n" * 5, "brief": "word " * 30, "prose": "words " * 400}
    rows = [(i, text, lang, source) for i, (lang, source, text) in enumerate((x, y, z * (1 + k % 3)) for k, x in enumerate(("en", "de", None)) for y in ("a", "a", "b", "c") for z in kinds.values())]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), CONFIG).toPandas().fillna("null")
    assert got["weight"].sum() == pytest.approx(1, abs=1e-9)
    assert (got["tokens"] * got["probability"]).sum() == pytest.approx(0.4 * got["tokens"].sum(), rel=1e-9)
    for margin, power in zip(mixing.MARGINS, CONFIG.temper, strict=True):
        natural = (got.groupby(margin)["tokens"].sum() / got["tokens"].sum()) ** power
        have = got.groupby(margin)["weight"].sum()
        assert (have - natural / natural.sum()).abs().max() < 1e-6


def test_rows_and_decisions(docs, repeated, empty):
    got = mixing.mix(repeated, CONFIG)
    assert got.count() == repeated.count()
    assert got.groupBy("doc_id").agg(F.countDistinct("kept").alias("k")).filter("k > 1").count() == 0
    assert mixing.mix(empty, CONFIG).count() == 0 and mixing.sample(empty, CONFIG).count() == 0
    kept = {r["doc_id"] for r in mixing.mix(docs, CONFIG).filter("kept").collect()}
    out = mixing.sample(docs, CONFIG)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == kept


def test_token_count(spark):
    texts = [None, "", "  ", "a", " a\tb\n", "a b", "é\x0bß\x0c\rz"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(mixing.token_count(F.col("text"))).collect()]
    assert got == [len((t or "").encode().split()) for t in texts]


def test_given_targets_are_met(spark):
    """Explicit shares of two margins, and how far the fitting is from them."""
    kinds = ["a b c\n" * 5, "word " * 30, "words " * 400]
    rows = [(i, text * (1 + i % 2), lang, source) for i, (lang, source, text) in enumerate((x, y, z) for x in ("en", "fr", None) for y in ("a", "b", None) for z in kinds)]
    config = mixing.MixConfig(rounds=40, targets=(("source", "a", 0.5), ("source", None, 0.3), ("source", "b", 0.2), ("lang", "en", 1.0), ("lang", None, 1.0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    raked = mixing.rake(mixing.cells(mixing.label(docs)), config)
    got = {(r["margin"], r["value"]): r for r in mixing.margin_errors(raked).collect()}
    assert got["lang", "fr"]["target"] == 0 and got["lang", None]["target"] == 0.5 and got["source", "a"]["target"] == 0.5
    assert all(r["error"] < 1e-3 for r in got.values())
