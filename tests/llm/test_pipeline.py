import corpus_pipeline
from loomspan.llm import bpe
from loomspan.llm.sketch import parted
from loomspan.session import materialize


def test_stages_in_order(docs, spark):
    df = docs.union(docs.filter("doc_id < 9"))
    columns = df.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    before = df.count()
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        df = materialize(stage(spark, df, ""), f"test-{i}")
        assert df.count() <= before
        before = df.count()
        if i < 4:
            assert df.columns == columns
        if i == 1:
            assert df.groupBy("doc_id").count().filter("count > 1").count() == 0
    assert {"doc_id", "ids", "n_tokens"} <= set(df.columns) and before > 0


def test_near_duplicates_with_clashing_columns(docs, spark):
    """Extra columns called like those that the stage uses itself, with repeated rows and without."""
    odd = docs.select("*", *(docs["doc_id"].alias(c) for c in ("gone", "again", "id", "row", "first", "count", "component_id", "part", "block", "kind")))
    for frame in (odd, odd.union(odd.filter("doc_id < 9"))):
        kept = materialize(corpus_pipeline.near_duplicates(spark, frame, ""), "test-odd")
        assert kept.columns == odd.columns and kept.count() == kept.select("doc_id").distinct().count() < odd.count()
        assert corpus_pipeline.repeated_passages(spark, kept, "").columns == odd.columns


def test_stages_on_nothing(empty, spark):
    df = empty
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        df = materialize(stage(spark, df, ""), f"test-empty-{i}")
        assert df.count() == 0


def test_last_stage_encodes_what_is_left(docs, spark):
    import public_tokenizers

    encoding = bpe.load_encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    row = corpus_pipeline.tokens(spark, docs.filter("doc_id = 7"), "").first()
    assert bpe.decode(encoding, __import__("numpy").frombuffer(row["ids"], "<u4")) == b"one two three"


def test_only_rows_that_may_go_are_dealt(spark, monkeypatch):
    """Of 1,000 documents with 20 near copies all but the copies, and a few more, stay where they are."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(40)), "en", "a") for i in range(1000)]
    rows += [(2000 + i, rows[i][1] + " end", "en", "a") for i in range(20)]
    parts = []
    monkeypatch.setattr(corpus_pipeline, "parted", lambda *a: parts.append(parted(*a)) or parts[-1])
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(1000))
    (near, far) = parts[0]
    assert 20 <= near.count() < 30 and near.count() + far.count() == 1020
