import hashlib
import random

import pytest

from loomspan.llm.repeats import STEPS, WINDOWS, RepeatConfig, packed_anchors, part_column, part_windows, recurring, remove_repeats, removal_digests, unpack


def brute(rows, window=13):
    first = {}
    split = [(r[0], (r[1] or "").encode().split()) for r in rows]
    for doc_id, w in split:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if doc_id is not None:
                first[k] = min(first.get(k, doc_id), doc_id)
    gone = {}
    for doc_id, w in split:
        for i in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[i : i + window])] < doc_id:
                gone.setdefault((doc_id, tuple(w)), set()).update(range(i, i + window))
    out = []
    for doc_id, w in split:
        g = gone.get((doc_id, tuple(w)), set())
        kept = b" ".join(x for i, x in enumerate(w) if i not in g)
        out.append((str(doc_id), len(w), len(g), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("config", [RepeatConfig(), RepeatConfig(anchor=3, part_bytes=900, automaton_blocks=5), RepeatConfig(anchor=13, part_bytes=4000, automaton_blocks=40)])
def test_matches_brute_force(docs, rows, config):
    got = sorted((str(r[0]), *r[1:]) for r in removal_digests(docs, config).collect())
    assert got == brute(rows)
    assert any(r[2] for r in got)


def test_repeats_and_empty(repeated, empty):
    got = sorted((str(r[0]), *r[1:]) for r in removal_digests(repeated, RepeatConfig()).collect())
    assert got == brute([tuple(r) for r in repeated.collect()])
    assert removal_digests(empty).count() == 0 and remove_repeats(empty).count() == 0


def test_texts_are_cut(docs, rows):
    want = {(r[0]): r for r in brute(rows)}
    out = remove_repeats(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        kept = b" ".join((r["text"] or "").encode().split())
        assert hashlib.sha256(kept).hexdigest() == want[str(r["doc_id"])][3]


def test_a_passage_in_every_document(spark):
    """One passage in all documents reaches its range once for each part, not for each document."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"a{i} b{i} {passage} c{i} d{i}") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    config = RepeatConfig(part_bytes=20_000)
    got = sorted((str(r[0]), *r[1:]) for r in removal_digests(frame, config).collect())
    assert got == brute(rows) and sum(r[2] for r in got) == 399 * 40
    parts = 1 + sum(len(t.encode()) for _, t in rows) // config.part_bytes
    told = recurring(packed_anchors(frame, parts, config), parts)
    blocks = part_windows(frame.withColumn("part", part_column(parts)), told, parts, config).collect()
    h = [x for r in blocks if r["kind"] == WINDOWS for x in unpack(r["block"], STEPS[WINDOWS])[0].tolist()]
    assert parts > 3 and max(h.count(x) for x in set(h)) == parts


def test_a_very_long_text(spark):
    """A text of some MB, half of it an earlier one's, in one part with short ones."""
    rng = random.Random(5)
    half = [f"w{rng.randrange(50_000)}" for _ in range(150_000)]
    other = [f"w{rng.randrange(50_000)}" for _ in range(150_000)]
    rows = [(2, " ".join(half + other)), (1, " ".join(half)), (3, " ".join(other[:20])), (4, "short")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in removal_digests(frame).collect()}
    assert got == {1: 0, 2: 150_000, 3: 20, 4: 0}
