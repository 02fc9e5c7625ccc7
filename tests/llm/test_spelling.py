import random
import re
import zlib
from collections import Counter

import pytest

from loomspan.llm import spelling as sp


def plain_words(rows, config):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            total[run[: h % len(run)] + run[h % len(run) + 1 :] if config.damage and h % config.damage == 0 else run] += 1
    return {w: n for w, n in total.items() if len(w) >= config.min_length and n >= config.min_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(words, config):
    """{word: (form, root, n, n_near, form_n)} by comparing all pairs."""
    found, forms = {}, {}
    for w in words:
        around = [x for x in words if near(w, x)]
        best = min(around, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best and words[best] >= config.ratio * words[w] else None
        found[w] = (len(around),)
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        found[w] = (forms[w], root, words[w], found[w][0], words.get(forms[w]))
    return found


def table(df):
    return {r["word"]: tuple(r[c] for c in ("form", "root", "n", "n_near", "form_n")) for r in df.collect()}


@pytest.mark.parametrize("config", [sp.SpellingConfig(damage=3), sp.SpellingConfig(min_length=2, min_count=1, ratio=2, damage=2, block=3, held=50)])
def test_against_all_pairs(spark, docs, rows, config):
    words = plain_words([r[:2] for r in rows], config)
    got = sp.variants(docs, config)
    assert table(got) == plain(words, config) and got.count() == len(words)


@pytest.mark.parametrize("block", [2, 7, 1000])
def test_hot_blocks_are_cut_and_lose_no_pair(spark, block):
    """Words of few letters, so that edits have several places and halves are shared by very many."""
    rng = random.Random(block)
    words = {"".join(rng.choice("abÿ") for _ in range(rng.randint(6, 10))): rng.randint(5, 900) for _ in range(600)}
    words |= {"common" + "".join(rng.choice("ab") for _ in range(k)): k for k in range(5, 40)}
    words |= {"z" * k: k**3 for k in range(6, 30)}
    config = sp.SpellingConfig(block=block)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = [(r.word, r.near) for r in sp.neighbours(frame, config).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if near(a, b)}
    sizes = [r["count"] for r in sp.small_blocks(frame, config).filter("size - i - j > 1").groupBy("key").count().collect()]
    assert max(sizes, default=0) <= block


def test_nulls_repeats_ties_long_texts(spark):
    rows = [(1, "colour colours"), (1, "colour colours"), (None, "colour"), (2, None), (3, ""), (4, "colour " * 400_000 + "x" * 50_000 + " color1 cölour")]
    config = sp.SpellingConfig(min_count=1, damage=None)
    got = table(sp.variants(spark.createDataFrame(rows, "doc_id long, text string"), config))
    assert got == plain(plain_words(rows, config), config)
    assert got["colours"][:3] == ("colour", "colour", 2) and "x" * 50_000 in got


def test_empty(spark, empty):
    assert sp.variants(empty).count() == 0


def test_roots_follow_long_chains(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(37)]
    assert {r.word: r.root for r in sp.roots(spark.createDataFrame(chain, "word string, form string")).collect()} == {w: "w37" for w, _ in chain}
