import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loomspan.llm import simple8b, tokenfile
from loomspan.session import materialize

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_257), st.integers(0, 2**64 - 1)), max_size=400), st.integers(1, 130))
def test_simple8b_round_trip(values, block):
    v = np.array(values, np.uint64)
    words, before = simple8b.encode(v, block)
    assert (simple8b.decode(words) == v).all()
    for i in range(len(before) - 1):  # each block alone
        assert (simple8b.decode(words[before[i] : before[i + 1]]) == v[i * block : (i + 1) * block]).all()


def test_parts_encode_alike():
    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(2)
    parts = ["a", " ", "  ", "\n", "'s", "1", "é", " ", "<|endoftext|>", "\x1d", "!", "?? ", "\t", "Ġ", "<|endof", "text|>", "Zz", "ñ", ",", "a.b", "x%", "\u00a0", "\u3000", "\x00", "\x85", "\u200b", "\U000e0001"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    encoder = tokenfile.PartEncoder(tokenizer, memory=200)
    for some in (texts[:700], texts[700:], texts):
        ids, per = encoder.encode(pa.array(some))
        for text, got in zip(some, np.split(ids, np.cumsum(per)[:-1]), strict=True):
            assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert any(50256 in tokenizer.encode(t, add_special_tokens=False).ids for t in texts)


def test_cuts_stand_only_where_the_library_parts():
    """Of every character below U+10000 and some above: no cut behind white space or before a mark; all those of common blocks."""
    every = [chr(c) for c in [*range(0x3400), *range(0x4DC0, 0x4E80), *range(0xD7A0, 0xD800), *range(0xE000, 0x10000), 0x1F600, 0xE0001] if c < 0xD800 or c > 0xDFFF]
    tokenizer = Tokenizer.from_file(PATH)
    for first in range(0, len(every), 4096):
        some = [f"x{c} y{c}.{c}" for c in every[first : first + 4096]]
        ids, per = tokenfile.PartEncoder(tokenizer).encode(pa.array(some))
        expected = [e.ids for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])] == expected
    at = lambda text: tokenfile.cuts(np.frombuffer(text.encode(), np.uint8)).tolist()
    assert not any(at(f"{c} y") for c in every if c.isspace() or c < "!")
    assert all(at(f"{c} y") == [len(c.encode())] for c in "aZ9.-~éñßжλ\u05d0”…–€→中한😀")
    assert all(at(f"{c}.") == [len(c.encode())] for c in "aZ9éñßɏ") and not any(at(f"{c}.") for c in "×÷.'ɐж ")


def test_memory_counts_what_a_part_takes():
    """Short parts take far more than their characters: 2,000 of them overrun 200,000 bytes."""
    tokenizer = Tokenizer.from_file(PATH)
    encoder = tokenfile.PartEncoder(tokenizer, memory=200_000)
    for k in range(5):
        text = " ".join(f"w{i}" for i in range(2000 * k, 2000 * k + 2000))
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder.known) <= 2001


def test_long_and_special_texts(spark):
    """The library's own ids, also of an added token's string and of texts of many MB."""
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "x" * 300_000, "日本語" * 100_000, " ".join(f"w{i}" for i in range(400_000)), None, ""]
    got = tokenfile.token_digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH, 2).collect()
    for r in got:
        ids = np.array([*tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
    assert len(got) == len(texts)


def test_files_read_back(docs, rows, empty, repeated):
    tokenizer = Tokenizer.from_file(PATH)
    start, want = 0, []
    for r in sorted(rows):
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    files = materialize(tokenfile.write_tokens(docs, PATH, 2, chunk_ids=500), "test-files")
    assert files.count() > 4
    assert sorted(tuple(r) for r in tokenfile.read_tokens(files).collect()) == want
    assert tokenfile.token_digests(empty, PATH, 2).count() == 0
    again = tokenfile.token_digests(repeated, PATH, 2).collect()
    spans = sorted((r["start"], r["start"] + r["n_tokens"]) for r in again)
    assert len(again) == repeated.count() and spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
