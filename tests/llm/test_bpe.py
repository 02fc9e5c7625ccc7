import hashlib
import random

import numpy as np
import public_tokenizers

from loomspan.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_digests_match_the_library(docs, rows, repeated, empty):
    encoding = bpe.load_encoding(PATH, PATTERN)
    for frame, table in ((docs, rows), (repeated, [tuple(r) for r in repeated.collect()])):
        want = sorted((str(r[0]), len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in table for i in [encoding.encode_ordinary(r[1] or "")])
        got = bpe.token_digests(frame, PATH, PATTERN).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == want
    assert bpe.token_digests(empty, PATH, PATTERN).count() == 0


def test_pieces_encode_alike():
    encoding = bpe.load_encoding(PATH, PATTERN)
    rng = random.Random(5)
    parts = ["a", " ", "  ", "\n", "'s", "1", "é", " ", "<|endoftext|>", "\x1c", "!", "\t", "日本", "ab12 "]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(60))
        pieces = list(bpe.pieces(text, 7))
        assert "".join(pieces) == text
        assert [i for p in pieces for i in encoding.encode_ordinary(p)] == encoding.encode_ordinary(text)
        assert bpe.decode(encoding, bpe.encode(encoding, text)) == text.encode()


def test_ids_column(docs):
    got = {r["doc_id"]: r for r in bpe.encode_documents(docs, PATH, PATTERN, keep=("doc_id", "lang")).collect()}
    assert got[1]["n_tokens"] == 0 and got[1]["ids"] == b"" and len(got[10]["ids"]) == 4 * got[10]["n_tokens"]
