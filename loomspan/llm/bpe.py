"""Byte-level BPE with tiktoken: encode whole texts, decode ids to raw bytes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts longer than this many characters are encoded in pieces.
PIECE_CHARS = 1 << 16


def load_encoding(rank_path: str, pattern: str):
    """A tiktoken encoding from a local rank file, without special tokens."""
    import tiktoken

    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


#: A cut between a letter or digit and a plain space: no match of the split pattern
#: reaches over it, and none looks behind it, so both sides encode on their own.
SAFE_CUT = regex.compile(r"[\p{L}\p{N}](?= )")


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Consecutive parts of a text, cut at safe boundaries at least `size` characters apart."""
    start = 0
    while len(text) - start > size:
        cut = SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def encode(encoding, text: str | None) -> np.ndarray:
    """Ids of one whole text as little-endian unsigned 32-bit integers."""
    if not text:
        return np.empty(0, "<u4")
    ids: list[int] = []
    for piece in pieces(text):
        ids += encoding.encode_ordinary(piece)
    return np.array(ids, "<u4")


def decode(encoding, ids: np.ndarray) -> bytes:
    """The bytes that the ids stand for; they need not be valid UTF-8."""
    return encoding.decode_bytes(ids.tolist())


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns plus `ids` (binary, little-endian u32) and `n_tokens` for each document.

    A null text counts as empty. Rows are mapped one by one in their own partition:
    repeated rows stay repeated, other columns are not read, no shuffle happens.
    """

    def run(batches):
        encoding = load_encoding(rank_path, pattern)
        for batch in batches:
            ids = [encode(encoding, t) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())],
                names=[*keep, "ids", "n_tokens"],
            )

    chosen = docs.select(*keep, F.col(text))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(run, f"{schema}, ids binary, n_tokens long")


def token_digests(docs: DataFrame, rank_path: str, pattern: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: ids and their decoded bytes, as digests.

    The decoded bytes come from the ids alone. A null text counts as empty.
    """

    def run(batches):
        encoding = load_encoding(rank_path, pattern)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for t in batch.column(1).to_pylist():
                ids = encode(encoding, t)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(decode(encoding, ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", F.col(text)).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
