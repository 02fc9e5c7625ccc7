"""Media columns: documents as FLAC streams, and PCM blocks decoded from them."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomspan.llm import flac

#: Payload bytes that a task codes at once, unless one document has more.
GROUP_BYTES = 1 << 21
UNIT = 192


def payload(text: str | None) -> tuple[int, bytes]:
    """(bytes of the text, bytes padded with spaces to a positive multiple of the unit)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b" " * (-len(raw) % UNIT if raw else UNIT)


def groups(texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """(first row, payloads) of consecutive rows of about GROUP_BYTES."""
    first, held, total = 0, [], 0
    for i, t in enumerate(texts):
        held.append(payload(t))
        total += len(held[-1][1])
        if total >= GROUP_BYTES:
            yield first, held
            first, held, total = i + 1, [], 0
    if held:
        yield first, held


def store_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each whole text, padded, as a FLAC stream.

    A null text counts as empty, and is one unit of spaces. Rows are coded where they lie;
    repeated rows stay repeated, equal texts give equal streams. Other columns are not read.
    """

    def run(batches):
        codec = flac.Codec()
        for batch in batches:
            for first, held in groups(batch.column(1).to_pylist()):
                media = codec.encode([p for _, p in held])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(held)), pa.array([n for n, _ in held], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def _decoded(batches, columns: int):
    """(rows, media, payloads) of stored streams, some at a time."""
    codec = flac.Codec()
    for batch in batches:
        media = batch.column(columns).to_pylist()
        first, total = 0, 0
        for i, m in enumerate(media):
            total += len(m)
            if total >= GROUP_BYTES or i == len(media) - 1:
                some = media[first : i + 1]
                yield batch.slice(first, len(some)), some, codec.decode(some)
                first, total = i + 1, 0


def blocks_of(stream: bytes, pcm: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(first sample, samples, PCM bytes) of each frame of a decoded stream, by its seek table,
    which must leave no gap."""
    at = 0
    for sample, _, n in flac.parse_stream(stream)[1].tolist():
        if sample != at:
            raise flac.FlacError("the seek table leaves a gap")
        yield sample, n, pcm[sample : sample + n]
        at += n
    if at != len(pcm):
        raise flac.FlacError("the seek table does not reach the end")


def pcm_digests(stream: bytes, pcm: bytes) -> tuple[int, str, int, str]:
    """payload_bytes, payload_sha256, tail_crc32 and feature, gathered from the stream's PCM blocks."""
    sha, size, tail, last = hashlib.sha256(), 0, b"", None
    peak = total = energy = crossings = 0
    for _, n, block in blocks_of(stream, pcm):
        sha.update(block)
        size += n
        tail = (tail + block)[-16:]
        x = (np.frombuffer(block, np.uint8) ^ 128).view(np.int8)
        wide = x.astype(np.int64)
        peak = max(peak, int(np.abs(wide).max()))
        total, energy = total + int(wide.sum()), energy + int((wide * wide).sum())
        negative = np.signbit(x)
        crossings += int(np.count_nonzero(negative[1:] != negative[:-1])) + (last is not None and last != negative[0])
        last = negative[-1]
    return size, sha.hexdigest(), zlib.crc32(tail), f"peak={peak};sum={total};energy={energy};crossings={crossings}"


def media_digests(stored: DataFrame) -> DataFrame:
    """Digests of stored streams and of the PCM blocks that they decode to, with features.

    Columns: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature (peak, sum, energy and sign changes of the samples). A damaged
    stream fails its task with what is wrong.
    """

    def run(batches):
        for rows, media, pcm in _decoded(batches, 2):
            size, sha, tail, feature = zip(*map(pcm_digests, media, pcm), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    rows.column(1),
                    pa.array(size, pa.int64()),
                    pa.array(sha, pa.string()),
                    pa.array(tail, pa.int64()),
                    pa.array([len(m) for m in media], pa.int64()),
                    pa.array([hashlib.sha256(m).hexdigest() for m in media], pa.string()),
                    pa.array(feature, pa.string()),
                ],
                names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    return stored.mapInArrow(
        run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )


def pcm_blocks(stored: DataFrame) -> DataFrame:
    """(doc_id, block, first_sample, n_samples, pcm): a row for each frame of each stream, by
    the seek table's offsets; pcm is unsigned 8-bit. A null doc_id stays null, repeated rows
    give repeated blocks, and an empty table none. Only doc_id and media are read."""

    def run(batches):
        for rows, media, pcm in _decoded(batches, 1):
            for doc_id, m, x in zip(rows.column(0).to_pylist(), media, pcm, strict=True):
                sample, n, block = zip(*blocks_of(m, x), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id] * len(n), pa.int64()), pa.array(range(len(n)), pa.int32()), pa.array(sample, pa.int64()), pa.array(n, pa.int32()), pa.array(block, pa.binary())],
                    names=["doc_id", "block", "first_sample", "n_samples", "pcm"],
                )

    return stored.select("doc_id", "media").mapInArrow(run, "doc_id long, block int, first_sample long, n_samples int, pcm binary")
