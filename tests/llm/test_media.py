import hashlib
import zlib

import numpy as np
import pytest

from loomspan.llm import flac, media
from loomspan.session import materialize


def slow_decode(stream: bytes) -> bytes:
    """A plain, bit by bit decoder of the same streams."""
    info, table, at = flac.parse_stream(stream)
    out = []
    bits = "".join(f"{b:08b}" for b in stream[at:])
    for sample, offset, n in table.tolist():
        p = offset * 8 + 32
        lead = len(bits[p : p + 8].split("0")[0])
        p += 8 * max(1, lead) + 16 + 8
        read = lambda w: int(bits[p : p + w], 2) if w else 0  # noqa: B023, E731
        sign = lambda v, w: v - (1 << w) if v >> (w - 1) else v
        kind = read(8) >> 1
        p += 8
        if kind == 0:
            out += [sign(read(8), 8)] * n
            continue
        if kind == 1:
            for _ in range(n):
                out.append(sign(read(8), 8))
                p += 8
            continue
        order = kind & 7 if kind < 16 else (kind & 31) + 1
        x = []
        for _ in range(order):
            x.append(sign(read(8), 8))
            p += 8
        taps, shift = flac.FIXED[order] if kind < 16 else [], 0
        if kind >= 32:
            precision = read(4) + 1
            p += 4
            shift = read(5)
            p += 5
            taps = []
            for _ in range(order):
                taps.append(sign(read(precision), precision))
                p += precision
        assert read(2) == 0
        p += 2
        parts = 1 << read(4)
        p += 4
        for i in range(parts):
            k = read(4)
            p += 4
            for _ in range(n // parts - (order if i == 0 else 0)):
                q = bits.index("1", p) - p
                p += q + 1
                u = q << k | read(k)
                p += k
                r = u >> 1 if u % 2 == 0 else -(u >> 1) - 1
                x.append(r + (sum(c * x[-1 - j] for j, c in enumerate(taps)) >> shift))
        out += x
    return bytes(v + 128 for v in out)


def signals():
    rng = np.random.default_rng(1)
    yield bytes(rng.integers(0, 256, 192 * 7).astype(np.uint8))
    yield b" " * 192
    yield bytes((128 + 100 * np.sin(np.arange(192 * 13) / 9)).astype(np.uint8))
    yield bytes(np.where(rng.random(192 * 12) < 0.01, 255, 128).astype(np.uint8))
    yield bytes((np.cumsum(rng.integers(-1, 2, 192 * 9)) % 256).astype(np.uint8))
    yield bytes(np.where(np.arange(192 * 140) % 1152 < 3, 0, 255).astype(np.uint8))


def test_round_trip_and_slow_decoder():
    codec = flac.Codec()
    payloads = list(signals())
    streams = codec.encode(payloads)
    assert codec.decode(streams) == payloads
    assert [slow_decode(s) for s in streams] == payloads


def test_seek_and_damage():
    codec = flac.Codec()
    payload = list(signals())[2]
    stream = codec.encode([payload])[0]
    first, block = flac.seek(codec, stream, 1500)
    assert first == 1152 and block == payload[1152:2304]
    bad = bytearray(stream)
    bad[-40] ^= 8
    with pytest.raises(flac.FlacError):
        codec.decode([bytes(bad)])


def test_documents(docs, rows, repeated, empty):
    stored = media.store_media(docs)
    got = {r["doc_id"]: r for r in media.media_digests(stored).collect()}
    for r in rows:
        n, p = media.payload(r[1])
        g = got[r[0]]
        assert (g["n_bytes"], g["payload_bytes"], g["payload_sha256"], g["tail_crc32"]) == (n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
    for r in materialize(stored, "test-media").collect():
        p = slow_decode(bytes(r["media"]))
        assert p == media.payload(next(x[1] for x in rows if x[0] == r["doc_id"]))[1]
        x = np.frombuffer(p, np.uint8).astype(int) - 128
        want = f"peak={abs(x).max()};sum={x.sum()};energy={(x * x).sum()};crossings={((x[1:] < 0) != (x[:-1] < 0)).sum()}"
        g = got[r["doc_id"]]
        assert (g["media_bytes"], g["media_sha256"], g["feature"]) == (len(r["media"]), hashlib.sha256(bytes(r["media"])).hexdigest(), want)
    blocks = media.pcm_blocks(stored).filter("doc_id = 10").orderBy("block").collect()
    assert b"".join(bytes(b["pcm"]) for b in blocks) == media.payload(next(r[1] for r in rows if r[0] == 10))[1]
    assert [b["first_sample"] for b in blocks] == [1152 * i for i in range(len(blocks))]
    assert media.media_digests(media.store_media(empty)).count() == 0
    assert media.media_digests(media.store_media(repeated)).count() == repeated.count()


def test_a_long_stream_keeps_one_seek_table(monkeypatch):
    """Frames grow where a text has more of them than a seek table can hold."""
    assert flac.frame_size(1 << 29) == 1152 and flac.frame_size(5 << 30) % 1152 == 0 and -(-(5 << 30) // flac.frame_size(5 << 30)) <= flac.SEEK_POINTS
    monkeypatch.setattr(flac, "SEEK_POINTS", 3)
    payload = bytes((np.arange(192 * 50) * 7 % 251).astype(np.uint8))
    codec = flac.Codec()
    stream = codec.encode([payload])[0]
    assert len(flac.parse_stream(stream)[1]) <= 3 and codec.decode([stream]) == [payload] and slow_decode(stream) == payload
