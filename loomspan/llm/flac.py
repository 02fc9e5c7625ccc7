"""FLAC streams of 8-bit mono samples, coded and decoded for many streams at once in numpy.

Coding tries the fixed predictors of order 0 to 2 and a two-tap linear predictor for each
frame, with four Rice partitions. Decoding handles constant, verbatim, fixed and linear
subframes with any partition order: all frames of a batch advance in step, one sample
at a time, each at its own bit position. Headers, CRC-8, CRC-16, frame numbers, sample
counts and the stream's MD5 are verified. A seek table lists every frame.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np

#: Samples in a frame, but for a stream's last.
FRAME = 1152
PARTITIONS = 4
#: A metadata block's length has 24 bits, and a seek point 18 bytes.
SEEK_POINTS = ((1 << 24) - 1) // 18
SHIFT = 8
PRECISION = 10

#: Coefficients of the fixed predictors by order; fixed values of the format.
FIXED = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]]


def frame_size(n: int) -> int:
    """Samples of a frame, of a stream of n: as many as keep all frames in one seek table."""
    return FRAME * max(1, -(-n // (FRAME * SEEK_POINTS)))


class FlacError(ValueError):
    """The stream is damaged or uses what this decoder does not read."""


def _crc_table(poly: int, bits: int) -> np.ndarray:
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    out = np.arange(256, dtype=np.uint32) << np.uint32(bits - 8)
    for _ in range(8):
        out = np.where(out & top, (out << np.uint32(1)) ^ np.uint32(poly), out << np.uint32(1)) & np.uint32(mask)
    return out.astype(np.uint16)


def _crc_rows(table: np.ndarray, bits: int, length: int) -> np.ndarray:
    """Row d: what a byte adds to the checksum when d bytes follow it."""
    rows = np.empty((length, 256), np.uint16)
    rows[0] = table
    for d in range(1, length):
        s = rows[d - 1]
        rows[d] = table[s] if bits == 8 else ((s << np.uint16(8)) ^ table[s >> np.uint16(8)])
    return rows


class Crc:
    """Checksums of many byte ranges of one buffer; grows its rows when a range is longer."""

    def __init__(self, poly: int, bits: int):
        self.bits, self.table = bits, _crc_table(poly, bits)
        self.rows = _crc_rows(self.table, bits, 64)

    def __call__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        most = int(length.max())
        if most > len(self.rows):
            self.rows = _crc_rows(self.table, self.bits, most * 5 // 4)
        ends = np.cumsum(length)
        at = np.arange(int(ends[-1])) - np.repeat(ends - length, length)
        byte = data[np.repeat(start, length) + at]
        after = np.repeat(length, length) - 1 - at
        return np.bitwise_xor.reduceat(self.rows.reshape(-1)[after * 256 + byte], ends - length)


class Codec:
    """Encoder and decoder with their checksum tables."""

    def __init__(self):
        self.crc8, self.crc16 = Crc(0x07, 8), Crc(0x8005, 16)
        lead = np.zeros(1 << 16, np.uint8)
        for q in range(16):
            lead[: 1 << (16 - q - 1)] = q + 1
        self.lead = lead

    # -- encoding

    def encode(self, payloads: list[bytes]) -> list[bytes]:
        """A complete stream for each payload; unsigned bytes become samples less 128."""
        sizes = [len(p) for p in payloads]
        data = np.frombuffer(b"".join(payloads), np.uint8).astype(np.int16) - 128
        steps = [frame_size(n) for n in sizes]
        frames = [-(-n // f) for n, f in zip(sizes, steps, strict=True)]
        step = np.repeat(steps, frames)
        base = np.repeat(np.cumsum([0, *sizes[:-1]]), frames)
        number = np.arange(sum(frames)) - np.repeat(np.cumsum([0, *frames[:-1]]), frames)
        first = base + number * step
        length = np.minimum(step, np.repeat(sizes, frames) - number * step)
        coded: list[bytes] = [b""] * len(first)
        for n in np.unique(length):
            mine = np.flatnonzero(length == n)
            for k in range(0, len(mine), 1024):
                some = mine[k : k + 1024]
                for i, x in zip(some.tolist(), self._frames(data[first[some][:, None] + np.arange(n)], number[some]), strict=True):
                    coded[i] = x
        out, at = [], 0
        for payload, count in zip(payloads, frames, strict=True):
            out.append(self._stream(payload, coded[at : at + count]))
            at += count
        return out

    def _stream(self, payload: bytes, frames: list[bytes]) -> bytes:
        n = len(payload)
        step = frame_size(n)
        size = min(step, n)
        lengths = [len(f) for f in frames]
        md5 = hashlib.md5((np.frombuffer(payload, np.uint8) ^ 128).tobytes()).digest()
        info = struct.pack(">HH", size, size) + min(lengths).to_bytes(3, "big") + max(lengths).to_bytes(3, "big")
        info += (44100 << 44 | 0 << 41 | 7 << 36 | n).to_bytes(8, "big") + md5
        seek, at = b"", 0
        for i, m in enumerate(lengths):
            seek += struct.pack(">QQH", i * step, at, min(step, n - i * step))
            at += m
        return b"fLaC" + bytes([0]) + len(info).to_bytes(3, "big") + info + bytes([0x80 | 3]) + len(seek).to_bytes(3, "big") + seek + b"".join(frames)

    def _candidates(self, x: np.ndarray):
        """(subframe type, order, coefficients, residuals with the warm-up left as 0)."""
        wide = x.astype(np.int32)
        yield 0b001000, 0, None, wide
        one = np.zeros_like(wide)
        one[:, 1:] = np.diff(wide, axis=1)
        yield 0b001001, 1, None, one
        two = np.zeros_like(wide)
        two[:, 2:] = np.diff(one[:, 1:], axis=1)
        yield 0b001010, 2, None, two
        f = x.astype(np.float32)
        r0, r1, r2 = ((f[:, : f.shape[1] - d] * f[:, d:]).sum(axis=1, dtype=np.float64) for d in (0, 1, 2))
        det = np.where(r0 * r0 - r1 * r1 > 0, r0 * r0 - r1 * r1, 1)
        a = np.stack(((r1 * r0 - r1 * r2) / det, (r0 * r2 - r1 * r1) / det), axis=1)
        limit = 1 << (PRECISION - 1)
        c = np.clip(np.rint(a * (1 << SHIFT)), -limit, limit - 1).astype(np.int32)
        lpc = np.zeros_like(wide)
        lpc[:, 2:] = wide[:, 2:] - ((c[:, :1] * wide[:, 1:-1] + c[:, 1:] * wide[:, :-2]) >> SHIFT)
        yield 0b100001, 2, c, lpc

    def _frames(self, x: np.ndarray, number: np.ndarray) -> list[bytes]:
        """Coded frames of equally long sample rows."""
        count, n = x.shape
        part = n // PARTITIONS
        best = np.full(count, 8 * n + 8, np.int64)  # verbatim
        kind = np.full(count, 0b000001)
        order = np.zeros(count, np.int64)
        taps = np.zeros((count, 2), np.int64)
        codes = np.zeros((count, n), np.int64)
        params = np.zeros((count, PARTITIONS), np.int64)
        for sub, o, c, res in self._candidates(x):
            u = (res << 1) ^ (res >> 31)
            cells = u.reshape(count, PARTITIONS, part)
            mean = cells.sum(axis=2) / part
            k = np.clip(np.floor(np.log2(mean * 0.7 + 1e-9)), 0, 14).astype(np.int32)
            q = (cells >> k[:, :, None]).sum(axis=2)
            cost = (q + (k + 1) * part).sum(axis=1) + 8 * o + (29 if c is not None else 0) + 10 + 4 * (PARTITIONS - 1) + 8
            better = cost < best
            best[better], kind[better], order[better] = cost[better], sub, o
            params[better], codes[better] = k[better], u[better]
            taps[better] = c[better] if c is not None else 0
        same = (x == x[:, :1]).all(axis=1)
        kind[same], order[same] = 0, 0
        raw = (x & 0xFF).astype(np.int64)
        rice = kind >= 0b001000

        bits = np.zeros((count, 9 + n + PARTITIONS), np.int64)  # bits of each field
        low = np.zeros_like(bits)  # of them, those that hold the value; zeros stand before
        value = np.zeros_like(bits)

        def put(col, v, w, where=True):
            value[:, col], bits[:, col] = np.where(where, v, 0), np.where(where, w, 0)
            low[:, col] = bits[:, col]

        put(0, 0xFFF87902, 32)
        coded, width = _utf8(number)
        put(1, coded, width)
        put(2, n - 1, 16)
        heads = ((0xFFF87902).to_bytes(4, "big") + c.to_bytes(w // 8, "big") + (n - 1).to_bytes(2, "big") for c, w in zip(coded.tolist(), width.tolist(), strict=True))
        head = np.frombuffer(b"".join(heads), np.uint8)
        lengths = 6 + width // 8
        put(3, self.crc8(head, np.cumsum(lengths) - lengths, lengths), 8)
        put(4, kind << 1, 8)
        put(5, raw[:, 0], 8, (order > 0) | (kind == 0))
        put(6, raw[:, min(1, n - 1)], 8, order > 1)
        lpc = ((PRECISION - 1) << 25) | (SHIFT << 20) | ((taps[:, 0] & 1023) << 10) | (taps[:, 1] & 1023)
        put(7, lpc, 29, kind >= 0b100000)
        depth = PARTITIONS.bit_length() - 1
        col = 8
        for p in range(PARTITIONS):
            put(col, (depth << 4 | params[:, p]) if p == 0 else params[:, p], 10 if p == 0 else 4, rice)
            span = slice(p * part, (p + 1) * part)
            k = params[:, p : p + 1]
            u = codes[:, span]
            to = slice(col + 1, col + 1 + part)
            coded_here = rice[:, None] & (np.arange(p * part, (p + 1) * part) >= order[:, None])
            verbatim = (kind == 1)[:, None]
            value[:, to] = np.where(coded_here, (1 << k) | (u & ((1 << k) - 1)), np.where(verbatim, raw[:, span], 0))
            low[:, to] = np.where(coded_here, k + 1, np.where(verbatim, 8, 0))
            bits[:, to] = np.where(coded_here, (u >> k) + k + 1, low[:, to])
            col += 1 + part
        total = bits.sum(axis=1)
        bits[:, -1] = -total % 8
        size = (total + bits[:, -1]) // 8
        start = np.cumsum(size) - size
        end = np.cumsum(bits.reshape(-1))  # frames are whole bytes, so rows follow on
        packed = _pack(value.reshape(-1), low.reshape(-1), end, int(size.sum()))
        crc = self.crc16(packed, start, size)
        image = packed.tobytes()
        return [image[a : a + m] + int(c).to_bytes(2, "big") for a, m, c in zip(start.tolist(), size.tolist(), crc.tolist(), strict=True)]

    # -- decoding

    def decode(self, streams: list[bytes]) -> list[bytes]:
        """The payload of each stream, verified."""
        parsed = [parse_stream(s) for s in streams]
        base = np.cumsum([0] + [len(s) for s in streams[:-1]])
        counts = [len(t) for _, t, _ in parsed]
        start = np.concatenate([t["offset"].astype(np.int64) + at + b for (_, t, at), b in zip(parsed, base.tolist(), strict=True)])
        stop = np.concatenate([np.append(t["offset"][1:].astype(np.int64) + at, len(s)) + b for (_, t, at), s, b in zip(parsed, streams, base.tolist(), strict=True)])
        length = np.concatenate([t["samples"].astype(np.int64) for _, t, _ in parsed])
        number = np.concatenate([np.arange(c) for c in counts])
        rows = self.decode_frames(np.frombuffer(b"".join(streams), np.uint8), start, stop, length, number)
        out, at = [], 0
        for (info, _, _), c in zip(parsed, counts, strict=True):
            pcm = np.concatenate(rows[at : at + c])
            at += c
            if len(pcm) != info["samples"] or hashlib.md5(pcm.tobytes()).digest() != info["md5"]:
                raise FlacError("the decoded samples are not those of the stream's header")
            out.append((pcm.view(np.uint8) ^ 128).tobytes())
        return out

    def decode_frames(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray, length: np.ndarray, number: np.ndarray) -> list[np.ndarray]:
        """Samples (int8) of the frames at data[start:stop], checked against their headers."""
        data = np.append(data, np.zeros(16, np.uint8))
        word = np.zeros(len(data) - 8, np.uint64)
        for i in range(8):
            word |= data[i : i + len(word)].astype(np.uint64) << np.uint64(56 - 8 * i)
        if (self.crc16(data, start, stop - start - 2) != data[stop - 2].astype(np.uint16) * 256 + data[stop - 1]).any():
            raise FlacError("a frame's CRC-16 is wrong")
        out: list[np.ndarray] = [np.empty(0, np.int8)] * len(start)
        for n in np.unique(length):
            mine = np.flatnonzero(length == n)
            for k in range(0, len(mine), 4096):
                some = mine[k : k + 4096]
                for i, x in zip(some.tolist(), self._rows(data, word, start[some], int(n), number[some]), strict=True):
                    out[i] = x
        return out

    def _rows(self, data: np.ndarray, word: np.ndarray, start: np.ndarray, n: int, number: np.ndarray) -> np.ndarray:
        u64 = np.uint64

        def window(p):
            return word[p >> 3] << (p & 7).astype(u64)

        def take(p, w):
            return ((window(p) >> u64(1)) >> (63 - w).astype(u64)).astype(np.int64)

        def fixed(p, w):
            return (window(p) >> u64(64 - w)).astype(np.int64)

        def signed(v, w):
            return v - ((v >> (w - 1)) << w)

        if (data[start] != 0xFF).any() or (data[start + 1] != 0xF8).any():
            raise FlacError("a frame does not begin with the sync code")
        coded, width = _utf8(number)
        body = start + 4 + width // 8
        if (data[start + 2] >> 4 != 7).any() or (data[start + 3] != 0x02).any():
            raise FlacError("only 8-bit mono frames with 16-bit sizes are read")
        if (fixed((start + 4) * 8, 32) >> (32 - width) != coded).any() or (fixed(body * 8, 16) != n - 1).any():
            raise FlacError("a frame's number or size is wrong")
        if (self.crc8(data, start, body + 2 - start) != data[body + 2]).any():
            raise FlacError("a frame's CRC-8 is wrong")
        p = (body + 3) * 8
        head = fixed(p, 8)
        p = p + 8
        kind = head >> 1
        if (head & 0x81).any():
            raise FlacError("wasted bits and padding in a subframe header are not read")
        is_fixed, is_lpc = kind >> 3 == 1, kind >> 5 == 1
        if (~(is_fixed | is_lpc | (kind < 2))).any() or (is_fixed & (kind & 7 > 4)).any():
            raise FlacError("a subframe's type is reserved")
        order = np.where(is_fixed, kind & 7, np.where(is_lpc, (kind & 31) + 1, 0))
        x = np.zeros((n, len(start)), np.int64)  # time runs down: rows are contiguous
        constant = kind == 0
        if constant.any():
            x[:, constant] = signed(fixed(p, 8), 8)[constant]
        verbatim = np.flatnonzero(kind == 1)
        if len(verbatim):
            x[:, verbatim] = data[(p[verbatim] >> 3) + np.arange(n)[:, None]].view(np.int8)
        for j in range(int(order.max())):
            on = order > j
            x[j, on] = signed(fixed(p, 8), 8)[on]
            p = p + 8 * on
        shift = np.zeros(len(start), np.int64)
        taps = np.zeros((int(order.max()), len(start)), np.int64)
        for o in np.unique(order[is_fixed]).tolist():
            for j, c in enumerate(FIXED[o]):
                taps[j, is_fixed & (order == o)] = c
        if is_lpc.any():
            precision = fixed(p, 4) + 1
            shift = np.where(is_lpc, signed(fixed(p + 4, 5), 5), 0)
            if (shift < 0).any() or (precision[is_lpc] == 16).any():
                raise FlacError("a linear predictor's precision or shift is reserved")
            p = p + 9 * is_lpc
            for j in range(int(order[is_lpc].max())):
                on = is_lpc & (order > j)
                taps[j, on] = signed(take(p, precision), precision)[on]
                p = p + precision * on
        rice = np.flatnonzero(is_fixed | is_lpc)
        if len(rice):
            self._residuals(x, p, n, order, rice, fixed, take, signed, window)
        self._predict(x, taps, shift, order)
        return x.T.astype(np.int8)

    def _residuals(self, x, p, n, order, rice, fixed, take, signed, window) -> None:
        """Read the Rice-coded residuals of the subframes `rice` into x."""
        u64 = np.uint64
        p, order = p[rice], order[rice]
        method = fixed(p, 2)
        if (method > 1).any():
            raise FlacError("the residual's coding method is reserved")
        wide = 4 + method
        part = n >> fixed(p + 2, 4)
        p = p + 6
        k = take(p, wide)
        p = p + wide
        raw = np.full(len(p), -1, np.int64)  # escaped partitions: bits of a plain residual

        def escapes(p, k, raw, at):
            new = at & (k == (1 << wide) - 1)
            raw = np.where(at, -1, raw)
            if new.any():
                raw = np.where(new, fixed(p, 5), raw)
                p = p + 5 * new
            return p, raw

        p, raw = escapes(p, k, raw, np.ones(len(p), bool))
        sizes = np.unique(part).tolist()
        latest = int(order.max())
        for i in range(n):
            if i and any(i % s == 0 for s in sizes):
                at = i % part == 0
                k = np.where(at, take(p, wide), k)
                p = p + wide * at
                p, raw = escapes(p, k, raw, at)
            win = window(p)
            q = self.lead[win >> u64(48)].astype(np.int64)
            plain = raw >= 0
            odd = plain.any()
            skipped = 0
            long = (q == 16) & ~plain
            while long.any():  # quotients of 16 and more: step over whole runs of zeros
                skipped = skipped + 16 * long
                win = window(p + skipped)
                q = self.lead[win >> u64(48)].astype(np.int64)
                long = long & (q == 16)
            q = np.where(plain, 0, q)
            low = (((win << (q + 1).astype(u64)) >> u64(1)) >> (63 - k).astype(u64)).astype(np.int64)
            u = ((q + skipped) << k) | low
            r = (u >> 1) ^ -(u & 1)
            used = q + skipped + 1 + k
            if odd:
                w = np.maximum(raw, 1)
                r = np.where(plain, np.where(raw > 0, signed(take(p, w), w), 0), r)
                used = np.where(plain, raw, used)
            if i < latest:
                on = i >= order
                x[i, rice[on]] = r[on]
                p = p + used * on
            else:
                x[i, rice] = r
                p = p + used

    def _predict(self, x: np.ndarray, taps: np.ndarray, shift: np.ndarray, order: np.ndarray) -> None:
        """Turn residuals into samples, in place."""
        for o in np.unique(order[order > 0]).tolist():
            mine = np.flatnonzero(order == o)
            y, c, s = x[:, mine], taps[:o, mine], shift[mine]
            for i in range(o, len(y)):
                total = c[0] * y[i - 1]
                for j in range(1, o):
                    total += c[j] * y[i - 1 - j]
                y[i] += total >> s
            x[:, mine] = y


def _utf8(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frame numbers in UTF-8's manner: value and width in bits (up to 21-bit numbers)."""
    n = number.astype(np.int64)
    two = (0xC0 | n >> 6) << 8 | 0x80 | n & 63
    three = (0xE0 | n >> 12) << 16 | (0x80 | n >> 6 & 63) << 8 | 0x80 | n & 63
    four = (0xF0 | n >> 18) << 24 | (0x80 | n >> 12 & 63) << 16 | (0x80 | n >> 6 & 63) << 8 | 0x80 | n & 63
    if len(n) and n.max() >= 1 << 21:
        raise FlacError("more frames than a stream is written with")
    value = np.where(n < 1 << 7, n, np.where(n < 1 << 11, two, np.where(n < 1 << 16, three, four)))
    return value, np.where(n < 1 << 7, 8, np.where(n < 1 << 11, 16, np.where(n < 1 << 16, 24, 32)))


def _pack(value: np.ndarray, low: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Bytes with each value's `low` bits just before bit `end`; all other bits are 0."""
    on = low > 0
    value, low, end = value[on].astype(np.uint64), low[on], end[on]
    begin = end - low
    word = begin >> 5
    wide = value << (64 - low - (begin & 31)).astype(np.uint64)
    words = size // 4 + 2
    out = np.bincount(word, (wide >> np.uint64(32)).astype(np.float64), words)
    out += np.bincount(word + 1, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), words + 1)[:words]
    return out.astype(np.uint64).astype(">u4").view(np.uint8)[:size]


SEEK = np.dtype([("sample", ">u8"), ("offset", ">u8"), ("samples", ">u2")])


def parse_stream(stream: bytes) -> tuple[dict, np.ndarray, int]:
    """(stream header, seek table, where the first frame begins)."""
    if stream[:4] != b"fLaC":
        raise FlacError("not a FLAC stream")
    at, info, seek, last = 4, {}, np.empty(0, SEEK), False
    while not last:
        last, kind, size = bool(stream[at] & 0x80), stream[at] & 0x7F, int.from_bytes(stream[at + 1 : at + 4], "big")
        body = stream[at + 4 : at + 4 + size]
        if kind == 0:
            packed = int.from_bytes(body[10:18], "big")
            info = {"block": int.from_bytes(body[:2], "big"), "rate": packed >> 44, "channels": (packed >> 41 & 7) + 1, "bits": (packed >> 36 & 31) + 1, "samples": packed & (1 << 36) - 1, "md5": body[18:34]}
        elif kind == 3:
            seek = np.frombuffer(body, SEEK)
        at += 4 + size
    if info.get("channels") != 1 or info.get("bits") != 8 or not len(seek):
        raise FlacError("only 8-bit mono streams with a seek table of all frames are read")
    return info, seek, at


def seek(codec: Codec, stream: bytes, sample: int) -> tuple[int, bytes]:
    """(first sample, PCM bytes) of the one frame that holds a sample, decoded alone."""
    info, table, at = parse_stream(stream)
    if not 0 <= sample < info["samples"]:
        raise IndexError(sample)
    i = int(np.searchsorted(table["sample"], sample, side="right")) - 1
    a = at + int(table["offset"][i])
    b = at + int(table["offset"][i + 1]) if i + 1 < len(table) else len(stream)
    frame = np.frombuffer(stream[a:b], np.uint8)
    rows = codec.decode_frames(frame, np.array([0]), np.array([b - a]), table["samples"][i : i + 1].astype(np.int64), np.array([i]))
    return int(table["sample"][i]), (rows[0].view(np.uint8) ^ 128).tobytes()
