"""Word splitting and 64-bit hashing of texts, in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

#: Word characters are all but these; bytes.split() splits at exactly the same six.
WORD_BREAKS = "\x20\x09\x0a\x0b\x0c\x0d"

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_TO_LOWER = bytes.maketrans(_UPPER, _LOWER)

#: The SQL form of the word pattern (Spark and DuckDB).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words of a whole text as UTF-8; lower maps A-Z only. A null text has none."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.translate(_TO_LOWER) if lower else raw).split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _multipliers(size: int) -> list[int]:
    """An odd 64-bit multiplier for each place in a window."""
    return [xxhash.xxh64_intdigest(b"place", seed=i) | 1 for i in range(size)]


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` consecutive words (none if there are fewer)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i, m in enumerate(_multipliers(size)):
        out += hashes[i : i + n] * np.uint64(m)
    return _mix(out)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased text's word shingles.

    With fewer than `size` words the whole sequence is the one shingle; without words
    the set is empty.
    """
    h = word_hashes(words(text, lower=True))
    if not len(h):
        return np.empty(0, np.uint64)
    if len(h) < size:  # tagged with its length, so it can't equal a longer one
        return window_hashes(np.append(h, np.uint64(len(h))), len(h) + 1)
    return np.unique(window_hashes(h, size))

#: The 256 remainders of CRC-32 as a DuckDB list `t` of one row, and the sum of a string by it.
CRC_TABLE_SQL = "crc_table AS (SELECT list(list_reduce([CAST(n AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) x(n))"


def crc32_sql(text: str) -> str:
    """DuckDB's expression of the unsigned CRC-32 of a string's UTF-8, where crc_table is joined."""
    h = f"hex(encode({text}))"
    octets = f"list_transform(range(0, length({h}) // 2), lambda i: CAST('0x' || substr({h}, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    return f"xor(list_reduce([4294967295] || {octets}, lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295)"
