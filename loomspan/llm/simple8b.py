"""Simple-8b word-aligned coding of token ids, in numpy.

A 64-bit word holds a 4-bit selector in its top bits and, below it, as many ids as that
selector packs. The last selector is the escape: the next whole word is one value of
up to 64 bits. A block is a number of consecutive ids coded on their own; the words
before each block are listed, so any block decodes alone, and all decode at once.
"""

from __future__ import annotations

import numpy as np

#: (ids in a word, bits of each) by selector from 0; fixed values of the format. Two of
#: Simple-8b's sixteen selectors, the runs of zeros, are given to the escape.
PACKINGS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 15
BLOCK = 1024


def _choices(values: np.ndarray, block: int) -> np.ndarray:
    """For each place, the selector that packs most ids from there on within its block."""
    n = len(values)
    if n and values.max() < 1 << 32:
        values = values.astype(np.uint32)
    chosen = np.full(n, ESCAPE, np.uint8)
    left = block - np.arange(n, dtype=np.int32) % block
    for selector in range(len(PACKINGS) - 1, -1, -1):
        count, bits = PACKINGS[selector]
        fits = values < values.dtype.type(1 << bits) if bits < 8 * values.dtype.itemsize else np.ones(n, bool)
        if count == 1:
            chosen[fits] = selector
            continue
        # Places from which `count` ids in a row fit.
        if np.count_nonzero(fits) > n // 4:
            if count > n:
                break
            row = fits[: n - count + 1] & (left[: n - count + 1] >= count)
            for i in range(1, count):
                row &= fits[i : n - count + 1 + i]
            chosen[: len(row)][row] = selector
            continue
        at = np.flatnonzero(fits)  # few: they are looked at alone
        if len(at) < count:
            break
        first = at[: len(at) - count + 1]
        chosen[first[(at[count - 1 :] - first == count - 1) & (left[first] >= count)]] = selector
    return chosen


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, words before each block and after the last) of a sequence of ids."""
    values = ids.astype(np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    chosen = _choices(values, block)
    # All blocks go forward together, word by word: no word reaches over a block's end.
    step = np.array([c for c, _ in PACKINGS] + [0, 1], np.int64)[chosen]
    at = np.arange(0, n, block)
    end = np.minimum(at + block, n)
    head = np.zeros(n, bool)
    while len(at):
        head[at] = True
        at = at + step[at]
        more = at < end
        at, end = at[more], end[more]
    starts = np.flatnonzero(head)
    selectors = chosen[starts]
    escaped = selectors == ESCAPE
    place = np.arange(len(starts)) + np.cumsum(escaped) - escaped
    words = np.zeros(int(place[-1]) + 1 + int(escaped[-1]), np.uint64)
    words[place] = selectors.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(selectors[~escaped]):
        count, bits = PACKINGS[selector]
        mine = selectors == selector
        first = starts[mine]
        packed = np.zeros(len(first), np.uint64)
        for i in range(count):
            packed |= values[first + i] << np.uint64(i * bits)
        words[place[mine]] |= packed
    words[place[escaped] + 1] = values[starts[escaped]]
    before = np.append(place[np.searchsorted(starts, np.arange(0, n, block))], len(words))
    return words, before


def _selectors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Selector of each word, and whether the word is an escaped value rather than a head.

    In a run of words that look like escapes, heads and values take turns, so only a
    value's neighbours matter; without an escape every word is a head.
    """
    selectors = (words >> np.uint64(60)).astype(np.uint8)
    value = np.zeros(len(words), bool)
    for i in np.flatnonzero(selectors == ESCAPE).tolist():
        if not value[i]:
            value[i + 1] = True
    return selectors, value


def decode(words: np.ndarray) -> np.ndarray:
    """All values of consecutive blocks' words."""
    if not len(words):
        return np.empty(0, np.uint64)
    selectors, value = _selectors(words)
    counts = np.array([c for c, _ in PACKINGS] + [0, 1], np.int64)[selectors]
    counts[value] = 0
    offset = np.concatenate(([0], np.cumsum(counts)))
    out = np.empty(int(offset[-1]), np.uint64)
    for selector in np.unique(selectors[~value]):
        mine = np.flatnonzero((selectors == selector) & ~value)
        if selector == ESCAPE:
            out[offset[mine]] = words[mine + 1]
            continue
        count, bits = PACKINGS[selector]
        mask = np.uint64((1 << bits) - 1)
        for i in range(count):
            out[offset[mine] + i] = (words[mine] >> np.uint64(i * bits)) & mask
    return out
