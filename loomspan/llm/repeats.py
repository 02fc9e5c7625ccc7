"""Repeated passages across documents, removed but for their first occurrence.

A window is a run of consecutive words of one document. A word goes if a window over it
also starts in a document with a smaller doc_id.

1. Anchors. In every window at least one short word run is picked by its hash alone, so a
   recurring window recurs with its anchor. Anchors travel packed, a block for each batch
   and hash range, and each range tells the documents whose anchors recur.
2. Confirmation. Documents are dealt into parts. A part sends the hashes of its windows with
   recurring anchors, each distinct window once; the range of a hash finds the first document
   and tells every part with a later one which of its own windows is a recurring passage. No
   words travel, and a passage of any number of documents comes once from each part.
3. Automata. Each part compiles the passages confirmed there into Aho-Corasick automata of
   their word blocks, streams all its documents through, and widens each hit to the whole
   words in common: that locates every occurrence.
4. Each document drops the located words.

Passages are confirmed by 128-bit hashes; occurrences are compared word for word.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.llm.text import window_hashes, word_hashes


@dataclass(frozen=True)
class RepeatConfig:
    """`window` words must repeat; anchors have `anchor` words. A part holds about `part_bytes` of
    text, and a hash range the hashes of about as much. An automaton has at most
    `automaton_blocks` blocks; a part with more passages streams its texts once for each."""

    window: int = 13
    anchor: int = 7
    part_bytes: int = 8 << 20
    automaton_blocks: int = 200_000

    @property
    def block(self) -> int:
        """Words of a block: every window of a passage holds a whole block that begins at a
        multiple of this from the passage's first word."""
        return (self.window + 1) // 2


#: Anchors are least hashes, so small ones prevail; times an odd number they are even again.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: The second half of a window's hash is that of its words' hashes changed by this.
SECOND = np.uint64(0xD6E8FEB86659FD93)


def text_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def window_anchors(hashes: np.ndarray, config: RepeatConfig) -> tuple[np.ndarray, np.ndarray]:
    """(run hashes, place of each window's anchor) of a text's word hashes: the least hash among
    the short runs of the window, the leftmost of equal ones. Too short a text has no windows."""
    h = window_hashes(hashes, config.anchor)
    span = config.window - config.anchor + 1
    if len(h) < span:
        return h, np.empty(0, np.int64)
    rows = np.lib.stride_tricks.sliding_window_view(h, span)
    return h * SPREAD, rows.argmin(axis=1) + np.arange(len(rows))


def pack(columns: list[np.ndarray], steps: list[bool]) -> bytes:
    """64-bit columns by byte planes, those of `steps` as differences: planes of zeros compress."""
    out = []
    for x, step in zip(columns, steps, strict=True):
        x = np.ascontiguousarray(x).view(np.uint64)
        out.append((np.diff(x, prepend=np.uint64(0)) if step else x).view(np.uint8).reshape(-1, 8).T.tobytes())
    return b"".join(out)


def unpack(block: bytes, steps: list[bool]) -> list[np.ndarray]:
    planes = np.frombuffer(block, np.uint8).reshape(len(steps), 8, -1)
    columns = [np.ascontiguousarray(p.T).view(np.uint64).reshape(-1) for p in planes]
    return [np.cumsum(x, dtype=np.uint64) if step else x for x, step in zip(columns, steps, strict=True)]


def hash_range(h: np.ndarray, ranges: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def slices(keys: np.ndarray):
    """(key, first, end) of each run of equal keys."""
    edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, np.int64)
    return [(int(keys[a]), a, b) for a, b in pairwise(edge.tolist())]


# -- what travels


#: Kinds of packed blocks, with the columns that hold differences. Of a batch: its distinct anchors
#: and texts (a digest in two halves), each with one document that has it.
ANCHORS, TEXTS = 0, 1
#: Documents with an anchor, or a whole text, that they share with others.
HITS, COPIES = 2, 3
#: A part's windows (a hash in two halves), document, place, and whether several of its documents have it.
WINDOWS = 4
#: Windows that recur: document and place in the part, and the first document of all.
PASSAGES = 5
STEPS = {ANCHORS: [True, False], TEXTS: [True, False, False], HITS: [True, False], COPIES: [True, False, False], WINDOWS: [False, False, True, True, False], PASSAGES: [True, True, True]}


def part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    """The part of each document, as part_column() has it."""
    distinct, at = np.unique(ids, return_inverse=True)
    return np.array([zlib.crc32(b"%d" % i) % parts for i in distinct.tolist()], np.int64)[at]


def part_column(parts: int) -> Column:
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    return F.pmod(F.crc32(key.cast("binary")), F.lit(parts)).cast("int")


def table_of(keys: tuple[str, ...], rows: list[tuple]) -> pa.Table:
    """Rows of int keys and a block."""
    return pa.table({**{k: pa.array([r[i] for r in rows], pa.int32()) for i, k in enumerate(keys)}, "block": pa.array([r[-1] for r in rows], pa.binary())})


def dealt_blocks(kind: int, key: np.ndarray, columns: list[np.ndarray], by: list[np.ndarray]):
    """(key, kind, block) for each value of `key`, sorted by `by`."""
    order = np.lexsort((*reversed(by), key))
    columns = [x[order] for x in columns]
    for k, a, b in slices(key[order]):
        yield k, kind, pack([x[a:b] for x in columns], STEPS[kind])


def collected(table: pa.Table, kind: int) -> list[np.ndarray] | None:
    """The columns of all blocks of a kind."""
    blocks = [unpack(x, STEPS[kind]) for k, x in zip(table["kind"].to_pylist(), table["block"].to_pylist(), strict=True) if k == kind]
    return [np.concatenate(x) for x in zip(*blocks, strict=True)] if blocks else None


def digest(text: str) -> tuple[int, int]:
    """Half of a text's SHA-256."""
    return struct.unpack("<QQ", hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:16])


# -- anchors


def packed_anchors(docs: DataFrame, ranges: int, config: RepeatConfig) -> DataFrame:
    """(range, kind, block): each batch's distinct anchors and texts, and those of its documents
    that are known to recur within it."""

    def run(batches):
        for batch in batches:
            held, owner, texts = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if doc_id is None or not text:
                    continue
                texts.append((*digest(text), doc_id))
                h, at = window_anchors(word_hashes(text_words(text)), config)
                h = np.unique(h[np.unique(at)])
                held.append(h)
                owner.append(np.full(len(h), doc_id, np.int64))
            if not texts:
                continue
            out = []
            h, d = np.concatenate(held), np.concatenate(owner)
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            fresh = np.r_[True, h[1:] != h[:-1]][: len(h)]
            group = np.cumsum(fresh) - 1
            several = np.isin(group, group[~fresh & np.r_[False, d[1:] != d[:-1]][: len(d)]])
            # One document stands for the batch: if other batches have the anchor, it alone need be told.
            out += dealt_blocks(ANCHORS, hash_range(h[fresh], ranges), [h[fresh], d[fresh]], [h[fresh]])
            out += dealt_blocks(HITS, hash_range(h[several], ranges), [d[several], h[several]], [d[several]])
            x, y, d = np.array([t[0] for t in texts], np.uint64), np.array([t[1] for t in texts], np.uint64), np.array([t[2] for t in texts], np.int64)
            order = np.lexsort((d, y, x))
            x, y, d = x[order], y[order], d[order]
            fresh = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
            later = d > d[fresh][np.cumsum(fresh) - 1]
            out += dealt_blocks(TEXTS, hash_range(x[fresh], ranges), [x[fresh], y[fresh], d[fresh]], [x[fresh]])
            out += dealt_blocks(COPIES, hash_range(x[later], ranges), [d[later], x[later], y[later]], [d[later]])
            yield table_of(("range", "kind"), out).combine_chunks().to_batches()[0]

    return docs.select("doc_id", "text").mapInArrow(run, "range int, kind int, block binary")


def recurring(packed: DataFrame, parts: int) -> DataFrame:
    """(part, kind, block): documents' anchors that others hold too, and whole texts that an earlier document has."""

    def merge(group: pa.Table) -> pa.Table:
        hits, copied = collected(group, HITS), collected(group, COPIES)
        if (got := collected(group, ANCHORS)) is not None:
            order = np.argsort(got[0], kind="stable")
            h, d = got[0][order], got[1][order]
            same = h[1:] == h[:-1]
            again = np.r_[same, False] | np.r_[False, same]
            hits = [np.concatenate(x) for x in zip(hits or [d[:0], h[:0]], [d[again], h[again]], strict=True)]
        if (got := collected(group, TEXTS)) is not None:
            x, y, d = got[0], got[1], got[2].view(np.int64)
            order = np.lexsort((d, y, x))
            x, y, d = x[order], y[order], d[order]
            fresh = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
            later = d > d[fresh][np.cumsum(fresh) - 1]
            copied = [np.concatenate(z) for z in zip(copied or [d[:0].view(np.uint64), x[:0], y[:0]], [d[later].view(np.uint64), x[later], y[later]], strict=True)]
        out = []
        for kind, columns in ((HITS, hits), (COPIES, copied)):
            if columns is not None:
                out += dealt_blocks(kind, part_of(columns[0].view(np.int64), parts), columns, [columns[0]])
        return table_of(("part", "kind"), out)

    return packed.groupBy("range").applyInArrow(merge, "part int, kind int, block binary")


# -- confirmation


class Part:
    """The texts of a part: rows by doc_id and text, so that a word's place in its document is
    the same whenever the part is read, also where rows share a doc_id."""

    def __init__(self, table: pa.Table, told: pa.Table):
        whole: dict[int, set[tuple[int, int]]] = {}
        if (got := collected(told, COPIES)) is not None:
            for k, x, y in zip(got[0].view(np.int64).tolist(), got[1].tolist(), got[2].tolist(), strict=True):
                whole.setdefault(k, set()).add((x, y))
        ids, texts = table["doc_id"].to_pylist(), table["text"].to_pylist()
        #: Row numbers of each document.
        self.rows: dict[int, list[int]] = {}
        for i in sorted((i for i, k in enumerate(ids) if k is not None), key=lambda i: (ids[i], texts[i] or "")):
            self.rows.setdefault(ids[i], []).append(i)
        #: Whether a row's whole text is an earlier document's: all its windows are known to repeat.
        self.whole = [k in whole and t is not None and digest(t) in whole[k] for k, t in zip(ids, texts, strict=True)]
        self.ids, self.texts = ids, texts

    def words(self, row: int) -> list[bytes]:
        return text_words(self.texts[row])


def part_windows(docs: DataFrame, told: DataFrame, ranges: int, config: RepeatConfig) -> DataFrame:
    """(range, of, kind, block): each part's distinct windows that hold a recurring anchor; whole
    texts that recur pass through."""

    def run(key, table: pa.Table, told: pa.Table) -> pa.Table:
        part, of, out = Part(table, told), key[0].as_py(), []
        found = []
        if (got := collected(told, HITS)) is not None:
            order = np.argsort(got[0].view(np.int64), kind="stable")
            ids, hits = got[0].view(np.int64)[order], got[1][order]
            for doc_id, a, b in slices(ids):
                base = 0
                for row in part.rows.get(doc_id, ()):
                    hashes = word_hashes(part.words(row))
                    if not part.whole[row]:
                        h, at = window_anchors(hashes, config)
                        places = np.flatnonzero(np.isin(h[at], hits[a:b])) if len(at) else at
                        if len(places):
                            second = hashes * SECOND
                            second ^= second >> np.uint64(29)
                            found.append((window_hashes(hashes, config.window)[places], window_hashes(second, config.window)[places], np.full(len(places), doc_id, np.int64), places + base))
                    base += len(hashes)
        if found:
            h, g, d, p = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((p, d, g, h))
            h, g, d, p = h[order], g[order], d[order], p[order]
            first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
            last = np.r_[first[1:], len(h)] - 1
            several = (d[first] != d[last]).astype(np.uint64)
            h, g, d, p = h[first], g[first], d[first], p[first]
            out += dealt_blocks(WINDOWS, hash_range(h, ranges), [h, g, d, p, several], [d, p])
        out += [(of % ranges, COPIES, x) for k, x in zip(told["kind"].to_pylist(), told["block"].to_pylist(), strict=True) if k == COPIES]
        return table_of(("range", "of", "kind"), [(r, of, kind, x) for r, kind, x in out])

    return docs.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(run, "range int, of int, kind int, block binary")


def confirmed(windows: DataFrame) -> DataFrame:
    """(part, kind, block): each part's windows that a document before another one has; whole texts pass through."""

    def merge(group: pa.Table) -> pa.Table:
        kinds, of, held = group["kind"].to_pylist(), group["of"].to_pylist(), group["block"].to_pylist()
        out = [(p, k, x) for p, k, x in zip(of, kinds, held, strict=True) if k == COPIES]
        if (got := collected(group, WINDOWS)) is not None:
            h, g, d, p, several = got
            part = np.repeat([p for p, k in zip(of, kinds, strict=True) if k == WINDOWS], [len(x) // (8 * len(STEPS[WINDOWS])) for x, k in zip(held, kinds, strict=True) if k == WINDOWS])
            d = d.view(np.int64)
            order = np.lexsort((d, g, h))
            h, g, d, p, several, part = h[order], g[order], d[order], p[order], several[order], part[order]
            fresh = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])]
            owner = d[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
            keep = ~fresh | (several > 0)
            d, p, owner, part = d[keep], p[keep], owner[keep], part[keep]
            out += dealt_blocks(PASSAGES, part, [d, p, owner], [d, p])
        return table_of(("part", "kind"), out)

    return windows.groupBy("range").applyInArrow(merge, "part int, kind int, block binary")


# -- automata


class WordCodes:
    """Words as strings of a fixed number of symbols, each place with an alphabet of its own.

    An automaton searches a node's branches one by one, so few symbols keep it fast, and as
    the places' alphabets differ, matches begin at words only. Word 0 is any unknown one.
    """

    BASE = 64

    def __init__(self, words: int):
        self.places = 1
        while self.BASE**self.places < words:
            self.places += 1
        self.codes = ["".join(chr(0x100 + self.BASE * p + w // self.BASE**p % self.BASE) for p in range(self.places)) for w in range(words)]

    def spell(self, numbers: list[int]) -> str:
        return "".join([self.codes[w] for w in numbers])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values in a row a and b have in common from their begin."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = np.flatnonzero(a[at : min(at + step, n)] != b[at : min(at + step, n)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, 2 * step
    return n


class Automaton:
    """Some passages' blocks, compiled. A passage is a run of words, all windows of which recur,
    and has one first document."""

    def __init__(self, passages: list[tuple[np.ndarray, int]], codes: WordCodes, config: RepeatConfig):
        import ahocorasick

        self.passages, self.codes, self.config = passages, codes, config
        self.spelled = [codes.spell(words.tolist()) for words, _ in passages]
        self.uses: list[list[tuple[int, int]]] = []
        width = config.block * codes.places
        self.automaton = ahocorasick.Automaton()
        number: dict[str, int] = {}
        for k, text in enumerate(self.spelled):
            for at in range(0, len(text) - width + 1, width):
                block = text[at : at + width]
                i = number.setdefault(block, len(number))
                if i == len(self.uses):
                    self.uses.append([])
                    self.automaton.add_word(block, i)
                self.uses[i].append((k, at // codes.places))
        self.automaton.make_automaton()

    def locate(self, doc_id: int, numbers: Callable[[], np.ndarray], spelled: str) -> list[tuple[int, int]]:
        """Word ranges of a document that passages of earlier documents cover; its words'
        numbers are asked for only where a passage is not there as a whole."""
        places, block = self.codes.places, self.config.block
        found, done, words = [], {}, None
        for end, i in self.automaton.iter(spelled):
            j = (end + 1) // places - block
            for k, at in self.uses[i]:
                passage, first = self.passages[k]
                if first >= doc_id or done.get((k, j - at), -1) >= j + block:
                    continue
                if j >= at and spelled.startswith(self.spelled[k], (j - at) * places):
                    a, b = j - at, j - at + len(passage)
                else:
                    words = numbers() if words is None else words
                    a = j - _common(words[:j][::-1], passage[:at][::-1])
                    b = j + _common(words[j:], passage[at:])
                done[k, j - at] = b
                if b - a >= self.config.window:
                    found.append((a, b))
        return found


def runs(told: pa.Table, window: int):
    """(document, first, end, first document) of each run of confirmed windows with one first document."""
    if (got := collected(told, PASSAGES)) is None:
        return
    d, p, f = (x.view(np.int64) for x in got)
    order = np.lexsort((p, d))
    d, p, f = d[order], p[order], f[order]
    edge = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1) | (f[1:] != f[:-1]), True])
    for a, b in pairwise(edge.tolist()):
        yield int(d[a]), int(p[a]), int(p[b - 1]) + window, int(f[a])


def located(part: Part, told: pa.Table, config: RepeatConfig) -> dict[int, np.ndarray]:
    """Which words of each row passages of earlier documents cover; rows that lose none are left out."""
    number: dict[bytes, int] = {}
    passages, held, words = [], None, []
    for doc_id, a, b, first in runs(told, config.window):
        if held != doc_id:
            held, words = doc_id, [w for row in part.rows[doc_id] for w in part.words(row)]
        passages.append((np.array([number.setdefault(w, len(number) + 1) for w in words[a:b]], np.int32), first))
    gone: dict[int, np.ndarray] = {}
    for row, whole in enumerate(part.whole):
        if whole and len(words := part.words(row)) >= config.window:
            gone[row] = np.ones(len(words), bool)
    if not passages:
        return gone
    codes = WordCodes(len(number) + 1)
    code, unknown = {w: codes.codes[i] for w, i in number.items()}, codes.codes[0]
    weight = np.cumsum([len(p) // config.block for p, _ in passages]) // config.automaton_blocks
    for _, a, b in slices(weight):
        automaton = Automaton(passages[a:b], codes, config)
        for row, (doc_id, text) in enumerate(zip(part.ids, part.texts, strict=True)):
            if doc_id is None or not text or part.whole[row]:
                continue
            words = part.words(row)
            spelled = "".join([code.get(w, unknown) for w in words])
            for x, y in automaton.locate(doc_id, lambda words=words: np.array([number.get(w, 0) for w in words], np.int32), spelled):
                gone.setdefault(row, np.zeros(len(words), bool))[x:y] = True
    return gone


Finish = Callable[[pa.Table, dict[int, np.ndarray]], pa.Table]


def cut(docs: DataFrame, config: RepeatConfig, finish: Finish, schema: str) -> DataFrame:
    """`finish` of each part's rows and of the words that they lose, by row.

    Columns keep their places, but only doc_id and text their names; the last one is the part.
    The texts are dealt once: looking for windows and removing words read the same exchange.
    """
    docs = docs.toDF(*(c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + total // config.part_bytes
    dealt = docs.withColumn("part", part_column(parts))
    told = recurring(packed_anchors(docs, parts, config), parts)
    found = confirmed(part_windows(dealt, told, parts, config))

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        return finish(table, located(Part(table, told), told, config))

    return dealt.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(run, schema)


def removal_digests(docs: DataFrame, config: RepeatConfig = RepeatConfig()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row of docs.

    A null text has no words. Rows that share a doc_id are one document: a window they share
    is not repeated by that. A row with a null doc_id keeps all and repeats nothing. Only
    doc_id and text are read.
    """

    def finish(table: pa.Table, gone: dict[int, np.ndarray]) -> pa.Table:
        n, removed, sha = [], [], []
        for row, text in enumerate(table["text"].to_pylist()):
            kept = tokens = text_words(text)
            if row in gone:
                kept = [w for w, g in zip(tokens, gone[row].tolist(), strict=True) if not g]
            n.append(len(tokens))
            removed.append(len(tokens) - len(kept))
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return pa.table({"doc_id": table["doc_id"], "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})

    return cut(docs.select("doc_id", "text"), config, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, config: RepeatConfig = RepeatConfig()) -> DataFrame:
    """docs with repeated passages cut from `text`; a document left without words goes.

    Columns stay as they are. A text that loses nothing is unchanged; white space around
    the kept words of others stays. Null texts and rows that had no words before stay, as do
    rows without a doc_id. Repeated rows of one doc_id stay repeated.
    """
    import regex

    word = regex.compile(rb"[^\x20\x09-\x0D]+")
    fields = docs.columns
    text_at = fields.index("text")

    def finish(table: pa.Table, gone: dict[int, np.ndarray]) -> pa.Table:
        texts, keep = table["text"].to_pylist(), np.ones(table.num_rows, bool)
        for row, lost in gone.items():
            raw = texts[row].encode("utf-8", "surrogatepass")
            out, at = [], 0
            for m, g in zip(word.finditer(raw), lost.tolist(), strict=True):
                if g:
                    out.append(raw[at : m.start()])
                    at = m.end()
            out.append(raw[at:])
            texts[row] = b"".join(out).decode("utf-8", "surrogatepass")
            keep[row] = not lost.all()
        columns = list(table.columns[: len(fields)])
        columns[text_at] = pa.array(texts, pa.string())
        return pa.Table.from_arrays(columns, names=fields).filter(pa.array(keep))

    return cut(docs, config, finish, docs.schema)
