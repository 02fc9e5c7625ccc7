"""Token ids of documents in one global order, in Simple-8b files of bounded size.

Documents are put in ascending doc_id order by a range partitioning; each range is one
shard of the output, a set of Parquet rows in the shared folder: (shard, chunk, first
document's rank in the shard, binary file image). A file image is a header, a document
table, a block offset table and the coded words. The start of each document in the
whole sequence is the sum of the ids in earlier shards plus those before it in its own.
"""

from __future__ import annotations

import struct
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.llm import simple8b
from loomspan.session import materialize

MAGIC = b"S8BTOK1\0"
#: Ids in a file image at most, unless a single document has more.
CHUNK_IDS = 1 << 20
#: Text that a range of documents holds, about, and that a task encodes at once.
RANGE_BYTES = 16 << 20
GROUP_BYTES = 8 << 20
#: Bytes of distinct text parts and their ids that a Python worker remembers, about.
MEMORY = 128 << 20
#: What a part takes besides its characters: its string's header, its place among the known ones, its ids.
PART_BYTES = 200
#: Where texts are cut: before a space after a character that is neither white space nor a control
#: one, of blocks that have none; and before punctuation after a letter or digit, of blocks that every
#: version of Unicode has alike. An apostrophe may open a contraction, so it is none.
#: A byte's bits: plain ASCII that is no space, a letter or digit among it, punctuation but the apostrophe.
SOLID, WORD, POINT = 1, 2, 4
KINDS = np.array([SOLID * (33 <= b < 127) | WORD * (b < 128 and chr(b).isalnum()) | POINT * (33 <= b < 127 and not chr(b).isalnum() and b != 39) for b in range(256)], np.uint8)


def load_tokenizer(path: str):
    """The tokenizers library's tokenizer, as its file has it."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _ends_solid(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place, not an ASCII one, is of a block without white
    space: U+00C0 to U+07FF, U+2010 to U+2027, U+2080 to U+2FFF, U+4000 to U+DFFF, and those of four bytes."""
    one, two, three, four = (data[np.maximum(at - k, 0)] for k in (1, 2, 3, 4))
    inner = two & 0xC0 == 0x80
    low = (two >= 0xC3) & (two < 0xE0)
    mid = inner & ((three == 0xE2) & ((two >= 0x82) | (two == 0x80) & (one >= 0x90) & (one <= 0xA7)) | (three >= 0xE4) & (three <= 0xED))
    return (one >= 0x80) & (low | mid | inner & (three & 0xC0 == 0x80) & (four >= 0xF0))


def _ends_word(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place, not an ASCII one, is a letter of U+00C0 to U+024F."""
    one, two = (data[np.maximum(at - k, 0)] for k in (1, 2))
    times = (two == 0xC3) & ((one == 0x97) | (one == 0xB7))
    return (one >= 0x80) & (one < 0xC0) & ((two >= 0xC3) & (two <= 0xC8) | (two == 0xC9) & (one <= 0x8F)) & ~times


def cuts(data: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes at which parts begin, in order; what of them follows a text's first byte depends on this text alone."""
    kind = KINDS[data]
    before, high = kind[:-1], data[:-1] >= 0x80
    space, point = data[1:] == 32, kind[1:] & POINT != 0
    found = space & (before & SOLID != 0) | point & (before & WORD != 0)
    for opens, test in ((space, _ends_solid), (point, _ends_word)):
        places = np.flatnonzero(high & opens)
        found[places] = test(data, places + 1)
    return np.flatnonzero(found) + 1


class PartEncoder:
    """Encodes whole texts part by part, and remembers the ids of frequent parts.

    A part starts at a space after a character that is no white space, or at punctuation after
    a letter or digit. Byte-level pre-tokenizing never joins characters over such a place, so
    the ids of a text without added tokens' strings are its parts' ids in order. Texts are cut by their bytes, and
    distinct parts found in Arrow; only parts not yet known are encoded. Forgetting a part only costs
    encoding it again.
    """

    def __init__(self, tokenizer, memory: int = MEMORY):
        self.tokenizer, self.memory = tokenizer, memory
        #: Whether an id's bytes begin with a space.
        self.opens = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, i in tokenizer.get_vocab().items():
            self.opens[i] = token.startswith("\u0120")  # how byte-level vocabularies write a space
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.size, self.count = 0, 0
        self.starts, self.ids = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, "<u4")

    def _remember(self, parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Parts with their ids, one after another."""
        n = self.size + len(ids)
        if n > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.size], np.zeros(max(n, len(self.ids)), "<u4")))
        self.ids[self.size : n] = ids
        at = self.count + len(parts)
        if at + 1 > len(self.starts):
            self.starts = np.concatenate((self.starts[: self.count + 1], np.zeros(max(at + 1, len(self.starts)), np.int64)))
        self.starts[self.count + 1 : at + 1] = self.size + np.cumsum(sizes)
        self.known.update(zip(parts, range(self.count, at), strict=True))
        self.size, self.count = n, at

    def learn(self, missing: list[str]) -> None:
        """Parts with one space, at their begin, are encoded together: each id that begins with
        a space opens the next part."""
        plain = [p for p in missing if p.rfind(" ") == 0 and not p[-1].isspace() and p.isprintable()]
        for i in range(0, len(plain), 512):
            some = plain[i : i + 512]
            got = np.array(self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.append(np.flatnonzero(self.opens[got]), len(got))
            if len(cuts) != len(some) + 1:
                raise AssertionError("the vocabulary does not mark spaces as expected")
            self._remember(some, got, np.diff(cuts))
        if len(plain) < len(missing):
            rest = list(set(missing).difference(plain))
            found = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            self._remember(rest, np.array([x for ids in found for x in ids], "<u4"), np.array([len(x) for x in found]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each text); a null text has none. A text that holds
        an added token, which is found in the raw text before all else, is encoded whole."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        marked = pa.array(np.zeros(len(texts), bool))
        for token in self.added:
            marked = pc.or_(marked, pc.match_substring(texts, token))
        cut = pc.if_else(marked, "", texts) if pc.any(marked).as_py() else texts
        bounds = np.frombuffer(cut.buffers()[1], np.int32)[cut.offset : cut.offset + len(cut) + 1] if len(cut) else np.zeros(1, np.int32)
        data = np.frombuffer(cut.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        # A part begins where a text does, too; an empty text has none.
        opens = np.zeros(len(data) + 1, bool)
        opens[bounds] = True
        opens[cuts(data)] = True
        opens[-1] = True
        places = np.flatnonzero(opens).astype(np.int32)
        begins = places[:-1]
        parts = pa.StringArray.from_buffers(len(begins), pa.py_buffer(places), pa.py_buffer(data)).dictionary_encode()
        code, distinct = parts.indices, parts.dictionary.to_pylist()
        of = np.searchsorted(begins, bounds)
        del cut, parts, places, begins, data
        if self.held > self.memory:
            self.forget()
        row = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        fresh = np.flatnonzero(row < 0)
        if len(fresh):
            missing = [distinct[i] for i in fresh.tolist()]
            self.held += sum(map(len, missing)) * 2 + len(missing) * PART_BYTES
            self.learn(missing)
            row[fresh] = [self.known[p] for p in missing]
        # Ids of the distinct parts side by side, as binary values; Arrow copies them to where the parts are.
        sizes = self.starts[row + 1] - self.starts[row]
        ends = np.cumsum(sizes)
        own = self.ids[np.arange(int(sizes.sum())) + np.repeat(self.starts[row] - (ends - sizes), sizes)]
        held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(np.concatenate(([0], ends)) * 4), pa.py_buffer(own)])
        found = held.take(code)
        at = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1) // 4 if len(found) else np.zeros(1, np.int64)
        ids = np.frombuffer(found.buffers()[2], "<u4", int(at[-1])) if at[-1] else np.zeros(0, "<u4")
        per = np.diff(at[of])
        pa.default_memory_pool().release_unused()
        if not pc.any(marked).as_py():
            return ids, per
        whole = {i: np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4") for i in np.flatnonzero(marked.to_numpy(zero_copy_only=False)).tolist()}
        each = [whole.get(i, x) for i, x in enumerate(np.split(ids, np.cumsum(per)[:-1]))]
        return np.concatenate(each), np.array([len(x) for x in each])


_encoders: dict[str, PartEncoder] = {}


def worker_encoder(path: str) -> PartEncoder:
    """The encoder of this Python worker; later tasks find what earlier ones have learned."""
    if path not in _encoders:
        _encoders[path] = PartEncoder(load_tokenizer(path))
    return _encoders[path]


def write_image(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """A file image: header, document table (doc_id, null flag, ids), block offsets, words."""
    words, before = simple8b.encode(ids)
    table = np.zeros(len(sizes), np.dtype([("doc_id", "<i8"), ("null", "<u1"), ("ids", "<i8")]))
    table["doc_id"] = [x or 0 for x in doc_ids]
    table["null"] = [x is None for x in doc_ids]
    table["ids"] = sizes
    return MAGIC + struct.pack("<qqq", len(table), len(before), len(words)) + table.tobytes() + before.astype("<i8").tobytes() + words.astype("<u8").tobytes()


def read_image(image: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document table, ids of all documents, words before each block) of a file image."""
    if image[:8] != MAGIC:
        raise ValueError("not a token file")
    docs, blocks, words = struct.unpack_from("<qqq", image, 8)
    dtype = np.dtype([("doc_id", "<i8"), ("null", "<u1"), ("ids", "<i8")])
    at = 32
    table = np.frombuffer(image, dtype, docs, at)
    at += docs * dtype.itemsize
    before = np.frombuffer(image, "<i8", blocks, at)
    at += blocks * 8
    return table, simple8b.decode(np.frombuffer(image, "<u8", words, at)).astype("<u4"), before


def read_block(image: bytes, block: int) -> np.ndarray:
    """The ids of one block alone, by its offset."""
    docs, blocks, _ = struct.unpack_from("<qqq", image, 8)
    at = 32 + docs * 17
    start, end = np.frombuffer(image, "<i8", 2, at + 8 * block).tolist()
    return simple8b.decode(np.frombuffer(image, "<u8", end - start, at + blocks * 8 + 8 * start)).astype("<u4")


def groups(texts: pa.Array):
    """(first, rows) of consecutive rows of about GROUP_BYTES."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes) - sizes) // GROUP_BYTES
    edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if len(group) else np.zeros(1, np.int64)
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        yield a, b - a


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """(shard, chunk, n_docs, n_ids, image): token files of all documents in doc_id order.

    Each document's ids are followed by `end_id`. A null text counts as empty; rows with a
    null doc_id come first; rows that share a doc_id keep together in the order of their
    texts. Only doc_id and text are read. An empty table gives no files.
    """

    def run(batches):
        encoder = worker_encoder(tokenizer_path)
        shard, chunk, held, sizes, ids, total = None, 0, [], [], [], 0

        def image():
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([chunk], pa.int32()), pa.array([len(held)], pa.int64()), pa.array([total], pa.int64()), pa.array([write_image(held, sizes, np.concatenate(ids))], pa.binary())],
                names=["shard", "chunk", "n_docs", "n_ids", "image"],
            )

        for batch in batches:
            shard = batch.column(2)[0].as_py() if shard is None and batch.num_rows else shard
            for first, rows in groups(batch.column(1)):
                got, per = encoder.encode(batch.column(1).slice(first, rows))
                ends = np.cumsum(per)
                got = np.insert(got, ends, end_id)  # one end after each document
                ends, doc_ids, a = ends + np.arange(1, rows + 1), batch.column(0).slice(first, rows).to_pylist(), 0
                while a < rows:
                    begin = int(ends[a - 1]) if a else 0
                    b = min(rows, 1 + int(np.searchsorted(ends, begin + chunk_ids - total)))  # the document that fills the chunk is its last
                    held += doc_ids[a:b]
                    sizes += (per[a:b] + 1).tolist()
                    ids.append(got[begin : ends[b - 1]])
                    total += int(ends[b - 1]) - begin
                    a = b
                    if total >= chunk_ids:
                        yield image()
                        chunk, held, sizes, ids, total = chunk + 1, [], [], [], 0
        if held:
            yield image()

    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = docs.select("doc_id", "text").repartitionByRange(1 + total // RANGE_BYTES, "doc_id").sortWithinPartitions("doc_id", "text")
    return ranges.withColumn("shard", F.spark_partition_id()).mapInArrow(run, "shard int, chunk int, n_docs long, n_ids long, image binary")


def read_tokens(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files alone.

    `start` is the number of ids of all documents before it. `files` must be stored. Each file
    is decoded where it lies; the ids in the files before it are added to its documents'
    places afterwards, from the files' sizes.
    """

    def run(batches):
        for batch in batches:
            for shard, chunk, image in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                table, ids, _ = read_image(image)
                ends = np.cumsum(table["ids"])
                starts = ends - table["ids"]
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(crc), pa.int32()), pa.array([chunk] * len(crc), pa.int32()), pa.array(table["doc_id"], mask=table["null"].astype(bool)), pa.array(starts), pa.array(table["ids"].astype(np.int64)), pa.array(crc, pa.int64())],
                    names=["shard", "chunk", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    earlier = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = shards.select(F.col("shard").alias("s"), earlier.alias("base"))
    chunks = files.select("shard", "chunk", "n_ids")
    within = F.coalesce(F.sum("n_ids").over(Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = chunks.withColumn("within", within).join(base, F.col("shard") == F.col("s")).select(F.col("shard").alias("s"), F.col("chunk").alias("c"), (F.col("base") + F.col("within")).alias("before"))
    decoded = files.select("shard", "chunk", "image").mapInArrow(run, "shard int, chunk int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    placed = decoded.join(offsets, (F.col("shard") == F.col("s")) & (F.col("chunk") == F.col("c")))
    return placed.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_digests(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write the token files and read the digests back from them."""
    return read_tokens(materialize(write_tokens(docs, tokenizer_path, end_id), "token-files"))
