"""Exact n-gram Jaccard join in the Jaccard metric space.

1. Every document becomes the set of its word shingles; equal sets fall together.
2. Two sets within the threshold must share shingles among the first of each set in one
   global order (rare ones first, by counts over all documents in a fixed number of
   hash bins). Texts without such a link are at distance 1 from each other and from any
   pivot, so triangle inequalities cannot part them; this step does, and leaves regions
   of documents that may link.
3. Each region is split by pivots that lie far apart. A document within the radius of a
   pivot is linked to it. Documents go to the Voronoi cell of the nearest pivot and, if they
   lie near a boundary by the triangle inequality, to the neighbours' cells; those far from
   all pivots form one more cell; those deep inside a pivot's ball are left out. Cells
   are split again until they are small. A split that does not shrink its region is not
   made: its documents are compared in windows of their sizes.

A region within the task bound is split in memory, in one task; a larger one is split by
Spark, with the same windows. Nothing is approximate, but for collisions of 64-bit hashes:
any pair within the threshold ends up in one component.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.llm.sketch import parted
from loomspan.llm.text import shingle_set
from loomspan.session import discard, materialize, scratch


@dataclass(frozen=True)
class JaccardConfig:
    """Documents link when 100 * |A & B| >= `percent` * |A | B|. `bins` fixes the size of the
    shingle counts that order shingles. Cells of up to `small_cell` documents give
    candidate pairs, which need as many shared prefix shingles as `slack` forces.
    Regions of up to `region_weight` are joined in one task; a document weighs as many as its
    shingles, and `least_weight` at least. A split has at most `pivots` pivots, or in memory the
    square root of its members if that is more. It is made only if comparing all pairs in the
    cells, and all members with the pivots, takes at most `shrink` times as many comparisons as
    all pairs of the region, and the cells hold at most `growth` times its documents."""

    size: int = 5
    percent: int = 80
    bins: int = 1 << 20
    slack: float = 0.05
    small_cell: int = 16
    region_weight: int = 500_000
    least_weight: int = 100
    pivots: int = 64
    shrink: float = 0.7
    growth: float = 2.0


BIN_BLOCK = 1 << 14

#: A task adds its shingles up once it holds so many, and works on so many rows of a batch at once.
HELD_SHINGLES, HELD_ROWS = 1 << 18, 1_000


def linked(common, a, b, percent: int):
    """Whether sets of sizes a and b with `common` shared elements link; integers only."""
    return 100 * common >= percent * (a + b - common)


# -- shingle counts and the global order


def bin_counts(docs: DataFrame, config: JaccardConfig) -> np.ndarray:
    """How many documents' shingles fall in each hash bin: `config.bins` numbers, whatever
    the input. Tasks add theirs up first, and hold the shingles of some texts only; blocks of
    bins are summed in two levels."""

    def local(batches):
        total = np.zeros(config.bins, np.int64)
        held, n = [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(shingle_set(text.as_py(), config.size))
                n += len(held[-1])
                if n >= HELD_SHINGLES:
                    total += np.bincount((np.concatenate(held) & np.uint64(config.bins - 1)).astype(np.int64), minlength=config.bins)
                    held, n = [], 0
        if held:
            total += np.bincount((np.concatenate(held) & np.uint64(config.bins - 1)).astype(np.int64), minlength=config.bins)
        blocks = range(0, config.bins, BIN_BLOCK)
        small = total.astype(np.uint32) if total.max() < 1 << 32 else total
        kind = np.uint16 if total.max() < 1 << 16 else small.dtype
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([b // BIN_BLOCK for b in blocks], pa.int32()),
                pa.array([np.dtype(kind).itemsize] * len(blocks), pa.int32()),
                pa.array([total[b : b + BIN_BLOCK].astype(kind).tobytes() for b in blocks], pa.binary()),
            ],
            names=["block", "width", "counts"],
        )

    def add(key, group):
        total = 0
        for width, x in zip(group["width"].to_pylist(), group["counts"].to_pylist(), strict=True):
            total = total + np.frombuffer(x, f"<u{width}").astype(np.int64)
        width = 4 if total.max() < 1 << 32 else 8
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "width": pa.array([width], pa.int32()), "counts": pa.array([total.astype(f"<u{width}").tobytes()], pa.binary())})

    schema = "block int, width int, counts binary"
    parts = docs.select("text").mapInArrow(local, schema).withColumn("salt", F.spark_partition_id() % 64)
    first = parts.groupBy("block", "salt").applyInArrow(lambda key, t: add(key, t), schema)
    out = np.zeros(config.bins, np.int64)
    for row in first.groupBy("block").applyInArrow(lambda key, t: add(key, t), schema).collect():
        out[row["block"] * BIN_BLOCK : (row["block"] + 1) * BIN_BLOCK] = np.frombuffer(row["counts"], f"<u{row['width']}").astype(np.int64)
    return out


def forced(n: int, config: JaccardConfig) -> int:
    """Prefix shingles that a set of size n surely shares with a linked one, by the slack."""
    return 1 + int(config.slack * n)


def prefix_length(n: int, config: JaccardConfig) -> int:
    """A set of size n shares at least ceil(n * percent / 100) shingles with a linked one; so many
    of its first shingles must hold forced(n) of them, whatever the rest holds."""
    return min(n, n - -(-n * config.percent // 100) + forced(n, config))


def signatures(docs: DataFrame, order: np.ndarray, config: JaccardConfig) -> DataFrame:
    """doc_id, n, sig1, sig2 (the set's digest) and prefix (its first shingles) of each row."""
    shipped = docs.sparkSession.sparkContext.broadcast(np.minimum(order, np.iinfo(np.uint32).max).astype(np.uint32))

    def run(batches):
        rank = shipped.value
        mask = np.uint64(config.bins - 1)
        for batch in (whole.slice(i, HELD_ROWS) for whole in batches for i in range(0, whole.num_rows, HELD_ROWS)):
            n, s1, s2, prefix = [], [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), config.size)
                n.append(len(s))
                s1.append(int(np.add.reduce(s).view(np.int64)))
                s2.append(int(np.bitwise_xor.reduce(s * np.uint64(0x9E3779B97F4A7C15) ^ (s >> np.uint64(29))).view(np.int64)) if len(s) else 0)
                k = prefix_length(len(s), config)
                first = np.lexsort((s, rank[(s & mask).astype(np.int64)]))[:k]
                prefix.append(s[first].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))],
                names=["doc_id", "n", "sig1", "sig2", "prefix"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, sig1 long, sig2 long, prefix array<long>")


# -- candidate regions


def cell_slices(batches, config: JaccardConfig):
    """Prefix rows (doc_id, n, prefix) by slices, as arrays: (shingle, doc_id, n, -1 where several are tied),
    in the order of shingles as unsigned numbers, and (doc_id, tied): edges of one cell."""
    rows = 4 * HELD_ROWS
    for batch in (whole.slice(i, rows) for whole in batches for i in range(0, whole.num_rows, rows)):
        ids, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        prefix = batch.column(2)
        per = np.diff(prefix.offsets.to_numpy())
        sig, doc = prefix.values.to_numpy()[prefix.offsets.to_numpy()[0] : prefix.offsets.to_numpy()[-1]].view(np.uint64), np.repeat(ids, per)
        order = np.lexsort((doc, sig))
        sig, doc, n = sig[order], doc[order], np.repeat(sizes, per)[order]
        first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]][: len(sig)])
        count = np.diff(np.append(first, len(sig)))
        many = np.repeat(count > config.small_cell, count)
        least = np.repeat(doc[first], count)
        head = np.zeros(len(sig), bool)
        head[first] = True
        sent = ~many | head
        tied = many & (doc > least)
        yield sig[sent], doc[sent], np.where(many, -1, n)[sent], doc[tied], least[tied]


def prefix_cells(firsts: DataFrame, config: JaccardConfig) -> DataFrame:
    """(shingle, doc_id, n, tied): each prefix shingle's documents, and edges of one cell, as rows.

    A slice of a batch with more than `small_cell` documents of a shingle ties them to the least
    of them at once (`tied`), and sends that one alone, with a null n: so a very frequent
    shingle comes to its cell once for each slice.
    """

    def run(batches):
        for sig, doc, n, tied, least in cell_slices(batches, config):
            edge = np.r_[np.zeros(len(sig), bool), np.ones(len(tied), bool)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[sig.view(np.int64), tied], mask=edge),
                    pa.array(np.r_[doc, tied]),
                    pa.array(np.r_[n, tied], mask=edge | np.r_[n < 0, edge[len(sig) :]]),
                    pa.array(np.r_[doc, least], mask=~edge),
                ],
                names=["shingle", "doc_id", "n", "tied"],
            )

    return firsts.select("doc_id", "n", "prefix").mapInArrow(run, "shingle long, doc_id long, n long, tied long")


#: Bits of a shingle that its cell goes by. A cell of two shingles only gives more candidates.
CELL_BITS = 48

#: Prefix rows of a part, about.
PART_ROWS = 1 << 19


def planes(x: np.ndarray) -> bytes:
    """Numbers of 64 bits as bytes of one weight after the other: the high ones, mostly equal, take no room once compressed."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view(np.uint64).reshape(-1)


def shared_cells(firsts: DataFrame, config: JaccardConfig, parts: int) -> DataFrame:
    """(shingle, doc_id, n, tied, least, large): prefix_cells() of several documents, with the least of them, and
    whether they are too many to be compared; and edges of one cell (`tied`), as they are.

    Shingles travel in blocks, one of each slice for each of `parts` ranges of them: sorted, as
    differences, and with the bytes of one weight together, about 7 bytes a row in place of 19.
    """

    def pack(batches):
        for sig, doc, n, tied, least in cell_slices(batches, config):
            sig = sig >> np.uint64(64 - CELL_BITS)
            part = ((sig >> np.uint64(CELL_BITS - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)])
            step = np.diff(sig, prepend=np.uint64(0))
            step[starts] = sig[starts]
            bounds = list(zip(starts.tolist(), np.append(starts[1:], len(sig)).tolist(), strict=True))
            held = [(int(part[a]), planes(step[a:b]), planes(doc[a:b]), planes(n[a:b])) for a, b in bounds]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in held], pa.int32()), *(pa.array([x[k] for x in held], pa.binary()) for k in (1, 2, 3)), pa.array([b""] * len(held), pa.binary()), pa.array([b""] * len(held), pa.binary())],
                names=["part", "shingles", "docs", "sizes", "tied", "least"],
            )
            if len(tied):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(tied[0]) % parts], pa.int32()), *(pa.array([b""], pa.binary()) for _ in range(3)), pa.array([planes(tied)]), pa.array([planes(least)])],
                    names=["part", "shingles", "docs", "sizes", "tied", "least"],
                )

    def unpack(group: pa.Table) -> pa.Table:
        read = lambda name, f=from_planes: np.concatenate([f(x) for x in group[name].to_pylist()] or [np.empty(0, np.uint64)])
        sig, doc, n = read("shingles", lambda x: np.cumsum(from_planes(x), dtype=np.uint64)), read("docs").view(np.int64), read("sizes").view(np.int64)
        order = np.lexsort((doc, sig))
        sig, doc, n = sig[order], doc[order], n[order]
        first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]][: len(sig)])
        count = np.diff(np.append(first, len(sig)))
        many = np.logical_or.reduceat(n < 0, first) | (count > config.small_cell) if len(sig) else np.empty(0, bool)
        least, large = np.repeat(doc[first], count), np.repeat(many, count)
        kept = np.repeat(count > 1, count)
        sig, doc, n, least, large = sig[kept], doc[kept], n[kept], least[kept], large[kept]
        tied, to = read("tied").view(np.int64), read("least").view(np.int64)
        edge = np.r_[np.zeros(len(sig), bool), np.ones(len(tied), bool)]
        return pa.table(
            {
                "shingle": pa.array(np.r_[sig.view(np.int64), tied], mask=edge),
                "doc_id": pa.array(np.r_[doc, tied]),
                "n": pa.array(np.r_[n, tied], mask=edge | np.r_[n < 0, edge[len(sig) :]]),
                "tied": pa.array(np.r_[doc, to], mask=~edge),
                "least": pa.array(np.r_[least, tied], mask=edge),
                "large": pa.array(np.r_[large, edge[len(sig) :]], mask=edge),
            }
        )

    packed = firsts.select("doc_id", "n", "prefix").mapInArrow(pack, "part int, shingles binary, docs binary, sizes binary, tied binary, least binary")
    return packed.groupBy("part").applyInArrow(unpack, "shingle long, doc_id long, n long, tied long, least long, large boolean")


def candidate_edges(firsts: DataFrame, config: JaccardConfig, parts: int = 8) -> DataFrame:
    """(a, b) with a < b: documents of one region. Every linked pair is joined by such edges.

    A shingle's cell holds the documents with it in their prefix. Of a pair whose common
    prefix shingles all lie in small cells, enough are counted there; all documents of a
    larger cell are tied to its smallest.
    """
    cells = materialize(shared_cells(firsts, config, parts), "jaccard-cells")
    large = cells.filter(F.col("tied").isNull() & F.col("large") & (F.col("doc_id") > F.col("least"))).select(F.col("least").alias("a"), F.col("doc_id").alias("b"))
    tied = cells.filter(F.col("tied").isNotNull()).select(F.col("tied").alias("a"), F.col("doc_id").alias("b"))
    small = (
        cells.filter(F.col("tied").isNull() & ~F.col("large"))
        .groupBy("shingle")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "n"))).alias("m"))
        .select(F.explode(F.flatten(F.transform("m", lambda x: F.transform(F.filter("m", lambda y: (y["doc_id"] > x["doc_id"]) & (100 * F.least(x["n"], y["n"]) >= config.percent * F.greatest(x["n"], y["n"]))), lambda y: F.struct(x["doc_id"].alias("a"), y["doc_id"].alias("b"), F.least(x["n"], y["n"]).alias("n")))))).alias("p"))
        .select("p.*")
        .groupBy("a", "b")
        .agg(F.count("*").alias("common"), F.min("n").alias("n"))
    )
    # Both prefixes hold the first forced(n) shared shingles, n the smaller set's size.
    enough = small.filter(F.col("common") >= 1 + F.floor(F.col("n") * F.lit(config.slack)))
    return enough.select("a", "b").union(large).union(tied).distinct()


# -- pivots and cells


def radius_of(config: JaccardConfig) -> float:
    return 1 - config.percent / 100 + 1e-6  # a little wide: distances only rule pairs out


def distances(common: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
    return 1 - common / (size + sizes - common)


def cell_windows(far: np.ndarray, radius: float) -> np.ndarray:
    """Which cells each member goes to, from its distances to the pivots (members x pivots): a
    column for each pivot and a last one for the members far from all pivots.

    Let x and y link, so their distances to any pivot differ by the radius at most, and let
    `bound` part near from far members. If both are near, each is in the cell of the other's
    nearest pivot: its distance there is at most its least one and twice the radius, and at
    most bound and radius. If one is far, the other's least distance is at least the bound
    less the radius, and both are in the last cell.
    """
    bound = 1 - 2 * radius
    nearest = far.min(axis=1, keepdims=True)
    cells = (nearest < bound) & (far <= np.minimum(nearest + 2 * radius, bound + radius))
    return np.append(cells, nearest >= bound - radius, axis=1)


def may_leave(far: np.ndarray, near: np.ndarray, edge, radius: float) -> np.ndarray:
    """Members of a pivot's cell that have to stay: those outside its ball, and those inside from
    which a link may reach outside; `edge` is the least distance of those outside."""
    return ~near | (far >= edge - radius)


def spread_pivots(count: int, most: int, apart: float, measure) -> list[int]:
    """Farthest-first choice among `count` members: measure(i) gives member i's distances to all.
    Pivots are more than `apart` from each other, so that few members lie between two."""
    chosen, nearest = [0], measure(0)
    while len(chosen) < most:
        i = int(nearest.argmax())
        if nearest[i] <= apart:
            break
        chosen.append(i)
        nearest = np.minimum(nearest, measure(i))
    return chosen


# -- joining a region in memory


class Links:
    """Components under construction; `roots` are read at once, and made anew only after a change."""

    def __init__(self, count: int):
        self.parent = np.arange(count)
        self.stale = False

    def roots(self) -> np.ndarray:
        if self.stale:
            while (up := self.parent[self.parent] != self.parent).any():
                self.parent[up] = self.parent[self.parent[up]]
            self.stale = False
        return self.parent

    def join(self, i: int, others: np.ndarray) -> None:
        """Put all into one component, whose root is the least."""
        roots = self.roots()
        mine = np.unique(np.append(roots[others], roots[i]))
        if len(mine) > 1:
            self.parent[mine] = mine[0]
            self.stale = True


class Cell:
    """Some members' sets, one after another, by size."""

    def __init__(self, members: np.ndarray, sizes: np.ndarray, codes: list[np.ndarray]):
        self.members = members[np.argsort(sizes[members], kind="stable")]
        self.sizes = sizes[self.members]
        self.codes = np.concatenate([codes[i] for i in self.members.tolist()])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def common(self, i: int, mark: np.ndarray, a: int, b: int) -> np.ndarray:
        """Shingles that set i shares with each of sets a to b."""
        own = self.codes[self.starts[i] : self.starts[i] + self.sizes[i]]
        mark[own] = True
        first = self.starts[a]
        last = self.starts[b - 1] + self.sizes[b - 1]
        found = np.add.reduceat(mark[self.codes[first:last]].astype(np.int32), self.starts[a:b] - first)
        mark[own] = False
        return found


def join_region(ids: list[int], sets: list[np.ndarray], config: JaccardConfig, sizes_of_splits: list | None = None) -> list[int]:
    """The least id that each member reaches by links within the region; exact.

    Rows of one id are one document. `sizes_of_splits` collects (members, members of all cells,
    of the largest) of each split that is made.
    """
    percent, radius = config.percent, radius_of(config)
    order = np.lexsort((np.array([len(s) for s in sets]), np.array(ids)))
    ids, sets = np.array(ids, np.int64)[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets], np.int64)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    codes = np.split(flat, np.cumsum(sizes)[:-1])
    mark = np.zeros(int(flat.max()) + 1, bool)
    links = Links(len(ids))
    for i in np.flatnonzero(ids[1:] == ids[:-1]).tolist():
        links.join(i, np.array([i + 1]))

    def compare(cell: Cell) -> None:
        """All pairs of different components in windows of sizes."""
        last = np.searchsorted(100 * cell.sizes, percent * cell.sizes, side="left")  # the least size that each may link with
        high = np.searchsorted(last, np.arange(len(cell.members)), side="right")
        for i, b in enumerate(high.tolist()):
            if b <= i + 1:
                continue
            roots = links.roots()[cell.members[i:b]]
            if (roots[1:] == roots[0]).all():
                continue
            c = cell.common(i, mark, i + 1, b)
            links.join(int(cell.members[i]), cell.members[i + 1 : b][linked(c, cell.sizes[i], cell.sizes[i + 1 : b], percent)])

    todo = [np.arange(len(ids))]
    while todo:
        cell = Cell(todo.pop(), sizes, codes)
        m = len(cell.members)
        if m <= config.small_cell:
            compare(cell)
            continue
        shared: dict[int, np.ndarray] = {}

        def measure(i: int, cell=cell, m=m, shared=shared) -> np.ndarray:
            shared[i] = cell.common(i, mark, 0, m)
            return distances(shared[i], cell.sizes[i], cell.sizes)

        pivots = spread_pivots(m, max(config.pivots, math.isqrt(m)), 1 - radius, measure)
        near = np.stack([linked(shared[i], cell.sizes[i], cell.sizes, percent) for i in pivots], axis=1)
        far = np.stack([distances(shared[i], cell.sizes[i], cell.sizes) for i in pivots], axis=1)
        for k, i in enumerate(pivots):
            links.join(int(cell.members[i]), cell.members[near[:, k]])
        inside = cell_windows(far, radius)
        parts = [cell.members[inside[:, -1]]]
        for k in range(len(pivots)):
            mine = inside[:, k]
            out = far[mine & ~near[:, k], k]
            if len(out):  # else the whole cell is one ball
                parts.append(cell.members[mine][may_leave(far[mine, k], near[mine, k], out.min(), radius)])
        parts = [p for p in parts if len(p) > 1]
        total, largest = sum(map(len, parts)), max(map(len, parts), default=0)
        if len(pivots) * m + sum(len(p) ** 2 for p in parts) > config.shrink * m * m or total > config.growth * m:
            compare(cell)
            continue
        if sizes_of_splits is not None:
            sizes_of_splits.append((m, total, largest))
        todo += parts
    roots = links.roots()  # members are in the order of their ids, so a root is the least
    out = [0] * len(ids)
    for place, root in zip(order.tolist(), roots.tolist(), strict=True):
        out[place] = int(ids[root])
    return out


def join_in_tasks(members: DataFrame, keys: list[str], config: JaccardConfig) -> DataFrame:
    """(a, b) star edges of the components of each group of (keys, doc_id, shingles)."""

    def kernel(group: pa.Table) -> pa.Table:
        ids = group["doc_id"].to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in group["shingles"].to_pylist()]
        labels = join_region(ids, sets, config) if len(ids) > 1 else ids
        pairs = {(b, a) for a, b in zip(ids, labels, strict=True) if a != b}
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    return members.select(*keys, "doc_id", "shingles").groupBy(*keys).applyInArrow(kernel, "a long, b long")


# -- splitting regions that are too large for a task


def set_size() -> Column:
    return (F.octet_length("shingles") / 8).cast("long")


def weigh(members: DataFrame, config: JaccardConfig) -> DataFrame:
    """(r, weight) of each region."""
    return members.groupBy(F.col("region").alias("r")).agg(F.sum(F.greatest(set_size(), F.lit(config.least_weight))).alias("weight"))


def choose_pivots(members: DataFrame, config: JaccardConfig, level: int) -> DataFrame:
    """(r, pivot, set): pivots of each region, farthest-first among members taken by hash."""
    seeds = [F.min(F.struct(F.xxhash64(F.lit(level * 1000 + k), "doc_id").alias("h"), "doc_id")) for k in range(config.pivots)]
    drawn = members.groupBy("region").agg(F.array_distinct(F.transform(F.array(*seeds), lambda x: x["doc_id"])).alias("ids"))
    picks = drawn.select(F.col("region").alias("r"), F.explode("ids").alias("seed"))
    sets = members.join(picks, (F.col("region") == F.col("r")) & (F.col("doc_id") == F.col("seed"))).select("r", "seed", F.col("shingles").alias("set")).dropDuplicates(["r", "seed"])

    def choose(group: pa.Table) -> pa.Table:
        held = [np.frombuffer(x, np.uint64) for x in group["set"].to_pylist()]
        sizes = np.array([len(s) for s in held])

        def measure(i: int) -> np.ndarray:
            return distances(np.array([len(np.intersect1d(held[i], s, assume_unique=True)) for s in held]), sizes[i], sizes)

        return group.take(spread_pivots(len(held), config.pivots, 1 - radius_of(config), measure)).rename_columns(["r", "pivot", "set"])

    return sets.groupBy("r").applyInArrow(choose, "r long, pivot long, set binary")


def measured_cells(members: DataFrame, config: JaccardConfig, level: int) -> DataFrame:
    """members (region, doc_id, shingles, weight) with `cells`: for each cell that a member goes to
    the pivot (null for the far ones), whether they link, and the distance.

    A region's pivots are sent to as many salts as its weight needs tasks.
    """
    radius = radius_of(config)
    tasks = F.ceil(F.col("weight") / F.lit(config.region_weight)).cast("int")
    pivots = materialize(choose_pivots(members, config, level), f"jaccard-pivots-{level}")
    held = pivots.groupBy("r").agg(F.collect_list(F.struct("pivot", "set")).alias("pivots"))
    weights = members.select(F.col("region").alias("q"), "weight").distinct()
    spread = held.join(weights, F.col("r") == F.col("q")).select("r", "pivots", F.explode(F.sequence(F.lit(0), tasks - 1)).alias("s"))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("doc_id"), tasks).cast("int"))

    def run(batches):
        for batch in batches:
            out = []
            for own, pivots in zip(batch.column("shingles").to_pylist(), batch.column("pivots").to_pylist(), strict=True):
                s = np.frombuffer(own, np.uint64)
                sizes = np.array([len(p["set"]) // 8 for p in pivots])
                c = np.array([len(np.intersect1d(s, np.frombuffer(p["set"], np.uint64), assume_unique=True)) for p in pivots])
                near, far = linked(c, len(s), sizes, config.percent), distances(c, len(s), sizes)
                inside = cell_windows(far[None], radius)[0]
                out.append([{"pivot": pivots[k]["pivot"], "near": bool(near[k]), "far": float(far[k])} for k in np.flatnonzero(inside[:-1] | near)] + [{"pivot": None, "near": False, "far": float(far.min())}] * bool(inside[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("region"), batch.column("doc_id"), batch.column("shingles"), batch.column("weight"), pa.array(out, pa.list_(pa.struct([("pivot", pa.int64()), ("near", pa.bool_()), ("far", pa.float64())])))],
                names=["region", "doc_id", "shingles", "weight", "cells"],
            )

    joined = salted.join(spread, (F.col("region") == F.col("r")) & (F.col("salt") == F.col("s"))).select("region", "doc_id", "shingles", "weight", "pivots")
    return joined.mapInArrow(run, "region long, doc_id long, shingles binary, weight long, cells array<struct<pivot: long, near: boolean, far: double>>")


def split_regions(members: DataFrame, config: JaccardConfig, level: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links to pivots, members of the cells of regions that a split shrinks, members of the others)."""
    radius = radius_of(config)
    measured = materialize(measured_cells(members, config, level), f"jaccard-measured-{level}")
    each = measured.select("region", "doc_id", "shingles", "weight", F.explode("cells").alias("c"))
    links = each.filter(F.col("c.near") & (F.col("c.pivot") != F.col("doc_id"))).select(F.least("c.pivot", "doc_id").alias("a"), F.greatest("c.pivot", "doc_id").alias("b"))
    keyed = each.select(F.col("region").alias("parent"), F.col("weight").alias("whole"), F.xxhash64("region", "c.pivot", F.lit(level)).alias("region"), "doc_id", "shingles", F.col("c.pivot").alias("pivot"), F.col("c.near").alias("near"), F.col("c.far").alias("far"))
    edges = materialize(keyed.filter(~F.col("near")).groupBy(F.col("region").alias("e")).agg(F.min("far").alias("edge")), f"jaccard-edges-{level}")
    stays = F.col("pivot").isNull() | ~F.col("near") | (F.col("far") >= F.col("edge") - F.lit(radius))
    cells = materialize(keyed.join(edges, F.col("region") == F.col("e")).filter(stays).select("parent", "whole", "region", "doc_id", "shingles"), f"jaccard-split-{level}")
    by_cell = cells.groupBy("parent", "whole", "region").agg(F.sum(F.greatest(set_size(), F.lit(config.least_weight))).alias("part"))
    square = F.col("part").cast("double") * F.col("part")
    by_parent = by_cell.groupBy(F.col("parent").alias("p")).agg(F.sum(square).alias("squares"), F.sum("part").alias("total"), F.first("whole").cast("double").alias("w"))
    refused = materialize(by_parent.filter((F.col("squares") > F.lit(config.shrink) * F.col("w") * F.col("w")) | (F.col("total") > F.lit(config.growth) * F.col("w"))).select("p"), f"jaccard-refused-{level}")
    made = cells.join(refused, F.col("parent") == F.col("p"), "left_anti").select("region", "doc_id", "shingles")
    others = measured.join(refused, F.col("region") == F.col("p"), "left_semi").select("region", "doc_id", "shingles", "weight")
    return links, made, others


def join_by_sizes(members: DataFrame, config: JaccardConfig) -> DataFrame:
    """Edges of regions that no pivots part: linked sets' sizes lie in one band or in neighbouring
    ones, so bands are joined by twos, in pairs of blocks that fit a task."""
    band = F.floor(F.log(set_size().cast("double")) / F.lit(np.log(100 / config.percent) + 1e-9)).cast("int")
    blocks = F.greatest(F.lit(1), F.ceil(2 * F.col("weight") / F.lit(config.region_weight))).cast("int")
    mine = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    pair = F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(o, mine).alias("x"), F.greatest(o, mine).alias("y"))))
    banded = members.select("region", "doc_id", "shingles", "weight", F.explode(F.array(band, band + 1)).alias("band"))
    held = materialize(banded.groupBy(F.col("region").alias("r"), F.col("band").alias("d")).agg(F.sum(F.greatest(set_size(), F.lit(config.least_weight))).alias("held")), "jaccard-bands")
    placed = banded.drop("weight").join(held, (F.col("region") == F.col("r")) & (F.col("band") == F.col("d"))).withColumn("weight", F.col("held"))
    tiles = placed.select("region", "band", "doc_id", "shingles", pair.alias("t")).select("region", "band", "t.x", "t.y", "doc_id", "shingles")
    return join_in_tasks(tiles, ["region", "band", "x", "y"], config)


def join_regions(members: DataFrame, config: JaccardConfig) -> DataFrame:
    """(a, b) edges that connect exactly the linked (region, doc_id, shingles) rows.

    Regions within the task bound are joined at once. Larger ones are split by pivots, level
    by level, as long as that shrinks them; the others are joined by sizes.
    """
    found: list[DataFrame] = []
    level = 0
    while True:
        large = materialize(weigh(members, config).filter(F.col("weight") > config.region_weight), f"jaccard-large-{level}")
        found.append(join_in_tasks(members.join(large, F.col("region") == F.col("r"), "left_anti"), ["region"], config))
        if large.isEmpty():
            break
        links, members, others = split_regions(members.join(large, F.col("region") == F.col("r")).select("region", "doc_id", "shingles", "weight"), config, level)
        found += [links, join_by_sizes(others, config)]
        level += 1
    return reduce(DataFrame.union, found)


def near_duplicates(docs: DataFrame, config: JaccardConfig = JaccardConfig()) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs.

    `component_id` is the least doc_id that links reach. Null and empty texts, and those
    without words, have no shingles, and are linked with nothing. Rows that share a doc_id
    are one document: they share a component, and each row has its own n_shingles. A row with
    a null doc_id takes part in nothing and has a null component. Only doc_id and text are
    read. An empty table gives an empty result. The result is stored; all tables on the way
    to it are deleted.
    """
    with scratch(docs.sparkSession):
        return materialize(_near_duplicates(docs, config), "jaccard-components", keep=True)


def owners_of(usable: DataFrame, several: DataFrame) -> DataFrame:
    """(doc_id, n, prefix) of one row for each distinct set: that of the least doc_id. `several` (s1, s2, m, first)
    has the sets of more than one row; only rows that may be of these are dealt by their set."""
    sets = [F.col("sig1"), F.col("sig2"), F.col("n")]
    shared, alone = parted(usable, sets, several, [F.col("s1"), F.col("s2"), F.col("m")])
    named = shared.join(several, (F.col("sig1") == F.col("s1")) & (F.col("sig2") == F.col("s2")) & (F.col("n") == F.col("m")), "left")
    least = named.filter(F.col("doc_id") == F.coalesce("first", "doc_id")).groupBy(*sets, "doc_id").agg(F.first("prefix").alias("prefix"))
    return alone.select("doc_id", "n", "prefix").union(least.select("doc_id", "n", "prefix"))


def _near_duplicates(docs: DataFrame, config: JaccardConfig) -> DataFrame:
    from loomspan.operators.graph import connected_components

    order = bin_counts(docs, config)
    prefixed = materialize(signatures(docs, order, config), "jaccard-signatures")
    signed = materialize(prefixed.select("doc_id", "n", "sig1", "sig2"), "jaccard-sizes")
    held = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    several = signed.filter(held).groupBy(F.col("sig1").alias("s1"), F.col("sig2").alias("s2"), F.col("n").alias("m")).agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).filter("rows > 1").drop("rows")
    several = materialize(several, "jaccard-copies")
    copies = signed.filter(held).join(several, (F.col("sig1") == F.col("s1")) & (F.col("sig2") == F.col("s2")) & (F.col("n") == F.col("m")))
    same = copies.filter(F.col("first") < F.col("doc_id")).select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    parts = 1 + int(order.sum()) * (100 - config.percent + 5) // 100 // PART_ROWS
    regions = materialize(connected_components(candidate_edges(owners_of(prefixed.filter(held), several), config, parts)), "jaccard-regions")
    discard(prefixed)
    # Texts of no region stay where they are, but for a few; the others are dealt by doc_id at every size.
    near, _ = parted(docs.select("doc_id", "text"), [F.col("doc_id").cast("long")], regions, [F.col("id")])
    placed = regions.select("id", F.col("component").alias("region")).hint("merge")
    members = near.join(placed, F.col("doc_id") == F.col("id")).select("region", "doc_id", "text")

    def shingle(batches):
        for batch in batches:
            held = [shingle_set(t, config.size) for t in batch.column(2).to_pylist()]
            got = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s.tobytes() for s in held], pa.binary())], names=["region", "doc_id", "shingles"])
            yield got.filter(pa.array([len(s) > 0 for s in held], pa.bool_()))

    sets = materialize(members.mapInArrow(shingle, "region long, doc_id long, shingles binary"), "jaccard-sets")
    components = connected_components(join_regions(sets, config).union(same))
    return (
        signed.select("doc_id", F.col("n").alias("n_shingles"))
        .join(components, F.col("doc_id") == F.col("id"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )
