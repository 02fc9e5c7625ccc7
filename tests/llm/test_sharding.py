import zlib
from collections import defaultdict

import pytest

from loomspan.llm.sharding import shard


def minimax(sizes, shards):
    """Least capacity by dynamic programming."""
    n = len(sizes)
    total = [0]
    for s in sizes:
        total.append(total[-1] + s)
    best = total[:]
    for _ in range(shards - 1):
        best = [min(max(best[i], total[j] - total[i]) for i in range(j + 1)) for j in range(n + 1)]
    return best[n]


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_smallest_capacity(docs, rows, shards):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    size = lambda t: len((t or "").encode()) + 1
    order = sorted(groups.values(), key=lambda g: min(r[0] for r in g))
    capacity = minimax([sum(size(r[1]) for r in g) for g in order], shards)
    got = shard(docs, shards).collect()
    by_id = {r["doc_id"]: r for r in got}
    bytes_of, slots = defaultdict(int), defaultdict(list)
    for r in got:
        bytes_of[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert max(bytes_of.values()) == capacity
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len({by_id[r[0]]["shard"] for r in g}) == 1 for g in groups.values())
    first = [by_id[min(r[0] for r in g)]["shard"] for g in order]
    assert first == sorted(first)
    assert all(by_id[r[0]]["text_crc32"] == zlib.crc32((r[1] or "").encode()) and by_id[r[0]]["size"] == size(r[1]) for r in rows)


def test_repeats_and_empty(repeated, empty):
    assert shard(empty).count() == 0
    got = shard(repeated, 4).collect()
    assert len(got) == repeated.count()
    assert len({(r["shard"], r["slot"]) for r in got}) == len(got)
