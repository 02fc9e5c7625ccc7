"""Depth of ranges as a stream, with a window of counters for each contig."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "frontier long, start long, depth long, pos array<long>, delta array<long>"


def depth_stream(stream: DataFrame, window: int, late: str = "error") -> DataFrame:
    """(contig, start, end, depth): pieces between consecutive endpoints, as soon as no later range can begin in them.

    stream is (contig, start, end). Ranges come in any order within `window` positions: one that begins
    more than that before the furthest start seen is late, and is an error or, with late="drop", left
    out. A row with a null start closes its contig, which then begins anew. State holds the endpoints
    of the window and those ahead of it alone, and the pieces are those of the batch sweep.
    """
    if late not in ("error", "drop"):
        raise ValueError(f"late ranges are an error or dropped, not {late!r}")

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frontier, at, depth, ahead = None, None, 0, {}
        if state.exists:
            frontier, at, depth, pos, delta = state.get
            ahead = dict(zip(pos, delta, strict=True))
        rows = pd.concat(list(batches))
        closing = bool(rows["start"].isna().any())
        rows = rows.dropna(subset=["start", "end"])
        rows = rows[rows["end"] > rows["start"]]
        starts, ends = rows["start"].astype("int64"), rows["end"].astype("int64")
        if frontier is not None and (starts < frontier).any():
            if late == "error":
                raise ValueError(f"a range of {key[0]} begins before {frontier}")
            starts, ends = starts[starts >= frontier], ends[starts >= frontier]
        for series, step in ((starts, 1), (ends, -1)):
            for p, n in series.value_counts().items():
                ahead[p] = ahead.get(p, 0) + step * n
        if len(starts):
            frontier = max(starts.max() - window, frontier if frontier is not None else starts.max() - window)
        out = []
        for p in sorted(ahead):
            if not closing and p >= frontier:
                break
            if depth > 0:
                out.append((key[0], at, p, depth))
            at, depth = p, depth + ahead.pop(p)
        if closing:
            if state.exists:
                state.remove()
        elif frontier is not None:
            state.update((int(frontier), None if at is None else int(at), int(depth), [int(p) for p in ahead], [int(d) for d in ahead.values()]))
        yield pd.DataFrame(out, columns=["contig", "start", "end", "depth"])

    return stream.groupBy("contig").applyInPandasWithState(run, "contig string, start long, end long, depth long", STATE, "append", GroupStateTimeout.NoTimeout)
