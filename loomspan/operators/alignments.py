"""Filtering, profiling and selecting pairwise alignments.

An alignment row has (query, qlen, qstart, qend, strand, target, tlen, tstart, tend,
matches, block, mapq) and any optional columns. Coordinates are half-open from 0.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions.bases import identity


def quality(min_mapq: int = 0, min_block: int = 0, small_query: int = 0, min_identity: float = 0.0, min_score: float | None = None, max_collapse: float | None = None, is_reference: Column | None = None) -> Column:
    """Predicate: reference rows pass; others need mapping quality, block length (waived for
    small queries and unknown blocks), identity, and, where known, score and collapse."""
    ok = F.col("mapq") >= min_mapq
    ok = ok & (F.col("block").isNull() | (F.col("qlen") <= small_query) | (F.col("block") >= min_block))
    ok = ok & (F.coalesce(identity(F.col("matches"), F.col("block")), F.lit(1.0)) >= min_identity)
    if min_score is not None:
        ok = ok & (F.col("score").isNull() | (F.col("score") >= min_score))
    if max_collapse is not None:
        ok = ok & (F.col("collapse").isNull() | (F.col("collapse") <= max_collapse))
    ok = F.coalesce(ok, F.lit(False))
    return ok if is_reference is None else F.coalesce(is_reference, F.lit(False)) | ok


def eliminated(df: DataFrame, keep: Column) -> DataFrame:
    """(query, rows): queries that lose every row to the predicate."""
    g = df.groupBy("query").agg(F.count("*").alias("rows"), F.count_if(keep).alias("kept"))
    return g.filter("kept = 0").select("query", "rows")


def invert(df: DataFrame) -> DataFrame:
    """Query and target exchanged."""
    swap = {"query": "target", "qlen": "tlen", "qstart": "tstart", "qend": "tend"}
    back = {b: a for a, b in swap.items()}
    return df.select(*(F.col(swap.get(c, back.get(c, c))).alias(c) for c in df.columns))


def restore_chunks(df: DataFrame) -> DataFrame:
    """Coordinates of chunk names `name|length|offset` back on their whole sequences."""
    out = df
    for name, length, start, end in (("query", "qlen", "qstart", "qend"), ("target", "tlen", "tstart", "tend")):
        parts = F.split(F.col(name), r"\|")
        whole = F.size(parts) >= 3
        offset = F.when(whole, F.element_at(parts, -1).cast("long")).otherwise(F.lit(0).cast("long"))
        out = out.withColumns(
            {
                name: F.when(whole, F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 2), "|")).otherwise(F.col(name)),
                length: F.when(whole, F.element_at(parts, -2).cast("long")).otherwise(F.col(length)),
                start: F.col(start) + offset,
                end: F.col(end) + offset,
            }
        )
    return out


def to_matches(df: DataFrame, cigar: Column) -> DataFrame:
    """(query, target, qpos, tpos, length, strand): gap-free runs of each alignment.

    Runs of M, = and X join. On the reverse strand query positions count down from qend.
    """
    ops = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDX=])"), 1), lambda x: F.struct(F.regexp_extract(x, r"^(\d+)", 1).cast("long").alias("n"), F.substring(x, -1, 1).alias("op")))

    def step(acc, x):
        m = x["op"].isin("M", "=", "X")
        last = F.element_at(acc["runs"], -1)
        joins = m & acc["open"]
        grown = F.concat(F.slice(acc["runs"], F.lit(1), F.size(acc["runs"]) - 1), F.array(F.struct(last["q"].alias("q"), last["t"].alias("t"), (last["n"] + x["n"]).alias("n"))))
        fresh = F.concat(acc["runs"], F.array(F.struct(acc["q"].alias("q"), acc["t"].alias("t"), x["n"].alias("n"))))
        runs = F.when(joins, grown).when(m, fresh).otherwise(acc["runs"])
        q = acc["q"] + F.when(m | (x["op"] == "I"), x["n"]).otherwise(F.lit(0).cast("long"))
        t = acc["t"] + F.when(m | (x["op"] == "D"), x["n"]).otherwise(F.lit(0).cast("long"))
        return F.struct(runs.alias("runs"), q.alias("q"), t.alias("t"), m.alias("open"))

    zero = F.lit(0).cast("long")
    first = F.struct(F.array(F.struct(zero.alias("q"), zero.alias("t"), zero.alias("n"))).alias("runs"), zero.alias("q"), zero.alias("t"), F.lit(False).alias("open"))
    runs = F.filter(F.aggregate(ops, first, step, lambda acc: acc["runs"]), lambda r: r["n"] > 0)
    each = df.select("*", F.explode(runs).alias("r"))
    forward = F.col("strand") == "+"
    qpos = F.when(forward, F.col("qstart") + F.col("r.q")).otherwise(F.col("qend") - F.col("r.q") - F.col("r.n"))
    return each.select("query", "target", qpos.alias("qpos"), (F.col("tstart") + F.col("r.t")).alias("tpos"), F.col("r.n").alias("length"), "strand")


#: Positions of the tiles between which groups of alignments are parted.
PART = 1 << 16


def _parted(df: DataFrame, keys: Sequence[str], start: str, end: str, gap: int) -> DataFrame:
    """df with `_part`: rows of different parts of a key are more than gap apart.

    A part ends before a tile whose first row starts beyond all that came before. Only each
    tile's bounds go through the window of a key.
    """
    tile = F.floor(F.col(start) / PART)
    bounds = df.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), tile.alias("_t")).agg(F.min(start).alias("_lo"), F.max(F.greatest(start, end)).alias("_hi"))
    w = Window.partitionBy(*(f"_k{i}" for i in range(len(keys)))).orderBy("_t")
    fresh = F.coalesce(F.col("_lo") > F.max("_hi").over(w.rowsBetween(Window.unboundedPreceding, -1)) + gap, F.lit(True))
    parts = bounds.withColumn("_fresh", fresh.cast("int")).withColumn("_part", F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_lo", "_hi", "_fresh")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(parts, [*same, tile.eqNullSafe(F.col("_t"))]).select(*df.columns, "_part")


def _best_before(t0: np.ndarray, t1: np.ndarray, q0: np.ndarray, q1: np.ndarray, w: np.ndarray, max_gap: int, gap_open: float, gap_extend: float) -> tuple[np.ndarray, list[int]]:
    """(total, before) of rows in order of t0: each row's score with that of its best predecessor, and that one's place, or -1.

    Of the rows that may precede, those of one query end compete: a row that ends later in the target and
    is no worse rules out the ones before it. So a row looks at one candidate for each query end
    within max_gap, however many rows there are. Rows without a bound or a score precede none.
    """
    n = len(t0)
    ends = np.unique(q1)
    column = np.searchsorted(ends, q1).tolist()
    lo, hi = np.searchsorted(ends, q0 - max_gap, "left").tolist(), np.searchsorted(ends, q0, "right").tolist()
    offers, seeks = (~np.isnan(t1 + q1 + w)).tolist(), (~np.isnan(t0 + q0)).tolist()
    by_end = [j for j in np.argsort(t1, kind="stable").tolist() if offers[j]]
    starts, stops, q_starts, q_stops, scores, reach = t0.tolist(), t1.tolist(), q0.tolist(), q1.tolist(), w.tolist(), (t0 - max_gap).tolist()
    live: list[deque[int]] = [deque() for _ in ends]
    most = np.full(len(ends), -np.inf)
    total, before, value = scores[:], [-1] * n, [0.0] * n
    adjoining: dict[tuple, int] = {}
    # Values that differ by rounding alone are told apart by their gains.
    slack = 1e-12 * (np.nansum(np.abs(w)) + gap_extend * (np.abs(np.nan_to_num([t1, q1])).max(initial=0) + max_gap)) if gap_extend else 0.0

    def rules_out(a: int, b: int) -> bool:
        if not gap_extend or stops[a] == stops[b]:
            return total[a] > total[b] or (total[a] == total[b] and a < b)
        return value[a] > value[b] + slack

    def show(c: int) -> None:
        most[c] = max(value[j] for j in live[c]) if live[c] else -np.inf

    def put(j: int) -> None:
        value[j] = total[j] + gap_extend * (stops[j] + q_stops[j])
        held, later = live[column[j]], []
        while held and stops[held[-1]] > stops[j]:  # rows of no length come out of turn
            later.append(held.pop())
        if not (later and rules_out(later[-1], j)) and not (held and stops[held[-1]] == stops[j] and rules_out(held[-1], j)):
            while held and rules_out(j, held[-1]):
                held.pop()
            held.append(j)
        held.extend(reversed(later))
        show(column[j])
        place = (stops[j], q_stops[j])
        if gap_open and ((k := adjoining.get(place)) is None or total[j] > total[k] or (total[j] == total[k] and j < k)):
            adjoining[place] = j

    def gain(j: int, i: int) -> float:
        gap = starts[i] - stops[j] + q_starts[i] - q_stops[j]
        return total[j] - (gap_open + gap_extend * gap if gap > 0 else 0.0)

    come = gone = 0
    for i in range(n):
        if seeks[i]:
            while come < len(by_end) and stops[by_end[come]] <= starts[i]:
                if stops[by_end[come]] > starts[by_end[come]]:
                    put(by_end[come])
                come += 1
            while gone < len(by_end) and stops[by_end[gone]] < reach[i]:
                j = by_end[gone]
                adjoining.pop((stops[j], q_stops[j]), None)
                held = live[column[j]]
                if held and stops[held[0]] < reach[i]:
                    while held and stops[held[0]] < reach[i]:
                        held.popleft()
                    show(column[j])
                gone += 1
            near = most[lo[i] : hi[i]]
            found = [adjoining[place]] if (place := (starts[i], q_starts[i])) in adjoining else []
            if len(near) and (top := near.max()) > -np.inf:
                found += [j for c in np.flatnonzero(near >= top - slack).tolist() for j in live[lo[i] + c] if value[j] >= top - slack]
            if found:
                more, j = max((gain(j, i), -j) for j in found)
                if more > 0:
                    total[i], before[i] = scores[i] + more, -j
            if offers[i] and reach[i] <= stops[i] <= starts[i]:
                put(i)
    return np.array(total), before


def chain(df: DataFrame, max_gap: int, gap_open: float = 0.0, gap_extend: float = 0.0) -> DataFrame:
    """Adds `chain_id` and `chain_score`: the best collinear chain that ends in each row's chain.

    Rows of one (query, target, strand) follow each other if they go forward in both sequences
    and leave at most max_gap in each. A chain's score is its rows' `score` less the gaps'
    cost. Each row continues its best predecessor; rows of one tree of continuations
    that lead to its best end share a chain. Ties go to the earlier row.

    Rows further apart in the target than max_gap never meet: a group is one part of the target, not all
    rows of a pair. Within it a row looks at one candidate for each query end within max_gap (_best_before).
    """

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tstart", "qstart", "id"], kind="stable").reset_index(drop=True)
        t0, t1, q0, q1, w = (pdf[c].to_numpy() for c in ("tstart", "tend", "qstart", "qend", "score"))
        if len(pdf) and pdf["strand"].iloc[0] == "-":  # going forward in the target is going back in the query
            top = int(pdf["qlen"].iloc[0])
            q0, q1 = top - q1, top - q0
        total, before = _best_before(t0, t1, q0, q1, w.astype(float), max_gap, gap_open, gap_extend)
        label, score, ids = np.full(len(pdf), -1, dtype=np.int64), np.zeros(len(pdf)), pdf["id"].to_numpy()
        for i in np.argsort(-total, kind="stable").tolist():
            k = i
            while k >= 0 and label[k] < 0:
                label[k], score[k] = ids[i], total[i]
                k = before[k]
        return pdf.assign(chain_id=label, chain_score=score)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    parted = _parted(df, ["query", "target", "strand"], "tstart", "tend", max_gap)
    return parted.groupBy("query", "target", "strand", "_part").applyInPandas(lambda pdf: best(pdf.drop(columns="_part")), f"{schema}, chain_id long, chain_score double")


def tile(df: DataFrame) -> DataFrame:
    """Adds `level`: 1 plus the deepest cover of a row's query range by better rows.

    Rows are taken best first (score, then id); a row's level is one more than the greatest
    number of better rows over any of its positions. A group is one part of the query.
    """

    def levels(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", "id"], ascending=[False, True], kind="stable").reset_index(drop=True)
        cuts = np.unique(np.concatenate((pdf["qstart"], pdf["qend"])))
        deep = np.zeros(len(cuts), np.int64)
        out = np.empty(len(pdf), np.int64)
        a, b = np.searchsorted(cuts, pdf["qstart"]), np.searchsorted(cuts, pdf["qend"])
        for i in range(len(pdf)):
            here = deep[a[i] : b[i]]
            out[i] = 1 + (here.max() if len(here) else 0)
            here += 1
        return pdf.assign(level=out)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    parted = _parted(df, ["query"], "qstart", "qend", 0)
    return parted.groupBy("query", "_part").applyInPandas(lambda pdf: levels(pdf.drop(columns="_part")), f"{schema}, level long")


def select_primary(df: DataFrame, max_gap: int, min_chain_score: float) -> DataFrame:
    """Chain, tile, keep the first level, chain again; rows of weak chains become secondary.

    Adds `chain_id`, `chain_score`, `level` and `tag` (`P` or `S`).
    """
    chained = chain(df, max_gap)
    tiled = tile(chained.withColumn("own", F.col("score")).withColumn("score", F.col("chain_score")).drop("chain_id", "chain_score"))
    first = chain(tiled.filter("level = 1").withColumn("score", F.col("own")).drop("own"), max_gap)
    weak = F.col("chain_score") < min_chain_score
    return first.withColumn("tag", F.when(weak, "S").otherwise("P")).withColumn("level", F.when(weak, 2).otherwise(F.col("level")))


def filter_levels(df: DataFrame, max_level: int | None = None, min_chain_score: float | None = None, invert: bool = False) -> DataFrame:
    """Rows of tile levels up to max_level and chains of at least min_chain_score, or all others."""
    keep = F.lit(True)
    if max_level is not None:
        keep = keep & F.coalesce(F.col("level") <= max_level, F.lit(False))
    if min_chain_score is not None:
        keep = keep & F.coalesce(F.col("chain_score") >= min_chain_score, F.lit(False))
    return df.filter(~keep if invert else keep)


def split_by_query(df: DataFrame, size: int) -> DataFrame:
    """df with `part`: a query of more than `size` rows is a part of its own, the rest are dealt by hash
    into as many parts as hold about `size` rows each."""
    counts = df.groupBy(F.col("query").alias("_q")).agg(F.count("*").alias("_n"))
    rest = counts.filter(F.col("_n") <= size).agg(F.greatest(F.lit(1), F.ceil(F.sum("_n") / size)).alias("_parts"))
    shared = F.concat(F.lit("rest-"), F.pmod(F.xxhash64("query"), F.coalesce("_parts", F.lit(1))))
    dealt = df.join(counts, F.col("query").eqNullSafe(F.col("_q"))).crossJoin(rest)
    return dealt.withColumn("part", F.when(F.col("_n") > size, F.concat(F.lit("query-"), "query")).otherwise(shared)).drop("_q", "_n", "_parts")


def select_primary_by_side(df: DataFrame, outgroups: Sequence[str], max_gap: int, min_chain_score: float) -> DataFrame:
    """select_primary() of rows among ingroups and of rows that touch an outgroup apart, so that neither
    takes the other's first level; adds `outgroup`."""
    touches = F.col("query").isin(*outgroups) | F.col("target").isin(*outgroups)
    inner = select_primary(df.filter(~touches), max_gap, min_chain_score).withColumn("outgroup", F.lit(False))
    return inner.unionByName(select_primary(df.filter(touches), max_gap, min_chain_score).withColumn("outgroup", F.lit(True)))


def consistency_cut(df: DataFrame, keys: Sequence[str], order: str, left: str, right: str) -> DataFrame:
    """(keys, cut, score): where to change from the left to the right alignment.

    The score of a cut is the left scores before it plus the right scores from it on; of equal
    cuts the first is taken. A cut may stand before the first and after the last place.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    run = df.select(
        *keys,
        order,
        F.coalesce(F.sum(left).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum(right).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("_after"),
        F.sum(left).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_all"),
        F.lead(order).over(w).alias("_next"),
    )
    at = run.select(*keys, F.explode(F.array(F.struct(F.col(order).alias("cut"), (F.col("_before") + F.col("_after")).alias("score")), F.when(F.col("_next").isNull(), F.struct((F.col(order) + 1).alias("cut"), F.col("_all").alias("score"))))).alias("c"))
    return at.filter(F.col("c").isNotNull()).groupBy(*keys).agg(F.max_by("c", F.struct(F.col("c.score"), -F.col("c.cut"))).alias("c")).select(*keys, "c.cut", "c.score")


def gapless_blocks(df: DataFrame, keys: Sequence[str], column: str, row: str) -> DataFrame:
    """(keys, start, end, rows): runs of alignment columns in which the same rows, two or more, have a base.

    df has a row for each base: (keys, column, row).
    """
    present = df.groupBy(*keys, column).agg(F.sort_array(F.collect_set(row)).alias("rows"))
    w = Window.partitionBy(*keys).orderBy(column)
    fresh = F.coalesce((F.lag(column).over(w) == F.col(column) - 1) & (F.lag("rows").over(w) == F.col("rows")), F.lit(False))
    runs = present.withColumn("_run", F.sum(F.when(fresh, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = runs.groupBy(*keys, "_run").agg(F.min(column).alias("start"), (F.max(column) + 1).alias("end"), F.first("rows").alias("rows"))
    return blocks.filter(F.size("rows") >= 2).drop("_run")
