"""Nested sites of a variation graph: allele traversals taken apart, and sites checked against those around them.

A traversal is an array of steps, each `>` or `<` and a node's name; that of the reference and
that of the alternative begin and end alike.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.operators.relational import follow_parents

PART = "part int, ref_from int, ref_steps array<string>, alt_steps array<string>, inverted boolean"


def _places(steps: Sequence[str]) -> dict[str, list[int]]:
    found: dict[str, list[int]] = {}
    for i, step in enumerate(steps):
        found.setdefault(step, []).append(i)
    return found


def first_anchors(ref: Sequence[str], alt: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Inner steps in common, from the left: each step of ref with its next place in alt behind the anchor before."""
    places, last = _places(alt[:-1]), 0
    for i in range(1, len(ref) - 1):
        at = places.get(ref[i], ())
        k = bisect_right(at, last)
        if k < len(at):
            last = at[k]
            yield i, last


def longest_anchors(ref: Sequence[str], alt: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Inner steps of a longest common subsequence: the longest rising run through the places in common."""
    places = _places(alt[:-1])
    ends: list[int] = []
    tails: list[tuple] = []
    for i in range(1, len(ref) - 1):
        for j in reversed(places.get(ref[i], ())):
            if j:
                k = bisect_left(ends, j)
                ends[k : k + 1], tails[k : k + 1] = [j], [(i, j, tails[k - 1] if k else None)]
    way, held = [], tails[-1] if tails else None
    while held:
        way.append(held[:2])
        held = held[2]
    yield from reversed(way)


_ANCHORS = {"first": first_anchors, "longest": longest_anchors}
_TURN = str.maketrans("<>", "><")


def parts_of(ref: Sequence[str], alt: Sequence[str], anchors: str = "first") -> Iterator[tuple[int, int, list[str], list[str], bool]]:
    """(part, ref_from, ref_steps, alt_steps, inverted) of the differences between anchors: the anchor before, as a
    place in ref, the steps between, and whether alt holds one of ref's turned round. Of the steps that both end
    with, the first is the last anchor."""
    shorter = min(len(ref), len(alt))
    same = next((k for k in range(shorter) if ref[-1 - k] != alt[-1 - k]), None)
    if same:
        ref, alt = ref[: len(ref) - same + 1], alt[: len(alt) - same + 1]
    i, j, part = 0, 0, 0
    for p, q in [*_ANCHORS[anchors](ref, alt), (len(ref) - 1, len(alt) - 1)]:
        if p - i > 1 or q - j > 1:
            between, other = list(ref[i + 1 : p]), list(alt[j + 1 : q])
            yield part, i, between, other, not {s.translate(_TURN) for s in between}.isdisjoint(other)
            part += 1
        i, j = p, q


def decompose(alleles: DataFrame, anchors: str = "first") -> DataFrame:
    """alleles (id, ref, alt: arrays of steps) as the simple differences they are made of: (id, part, ref_from,
    ref_steps, alt_steps, inverted).

    Equal traversals have none. A null traversal has none; two that do not begin and end alike are
    an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, rows = [], []
            for k, (ref, alt) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if ref is None or alt is None:
                    continue
                if not ref or not alt or ref[0] != alt[0] or ref[-1] != alt[-1]:
                    raise ValueError("two traversals of one site have to begin and end alike")
                for row in parts_of(ref, alt, anchors):
                    keep.append(k)
                    rows.append(row)
            types = [pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()), pa.bool_()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), *arrays], names=["id", "part", "ref_from", "ref_steps", "alt_steps", "inverted"])

    kind = alleles.schema["id"].dataType.simpleString()
    return alleles.select("id", "ref", "alt").mapInArrow(run, f"id {kind}, {PART}")


def oriented(step: Column, seq: Column) -> Column:
    """A node's bases along a step: turned round for `<`."""
    return F.when(F.left(step, F.lit(1)) == "<", F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))).otherwise(seq)


def typed_variants(alleles: DataFrame, nodes: DataFrame, anchors: str = "first") -> DataFrame:
    """Simple variants of alleles (id, contig, pos, ref, alt), pos being that of the base behind the first step:
    (id, part, contig, pos, kind, ref_bases, alt_bases, length, end).

    Differences of equal length are SNP or MNP; all others are INV, DEL or INS, begin at the base before
    them, and have an `end` there plus the reference's length. nodes is (node, seq). Texts of bases
    are put together by joins with the nodes, so that neither table has to fit anywhere whole.
    """
    parts = decompose(alleles, anchors)
    # Where a part begins: the lengths of the steps up to its anchor, without the first.
    steps = alleles.select("id", F.posexplode("ref").alias("at", "step"))
    known = nodes.select(F.col("node").alias("_n"), "seq")
    placed = steps.join(known, F.substring("step", 2, 1 << 30) == F.col("_n"))
    upto = Window.partitionBy("id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    starts = placed.select(F.col("id").alias("_i"), F.col("at").alias("_at"), F.right(oriented(F.col("step"), F.col("seq")), F.lit(1)).alias("before"), F.sum(F.when(F.col("at") > 0, F.length("seq")).otherwise(0)).over(upto).alias("offset"))
    inner = parts.select("id", "part", F.explode(F.array(F.struct(F.lit("r").alias("side"), F.col("ref_steps").alias("steps")), F.struct(F.lit("a").alias("side"), F.col("alt_steps").alias("steps")))).alias("s"))
    pieces = inner.select("id", "part", "s.side", F.posexplode("s.steps").alias("at", "step")).join(known, F.substring("step", 2, 1 << 30) == F.col("_n"))
    held = F.struct("at", oriented(F.col("step"), F.col("seq")).alias("bases"))
    text = lambda side: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == side, held))), lambda x: x["bases"]), "")
    bases = pieces.groupBy(F.col("id").alias("_b"), F.col("part").alias("_p")).agg(text("r").alias("r"), text("a").alias("a"))
    whole = parts.join(bases, (F.col("id") == F.col("_b")) & (F.col("part") == F.col("_p"))).join(starts, (F.col("id") == F.col("_i")) & (F.col("ref_from") == F.col("_at")))
    whole = whole.join(alleles.select(F.col("id").alias("_a"), "contig", "pos"), F.col("id") == F.col("_a"))
    n_ref, n_alt = F.length("r"), F.length("a")
    plain = (n_ref == n_alt) & ~F.col("inverted")
    kind = F.when(plain, F.when(n_ref == 1, "SNP").otherwise("MNP")).when(F.col("inverted"), "INV").when(n_alt < n_ref, "DEL").otherwise("INS")
    at = F.col("pos") + F.col("offset") - F.when(plain, 0).otherwise(1)
    lead = F.when(plain, "").otherwise(F.col("before"))
    length = F.when(plain | F.col("inverted"), n_ref).otherwise(n_alt - n_ref)
    return whole.select("id", "part", "contig", at.alias("pos"), kind.alias("kind"), F.concat(lead, "r").alias("ref_bases"), F.concat(lead, "a").alias("alt_bases"), length.alias("length"), F.when(~plain, at + n_ref).alias("end"))


def nested_consistency(sites: DataFrame) -> DataFrame:
    """sites (id, parent, alleles: texts of steps, the reference's first) with `top`, the outermost site around each, and
    `consistent`.

    A nested site is consistent if at least as many of its alleles run within alternative alleles of the
    outermost site as that one has. Outermost sites are; a parent that is no site counts for none. Rows
    of one id are one site: their alternatives are put together, and each row is judged by its own.
    """
    ids = sites.select(F.col("id").alias("_k")).distinct()
    links = sites.groupBy("id").agg(F.min("parent").alias("parent")).join(ids, F.col("parent") == F.col("_k"), "left").select("id", F.col("_k").alias("parent"))
    tops = follow_parents(links, "id", "parent").select(F.col("id").alias("_i"), "top")
    outer = tops.select(F.col("top").alias("_o")).distinct()
    alts = sites.join(outer, F.col("id") == F.col("_o"), "left_semi").select(F.col("id").alias("_t"), F.explode(F.slice("alleles", 2, 1 << 30)).alias("alt")).distinct()
    sets = alts.groupBy("_t").agg(F.collect_list(F.concat("alt", F.lit("$"))).alias("_alts"))
    joined = sites.join(tops, F.col("id") == F.col("_i"), "left").join(sets, F.col("top") == F.col("_t"), "left")
    held = lambda a: F.exists("_alts", lambda t: F.regexp_like(t, F.concat(a, F.lit("[^0-9]"))))
    nested = F.size(F.filter("alleles", held)) >= F.size("_alts")
    consistent = (F.col("id") == F.col("top")) | F.coalesce(nested, F.lit(True))
    return joined.select(*sites.columns, "top", consistent.alias("consistent"))
