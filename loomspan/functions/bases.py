"""Column expressions on sequences, alignments, genotypes and models."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The codes for sets of bases; fixed values.
AMBIGUOUS = "uwsmkrybdhvUWSMKRYBDHV"


def plain_bases(seq: Column) -> Column:
    """Ambiguity codes become n or N, in their case; any other letter than A, C, G, T, N fails."""
    plain = F.translate(seq, AMBIGUOUS, "n" * 11 + "N" * 11)
    return F.when(plain.rlike("^[ACGTNacgtn]*$"), plain).otherwise(F.raise_error(F.concat(F.lit("not a sequence: "), F.substring(seq, 1, 40))))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def stranded_substring(seq: Column, start: Column, length: Column, forward: Column) -> Column:
    """length bases from start (from 0), reverse-complemented on the other strand."""
    part = F.substring(seq, start + 1, length)
    return F.when(forward, part).otherwise(reverse_complement(part))


def unmask(seq: Column) -> Column:
    return F.upper(seq)


def masked_share(seq: Column) -> Column:
    """Share of lower-case letters."""
    return (F.length(seq) - F.length(F.regexp_replace(seq, "[a-z]", ""))) / F.greatest(F.length(seq), F.lit(1))


def mask_ranges(seq: Column, ranges: Column, soft: bool = True, mark: str = "N") -> Column:
    """seq with the sorted, disjoint ranges (array of struct(start, end)) in lower case, or marked."""

    def step(acc, r):
        part = F.substring(seq, r["start"] + 1, r["end"] - r["start"])
        masked = F.lower(part) if soft else F.repeat(F.lit(mark), (r["end"] - r["start"]).cast("int"))
        return F.struct(F.concat(acc["done"], F.substring(seq, acc["at"] + 1, r["start"] - acc["at"]), masked).alias("done"), r["end"].alias("at"))

    first = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))
    return F.aggregate(ranges, first, step, lambda acc: F.concat(acc["done"], F.substring(seq, acc["at"] + 1, F.length(seq))))


def runs(seq: Column, pattern: str) -> Column:
    """array of struct(start, end) of the maximal runs of a one-character pattern, e.g. `[a-z]`."""
    flags = F.regexp_replace(F.regexp_replace(seq, pattern, "\u0001"), "[^\u0001]", "\u0002")
    pieces = F.regexp_extract_all(flags, F.lit("(\u0001+|\u0002+)"), 1)

    def step(acc, piece):
        n = F.length(piece).cast("long")
        end = acc["at"] + n
        got = F.when(piece.startswith("\u0001"), F.concat(acc["runs"], F.array(F.struct(acc["at"].alias("start"), end.alias("end"))))).otherwise(acc["runs"])
        return F.struct(got.alias("runs"), end.alias("at"))

    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return F.aggregate(pieces, F.struct(empty.alias("runs"), F.lit(0).cast("long").alias("at")), step, lambda acc: acc["runs"])


def most_frequent_share(seq: Column, letters: str = "acgt") -> Column:
    """Greatest share that one letter has, whatever its case."""
    low = F.lower(seq)
    counts = [F.length(seq) - F.length(F.replace(low, F.lit(c), F.lit(""))) for c in letters]
    return F.greatest(*counts) / F.greatest(F.length(seq), F.lit(1))


def soften_homopolymers(seq: Column, keep: int) -> Column:
    """Lower case for what goes beyond the first `keep` letters of a run of one base."""

    def softened(base: str):
        return lambda p: F.when(p.startswith(base) & (F.length(p) > keep), F.concat(F.substring(p, 1, keep), F.lower(F.substring(p, F.lit(keep + 1), F.length(p))))).otherwise(p)

    out = seq
    for base in "ACGT":
        pieces = F.regexp_extract_all(out, F.lit(f"({base}+|[^{base}]+)"), 1)
        out = F.array_join(F.transform(pieces, softened(base)), "")
    return out


# -- alignments


def cigar(text: Column) -> Column:
    """array of struct(len, op)."""
    lens, ops = F.regexp_extract_all(text, F.lit(r"(\d+)([MIDNSHP=X])"), 1), F.regexp_extract_all(text, F.lit(r"(\d+)([MIDNSHP=X])"), 2)
    return F.zip_with(lens, ops, lambda n, o: F.struct(n.cast("long").alias("len"), o.alias("op")))


def cigar_sum(text: Column, ops: str) -> Column:
    """Total length of the given operations."""
    return F.aggregate(F.filter(cigar(text), lambda x: F.lit(ops).contains(x["op"])), F.lit(0).cast("long"), lambda a, x: a + x["len"])


def variation_length(text: Column) -> Column:
    return cigar_sum(text, "IDM")


def query_span(text: Column) -> Column:
    return cigar_sum(text, "MIS=X")


def target_span(text: Column) -> Column:
    return cigar_sum(text, "MDN=X")


def difference_string(cs: Column) -> Column:
    """array of struct(op, text) of a difference string such as `:10*ac+tt-g`."""
    pattern = F.lit(r"([:*+=\-])([^:*+=\-]+)")
    return F.zip_with(F.regexp_extract_all(cs, pattern, 1), F.regexp_extract_all(cs, pattern, 2), lambda o, t: F.struct(o.alias("op"), t.alias("text")))


def cs_to_cigar(cs: Column) -> Column:
    """The CIGAR text of a difference string."""

    def one(x):
        n = F.when(x["op"] == ":", x["text"]).when(x["op"] == "*", F.lit("1")).otherwise(F.length(x["text"]).cast("string"))
        op = F.when(x["op"].isin(":", "="), F.lit("=")).when(x["op"] == "*", F.lit("X")).when(x["op"] == "+", F.lit("I")).otherwise(F.lit("D"))
        return F.concat(n, op)

    return F.array_join(F.transform(difference_string(cs), one), "")


def cs_score(cs: Column, match: float, mismatch: float, gap_open: float, gap_extend: float, matrix: Mapping[str, float] | None = None) -> Column:
    """Alignment score: match for each equal base, a matrix value (or mismatch) for each
    substitution `*xy`, open + (n - 1) * extend for each gap."""
    table = F.create_map(*[F.lit(v) for kv in (matrix or {}).items() for v in (kv[0], float(kv[1]))]) if matrix else None

    def one(acc, x):
        n = F.length(x["text"]).cast("double")
        other = F.coalesce(F.try_element_at(table, x["text"]), F.lit(float(mismatch))) if table is not None else F.lit(float(mismatch))
        gain = F.when(x["op"] == ":", x["text"].cast("double") * match).when(x["op"] == "=", n * match).when(x["op"] == "*", other).otherwise(-(gap_open + (n - 1) * gap_extend))
        return acc + gain

    return F.aggregate(difference_string(cs), F.lit(0.0), one)


def perfect_alignment(cigar_text: Column, md: Column, read_length: Column) -> Column:
    """One match over the whole read, and no mismatch."""
    n = read_length.cast("string")
    return (cigar_text == F.concat(n, F.lit("M"))) & (md == F.concat(F.lit("MD:Z:"), n))


def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(bit) != 0


def identity(matches: Column, block: Column) -> Column:
    return matches / (block + F.lit(1e-8))


# -- variants


def alt_count(genotype: Column) -> Column:
    """Alternative alleles of a genotype; a missing one counts -1."""
    alleles = F.split(genotype, r"[/|]")
    return F.aggregate(alleles, F.lit(0), lambda a, x: a + F.when(x == ".", -1).when(x == "0", 0).otherwise(1))


def zygosity(genotype: Column) -> Column:
    """`hom`, `het` or `missing`, by the alleles themselves."""
    alleles = F.split(genotype, r"[/|]")
    return F.when(F.array_contains(alleles, "."), "missing").when(F.size(F.array_distinct(alleles)) > 1, "het").otherwise("hom")


def variant_type(ref: Column, alt: Column) -> Column:
    """SNP, MNP, INS, DEL or INV."""
    a, b = F.length(ref), F.length(alt)
    return F.when((a == 1) & (b == 1), "SNP").when(a < b, "INS").when(a > b, "DEL").when(alt == reverse_complement(ref), "INV").otherwise("MNP")


def signed_length(ref: Column, alt: Column) -> Column:
    return (F.length(alt) - F.length(ref)).cast("long")


# -- models


def choose2(n: Column) -> Column:
    return n * (n - 1) / 2


def support(homologies: Column, ingroup: Column, outgroup: Column) -> Column:
    """Pairwise homologies over those that in- and outgroup segments could have."""
    return homologies / (2 * choose2(ingroup) + ingroup * outgroup)


def same_base_probability(distance: Column) -> Column:
    """Jukes-Cantor: 1/4 + 3/4 exp(-4d/3)."""
    return F.lit(0.25) + F.lit(0.75) * F.exp(F.lit(-4 / 3) * distance)


def jukes_cantor(distance: float) -> list[list[float]]:
    """The 4 x 4 substitution matrix at a distance."""
    same = 0.25 + 0.75 * math.exp(-4 * distance / 3)
    return [[same if i == j else (1 - same) / 3 for j in range(4)] for i in range(4)]


def divergence_class(distance: Column, bounds: Mapping[str, float], strict: bool = False) -> Column:
    """Name of the first bound that the distance is within (below, if strict); the last one beyond all."""
    names = list(bounds)
    out = F.lit(names[-1])
    for name in reversed(names):
        out = F.when((distance < bounds[name]) if strict else (distance <= bounds[name]), F.lit(name)).otherwise(out)
    return out


UNITS = {"k": 10**3, "m": 10**6, "g": 10**9, "t": 10**12, "ki": 2**10, "mi": 2**20, "gi": 2**30, "ti": 2**40}


def parse_size(text: str) -> int:
    """A size with an optional unit, such as `4Gi` or `10k`, in ones."""
    digits = text.strip().rstrip("bB")
    number = digits.rstrip("kmgtiKMGTI")
    unit = digits[len(number) :].lower()
    if unit and unit not in UNITS:
        raise ValueError(f"unknown unit in {text!r}")
    return int(float(number) * UNITS.get(unit, 1))


def long_gap_scores(scores: Mapping[str, float], open_factor: float, extend_factor: float) -> dict[str, float]:
    """Scores with a second gap penalty, open_factor dearer to open and extend_factor cheaper to extend.

    Keys are pairs of bases, `open` and `extend`; `open2` and `extend2` are added. Penalties are scaled
    by extend_factor; where the extension is too small to be divided by it, so are the pairs' scores.
    """
    if open_factor <= 1 or extend_factor < 1:
        raise ValueError("a long gap needs open_factor > 1 and extend_factor >= 1")
    small = scores["extend"] < extend_factor
    out = {k: v * extend_factor if small or k in ("open", "extend") else v for k, v in scores.items()}
    return out | {"open2": out["open"] * open_factor, "extend2": max(1, int(out["extend"] / extend_factor))}
