"""Column expressions on sequence headers, sample names and graph paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_token(header: Column) -> Column:
    """The header up to its first white space."""
    return F.regexp_extract(header, r"^(\S*)", 1)


def sanitize(header: Column, event: Column | None = None, cut_hash: bool = False) -> Column:
    """A header that other tools accept.

    Cut at white space; optionally drop what precedes the last `#`; a region `:s-e` (from 1,
    closed) becomes `_sub_<s-1>_<e>` (s of 0 stays 0); other colons become `_`; an event
    is put in front as `id=EVENT|`.
    """
    h = first_token(header)
    if cut_hash:
        h = F.regexp_replace(h, r"^.*#", "")
    region = r"^(.*):(\d+)-(\d+)$"
    start = F.regexp_extract(h, region, 2)
    from_zero = F.greatest(start.cast("long") - 1, F.lit(0)).cast("string")
    named = F.when(h.rlike(region), F.concat(F.regexp_extract(h, region, 1), F.lit("_sub_"), from_zero, F.lit("_"), F.regexp_extract(h, region, 3))).otherwise(h)
    named = F.translate(named, ":", "_")
    return named if event is None else F.concat(F.lit("id="), event, F.lit("|"), named)


def strip_event(name: Column) -> Column:
    """Without a leading `id=EVENT|`."""
    return F.regexp_replace(name, r"^id=[^|]*\|", "")


def cut_before(header: Column, char: str, occurrence: int = 1) -> Column:
    """What stands before the n-th `char`; all of it if there are fewer."""
    return F.substring_index(header, char, occurrence)


def cut_after(header: Column, char: str) -> Column:
    """What follows the last `char`; all of it without one."""
    return F.substring_index(header, char, -1)


def subpath(name: Column) -> Column:
    """struct(base, offset, length) of a nested sub-path name.

    Each trailing `_sub_<start>_<end>` shifts the offset by its start; the length is that of
    the innermost. A name without any has offset 0 and a null length.
    """
    tail = F.regexp_extract(name, r"((?:_sub_\d+_\d+)*)$", 1)
    starts = F.transform(F.regexp_extract_all(tail, F.lit(r"_sub_(\d+)_(\d+)"), 1), lambda x: x.cast("long"))
    ends = F.transform(F.regexp_extract_all(tail, F.lit(r"_sub_(\d+)_(\d+)"), 2), lambda x: x.cast("long"))
    offset = F.aggregate(starts, F.lit(0).cast("long"), lambda a, x: a + x)
    length = F.when(F.size(starts) > 0, F.element_at(ends, -1) - F.element_at(starts, -1))
    return F.struct(F.substring(name, F.lit(1), F.length(name) - F.length(tail)).alias("base"), offset.alias("offset"), length.alias("length"))


def event_to_prefix(event: Column) -> Column:
    """`sample.2` to `sample#2`; without a number, `sample#0`."""
    n = F.regexp_extract(event, r"^(.*)\.(\d+)$", 2)
    return F.when(n != "", F.concat(F.regexp_extract(event, r"^(.*)\.(\d+)$", 1), F.lit("#"), n.cast("int").cast("string"))).otherwise(F.concat(event, F.lit("#0")))


def prefix_to_event(prefix: Column) -> Column:
    """`sample#2` to `sample.2`; a number of 0 is left out."""
    sample, n = F.substring_index(prefix, "#", 1), F.substring_index(prefix, "#", -1)
    return F.when(n.cast("int") == 0, sample).otherwise(F.concat(sample, F.lit("."), n.cast("int").cast("string")))


def path_name(name: Column, length: Column) -> Column:
    """struct(prefix, contig, start, end) of `sample#hap#contig[start-end]`; null with fewer fields."""
    parts = F.split(name, "#", 3)
    contig = F.get(parts, F.lit(2))
    sub = r"^(.*)\[(\d+)(?:-(\d+))?\]$"
    start = F.when(contig.rlike(sub), F.regexp_extract(contig, sub, 2).cast("long")).otherwise(F.lit(0).cast("long"))
    base = F.when(contig.rlike(sub), F.regexp_extract(contig, sub, 1)).otherwise(contig)
    return F.when(F.size(parts) >= 3, F.struct(F.concat_ws("#", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))).alias("prefix"), base.alias("contig"), start.alias("start"), (start + length).alias("end")))


def sample_base(sample: Column) -> Column:
    """A sample's name without its haplotype number."""
    return F.regexp_replace(sample, r"\.\d+$", "")


def sample_haplotype(sample: Column) -> Column:
    """The haplotype number of a sample's name, 0 without one."""
    return F.coalesce(F.nullif(F.regexp_extract(sample, r"\.(\d+)$", 1), F.lit("")).cast("int"), F.lit(0))


def alphanumeric(name: Column) -> Column:
    """Letters and digits only."""
    return F.regexp_replace(name, "[^A-Za-z0-9]", "")


def legal_header(name: Column) -> Column:
    """Whether a browser accepts the name: letters, digits, `_`, `-`, `.` and not only digits."""
    return name.rlike(r"^[A-Za-z0-9_.\-]+$") & ~name.rlike(r"^\d+$")


def graph_steps(path: Column) -> Column:
    """Steps, with their orientation, of a graph traversal such as `>1>2<3`."""
    return F.regexp_extract_all(path, F.lit("([<>][^<>]+)"), 1)


def reverse_path(path: Column) -> Column:
    """The traversal read from its other end: steps reversed, orientations flipped."""
    return F.array_join(F.transform(F.reverse(graph_steps(path)), lambda s: F.translate(s, "<>", "><")), "")
