"""Nested sites and graph coordinates against plain walks."""

import random
from itertools import combinations

import pytest

from loomspan.operators import graphpaths, nested

COMPLEMENT = str.maketrans("ACGT", "TGCA")


def bases(step, seqs):
    seq = seqs[step[1:]]
    return seq[::-1].translate(COMPLEMENT) if step[0] == "<" else seq


def random_pair(rng, n):
    ref = [">s", *(rng.choice("><") + rng.choice("abcdef") for _ in range(rng.randint(0, n))), ">e"]
    alt = [">s"]
    for step in ref[1:-1]:
        alt += {0: [], 1: [rng.choice("><") + rng.choice("abcdef")], 2: [step.translate(str.maketrans("<>", "><"))], 3: [step, step]}.get(rng.randrange(9), [step])
    return ref, [*alt, ">e"]


def rebuilt(ref, parts):
    """The alternative, put together again from the reference and the differences."""
    out, at = [], 0
    for _, i, gone, new, _ in parts:
        out += ref[at : i + 1] + new
        at = i + 1 + len(gone)
    return out + ref[at:]


@pytest.mark.parametrize("anchors", ["first", "longest"])
def test_parts_rebuild_the_alternative(anchors):
    rng = random.Random(7)
    for _ in range(500):
        ref, alt = random_pair(rng, 12)
        parts = list(nested.parts_of(ref, alt, anchors))
        assert rebuilt(ref, parts) == alt
        for _, _, gone, new, inverted in parts:
            assert gone or new
            assert inverted == any(x.translate(str.maketrans("<>", "><")) in new for x in gone)


def test_longest_anchors_are_longest():
    rng = random.Random(3)
    for _ in range(200):
        ref, alt = random_pair(rng, 7)
        found = list(nested.longest_anchors(ref, alt))
        assert all(ref[i] == alt[j] for i, j in found) and all(a < c and b < d for (a, b), (c, d) in zip(found, found[1:], strict=False))
        inner, other = ref[1:-1], alt[1:-1]
        within = lambda some: (lambda it: all(x in it for x in some))(iter(other))
        longest = max(k for k in range(len(inner) + 1) if any(within(c) for c in combinations(inner, k)))
        assert len(found) == longest


def walked(ref, alt, seqs, pos):
    """Typed variants by the rule: each step of ref in turn, found again behind the last anchor."""
    same = 0
    while same < min(len(ref), len(alt)) and ref[-1 - same] == alt[-1 - same]:
        same += 1
    if 0 < same < min(len(ref), len(alt)):
        ref, alt = ref[: len(ref) - same + 1], alt[: len(alt) - same + 1]
    spans, i0, j0 = [], 0, 0
    for i in range(1, len(ref) - 1):
        if ref[i] in alt[j0 + 1 : -1]:
            j = alt.index(ref[i], j0 + 1)
            spans.append((i0, i, j0, j))
            i0, j0 = i, j
    spans.append((i0, len(ref) - 1, j0, len(alt) - 1))
    out = []
    for i0, i1, j0, j1 in spans:
        if i1 - i0 > 1 or j1 - j0 > 1:
            r, a = ("".join(bases(s, seqs) for s in x) for x in (ref[i0 + 1 : i1], alt[j0 + 1 : j1]))
            start = pos + sum(len(seqs[s[1:]]) for s in ref[1 : i0 + 1])
            turned = any(s.translate(str.maketrans("<>", "><")) in alt[j0 + 1 : j1] for s in ref[i0 + 1 : i1])
            if len(r) == len(a) and not turned:
                out.append((start, "SNP" if len(r) == 1 else "MNP", r, a, len(r), None))
            else:
                before = bases(ref[i0], seqs)[-1]
                kind = "INV" if turned else "DEL" if len(a) < len(r) else "INS"
                out.append((start - 1, kind, before + r, before + a, len(r) if turned else len(a) - len(r), start - 1 + len(r)))
    return out


def test_typed_variants(spark):
    rng = random.Random(11)
    seqs = {n: "".join(rng.choice("ACGT") for _ in range(rng.choice([1, 1, 3]))) for n in "abcdefse"}
    pairs = [random_pair(rng, 10) for _ in range(250)] + [([">s", ">e"], [">s", ">e"])]
    rows = [(k, "c", 100 * k, ref, alt) for k, (ref, alt) in enumerate(pairs)] + [(900, "c", 5, None, [">s"])]
    frame = spark.createDataFrame(rows, "id long, contig string, pos long, ref array<string>, alt array<string>").repartition(3)
    got = nested.typed_variants(frame, spark.createDataFrame(list(seqs.items()), "node string, seq string")).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.id, r.part)):
        found.setdefault(r.id, []).append((r.pos, r.kind, r.ref_bases, r.alt_bases, r.length, r.end))
    want = {k: v for k, _, pos, ref, alt in rows[:-1] if (v := walked(ref, alt, seqs, pos))}
    assert found == want and {v[1] for vs in want.values() for v in vs} == {"SNP", "MNP", "INS", "DEL", "INV"}


def test_nested_sites(spark):
    rows = [(1, None, [">1>2", ">1>3>4>2", ">1>5>2"]), (2, 1, [">3>4", ">1>5"]), (3, 2, [">3>4", ">1>52"]), (4, 77, ["x"]), (5, 3, [">5>2", ">3>4"])]
    got = {r.id: (r.top, r.consistent) for r in nested.nested_consistency(spark.createDataFrame(rows, "id long, parent long, alleles array<string>")).collect()}
    assert got == {1: (1, True), 2: (1, True), 3: (1, False), 4: (4, True), 5: (1, True)}


# -- graph coordinates


def pieces(rng):
    """Sequences cut into nodes: (node, name, start, length)."""
    rows = []
    for name in "xyz":
        at = 0
        for _ in range(rng.randint(3, 9)):
            n = rng.randint(1, 9)
            rows.append((f"n{len(rows)}", name, at, n))
            at += n
    return rows


def spell(path, nodes):
    """The (name, position, direction) of every base along node steps."""
    out = []
    for step in path:
        _, name, start, n = nodes[step[1:]]
        bases = [(name, p, step[0]) for p in range(start, start + n)]
        out += bases if step[0] == ">" else bases[::-1]
    return out


def spell_stable(path):
    out = []
    for step in path:
        name, span = step[1:].split(":")
        a, b = map(int, span.split("-"))
        bases = [(name, p, step[0]) for p in range(a, b)]
        out += bases if step[0] == ">" else bases[::-1]
    return out


def test_coordinates_there_and_back(spark):
    rng = random.Random(4)
    rows = pieces(rng)
    nodes = {r[0]: r for r in rows}
    reads = [(k, [rng.choice("><") + rng.choice(rows)[0] for _ in range(rng.randint(1, 6))], 1, 2, "tag") for k in range(60)]
    names = [r[0] for r in rows]
    reads += [(100 + k, [way + n for n in (names[k : k + 4] if way == ">" else names[k : k + 4][::-1])], 0, 3, "run") for k in range(8) for way in ["><"[k % 2]]]
    schema = "id long, path array<string>, path_start long, path_end long, note string"
    given, table = spark.createDataFrame(reads, schema), spark.createDataFrame(rows, "node string, name string, start long, length long")
    stable = graphpaths.to_stable(given, table)
    for r in stable.collect():
        want = spell(next(x for x in reads if x[0] == r.id)[1], nodes)
        got = spell_stable(r.path)
        assert got == want
    back = {tuple(map(str, r)) for r in graphpaths.to_unstable(stable, table).collect()}
    assert back == {tuple(map(str, r)) for r in reads}
    lost = spark.createDataFrame([(1, [">n0", ">nowhere"], 0, 1, "")], schema)
    assert graphpaths.to_stable(lost, table).count() == 0


def test_intervals_that_begin_within_nodes(spark):
    table = spark.createDataFrame([("a", "x", 0, 10), ("b", "x", 10, 5), ("c", "x", 15, 20)], "node string, name string, start long, length long")
    reads = [(1, ["x"], 12, 18), (2, [">x:12-18"], 1, 4), (3, ["<x:12-18"], 1, 4), (4, [">x:40-50"], 0, 1)]
    got = {r.id: (r.path, r.path_start, r.path_end) for r in graphpaths.to_unstable(spark.createDataFrame(reads, "id long, path array<string>, path_start long, path_end long"), table).collect()}
    assert got == {1: ([">b", ">c"], 2, 8), 2: ([">b", ">c"], 3, 6), 3: (["<c", "<b"], 18, 21)}


def test_path_index(spark):
    steps = [("p", k, f">{'ab'[k % 2]}") for k in range(7)] + [("q", 0, "<b")]
    got = graphpaths.path_index(spark.createDataFrame(steps, "path string, place long, step string"), spark.createDataFrame([("a", 3), ("b", 5)], "node string, length long"))
    assert sorted((r.path, r.place, r.start, r.end) for r in got.collect()) == [("p", k, k // 2 * 8 + k % 2 * 3, (k + 1) // 2 * 3 + (k // 2 + k % 2) * 5 if k % 2 else k // 2 * 8 + 3) for k in range(7)] + [("q", 0, 0, 5)]


def test_overlap_and_jump_filters(spark):
    rng = random.Random(9)
    rows = [(k, rng.choice("ab"), s, s + rng.randint(1, 30)) for k in range(60) for s in [rng.randrange(300)]]
    kept = {r.id for r in graphpaths.drop_overlapped(spark.createDataFrame(rows, "id long, query string, start long, end long"), 2.0, 0.5, 1).collect()}
    contests = lambda a, b: a[0] != b[0] and a[1] == b[1] and (o := min(a[3], b[3]) - max(a[2], b[2])) > 1 and o >= 0.5 * min(a[3] - a[2], b[3] - b[2]) and a[3] - a[2] < 2.0 * (b[3] - b[2])
    assert kept == {a[0] for a in rows if not any(contests(a, b) for b in rows)} and 0 < len(kept) < 60
    jumps = [(k, "q", 100 * k, 100 * k + n, "t", "+", t, t + n) for k, (n, t) in enumerate([(90, 0), (20, 5000), (80, 200), (10, 300), (50, 9000), (60, 9100)])]
    schema = "id long, query string, start long, end long, target string, strand string, tstart long, tend long"
    left = {r.id for r in graphpaths.drop_jumps(spark.createDataFrame(jumps, schema), 1000).collect()}
    assert left == plain_jumps(jumps, 1000)


def plain_jumps(rows, most):
    """Rounds of the same rule over a list."""
    left = sorted(rows, key=lambda r: r[2])
    size = lambda r: (r[3] - r[2], -r[0])
    while True:
        pairs = [(a, b) for a, b in zip(left, left[1:], strict=False) if (b[6] - a[7]) - (b[2] - a[3]) > most]
        short, long = {min(p, key=size)[0] for p in pairs}, {max(p, key=size)[0] for p in pairs}
        if not short - long:
            return {r[0] for r in left}
        left = [r for r in left if r[0] not in short - long]
