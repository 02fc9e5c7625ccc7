"""Letters of ancestors, nested coordinates and isolated threads against plain recursion and union-find."""

import itertools
import os
import random

import pytest

from loomspan.functions.bases import jukes_cantor
from loomspan.operators import ancestral, graph

TREE = "id string, parent string, length double"
LETTERS = "ACGT"


def random_tree(rng, n):
    rows = [("n0", None, None)]
    rows += [(f"n{k}", rng.choice(rows)[0], rng.choice([0.05, 0.3, 1.0])) for k in range(1, n)]
    return rows


def marginals(tree, seen):
    """{node: weights of ACGT} by the sum over all assignments of letters to inner nodes; seen: [(leaf, letter)]."""
    held = {p for _, p, _ in tree if p}
    inner = [i for i, _, _ in tree if i in held]
    parent = {i: (p, jukes_cantor(d) if d is not None else None) for i, p, d in tree}
    total = {i: [0.0] * 4 for i in inner}
    for given in itertools.product(range(4), repeat=len(inner)):
        at = dict(zip(inner, given, strict=True))
        w = 1.0
        for i in inner:
            p, m = parent[i]
            if p:
                w *= m[at[p]][at[i]]
        for leaf, letter in seen:
            p, m = parent[leaf]
            if letter.upper() in LETTERS:
                w *= m[at[p]][LETTERS.index(letter.upper())]
        for i in inner:
            total[i][at[i]] += w
    return total


@pytest.mark.parametrize("seed", [1, 2])
def test_letters_are_those_of_all_assignments(spark, seed):
    rng = random.Random(seed)
    tree = random_tree(rng, 10)
    held = {p for _, p, _ in tree}
    leaves = [i for i, _, _ in tree if i not in held]
    rows = [("b", pos, leaf, rng.choice("AACGTacgtNn")) for pos in range(12) for leaf in leaves for _ in range(rng.choice([0, 1, 1, 2]))]
    rows += [("b", 99, leaves[0], "N"), ("b", 98, leaves[0], "n"), ("b", 97, "nowhere", "A")]
    observed = spark.createDataFrame(rows, "block string, pos long, event string, letter string")
    got = {(r.pos, r.id): r.letter for r in ancestral.ancestral_letters(observed, spark.createDataFrame(tree, TREE)).collect()}
    below = {i: {i} for i, _, _ in tree}
    for i, p, _ in reversed(tree):
        if p:
            below[p] |= below[i]
    for pos in range(12):
        here = [(e, x) for _, q, e, x in rows if q == pos]
        want = marginals(tree, here)
        for node, weights in want.items():
            if not any(e in below[node] for e, _ in here):
                assert (pos, node) not in got
                continue
            letter = got[pos, node]
            assert weights[LETTERS.index(letter.upper())] >= max(weights) * (1 - 1e-5) or letter.upper() == "N"
            assert (letter.upper() == "N") == all(x.upper() == "N" for _, x in here)
            assert letter.islower() == (sum(x.isupper() for _, x in here) <= len(here) // 2)
    assert got[99, "n0"] == "N" and got[98, "n0"] == "n" and (97, "n0") not in got


def test_deep_nesting(spark):
    rng = random.Random(6)
    rows, level = [], [("r0", None)]
    rows += [("r0", None, 0, None), ("lone", None, 3, 7)]
    for _ in range(10):
        following = []
        for name, _ in rng.sample(level, min(3, len(level))):
            for place in rng.sample(range(50), rng.randint(1, 3)):
                following.append((f"r{len(rows)}", name))
                rows.append((following[-1][0], name, place, None))
        level = following
    held = {p for _, p, _, _ in rows}
    rows = [(i, p, q, n if n is not None or i in held else rng.randint(0, 9)) for i, p, q, n in rows]
    want = {}

    def lay(name, start):
        own = next(r for r in rows if r[0] == name)
        end = start
        for child in sorted((r for r in rows if r[1] == name), key=lambda r: r[2]):
            end = lay(child[0], end)
        if name not in held:
            end = start + own[3]
        want[name] = (start, end)
        return end

    lay("r0", 0)
    lay("lone", 0)
    got = {r.id: (r.start, r.end) for r in ancestral.nested_coordinates(spark.createDataFrame(rows, "id string, parent string, place long, length long")).collect()}
    assert got == want


class Sets:
    """Union-find whose parts remember whether they hold a special node."""

    def __init__(self, special):
        self.parent, self.special = {}, set(special)

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def take(self, a, b):
        """joined, within or bridge."""
        x, y = self.root(a), self.root(b)
        if x == y:
            return "within"
        if x in self.special and y in self.special:
            return "bridge"
        self.parent[y] = x
        if y in self.special:
            self.special.add(x)
        return "joined"


def plain_cycle_free(matches, special):
    threads, marked = Sets(special), {s for _, a, x, b, y in matches for t, s in ((a, x), (b, y)) if t in special}
    segments, out = Sets(marked), {}
    for rank, a, x, b, y in sorted(matches):
        if threads.take(a, b) == "bridge":
            out[rank] = "bridge"
        else:
            out[rank] = {"bridge": "cycle"}.get(state := segments.take(x, y), state)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_isolated_threads(spark, seed):
    rng = random.Random(seed)
    special = ["s1", "s2", "s3"]
    names = special + [f"t{k}" for k in range(12)]
    matches = []
    for rank in rng.sample(range(1000), 60):
        a, b = rng.choice(names), rng.choice(names)
        matches.append((rank, a, f"{a}/{rng.randrange(3)}", b, f"{b}/{rng.randrange(3)}"))
    frame = spark.createDataFrame(matches, "rank long, a_thread string, a_segment string, b_thread string, b_segment string")
    got = {r["rank"]: r["state"] for r in graph.cycle_free(frame, spark.createDataFrame([(s,) for s in special], "id string")).collect()}
    assert got == plain_cycle_free(matches, set(special))
    assert set(got.values()) >= {"bridge", "joined"}


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no tables here")
def test_the_query_of_isolated_threads(spark):
    from loomspan.plans import catalog, nested

    sf = "/root/testdata/sf0.001"
    matches = [tuple(r) for r in nested.thread_matches(spark, sf).collect()]
    special = {f"c{r[0]}" for r in catalog.table(spark, sf, "customer").filter("c_custkey % 10 = 0").select("c_custkey").collect()}
    assert {r["rank"]: r["state"] for r in catalog.queries()["f15_cycle_free_threads"](spark, sf).collect()} == plain_cycle_free(matches, special)


def test_nothing(spark):
    none = spark.createDataFrame([], "a string, b string, rank long")
    assert graph.isolated(none, spark.createDataFrame([("x",)], "id string")).count() == 0
