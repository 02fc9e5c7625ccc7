"""Grouping over edge tables, by repeated joins with a stored table after each round."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.operators import intervals as iv
from loomspan.operators.relational import follow_parents
from loomspan.session import discard, materialize, scratch


def _neighbours_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each directed pair with the least of u and its neighbours."""
    least = pairs.groupBy(F.col("u").alias("w")).agg(F.least(F.first("u"), F.min("v")).alias("m"))
    return pairs.join(least, F.col("u") == F.col("w")).select("u", "v", "m")


def _settled(pairs: DataFrame) -> bool:
    """Whether (u, v), v < u, are stars around their v: each u has one v, and none of them is a u."""
    ends = pairs.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(pairs.select(F.col("v").alias("n"), F.lit(0), F.lit(1)))
    return ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) of every endpoint of (a, b) edges; the component is its least id.

    Large-star and small-star rounds alternate until all are stars, which edges may be from the start: each points
    neighbours at the least id around, so edges never outnumber those at the start, and a
    node with very many edges is summed up before it is joined. Self edges and repeated
    edges are harmless; null endpoints are dropped.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter(F.col("u").isNotNull() & F.col("v").isNotNull())
    first = state = materialize(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    for _ in range(max_rounds):
        pairs = state.filter(F.col("u") != F.col("v"))
        if _settled(pairs):
            break
        swapped = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))
        large = _neighbours_least(pairs.union(swapped)).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _neighbours_least(large.filter(F.col("u") != F.col("v")))
        stars = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        last, state = state, materialize(stars.filter(F.col("u") != F.col("v")).distinct(), "components")
        if last is not first:  # nodes with self edges alone are still to be read
            discard(last)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # Every node with a neighbour is in a star.
    roots = pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    labels = pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
    own = first.filter(F.col("u") == F.col("v")).select(F.col("u").alias("id"), F.col("u").alias("component"))
    if own.isEmpty():
        return labels
    return labels.union(own.join(labels.select(F.col("id").alias("w")), F.col("id") == F.col("w"), "left_anti"))


#: Edges that are gone through one after the other, at most: what one task holds.
GROUP_EDGES = 200_000


def _first_of(scores: str, a: str, b: str) -> Column:
    """Edges' order: best score first, none and NaN last, then by nodes."""
    none = F.col(scores).isNull() | F.isnan(scores)
    return F.struct(none.alias("none"), F.when(~none, -F.col(scores)).alias("minus"), F.col(a).alias("a"), F.col(b).alias("b"))


def _joined_in_turn(live: DataFrame, cap: int) -> DataFrame:
    """(old, new, size) of the parts joined by live edges (e, ca, cb, sa, sb), a bounded number, one after the other."""
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["none", "minus", "a", "b"], kind="stable")
        size = dict(zip(pdf["ca"].tolist(), pdf["sa"].tolist(), strict=True)) | dict(zip(pdf["cb"].tolist(), pdf["sb"].tolist(), strict=True))
        parent = {x: x for x in size}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in zip(pdf["ca"].tolist(), pdf["cb"].tolist(), strict=True):
            x, y = root(x), root(y)
            if x != y and size[x] + size[y] <= cap:
                x, y = min(x, y), max(x, y)
                parent[y] = x
                size[x] += size[y]
        moved = [(x, root(x)) for x in parent]
        apart = {y for x, y in moved if x != y}
        rows = [(x, y, size[y]) for x, y in moved if y in apart]
        return pd.DataFrame({"old": [r[0] for r in rows], "new": [r[1] for r in rows], "size": [r[2] for r in rows]}, dtype="int64")

    flat = live.select(F.lit(0).alias("one"), "e.none", "e.minus", "e.a", "e.b", "ca", "cb", "sa", "sb")
    return flat.groupBy("one").applyInPandas(run, "old long, new long, size long")


def _moved(state: DataFrame, moves: DataFrame) -> DataFrame:
    """state (id, c, size) of nodes in parts of several, after parts were joined."""
    later = moves.select(F.col("old").alias("_old"), F.col("new").alias("_new"), F.col("size").alias("_size"))
    known = state.join(later, F.col("c") == F.col("_old"), "left").select("id", F.coalesce("_new", "c").alias("c"), F.coalesce("_size", "size").alias("size"))
    # A part not yet in the state is a single node of its own name.
    fresh = moves.join(state.select(F.col("id").alias("_id")), F.col("old") == F.col("_id"), "left_anti").select(F.col("old").alias("id"), F.col("new").alias("c"), "size")
    return known.unionByName(fresh)


def _still_open(live: DataFrame, moves: DataFrame, cap: int) -> DataFrame:
    """Live edges after moves (old, new, size), without those that are decided: ends in one part, or in parts too large
    together. Parts only grow, and by edges before all those that are still open at them, so both hold in turn, too."""
    to = lambda end: moves.select(F.col("old").alias(f"_o{end}"), F.col("new").alias(f"_n{end}"), F.col("size").alias(f"_s{end}"))
    at = live.join(to("a"), F.col("ca") == F.col("_oa"), "left").join(to("b"), F.col("cb") == F.col("_ob"), "left")
    named = at.select("e", F.coalesce("_na", "ca").alias("ca"), F.coalesce("_nb", "cb").alias("cb"), F.coalesce("_sa", "sa").alias("sa"), F.coalesce("_sb", "sb").alias("sb"))
    return named.filter((F.col("ca") != F.col("cb")) & (F.col("sa") + F.col("sb") <= cap))


def break_up_greedily(edges: DataFrame, components: DataFrame | None, cap: int, group_edges: int = GROUP_EDGES) -> DataFrame:
    """Edges (a, b, score) with `kept`: best edges first, one is kept unless it would join parts to more
    than `cap` nodes. Edges are taken by score (null and NaN last), then a, then b.

    Only an edge's two parts matter to it, so in a round all edges that come first at both their parts are
    taken at once; edges within a part, or between parts too large together, are decided whenever that comes
    about. The best edges are settled first, then four times as many, and so on: once most parts are full, the rest is
    decided by one look. The last `group_edges` of them are gone through in one task. An edge is kept
    just if its ends are in one part in the end. No components are needed; of edges with a null end none is returned.
    """
    spark = edges.sparkSession
    rows = edges.filter("a IS NOT NULL AND b IS NOT NULL").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), F.col("score").cast("double").alias("score"))
    one = F.lit(1).cast("long")
    with scratch(spark):
        rest = materialize(rows.filter("a <> b").select(_first_of("score", "a", "b").alias("e"), F.col("a").alias("ca"), F.col("b").alias("cb"), one.alias("sa"), one.alias("sb")).filter(F.lit(cap >= 2)), "open-edges")
        state = spark.createDataFrame([], "id long, c long, size long")
        share = 64
        while not rest.isEmpty():
            live, later = rest, None
            if share > 1 and rest.count() > group_edges:
                bound = rest.select("e.minus").approxQuantile("minus", [1 / share], 0.25 / share)
                if bound and not (later := rest.filter(F.col("e.none") | (F.col("e.minus") > bound[0]))).isEmpty():
                    live = rest.filter(~F.col("e.none") & (F.col("e.minus") <= bound[0]))
                else:
                    later = None
            share //= 4
            while n := live.count():
                if n <= group_edges:
                    moves = materialize(_joined_in_turn(live, cap), "moves")
                else:
                    first = live.select("sa", "sb", F.explode(F.array(F.struct(F.col("ca").alias("c"), "e", "ca", "cb"), F.struct(F.col("cb").alias("c"), "e", "ca", "cb"))).alias("x")).groupBy("x.c").agg(F.min(F.struct("x.e", "x.ca", "x.cb", "sa", "sb")).alias("m"))
                    both = first.groupBy("m").agg(F.count("*").alias("n")).filter("n = 2")
                    new, size = F.least("m.ca", "m.cb"), F.col("m.sa") + F.col("m.sb")
                    moves = materialize(both.select(F.explode(F.array("m.ca", "m.cb")).alias("old"), new.alias("new"), size.alias("size")), "moves")
                state = materialize(_moved(state, moves), "parts")
                if n <= group_edges:
                    break
                live = materialize(_still_open(live, moves, cap), "open-edges")
            if later is None:
                break
            own = state.select(F.col("id").alias("old"), F.col("c").alias("new"), "size")
            # Names of `later` may be older than those of the state: its nodes' own are looked up.
            by_node = later.select("e", F.col("e.a").alias("ca"), F.col("e.b").alias("cb"), one.alias("sa"), one.alias("sb"))
            rest = materialize(_still_open(by_node, own, cap), "open-edges")
        state = materialize(state, "parts", keep=True)
    part = lambda end: state.select(F.col("id").alias(f"_i{end}"), F.col("c").alias(f"_c{end}"))
    placed = rows.join(part("a"), F.col("a") == F.col("_ia"), "left").join(part("b"), F.col("b") == F.col("_ib"), "left")
    return placed.select("a", "b", "score", ((F.coalesce("_ca", "a") == F.coalesce("_cb", "b")) & F.lit(cap >= 1)).alias("kept"))


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree) over both endpoints of distinct edges."""
    both = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return both.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))


def drop_stubs(edges: DataFrame, rounds: int) -> DataFrame:
    """Edges left after removing, for some rounds, all edges of nodes with one neighbour."""
    left = edges
    for _ in range(rounds):
        stub = degrees(left).filter("degree = 1").select("id")
        left = materialize(left.join(stub, F.col("a") == F.col("id"), "left_anti").join(stub, F.col("b") == F.col("id"), "left_anti"), "stubs")
    return left


def isolated(edges: DataFrame, special: DataFrame) -> DataFrame:
    """edges (a, b, rank; ranks unique) with `state`, taken by rank: `joined` joins two components, `within` lies in one,
    `bridge` would join two with a special node (id) each, and is not taken.

    The joining edges are a least spanning forest where all special nodes count as joined beforehand:
    so it is found by rounds in which every component takes its first edge, not one edge after the
    other, and each round at least halves the components. An edge outside the forest is a bridge if
    its ends lie in different components of the forest.
    """
    with scratch(edges.sparkSession):
        rows = materialize(edges.select("a", "b", "rank"), "forest-edges")
        # Special nodes begin as one component, named =.
        first_of = special.select(F.col("id").alias("_s")).distinct()
        name = lambda n: F.when(F.col("_s").isNotNull(), F.lit("=")).otherwise(F.concat(F.lit("+"), F.col(n).cast("string")))
        named = rows.filter("a <> b").join(first_of, F.col("a") == F.col("_s"), "left").select("rank", "b", name("a").alias("ca")).join(first_of, F.col("b") == F.col("_s"), "left").select("ca", name("b").alias("cb"), "rank")
        # Components' edges alone are carried on, and of those between two components only the first.
        apart = lambda df: df.filter("ca <> cb").groupBy(F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")).agg(F.min("rank").alias("rank"))
        live, forest = materialize(apart(named), "forest-apart"), None
        while True:
            first = live.select(F.explode(F.array(F.struct(F.col("ca").alias("c"), "ca", "cb", "rank"), F.struct(F.col("cb").alias("c"), "ca", "cb", "rank"))).alias("e")).groupBy("e.c").agg(F.min("e.rank").alias("rank"))
            taken = materialize(live.join(first.select(F.col("rank").alias("_r")).distinct(), F.col("rank") == F.col("_r"), "left_semi"), "forest-taken")
            if taken.isEmpty():
                break
            ranks = taken.select("rank")
            forest = ranks if forest is None else forest.union(ranks)
            # Each component that is left has an edge, and so a new name.
            merged = connected_components(taken.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
            to = lambda n, end: merged.select(F.col("id").alias(f"_{end}"), F.col("component").alias(n))  # noqa: E731, B023
            moved = live.join(to("na", "a"), F.col("ca") == F.col("_a")).join(to("nb", "b"), F.col("cb") == F.col("_b"))
            last, live = live, materialize(apart(moved.select(F.col("na").alias("ca"), F.col("nb").alias("cb"), "rank")), "forest-apart")
            discard(last)
        joined = rows.join(forest.select(F.col("rank").alias("_r")), F.col("rank") == F.col("_r"), "left_semi") if forest is not None else rows.filter("false")
        parts = materialize(connected_components(joined), "forest-parts")
        side = lambda n, end: parts.select(F.col("id").alias(f"_{end}"), F.col("component").alias(n))
        placed = rows.join(side("pa", "a"), F.col("a") == F.col("_a"), "left").join(side("pb", "b"), F.col("b") == F.col("_b"), "left")
        marks = joined.select(F.col("rank").alias("_r")).withColumn("_j", F.lit(True))
        within = F.coalesce("pa", "a") == F.coalesce("pb", "b")
        states = placed.join(marks, F.col("rank") == F.col("_r"), "left").select("a", "b", "rank", F.when(F.col("_j"), "joined").when(within, "within").otherwise("bridge").alias("state"))
        return materialize(states, "forest", keep=True)


def cycle_free(matches: DataFrame, special: DataFrame) -> DataFrame:
    """matches (rank, a_thread, a_segment, b_thread, b_segment) with `state`, taken by rank.

    `bridge`: the threads' components have a special thread (id) each, and are not the same. `cycle`: both
    segments' blocks hold a segment of a special thread. Neither is taken. `joined` segments were
    apart before, those `within` a block were not. Segments' names are unique over all threads.
    """
    threads = isolated(matches.select(F.col("a_thread").alias("a"), F.col("b_thread").alias("b"), "rank"), special)
    bridges = materialize(threads.filter("state = 'bridge'").select(F.col("rank").alias("_r")), "bridges")
    left = matches.join(bridges, F.col("rank") == F.col("_r"), "left_anti")
    sides = matches.select(F.col("a_thread").alias("t"), F.col("a_segment").alias("s")).union(matches.select("b_thread", "b_segment"))
    marked = sides.join(special.select(F.col("id").alias("_s")), F.col("t") == F.col("_s"), "left_semi").select(F.col("s").alias("id")).distinct()
    cuts = isolated(left.select(F.col("a_segment").alias("a"), F.col("b_segment").alias("b"), "rank"), marked).select(F.col("rank").alias("_r"), F.when(F.col("state") == "bridge", "cycle").otherwise(F.col("state")).alias("_state"))
    return matches.join(cuts, F.col("rank") == F.col("_r"), "left").select(*matches.columns, F.coalesce("_state", F.lit("bridge")).alias("state"))


def euler_tour(forest: DataFrame) -> DataFrame:
    """forest (a, b, rank; ranks unique) walked round: (tour, left, rank, source, target) of each edge in both directions,
    `left` being the arcs that follow in the component's tour.

    An arc is followed by the next arc out of its target, by rank, and the last of them by the first.
    The circle is opened at the least node, and arcs are counted by pointer doubling, so a long path
    takes no more rounds than a bush.
    """
    arc = lambda source, target, way: F.struct(F.col(source).alias("source"), F.col(target).alias("target"), F.lit(way).alias("way"))
    arcs = forest.select("rank", F.explode(F.array(arc("a", "b", 0), arc("b", "a", 1))).alias("x")).select("rank", "x.source", "x.target", (F.col("rank") * 2 + F.col("x.way")).alias("arc"), (F.col("rank") * 2 + 1 - F.col("x.way")).alias("back"))
    firsts = arcs.groupBy(F.col("source").alias("_v")).agg(F.min_by("arc", "rank").alias("first"))
    # with_next goes in tiles of ranks: a node of very many edges spreads.
    after = iv.with_next(arcs.select("source", "rank", "arc", "back"), ["source"], "rank", ["arc"]).join(firsts, F.col("source") == F.col("_v"))
    after = after.select(F.col("back").alias("arc"), F.coalesce("next.arc", "first").alias("following"), F.col("source").alias("at"), "first")
    roots = connected_components(forest).groupBy("component").agg(F.lit(1).alias("_one")).select(F.col("component").alias("_root"))
    opened = after.join(roots, F.col("at") == F.col("_root"), "left").select("arc", F.when(~(F.col("_root").isNotNull() & (F.col("following") == F.col("first"))), F.col("following")).alias("following"))
    found = follow_parents(opened, "arc", "following").select(F.col("id").alias("_a"), F.col("top").alias("tour"), F.col("hops").alias("left"))
    return arcs.join(found, F.col("arc") == F.col("_a")).select("tour", "left", "rank", "source", "target")


def edge_cuts(edges: DataFrame) -> DataFrame:
    """edges (a, b, rank; ranks unique, several between two nodes allowed) with `bridge`, whether their removal parts a
    component, and `cut`, the least rank of the edges any two of which part one together (their own,
    if there is none; null for a bridge).

    Edges outside a spanning forest get random 128-bit labels. That of a forest edge is the exclusive or of the
    labels at the nodes below it, a difference of two running ones along the tour: labels of edges within
    cancel. So it is 0 where no other edge crosses, and equal for edges that the same edges cross;
    wrongly so by chance only, once in 2^128 pairs.
    """
    with scratch(edges.sparkSession):
        none = edges.filter("false").select(F.col("a").alias("id"))
        states = isolated(edges, none)
        label = [F.xxhash64("rank", F.lit(k)) for k in (1, 2)]
        other = materialize(states.filter("state <> 'joined'").select("a", "b", "rank", label[0].alias("x"), label[1].alias("y")), "cut-labels")
        forest = materialize(states.filter("state = 'joined'").select("a", "b", "rank"), "cut-forest")
        at = other.select(F.explode(F.array("a", "b")).alias("_v"), "x", "y").groupBy("_v").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
        tour = materialize(euler_tour(forest), "cut-tour")
        enters = tour.groupBy(F.col("rank").alias("_r")).agg(F.max("left").alias("enter"), F.min("left").alias("exit"))
        marked = tour.join(enters, F.col("rank") == F.col("_r")).withColumn("down", F.col("left") == F.col("enter")).join(at, F.col("down") & (F.col("target") == F.col("_v")), "left")
        run = marked.select("tour", (-F.col("left")).alias("pos"), "rank", "down", F.coalesce("x", F.lit(0)).alias("x"), F.coalesce("y", F.lit(0)).alias("y"))
        sums = iv.running(run, ["tour"], "pos", {"x": F.bit_xor, "y": F.bit_xor})
        # Before the arc down, and up to the arc back: what lies between is the subtree.
        ends = lambda c: F.bit_xor(F.when(F.col("down"), F.col(f"_before_{c}")).otherwise(F.col(f"_before_{c}").bitwiseXOR(F.col(c))))
        inner = sums.groupBy("rank").agg(ends("x").alias("x"), ends("y").alias("y")).join(forest, "rank").select("a", "b", "rank", "x", "y")
        # An edge from a node to itself is crossed by nothing and crosses nothing.
        labelled = materialize(inner.union(other.select("a", "b", "rank", "x", "y")), "cut-edges")
        classes = labelled.filter("a <> b").groupBy(F.col("x").alias("_x"), F.col("y").alias("_y")).agg(F.min("rank").alias("cut"))
        bridge = (F.col("x") == 0) & (F.col("y") == 0)
        named = labelled.join(classes, (F.col("a") != F.col("b")) & (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y")), "left")
        return materialize(named.select("a", "b", "rank", bridge.alias("bridge"), F.when(~bridge, F.coalesce("cut", "rank")).alias("cut")), "cuts-of-edges", keep=True)
