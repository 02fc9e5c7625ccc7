"""Letters of ancestors: likelihoods along a tree, from the leaves up and back down, and coordinates of nested records.

A tree is (id, parent, length); observed letters are (block, pos, event, letter), an event being a leaf, and
any number of rows being of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions.bases import same_base_probability
from loomspan.operators import intervals as iv
from loomspan.operators import trees
from loomspan.session import discard, materialize

LETTERS = "ACGT"
P = tuple(f"p{k}" for k in range(4))
#: Least likelihood, relative to the largest, that is told from none.
FLOOR = 1e-30


def _along(branch: Column, logs: list[Column]) -> list[Column]:
    """Log likelihoods at the other end of a branch; the largest of each row is taken out first."""
    most = F.greatest(*logs)
    shares = [F.exp(x - most) for x in logs]
    same = same_base_probability(branch)
    other = (1 - same) / 3
    total = shares[0] + shares[1] + shares[2] + shares[3]
    return [F.ln(F.greatest(other * total + (same - other) * x, F.lit(FLOOR))) for x in shares]


def likelihoods(observed: DataFrame, tree: DataFrame) -> DataFrame:
    """(block, pos, id, p0, p1, p2, p3): log likelihoods of A, C, G and T at each node, given all letters of the tree, up to a
    constant of the row. Nodes with no letter at or below them have no row.

    One table is stored for each level, up from the leaves and down from the root. Letters other than
    ACGT, in either case, tell nothing. An event that is no node of the tree is left out.
    """
    up = trees.closure(tree)
    depth = up.groupBy(F.col("descendant").alias("id")).agg(F.max("hops").alias("depth"))
    nodes = materialize(tree.select("id", "parent", F.coalesce(F.col("length").cast("double"), F.lit(0.0)).alias("length")).join(depth, "id"), "ancestral-nodes")
    discard(up)
    by = ["block", "pos", "id"]
    # Every letter, sent up its own branch by itself: rows of one leaf are leaves of their own.
    own = [F.when(F.upper("letter") == c, 0.0).when(F.upper("letter").isin(*LETTERS), F.log(F.lit(FLOOR))).otherwise(0.0) for c in LETTERS]
    letters = observed.join(nodes, F.col("event") == F.col("id")).select(*by, "parent", "length", "depth", *(x.alias(p) for p, x in zip(P, own, strict=True)))
    sent = letters.select(*by, "parent", "depth", *(x.alias(p) for p, x in zip(P, _along(F.col("length"), [F.col(p) for p in P]), strict=True)))
    sent = materialize(sent.groupBy(*by, "parent", "depth").agg(*(F.sum(p).alias(p) for p in P)), "ancestral-up")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    levels, below = {}, sent.filter(F.col("depth") == deepest)
    for level in range(deepest - 1, -1, -1):
        raw = below.filter("parent IS NOT NULL").groupBy("block", "pos", F.col("parent").alias("id")).agg(*(F.sum(p).alias(p) for p in P))
        placed = raw.join(nodes, "id").select(*by, "parent", "length", *(F.col(p).alias(f"raw_{p}") for p in P))
        along = _along(F.col("length"), [F.col(f"raw_{p}") for p in P])
        levels[level] = materialize(placed.select("*", *(x.alias(p) for p, x in zip(P, along, strict=True))), "ancestral-up")
        below = levels[level].select(*by, "parent", *P).unionByName(sent.filter(F.col("depth") == level).select(*by, "parent", *P))
    # Down: what comes to a node is all of its parent's but its own part.
    result, above = None, None
    for level in range(deepest):
        here = levels[level]
        if above is None:
            whole = here.select(*by, *(F.col(f"raw_{p}").alias(p) for p in P))
        else:
            parents = above.select(F.col("block").alias("_b"), F.col("pos").alias("_p"), F.col("id").alias("_i"), *(F.col(p).alias(f"up_{p}") for p in P))
            joined = here.join(parents, (F.col("block") == F.col("_b")) & (F.col("pos") == F.col("_p")) & (F.col("parent") == F.col("_i")))
            rest = _along(F.col("length"), [F.col(f"up_{p}") - F.col(p) for p in P])
            whole = joined.select(*by, *((F.col(f"raw_{p}") + x).alias(p) for p, x in zip(P, rest, strict=True)))
        above = materialize(whole, "ancestral-down")
        result = above if result is None else result.unionByName(above)
    return result if result is not None else sent.select(*by, *P).filter("false")


def ancestral_letters(observed: DataFrame, tree: DataFrame) -> DataFrame:
    """(block, pos, id, letter): the likeliest letter of each inner node, by the letters at its leaves; ties, to six
    digits of their logarithm, go to the first of ACGT.

    It is N where all letters of the place are none of ACGT, and in lower case where no more than half,
    rounded down, of them are in upper case.
    """
    found = likelihoods(observed, tree)
    most = F.greatest(*P)
    ranked = F.array_min(F.array(*(F.struct((-F.round(F.col(p) - most, 6)).alias("m"), F.lit(c).alias("c")) for p, c in zip(P, LETTERS, strict=True))))
    letter = F.col("letter")
    seen = observed.groupBy(F.col("block").alias("_b"), F.col("pos").alias("_p")).agg(
        F.count("*").alias("n"), F.count_if(letter == F.upper(letter)).alias("upper"), F.count_if(~F.upper(letter).isin(*LETTERS)).alias("unknown")
    )
    plain = F.when(F.col("unknown") == F.col("n"), "N").otherwise(ranked["c"])
    masked = F.when(F.col("upper") <= F.floor(F.col("n") / 2), F.lower(plain)).otherwise(plain)
    return found.join(seen, (F.col("block") == F.col("_b")) & (F.col("pos") == F.col("_p"))).select("block", "pos", "id", masked.alias("letter"))


def nested_coordinates(records: DataFrame) -> DataFrame:
    """(id, start, end) of nested records (id, parent, place, length): lengths are summed from the leaves up, and each
    record begins where the earlier ones of its parent, in order of place, end. Roots begin at 0.

    The length of a record with others inside is theirs. Earlier ones are summed in tiles of places, so a
    record that holds very many spreads. Places of one parent's records are unique.
    """
    zero = F.lit(0).cast("long")
    sized: list[DataFrame] = []
    for here in reversed(trees.by_level(records.select("id", "parent", "place", "length"))):
        size = F.col("length")
        if sized:
            inside = sized[-1].groupBy(F.col("parent").alias("_p")).agg(F.sum("size").alias("_inside"))
            here = here.join(inside, F.col("id") == F.col("_p"), "left")
            size = F.when(F.col("_p").isNull(), size).otherwise(F.col("_inside"))
        here = here.select("id", "parent", "place", size.cast("long").alias("size"))
        sized.append(materialize(here, "nested-sizes") if sized else here)
    result, above = None, None
    for here in reversed(sized):
        # Records around which there is none, or that have no place, are not laid out among others.
        among = F.col("parent").isNotNull() & F.col("place").isNotNull()
        placed = iv.running_sum(here.filter(among), ["parent"], "place", "size", "start").select("id", "parent", "size", F.col("start").cast("long").alias("start"))
        placed = placed.unionByName(here.filter(~among).select("id", "parent", "size", zero.alias("start")))
        if above is not None:
            placed = placed.join(above, F.col("parent") == F.col("_u")).withColumn("start", F.col("start") + F.col("_start"))
        placed = placed.select("id", "start", "size")
        if here is not sized[0]:
            placed = materialize(placed, "nested-places")
        above = placed.select(F.col("id").alias("_u"), F.col("start").alias("_start"))
        result = placed if result is None else result.unionByName(placed)
    return result.select("id", "start", (F.col("start") + F.col("size")).alias("end"))
