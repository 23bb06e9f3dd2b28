"""Connected components and blocked comparison inside components, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import materialise


def _joined(edges: DataFrame, low: DataFrame, salt: int) -> DataFrame:
    """Each edge (u, v) with the smallest neighbour m of u; a hub's edges meet in ``salt`` tasks, not one.

    Always a shuffled join: the planner does not count the ``salt`` copies of a row, and would
    have the driver build a broadcast of ``salt`` times the size that it allows.
    """
    spread = edges.withColumn("_s", F.pmod(F.xxhash64(F.lit(13), "v"), F.lit(salt)).cast("int"))
    copies = low.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return spread.join(copies.hint("merge"), ["u", "_s"]).drop("_s")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", salt: int = 16) -> DataFrame:
    """(id, comp): the smallest id that links reach, for every id in ``edges``.

    Alternating large-star and small-star steps: each step sends a node's
    neighbours to the smallest id it sees. A node's neighbours are never
    gathered: the smallest one is an aggregate with a partial step and is
    joined back, a hub's edges spread over ``salt`` tasks. Every round is written to
    the shared folder; the loop ends when a round changes no edge, after a
    logarithmic number of rounds.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = materialise(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _joined(both, low, salt).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _joined(large, small_low, salt)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(small_low.select("u", F.col("m").alias("v"))).distinct())
        e = materialise(small, "edges")
        got = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
                    F.max("v").alias("x")).first()
        if not got["n"] or mark == tuple(got):
            break
        mark = tuple(got)
    return (e.select(F.col("u").alias("id"), F.col("v").alias("comp"))
            .union(e.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct()))


def deal_pairs_of_blocks(members: DataFrame, comp: str, item: Column, block: int, pack: int) -> DataFrame:
    """Rows of ``members`` dealt so that any two of one component meet in exactly one group.

    A component of at most ``block`` rows stays in one group; small components
    are dealt into groups of about ``pack`` rows. A larger one is cut into
    blocks by ``item``'s hash and each pair of blocks is a group, so no task
    ever holds more than two blocks of it. Adds ``_g`` (group), ``_i`` and
    ``_j`` (the blocks compared) and ``_o`` (the row's own block).
    """
    sizes = members.groupBy(comp).agg(F.count(F.lit(1)).alias("_n"))
    total = members.count()
    packs = max(1, -(-total // pack))
    m = members.join(sizes, comp).withColumn("_b", F.ceil(F.col("_n") / F.lit(block)).cast("int"))
    m = m.withColumn("_o", F.when(F.col("_b") > 1, F.pmod(F.xxhash64(F.lit(3), item), F.col("_b")).cast("int"))
                     .otherwise(0))
    m = m.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_b") - 1)))
    i, j = F.least("_o", "_other"), F.greatest("_o", "_other")
    g = F.when(F.col("_b") > 1, F.xxhash64(F.lit(5), F.col(comp), i, j)).otherwise(
        F.pmod(F.xxhash64(F.lit(7), F.col(comp)), F.lit(packs)))
    return m.withColumn("_g", g).withColumn("_i", i).withColumn("_j", j).drop("_n", "_b", "_other")


def forest(n: int, pairs) -> list[tuple[int, int]]:
    """The pairs that join two trees, at most n - 1 (union-find on small integers)."""
    parent = list(range(n))
    out = []
    for x, y in pairs:
        rx, ry = x, y
        while parent[rx] != rx:
            parent[rx] = parent[parent[rx]]
            rx = parent[rx]
        while parent[ry] != ry:
            parent[ry] = parent[parent[ry]]
            ry = parent[ry]
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out
