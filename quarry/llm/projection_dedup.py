"""Near-duplicate vectors by sorted projection passes (operator 7).

Equal vectors are one node. In each pass a node's key is the concatenation of
63 random hash bits (signs of random projections); nodes are put in
lexicographic order of the keys, all passes in one distributed sort, and each
is compared with the next ``window`` nodes of its pass. Pairs whose cosine
reaches the threshold are verified in double precision on the spot, and their
union over the passes gives the components. A group emits the edges of a
spanning forest, never its pairs.

The number of passes grows with the number of nodes (about its 0.15th power at
the 0.95 threshold), so that an isolated pair at the threshold is missed by all
of them with a probability of at most ``MISS`` where vectors lie evenly spread,
at every size. In a crowded direction (many vectors near each other but under
the threshold) more nodes share a prefix and the miss probability is larger.

A bounded window cannot see every pair of a dense component, so direct links
are then counted exactly: inside each component every two blocks are compared
by matrix product, and only counts leave the task.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are their own component, as are vectors of
another length than most; repeated vec_ids are separate rows that share the
id; columns other than the two named are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._graph import connected_components, deal_pairs_of_blocks, forest
from quarry.llm._shared import materialise
from quarry.llm._vectors import content_key, dimension, matrix, usable
from quarry.operators.tables import serial_number

THRESHOLD = 0.95
#: Fewest passes, and the probability of missing an isolated pair at the threshold that sets their number.
PASSES = 16
MISS = 1e-5
WINDOW = 48
BITS = 63


def passes_for(nodes: int, window: int = WINDOW, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Passes after which a pair at ``threshold`` among ``nodes`` evenly spread keys is missed with at most ``miss``.

    Two vectors at angle a differ in a hash bit with probability a / pi. A pass
    counts as finding them when they agree on the leading bits that leave half
    a window of nodes with their prefix.
    """
    bits = min(max(math.log2(max(2 * nodes / window, 1)), 0.0), BITS)
    found = (1 - math.acos(min(max(threshold, -1.0), 1.0)) / math.pi) ** bits
    return PASSES if found >= 1 else max(PASSES, math.ceil(math.log(miss) / math.log1p(-found)))


def pass_keys(x: np.ndarray, passes: int, seed: int) -> np.ndarray:
    """(rows, passes) non-negative 63-bit keys, most significant bit first."""
    out = np.zeros((len(x), passes), np.int64)
    for p in range(passes):
        plane = np.random.default_rng([seed, p]).normal(size=(x.shape[1], BITS))
        bits = (x @ plane >= 0).astype(np.int64)
        for b in range(BITS):
            out[:, p] = out[:, p] * 2 + bits[:, b]
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _keys(nodes: DataFrame, passes: int, seed: int) -> DataFrame:
    def run(batches):
        for b in batches:
            k = pass_keys(matrix(b.column(1)), passes, seed)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(list(k), pa.list_(pa.int64()))], names=["node", "v", "keys"])

    return nodes.select("node", "v").mapInArrow(run, "node string, v array<double>, keys array<bigint>")


def _window_edges(ranked: DataFrame, threshold: float, window: int, block: int) -> DataFrame:
    """Forest edges of the verified pairs within ``window`` places of one pass.

    Blocks of consecutive places; the first ``window`` rows of a block are
    also sent to the block before.
    """
    place = ranked.withColumn("_b", F.floor(F.col("place") / block).cast("bigint"))
    dealt = place.withColumn("_b", F.explode(F.when(
        (F.pmod("place", F.lit(block)) < window) & (F.col("_b") > 0), F.array("_b", F.col("_b") - 1))
        .otherwise(F.array("_b"))))

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("place")
        x, p = unit(np.stack(pdf["v"].to_numpy())), pdf["pass"].to_numpy()
        at, pairs = pdf["place"].to_numpy(), []
        for d in range(1, min(window, len(x) - 1) + 1):
            cos = np.einsum("ij,ij->i", x[:-d], x[d:])
            i = np.flatnonzero((cos >= threshold) & (p[:-d] == p[d:]) & (at[d:] - at[:-d] <= window))
            pairs += zip(i.tolist(), (i + d).tolist())
        node = pdf["node"].tolist()
        edges = [(node[i], node[j]) for i, j in forest(len(node), pairs)]
        return pd.DataFrame(edges, columns=["a", "b"])

    return dealt.groupBy("_b").applyInPandas(run, "a string, b string")


def _count_links(members: DataFrame, threshold: float) -> DataFrame:
    """node, n: vectors linked to each node inside its component, from blocks of dealt rows."""

    def run(pdf):
        import pandas as pd

        out = []
        pdf = pdf.sort_values(["comp", "_i", "_j", "_o", "node"], kind="stable")
        for _, part in pdf.groupby(["comp", "_i", "_j"], sort=False):
            x, w = unit(np.stack(part["v"].to_numpy())), part["n"].to_numpy()
            first = int((part["_o"] == part["_i"].iloc[0]).sum())
            same = part["_i"].iloc[0] == part["_j"].iloc[0]
            if same:
                hit = x @ x.T >= threshold
                np.fill_diagonal(hit, False)
                links = hit @ w
            else:
                hit = x[:first] @ x[first:].T >= threshold
                links = np.concatenate([hit @ w[first:], hit.T @ w[:first]])
            got = np.flatnonzero(links)
            node = part["node"].tolist()
            out += [(node[i], int(links[i])) for i in got]
        return pd.DataFrame(out, columns=["node", "n"])

    return members.groupBy("_g").applyInPandas(run, "node string, n bigint")


def vector_components(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding",
                      threshold: float = THRESHOLD, passes: int | None = None, window: int = WINDOW, seed: int = 7,
                      block: int = 1024, pair_block: int = 96) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``; ``passes`` None: by the number of nodes."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    good = rows.where(usable("v"))
    size = dimension(good, "v")
    good = good.where(F.size("v") == size).withColumn("node", content_key("v"))
    named = materialise(good, "vectors")
    nodes = named.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("rep"),
                                      F.first("v").alias("v"))
    nodes = materialise(nodes, "vector-nodes")
    if passes is None:
        passes = passes_for(nodes.count(), window, threshold)
    keyed = _keys(nodes, passes, seed).select("node", "v", F.posexplode("keys").alias("pass", "key"))
    ranked = serial_number(keyed, [F.col("pass"), F.col("key"), F.col("node")], "place")
    edges = _window_edges(ranked, threshold, window, block)
    comps = materialise(connected_components(edges), "vector-components")
    members = nodes.join(comps.select(F.col("id").alias("node"), "comp"), "node")
    counted = _count_links(deal_pairs_of_blocks(members, "comp", F.col("node"), pair_block, 512), threshold)
    links = counted.groupBy("node").agg(F.sum("n").alias("links"))
    smallest = members.groupBy("comp").agg(F.min("rep").alias("low"))
    low = members.select("node", "comp").join(smallest, "comp").select("node", "low")
    info = (nodes.select("node", "n", "rep").join(low, "node", "left").join(links, "node", "left")
            .select("node", F.coalesce("low", "rep").alias("low"),
                    (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    linked = named.select("vec_id", "node").join(info, "node").select("vec_id", "n_links", "low")
    rest = rows.where(~(usable("v") & (F.size("v") == size))).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("low"))
    return linked.unionByName(rest).select(
        "vec_id", "n_links", F.col("low").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("low")).alias("kept"))
