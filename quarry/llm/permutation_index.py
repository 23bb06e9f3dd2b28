"""Nearest neighbours by a permutation index (operator 5).

A bounded sample of vectors serves as pivots. Every vector is represented by
the order of its nearest pivots and is posted, with the place the pivot has in
that order, in the inverted file of each of its first pivots. A query reads
the files of its own first pivots, adds up the footrule distance to every
vector posted there (an absent pivot counts as the place after the last), and
the nearest permutations are reranked by the exact inner product.

Permutations follow angles, the answer follows inner products, which also grow
with a vector's length. So every entry gets one more component that fills it up
to the greatest norm, and a query gets a zero there: among vectors of equal
norm the nearest in angle has the largest inner product, and the inner products
are those of the original vectors.

The rows are indexed in blocks; each block of queries meets each block of the
index, and the best of every pair of blocks are merged. Equal vectors are one
entry that carries its smallest ids, so a hot vector cannot crowd out others.

Bounds (documented parameters): ``pivots`` pivots, ``order`` places kept,
``share`` of a block reranked (at least ``least`` entries). All rows are indexed, all
rows whose id is divisible by ``every`` are queries.

Defined cases: vectors that are null, empty, zero, hold null or non-finite
components or have another length than most take no part; with fewer
candidates than ``k`` all are returned; ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._shared import id_hash, materialise
from quarry.llm._vectors import content_key, dimension, matrix, usable

K = 20


def orders(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each row (largest cosine first)."""
    near = -(x @ pivots.T)
    part = np.argpartition(near, length - 1, axis=1)[:, :length] if length < len(pivots) else np.tile(
        np.arange(len(pivots)), (len(x), 1))
    return np.take_along_axis(part, np.argsort(np.take_along_axis(near, part, 1), axis=1, kind="stable"), 1)


def filled(x: np.ndarray, top_norm: float) -> np.ndarray:
    """The rows with one more component that brings each to the norm ``top_norm``, as unit vectors."""
    x = x / max(top_norm, 1e-300)
    return np.c_[x, np.sqrt(np.maximum(1.0 - (x * x).sum(1), 0.0))]


class InvertedFiles:
    """Posting lists (entry, place) per pivot of one block of vectors."""

    def __init__(self, order: np.ndarray, pivots: int):
        n, m = order.shape
        flat = order.ravel()
        by = np.argsort(flat, kind="stable")
        self.entry, self.place = by // m, by % m
        self.start = np.searchsorted(flat[by], np.arange(pivots + 1))
        self.n, self.m = n, m

    def footrule(self, q: np.ndarray) -> np.ndarray:
        """Footrule distance of a query's order to all entries; absent pivots count as place m."""
        gain = np.zeros(self.n)
        for place, p in enumerate(q):
            a, z = self.start[p], self.start[p + 1]
            # against an absent pivot: |place - m| for the query and |other - m| for the entry
            gain[self.entry[a:z]] += (self.m - place) + (self.m - self.place[a:z]) - np.abs(place - self.place[a:z])
        return self.m * (self.m + 1) - gain


def best_of_block(qv: np.ndarray, qo: np.ndarray, xv: np.ndarray, xo: np.ndarray, pivots: int, take: int, k: int):
    """Per query: entries of the block with the largest inner products among the nearest permutations."""
    files = InvertedFiles(xo, pivots)
    for v, o in zip(qv, qo):
        d = files.footrule(o)
        near = np.argpartition(d, take - 1)[:take] if take < len(d) else np.arange(len(d))
        s = np.einsum("ij,j->i", xv[near], v)
        best = np.argsort(-s, kind="stable")
        if len(best) > k:  # keep every entry that ties with the k-th
            best = best[s[best] >= s[best[k - 1]]]
        yield near[best], s[best]


def search(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = K,
           pivots: int = 512, order: int = 64, share: float = 0.2, least: int = 512, block: int = 8192,
           seed: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable("v"))
    size = dimension(rows, "v")
    rows = materialise(rows.where(F.size("v") == size).withColumn("node", content_key("v")), "index-rows")
    # of one vector's copies only the k + 1 smallest ids can be in an answer
    nth = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    copies = rows.select("node", "vec_id").withColumn("_r", nth).where(F.col("_r") <= k + 1).drop("_r")
    entries = rows.groupBy("node").agg(F.first("v").alias("v"))
    chosen = entries.orderBy(id_hash("node", seed), "node").limit(pivots).collect()  # at most ``pivots`` rows
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    top_norm = np.sqrt(rows.agg(F.max(squares)).first()[0] or 1.0)
    p = filled(np.asarray([r["v"] for r in chosen], np.float64).reshape(len(chosen), size), top_norm)
    length = min(order, len(p))

    def permute(as_query: bool):
        def run(batches):
            for b in batches:
                x = matrix(b.column(1))
                if not len(x):
                    continue
                x = np.c_[x, np.zeros(len(x))] if as_query else filled(x, top_norm)
                o = pa.array(list(orders(x, p, length).astype(np.int32)), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), o], names=["node", "v", "o"])
        return run

    schema = "node string, v array<double>, o array<int>"
    index = materialise(entries.select("node", "v").mapInArrow(permute(False), schema), "permutations")
    n_blocks = max(1, -(-index.count() // block))
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "node")
    q_nodes = index.join(asked.select("node").distinct(), "node", "left_semi").select("node", "v")
    q_nodes = materialise(q_nodes.mapInArrow(permute(True), schema), "query-permutations")
    q_blocks = max(1, -(-q_nodes.count() // 1024))
    of = lambda n, s: F.pmod(F.xxhash64(F.lit(s), "node"), F.lit(n)).cast("int")
    grid = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    q_side = q_nodes.withColumn("_q", of(q_blocks, 21)).withColumn("_x", grid).withColumn("side", F.lit(0))
    other = F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))
    x_side = index.withColumn("_q", other).withColumn("_x", of(n_blocks, 22)).withColumn("side", F.lit(1))

    def meet(pdf):
        import pandas as pd

        q, x = pdf[pdf["side"] == 0].sort_values("node"), pdf[pdf["side"] == 1].sort_values("node")
        out = []
        if len(q) and len(x):
            take = min(len(x), max(least, int(share * len(x))))
            names = x["node"].to_numpy()
            stack = lambda c, t: np.stack(c.to_numpy()).astype(t)
            found = best_of_block(stack(q["v"], float), stack(q["o"], int), stack(x["v"], float), stack(x["o"], int),
                                  len(p), take, k + 1)
            out = [(a, b, float(s)) for a, (i, t) in zip(q["node"], found) for b, s in zip(names[i], t)]
        return pd.DataFrame(out, columns=["q", "node", "score"])

    pairs = q_side.unionByName(x_side).groupBy("_q", "_x").applyInPandas(meet, "q string, node string, score double")
    # k + 1 entries, ties included: the query's own vector may be one of them
    top = F.rank().over(Window.partitionBy("q").orderBy(F.desc("score")))
    pairs = pairs.withColumn("_r", top).where(F.col("_r") <= k + 1).drop("_r")
    found = (asked.select(F.col("vec_id").alias("query_id"), F.col("node").alias("q")).join(pairs, "q")
             .join(copies, "node").where("vec_id <> query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score")
            .where(F.col("rank") <= k))
