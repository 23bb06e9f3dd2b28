"""Exact top-k by inner product or cosine for every query row at once
(inventory O108, O109, O113), without scoring every pair.

Items are laid out by norm stratum, nearest pivot and distance to it, and cut
into blocks. A block's summary (centre, widest angle, largest and smallest
norm) bounds from above what any of its items can score with a query
(Cauchy-Schwarz on norms, triangle inequality on angles). Queries are laid out
in the same way, so that those of one block want the same items. A query block
visits item blocks from its best bound down, in rounds of 1, 2, 4, ... blocks;
after each round a query whose k-th best score no remaining block can reach is
closed, and a block that no open query of a query block needs is skipped. The
result is exact: only what a proven bound rules out is not scored.

Everything of the size of a table stays in tables. To the driver come the
pivots (``PIVOTS`` rows) and the block summaries (at most ``MAX_BLOCKS`` rows;
the blocks grow beyond ``BLOCK`` rows when there would be more). Blocks meet in
tiles of neighbouring query blocks by neighbouring item blocks: a round sends a
query block once to each tile it needs, an item block likewise, and a task is
handed at most ``TILE`` bytes of either (one block, if that is more). A pair is
first scored in single precision and compared with the k-th best so far, less
what rounding can amount to; only pairs that pass are scored in double
precision, and only scores that reach that k-th best leave the task.

Where at most half of the vectors of a table differ, equal ones are handled
once: queries of one vector share their list, and of the items of one vector
only the ``k`` smallest ids can be in any list.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.operators.tables import serial_number
from quarry.sources.io import stored

BLOCK = 2048
MAX_BLOCKS = 8192
PIVOTS = 128
GROUP = 8
TILE = 16 << 20
STRATA = 64
#: Bounds are taken this much (relative) more generously than double rounding asks for.
SLACK = 1e-9


class TopK(NamedTuple):
    """``rows``: query, item, score, rank (from 1); ``scored``: one row, the number of pairs that were scored."""

    rows: DataFrame
    scored: DataFrame


def usable(vec: Column, zero: bool) -> Column:
    """Whether a vector takes part: not null or empty, all components finite, and not zero unless ``zero``."""
    ok = vec.isNotNull() & (F.size(vec) > 0) & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x)
                                                        & (F.abs(x) < float("inf")))
    return ok if zero else ok & F.exists(vec, lambda x: x != 0)


def _vectors(df: DataFrame, id_col: str, vec_col: str, zero: bool) -> DataFrame:
    out = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return out.where(F.coalesce(usable(F.col("vec"), zero), F.lit(False)))


def _matrix(column, width: int) -> np.ndarray:
    """A list column of equally long vectors as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != len(column) * width:
        raise ValueError(f"all vectors must have {width} components")
    return flat.reshape(len(column), width)


def _stored_matrix(m: np.ndarray) -> bytes:
    """The bytes of a matrix of doubles, in single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        single = m.astype(np.float32)
    return (single if (single == m).all() else m).tobytes()


def _read_matrix(mat: bytes, rows: int, width: int) -> np.ndarray:
    kind = np.float32 if len(mat) == rows * width * 4 else np.float64
    return np.frombuffer(mat, kind).reshape(rows, width).astype(np.float64)


def _short(m: np.ndarray, size) -> np.ndarray:
    """The rows over ``size`` (0: as they are) in single precision."""
    size = np.broadcast_to(size, len(m))
    return (m / np.where(size > 0, size, 1.0)[:, None]).astype(np.float32)


def _unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.sqrt((m * m).sum(1))
    return m / np.where(n > 0, n, 1.0)[:, None], n


def _chain(pivots: np.ndarray) -> np.ndarray:
    """The pivots in an order in which each is followed by the nearest one left, so that blocks stay narrow."""
    cos = (u := _unit(pivots)[0]) @ u.T
    order, left = [0], np.ones(len(pivots), bool)
    left[0] = False
    while left.any():
        order.append(int(np.where(left, cos[order[-1]], -np.inf).argmax()))
        left[order[-1]] = False
    return pivots[order]


def _placed(df: DataFrame, pivots: np.ndarray, top_norm: float, strata: bool) -> DataFrame:
    """id, vec and where they lie: norm stratum, nearest pivot, cosine to it."""
    id_type = df.schema["id"].dataType.simpleString()
    units = _unit(pivots)[0]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            u, n = _unit(_matrix(b.column(1), pivots.shape[1]))
            cos = u @ units.T
            near = cos.argmax(1)
            level = np.zeros(len(n))
            if strata:
                level = np.log(top_norm / np.maximum(n, top_norm * 1e-12)) / np.log(1.1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.clip(level, 0, STRATA - 1).astype(np.int32)),
                 pa.array(near.astype(np.int32)), pa.array(cos[np.arange(len(n)), near])],
                names=["id", "vec", "stratum", "pivot", "cosine"])

    return df.mapInArrow(run, f"id {id_type}, vec array<double>, stratum int, pivot int, cosine double")


def _blocks(placed: DataFrame, size: int, width: int) -> DataFrame:
    """One row per block of ``size`` rows: ids, matrix and summary."""
    id_type = placed.schema["id"].dataType.simpleString()
    numbered = serial_number(placed, [F.col("stratum"), F.col("pivot"), F.desc("cosine"), F.col("id"),
                                      F.xxhash64("vec")], name="serial")
    cut = numbered.select("id", "vec", "serial", F.floor((F.col("serial") - 1) / F.lit(size)).cast("int").alias("blk"))

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("serial")
        m = _matrix(t.column("vec").combine_chunks(), width)
        u, n = _unit(m)
        centre = u[n > 0].mean(0) if (n > 0).any() else np.zeros(width)
        length = np.sqrt(centre @ centre)
        centre = centre / length if length > 0 else centre
        cos = np.clip(u[n > 0] @ centre, -1, 1)
        widest = float(np.arccos(cos.min())) if length > 0 and len(cos) else float(np.pi)
        ids = pa.array([t.column("id").to_pylist()], pa.list_(t.schema.field("id").type))
        return pa.table({"blk": t.column("blk").slice(0, 1), "ids": ids, "mat": [_stored_matrix(m)], "centre": [centre.tolist()],
                         "widest": [widest], "most": [float(n.max())], "least": [float(n.min())]})

    return cut.groupBy("blk").applyInArrow(
        pack, f"blk int, ids array<{id_type}>, mat binary, centre array<double>, widest double, most double, least double")


class _Bounds:
    """The most any item of each block can score with each query."""

    def __init__(self, summary: pd.DataFrame, cosine: bool):
        self.blk = summary["blk"].to_numpy(np.int32)
        self.centre = np.stack([np.asarray(c, np.float64) for c in summary["centre"]])
        self.widest = summary["widest"].to_numpy(np.float64)
        self.cosine, one = cosine, np.ones(len(self.blk))
        self.most, self.least = (one, one) if cosine else (summary["most"].to_numpy(), summary["least"].to_numpy())

    def __call__(self, u: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Rows: queries of direction ``u`` and norm ``n``; columns: blocks."""
        gap = np.arccos(np.clip(u @ self.centre.T, -1, 1)) - self.widest
        cos = np.cos(np.maximum(gap, 0.0))
        norm = np.where(cos >= 0, self.most, self.least)
        return n[:, None] * (norm * cos + SLACK * self.most)


def top_k(queries: DataFrame, items: DataFrame, k: int, *, cosine: bool = False, exclude_same: bool = False,
          query_id: str = "id", query_vec: str = "features", item_id: str = "id", item_vec: str = "features",
          block: int = BLOCK, max_blocks: int = MAX_BLOCKS) -> TopK:
    """The ``k`` items of largest inner product (or cosine) for every query row; ties go to the smaller item id.

    Scores are in double precision. Vectors that are null, empty, hold null or non-finite components, or (cosine
    only) are zero take no part. Query rows that share an id are ranked each for itself. All vectors must have the
    same length. ``exclude_same`` leaves out the item with the query's own id. Empty tables give no rows.
    """
    spark = items.sparkSession
    q_type, i_type = queries.schema[query_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    same_table = queries is items and query_id == item_id and query_vec == item_vec
    its = stored(_vectors(items, item_id, item_vec, not cosine), "topk-items")
    qs = its if same_table else stored(_vectors(queries, query_id, query_vec, not cosine), "topk-queries")
    if not exclude_same:
        if _repeats(qs):
            return _by_vector(qs, its, k, cosine, block, max_blocks)
        if _repeats(its):
            nth = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
            its = stored(its.withColumn("_nth", nth).where(F.col("_nth") <= k).drop("_nth"), "topk-items")
            same_table = False
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    size = its.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width"), F.max(norm).alias("norm")).first()
    schema = f"query {q_type}, item {i_type}, score double, rank int"
    if not size["n"] or k < 1:
        return TopK(spark.createDataFrame([], schema), spark.createDataFrame([(0,)], "scored bigint"))
    n, width = size["n"], size["width"]
    result = T.StructType([T.StructField("query", queries.schema[query_id].dataType),
                           T.StructField("item", items.schema[item_id].dataType), T.StructField("score", T.DoubleType()),
                           T.StructField("qblk", T.IntegerType()), T.StructField("pos", T.IntegerType()),
                           T.StructField("pairs", T.LongType())])
    pivots = [r["vec"] for r in its.orderBy(F.xxhash64("id", "vec")).limit(PIVOTS).collect()]
    pivots = _chain(np.asarray([p for p in pivots if len(p) == width], np.float64))
    rows = max(block, -(-n // max_blocks))
    blocks = stored(_blocks(_placed(its, pivots, size["norm"] or 1.0, not cosine), rows, width), "topk-blocks")
    summary = blocks.select("blk", "centre", "widest", "most", "least").orderBy("blk").toPandas()
    bounds = _Bounds(summary, cosine)
    shared = spark.sparkContext.broadcast(bounds)  # at most max_blocks rows
    own = blocks if same_table and rows == block else _blocks(_placed(qs, pivots, 1.0, False), block, width)
    own = stored(own.select(F.col("blk").alias("qblk"), "ids", "mat").mapInArrow(
        _ordered(shared, width), f"qblk int, ids array<{q_type}>, mat binary, visit array<int>"), "topk-query-blocks")
    cores = spark.sparkContext.defaultParallelism
    q_tile, i_tile = _tile(own.count(), block, width, cores), _tile(len(bounds.blk), rows, width, cores)
    q_grp, i_grp = F.floor(F.col("qblk") / F.lit(q_tile)).cast("int"), F.floor(F.col("b") / F.lit(i_tile)).cast("int")
    top, scored, lo, step = None, [], 0, 1
    while lo < len(bounds.blk):
        state = own.select("qblk", F.size("ids").alias("rows"), "mat", F.slice("visit", lo + 1, step).alias("visit"))
        if top is None:
            state = state.withColumn("kth", F.lit(None).cast("array<struct<pos:int,score:double>>"))
        else:
            kth = top.where(F.col("rank") == k).groupBy("qblk").agg(F.collect_list(F.struct("pos", "score")).alias("kth"))
            state = state.join(kth, "qblk", "left")  # at most ``block`` entries a row
        plan = stored(state.mapInPandas(_wanted(shared, width, i_tile), "qblk int, igrp int, blks array<int>, open array<binary>, "
                                        "least binary"), "topk-plan")
        left = plan.join(own.select("qblk", F.col("ids").alias("q_ids"), F.col("mat").alias("q_mat")), "qblk")
        left = left.withColumn("grp", q_grp)
        need = plan.select(F.explode("blks").alias("b"), q_grp.alias("g")).distinct()
        right = blocks.select(F.col("blk").alias("b"), "ids", "mat").join(need, "b").withColumn("i", i_grp)
        found = left.groupBy("igrp", "grp").cogroup(right.groupBy("i", "g")).applyInArrow(
            _scored(k, width, cosine, exclude_same, to_arrow_schema(result)), result)
        found = stored(found, "topk-found")
        scored.append(found.agg(F.sum("pairs").alias("pairs")))
        new = found.where("pairs IS NULL").select("query", "item", "score", "qblk", "pos")
        every = new if top is None else new.unionByName(top.drop("rank"))
        w = Window.partitionBy("qblk", "pos").orderBy(F.desc("score"), F.asc("item"))
        top = stored(every.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k), "topk-best")
        lo, step = lo + step, step * 2
    total = scored[0]
    for s in scored[1:]:
        total = total.unionAll(s)
    return TopK(top.select("query", "item", "score", "rank"),
                total.agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("bigint").alias("scored")))


def _tile(blocks: int, rows: int, width: int, cores: int) -> int:
    """Blocks along a side of a tile: at most ``TILE`` bytes, and few enough for several tiles a core."""
    return max(1, min(TILE // (rows * width * 8), int(blocks / (2 * np.sqrt(cores)))))


def _repeats(vectors: DataFrame) -> bool:
    """Whether at most about half of the vectors differ; only what is faster depends on it, not what comes out."""
    r = vectors.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("vec")).alias("d")).first()
    return 0 < r["d"] * 2 <= r["n"]


def _by_vector(qs: DataFrame, its: DataFrame, k: int, cosine: bool, block: int, max_blocks: int) -> TopK:
    """``top_k`` of every different query vector, its list given to each row that has the vector."""
    numbered = stored(serial_number(qs.select("vec").distinct(), [F.col("vec")], name="id"), "topk-distinct")
    top = top_k(numbered, its, k, cosine=cosine, query_vec="vec", item_vec="vec", block=block, max_blocks=max_blocks)
    one = F.struct(F.col("item"), "score", "rank")
    lists = top.rows.groupBy("query").agg(F.collect_list(one).alias("best"))  # k entries a row
    lists = stored(lists.join(numbered, lists["query"] == numbered["id"]).select("vec", "best"), "topk-lists")
    rows = qs.join(lists, "vec").select(F.col("id").alias("query"), F.explode("best").alias("b")).select("query", "b.*")
    return TopK(rows, top.scored)


def _ordered(shared, width: int):
    """Adds the order in which a query block visits item blocks; it is stored, so every round sees the same one."""

    def run(batches):
        for b in batches:
            visit = []
            for ids, mat in zip(b.column(1), b.column(2)):
                u = _unit(_read_matrix(mat.as_py(), len(ids), width))[0]
                total = np.zeros(len(shared.value.blk))
                for at in range(0, len(u), 256):
                    total += shared.value(u[at:at + 256], np.ones(len(u[at:at + 256]))).sum(0)
                visit.append(shared.value.blk[np.argsort(-total, kind="stable")].tolist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(visit, pa.list_(pa.int32()))],
                                             names=["qblk", "ids", "mat", "visit"])

    return run


def _wanted(shared, width: int, tile: int):
    """(qblk, igrp, blks, open, least): the next item blocks that a query block still needs, by tiles; for each of them
    a bit per query that does, and the score that an item must reach for each query."""

    def run(frames):
        for pdf in frames:
            out: list[tuple] = []
            for qblk, rows, mat, visit, kth in zip(pdf["qblk"], pdf["rows"], pdf["mat"], pdf["visit"], pdf["kth"]):
                u, n = _unit(_read_matrix(mat, rows, width))
                if shared.value.cosine:
                    n = np.ones(len(n))
                least = np.full(len(u), -np.inf)
                for e in (kth if kth is not None else ()):
                    least[e["pos"]] = e["score"]
                at = np.searchsorted(shared.value.blk, np.asarray(visit, np.int32))
                need = np.concatenate([shared.value(u[i:i + 256], n[i:i + 256])[:, at] >= least[i:i + 256, None]
                                       for i in range(0, len(u), 256)])
                tiles: dict = {}
                for j, b in enumerate(visit):
                    if need[:, j].any():
                        tiles.setdefault(int(b) // tile, []).append((int(b), np.packbits(need[:, j]).tobytes()))
                out += [(int(qblk), t, [b for b, _ in x], [o for _, o in x], least.tobytes()) for t, x in tiles.items()]
            yield pd.DataFrame(out, columns=["qblk", "igrp", "blks", "open", "least"])

    return run


def _scored(k: int, width: int, cosine: bool, exclude_same: bool, schema: pa.Schema):
    """Of one tile, every score that can be among a query's best ``k``, and one row with the number of pairs scored."""
    # twice the most by which sums of ``width`` products in single precision, of rounded numbers, miss those of unit vectors
    slack = (width + 8) * 2.0 ** -22

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        at_item, pairs, cols = {b: i for i, b in enumerate(right.column("b").to_pylist())}, 0, [[] for _ in range(5)]
        items: dict = {}
        # written again by every strip: fresh memory for each would take longer than the products
        strip = 256 * max((len(ids) for ids in right.column("ids")), default=0)
        room, passed = np.empty(strip, np.float32), np.empty(strip, bool)

        def item_block(b):
            if b not in items:
                ids = right.column("ids")[at_item[b]].as_py()
                order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i]))  # ties: the smaller id, null first
                x = _read_matrix(right.column("mat")[at_item[b]].as_py(), len(ids), width)[order]
                ids = [ids[i] for i in order]
                where: dict = {}
                for i, v in enumerate(ids if exclude_same else ()):
                    where.setdefault(v, []).append(i)
                x_norm = np.sqrt((x * x).sum(1))
                # for the first look: in single precision, unit vectors or (inner product) at most as long
                size = x_norm if cosine else x_norm.max()
                items[b] = ids, where, x, x_norm, size, np.ascontiguousarray(_short(x, size).T)
            return items[b]

        for qblk, blks, opens, least, q_ids, mat in zip(*(left.column(c) for c in ("qblk", "blks", "open", "least", "q_ids", "q_mat"))):
            qblk, q_ids, least = qblk.as_py(), q_ids.as_py(), np.frombuffer(least.as_py())
            m = _read_matrix(mat.as_py(), len(q_ids), width)
            m_norm = np.sqrt((m * m).sum(1))
            short = _short(m, m_norm)
            places, names, points = [], [], []
            for b, bits in zip(blks.as_py(), opens.as_py()):
                ids, where, x, x_norm, size, x_short = item_block(b)
                open_ = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8))[:len(m)])
                pairs += len(open_) * len(x)
                with np.errstate(over="ignore"):
                    need = least if cosine else least / np.where(m_norm > 0, m_norm, 1.0) / (size if size > 0 else 1.0)
                c = min(k, len(x))
                for at in range(0, len(open_), 256):
                    pos = open_[at:at + 256]
                    rough = room[:len(pos) * len(x)].reshape(len(pos), len(x))
                    np.matmul(short[pos], x_short, out=rough)
                    if exclude_same:
                        for r, p in enumerate(pos):
                            rough[r, where.get(q_ids[p], [])] = -np.inf
                    edge = need[pos]
                    new = np.flatnonzero(edge == -np.inf)  # fewer than k items so far: this block's own k-th score
                    if len(new):
                        edge[new] = np.partition(rough[new], len(x) - c, 1)[:, len(x) - c]
                    # rounded down, so that no item is lost that the margin would keep
                    edge = np.nextafter((edge - slack).astype(np.float32), np.float32(-np.inf))
                    hit = passed[:rough.size].reshape(rough.shape)
                    hit = np.flatnonzero(np.greater_equal(rough, edge[:, None], out=hit).ravel())
                    if not len(hit):
                        continue
                    row, col = np.divmod(hit, len(x))
                    real = rough[row, col] > -np.inf
                    row, col = row[real], col[real]
                    q, q_norm = m[pos], m_norm[pos]
                    # the score itself: sums in an order that does not depend on where a vector stands
                    score = np.concatenate([(q[row[i:i + 16384]] * x[col[i:i + 16384]]).sum(1)
                                            for i in range(0, len(row), 16384)] or [np.empty(0)])
                    if cosine:
                        score /= q_norm[row] * x_norm[col]
                    best = np.lexsort((col, -score, row))
                    row, col, score = row[best], col[best], score[best]
                    keep = (np.arange(len(row)) - np.searchsorted(row, row) < k) & (score >= least[pos[row]])
                    places.append(pos[row[keep]])
                    points.append(score[keep])
                    names += [ids[c] for c in col[keep].tolist()]
            if not places:
                continue
            place, score = np.concatenate(places), np.concatenate(points)
            # over the blocks of the tile: no score below a query's k-th one; equal ones all stay
            best = np.lexsort((-score, place))
            first = np.searchsorted(place[best], place[best])
            last = np.minimum(first + k, np.searchsorted(place[best], place[best], "right")) - 1
            for i in best[score[best] >= score[best][last]].tolist():
                for c, v in zip(cols, (q_ids[place[i]], names[i], score[i], qblk, int(place[i]))):
                    c.append(v)
        for c in cols:
            c.append(None)
        counts = [None] * (len(cols[0]) - 1) + [pairs]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip([*cols, counts], schema)], schema=schema)

    return run


# ---------------------------------------------------------------- all pairs above a threshold

def pairs_above(vectors: DataFrame, tau: float, id_col: str = "id", vec_col: str = "features", block: int = 1024,
                max_blocks: int = MAX_BLOCKS, eps: float = 1e-9) -> DataFrame:
    """(a, b, score): every pair of rows with ``a < b`` and cosine at least ``tau`` (O82 on small alphabets).

    Rows are blocked as in ``top_k``; two blocks meet only if the angle between
    their centres, less the width of both, can be within the threshold's. Pairs
    are compared by matrix products, block against block, so the pairs below
    the threshold are never rows. Vectors that take no part, ids that repeat
    and empty tables as in ``top_k``; rows of one id make no pair.
    """
    if not 0.0 < tau <= 1.0:
        raise ValueError("tau must be in (0, 1]")
    kind = vectors.schema[id_col].dataType
    its = stored(_vectors(vectors, id_col, vec_col, False), "pairs-rows")
    size = its.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width")).first()
    result = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("score", T.DoubleType())])
    if not size["n"]:
        return its.sparkSession.createDataFrame([], result)
    width = size["width"]
    pivots = [r["vec"] for r in its.orderBy(F.xxhash64("id", "vec")).limit(PIVOTS).collect()]
    pivots = _chain(np.asarray([p for p in pivots if len(p) == width], np.float64))
    blocks = stored(_blocks(_placed(its, pivots, 1.0, False), max(block, -(-size["n"] // max_blocks)), width), "pairs-blocks")
    summary = blocks.select("blk", "centre", "widest", "most", "least").orderBy("blk").toPandas()
    shared = its.sparkSession.sparkContext.broadcast(_Bounds(summary, True))  # at most max_blocks rows

    def near(frames):
        for pdf in frames:
            out: list[tuple] = []
            for blk in pdf["blk"]:
                s = shared.value
                i = int(np.searchsorted(s.blk, blk))
                gap = np.arccos(np.clip(s.centre @ s.centre[i], -1, 1)) - s.widest - s.widest[i]
                want = (np.cos(np.maximum(gap, 0.0)) >= tau - 2 * SLACK) & (s.blk >= blk)
                out += [(int(blk), int(b)) for b in s.blk[want]]
            yield pd.DataFrame(out, columns=["qblk", "blk"])

    plan = stored(blocks.select("blk").mapInPandas(near, "qblk int, blk int"), "pairs-plan")
    group = F.floor(F.col("qblk") / F.lit(GROUP)).cast("int")
    left = plan.join(blocks.select(F.col("blk").alias("qblk"), F.col("ids").alias("q_ids"), F.col("mat").alias("q_mat")), "qblk")
    need = plan.select(F.col("blk").alias("b"), group.alias("g")).distinct()
    right = blocks.select(F.col("blk").alias("b"), "ids", "mat").join(need, "b")
    schema = to_arrow_schema(result)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if right.num_rows:
            ids, b_blk = right.column("ids")[0].as_py(), right.column("b")[0].as_py()
            x = _read_matrix(right.column("mat")[0].as_py(), len(ids), width)
            x_norm = np.sqrt((x * x).sum(1))
            for qblk, q_ids, mat in zip(*(left.column(c) for c in ("qblk", "q_ids", "q_mat"))):
                q_ids = q_ids.as_py()
                q = _read_matrix(mat.as_py(), len(q_ids), width)
                q_norm = np.sqrt((q * q).sum(1))
                for at in range(0, len(q), 256):
                    cos = (q[at:at + 256] @ x.T) / (q_norm[at:at + 256, None] * x_norm[None, :])
                    row, col = np.nonzero(cos >= tau - eps)
                    row = row + at
                    if qblk.as_py() == b_blk:
                        row, col = row[row < col], col[row < col]
                    score = (q[row] * x[col]).sum(1) / (q_norm[row] * x_norm[col])
                    out += [(*sorted((q_ids[r], ids[c])), s) for r, c, s in zip(row.tolist(), col.tolist(), score.tolist())
                            if s >= tau - eps and q_ids[r] is not None and ids[c] is not None and q_ids[r] != ids[c]]
        return pa.Table.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return left.groupBy("blk", group).cogroup(right.groupBy("b", "g")).applyInArrow(compare, result)
