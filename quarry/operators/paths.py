"""Minimum-cost paths over an edge table (inventory O114, H10).

Single-source shortest paths by frontier relaxation: each round joins only
the nodes whose cost improved last round with their edges, keeps the best
offer per node (``min_by`` on cost, predecessor as tiebreak) and merges it
into the distance table. Rounds stop when nothing improves or at the hop
bound. The distance table is checkpointed to the shared folder every few
rounds so the plan does not grow with the number of rounds and a lost
executor recomputes at most a few rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def undirected(edges: DataFrame, src: str = "src", dst: str = "dst", cost: str = "cost") -> DataFrame:
    """Both directions of every edge (relationships traversed either way)."""
    fwd = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"), F.col(cost).alias("cost"))
    back = edges.select(F.col(dst).alias("src"), F.col(src).alias("dst"), F.col(cost).alias("cost"))
    return fwd.unionByName(back)


def cheapest_paths(edges: DataFrame, source, max_hops: int | None = None, checkpoint_every: int = 3) -> DataFrame:
    """(node, dist, hops, pred) for every node reachable from ``source``.

    ``edges`` is (src, dst, cost) with ``cost >= 0`` (negative costs are
    rejected). ``max_hops`` bounds the path length in edges; by default the
    rounds run until no cost improves, which is the exact answer.
    """
    from quarry.session import ensure_checkpoint_dir

    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    e = (edges.select("src", "dst", F.col("cost").cast("double").alias("cost"))
         .groupBy("src", "dst").agg(F.min("cost").alias("cost")))
    e = e.checkpoint()  # the edges are read every round: made once, kept in the shared folder
    if not e.where(F.col("cost") < 0).isEmpty():
        raise ValueError("edge costs must be non-negative")
    key_type = edges.schema["src"].dataType
    dist = spark.createDataFrame([(source, 0.0, 0, None)],
                                 f"node {key_type.simpleString()}, dist double, hops int, pred {key_type.simpleString()}")
    frontier = dist
    rounds = 0
    while True:
        if max_hops is not None and rounds >= max_hops:
            break
        offers = (frontier.join(e, frontier["node"] == e["src"])
                  .select(F.col("dst").alias("node"), (F.col("dist") + F.col("cost")).alias("dist"),
                          (F.col("hops") + 1).alias("hops"), F.col("src").alias("pred")))
        best = offers.groupBy("node").agg(F.min_by(F.struct("dist", "pred", "hops"),
                                                   F.struct("dist", "pred")).alias("b"))
        best = best.select("node", "b.dist", "b.hops", "b.pred")
        cur = dist.select("node", F.col("dist").alias("old"))
        improved = (best.join(cur, "node", "left")
                    .where(F.col("old").isNull() | (F.col("dist") < F.col("old"))).drop("old"))
        improved = improved.checkpoint(eager=True)
        rounds += 1
        if improved.isEmpty():
            break
        dist = (dist.join(improved.select("node"), "node", "left_anti").unionByName(improved))
        if rounds % checkpoint_every == 0:
            dist = dist.checkpoint(eager=True)
        frontier = improved
    return dist


def path_rows(dist: DataFrame, target) -> DataFrame:
    """(pos, node): the whole path from the source to ``target``, position 0 the source.

    Pointer doubling: each round adds the ancestors twice as far up, so a path
    of any length takes a logarithmic number of joins and stays a table. The
    frame is empty when the target was not reached.
    """
    from quarry.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(dist.sparkSession)
    end = dist.where(F.col("node") == F.lit(target)).select("node", F.lit(0).cast("bigint").alias("back")).checkpoint()
    found = end
    jump = dist.where(F.col("pred").isNotNull()).select(F.col("node").alias("n"), F.col("pred").alias("up"))
    step = 1
    while True:
        more = (found.join(jump, found["node"] == jump["n"])
                .select(F.col("up").alias("node"), (F.col("back") + F.lit(step)).alias("back"))).checkpoint()
        if more.isEmpty():
            break
        found = found.unionByName(more).checkpoint()
        far = jump.select(F.col("n").alias("up"), F.col("up").alias("far"))
        jump = jump.join(far, "up").select("n", F.col("far").alias("up")).checkpoint()
        step *= 2
    length = found.agg(F.max("back")).first()[0]
    return found.select((F.lit(length or 0) - F.col("back")).cast("bigint").alias("pos"), "node")


def path_to(dist: DataFrame, target) -> list:
    """Node list from the source to ``target`` (one path, whole); empty when it was not reached."""
    return [r["node"] for r in path_rows(dist, target).orderBy("pos").collect()]


# ---------------------------------------------------------------- two nodes

#: Up to so many open nodes are sent to the edges, and no edge is moved.
SMALL_FRONTIER = 50_000

class _Side:
    """One direction of a two-sided search: (node, dist, pred, active), kept in the shared folder."""

    def __init__(self, edges: DataFrame, start, node_type: str, salt: int):
        spark = edges.sparkSession
        self.salt = salt
        # a hub's edges lie in ``salt`` places, its one frontier row is copied to each
        self.edges = edges.withColumn("_s", F.pmod(F.xxhash64("dst"), F.lit(salt)).cast("int")).checkpoint()
        self.dist = spark.createDataFrame([(start, 0.0, None, True)],
                                          f"node {node_type}, dist double, pred {node_type}, active boolean")
        self.least, self.n_active, self.expanded = 0.0, 1, 0

    def expand(self, bound: float | None) -> None:
        """One round: every active node nearer than ``bound`` offers its edges; the others can be on no better path."""
        near = F.lit(True) if bound is None else F.col("dist") < F.lit(bound)
        go = self.dist.where(F.col("active") & near).select(F.col("node").alias("src"), F.col("dist").alias("upto"))
        offers = self._offers(go).select(
            F.col("dst").alias("node"), (F.col("upto") + F.col("cost")).alias("offer"), F.col("src").alias("via"))
        best = offers.groupBy("node").agg(F.min(F.struct("offer", "via")).alias("b")).select("node", "b.offer", "b.via")
        better = F.col("offer").isNotNull() & (F.col("dist").isNull() | (F.col("offer") < F.col("dist")))
        self.dist = self.dist.join(best, "node", "full").select(
            "node", F.when(better, F.col("offer")).otherwise(F.col("dist")).alias("dist"),
            F.when(better, F.col("via")).otherwise(F.col("pred")).alias("pred"),
            (better | (F.coalesce("active", F.lit(False)) & ~F.coalesce(near, F.lit(False)))).alias("active")).checkpoint()
        self.measure()

    def _offers(self, go: DataFrame) -> DataFrame:
        if self.n_active <= SMALL_FRONTIER:
            return self.edges.join(F.broadcast(go), "src")
        copies = go.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(self.salt - 1))))
        return copies.join(self.edges, ["src", "_s"])

    def measure(self) -> None:
        r = self.dist.agg(F.min(F.when(F.col("active"), F.col("dist"))).alias("least"),
                          F.count(F.when(F.col("active"), 1)).alias("n"),
                          F.count(F.when(~F.col("active"), 1)).alias("done")).first()
        self.least, self.n_active, self.expanded = r["least"], r["n"], r["done"]


class Route:
    """A cheapest route: ``rows`` (pos, node, cost so far), its ``cost`` (None: not reachable) and the number of
    nodes each side ``expanded``."""

    def __init__(self, rows: DataFrame, cost: float | None, expanded: tuple[int, int]):
        self.rows, self.cost, self.expanded = rows, cost, expanded


def cheapest_route(edges: DataFrame, source, target, salt: int = 8) -> Route:
    """The cheapest path between two nodes by a search from both ends (O114).

    Each round the side with fewer open nodes relaxes their edges, against the
    edge direction on the target's side. A node that both sides have reached
    gives a meeting of known cost; the search stops when the least open cost of
    one side plus that of the other reaches the best meeting, for then every
    path not yet found costs at least as much. Open nodes that alone exceed the
    best meeting less the other side's least cost are not expanded.

    Costs must not be negative. Edges with a null end or cost are no edges.
    ``source`` equal to ``target`` is a path of one node; an unreachable target
    gives no rows. Among paths of equal cost one is returned: the meeting of the
    smallest node, predecessors of least (cost, node). Repeated edges count once, with their least cost.
    """
    from quarry.session import ensure_checkpoint_dir

    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    node_type = edges.schema["src"].dataType.simpleString()
    e = (edges.select("src", "dst", F.col("cost").cast("double").alias("cost")).dropna()
         .where("src <> dst").groupBy("src", "dst").agg(F.min("cost").alias("cost"))).checkpoint()
    if not e.where(F.col("cost") < 0).isEmpty():
        raise ValueError("edge costs must be non-negative")
    there = _Side(e, source, node_type, salt)
    back = _Side(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "cost"), target, node_type, salt)
    best = None
    while there.n_active and back.n_active:
        side, other = (there, back) if there.n_active <= back.n_active else (back, there)
        side.expand(None if best is None else best["total"] - other.least)
        met = there.dist.select("node", "dist").join(back.dist.select("node", F.col("dist").alias("rest")), "node")
        met = met.select((F.col("dist") + F.col("rest")).alias("total"), "node", "dist")
        best = met.agg(F.min(F.struct("total", "node", "dist")).alias("b")).first()["b"]
        if not there.n_active or not back.n_active:
            break  # one side has seen everything it can reach
        if best is not None and there.least + back.least >= best["total"]:
            break
    expanded = (there.expanded, back.expanded)
    if best is None and source == target:
        best = {"total": 0.0, "node": source, "dist": 0.0}
    if best is None:
        return Route(spark.createDataFrame([], f"pos bigint, node {node_type}, cost double"), None, expanded)
    head = path_rows(there.dist, best["node"]).join(there.dist.select("node", F.col("dist").alias("cost")), "node")
    tail = path_rows(back.dist, best["node"]).join(back.dist.select("node", "dist"), "node")
    steps = head.agg(F.max("pos")).first()[0]
    rest = tail.agg(F.max("pos")).first()[0]
    tail = tail.where(F.col("pos") < rest).select(  # the meeting node itself is in the head
        (F.lit(steps + rest) - F.col("pos")).alias("pos"), "node", (F.lit(best["total"]) - F.col("dist")).alias("cost"))
    return Route(head.select("pos", "node", "cost").unionByName(tail), best["total"], expanded)
