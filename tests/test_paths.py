import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import paths as P


def test_cheapest_paths(spark):
    e = spark.createDataFrame([("a", "b", 10.0), ("a", "c", 1.0), ("c", "d", 1.0), ("d", "b", 1.0),
                               ("e", "a", 0.0), ("x", "y", 1.0)], "src string, dst string, cost double")
    d = P.cheapest_paths(P.undirected(e), "a")
    got = {r.node: (r.dist, r.hops) for r in d.collect()}
    # two routes to b: the longer one is cheaper; e is reached over a reversed zero-cost edge
    assert got == {"a": (0.0, 0), "c": (1.0, 1), "d": (2.0, 2), "b": (3.0, 3), "e": (0.0, 1)}
    assert P.path_to(d, "b") == ["a", "c", "d", "b"]
    assert "y" not in got
    bounded = {r.node: r.dist for r in P.cheapest_paths(P.undirected(e), "a", max_hops=1).collect()}
    assert bounded["b"] == 10.0


def test_negative_cost_rejected(spark):
    e = spark.createDataFrame([("a", "b", -1.0)], "src string, dst string, cost double")
    with pytest.raises(ValueError):
        P.cheapest_paths(e, "a")


def test_long_path_comes_whole(spark):
    n = 70
    d = spark.createDataFrame([(i, float(i), i, i - 1 if i else None) for i in range(n + 1)],
                              "node int, dist double, hops int, pred int")
    assert P.path_to(d, n) == list(range(n + 1))
    assert P.path_to(d, 999) == [] and P.path_to(d, 0) == [0]


def _dijkstra(edges, source):
    import heapq

    out, heap, dist = {}, [(0.0, source)], {}
    for a, b, c in edges:
        out.setdefault(a, []).append((b, c))
    while heap:
        d, x = heapq.heappop(heap)
        if x in dist:
            continue
        dist[x] = d
        for y, c in out.get(x, ()):
            heapq.heappush(heap, (d + c, y))
    return dist


def _check_route(route, edges, source, target, want):
    rows = sorted((r.pos, r.node, r.cost) for r in route.rows.collect())
    assert [r[0] for r in rows] == list(range(len(rows)))
    assert rows[0][1:] == (source, 0.0) and rows[-1][1] == target and abs(rows[-1][2] - want) < 1e-9
    cost = {}
    for a, b, c in edges:
        cost[a, b] = min(c, cost.get((a, b), c))
    for (_, a, ca), (_, b, cb) in zip(rows, rows[1:]):
        assert abs(cb - ca - cost[a, b]) < 1e-9


@pytest.mark.parametrize("seed", [1, 2])
def test_route_between_two_nodes_equals_dijkstra(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60), float(rng.choice([0, 1, 2, 5, 9, 30]))) for _ in range(200)]
    edges += [(7, x, 50.0) for x in range(60)]  # a hub
    df = spark.createDataFrame(edges, "src int, dst int, cost double")
    dist = _dijkstra(edges, 3)
    for target in (59, 20):
        route = P.cheapest_route(df, 3, target)
        assert (target in dist) == (route.cost is not None)
        if target in dist:
            assert abs(route.cost - dist[target]) < 1e-9
            _check_route(route, edges, 3, target, dist[target])


def test_route_expands_less_than_one_sided_search(spark):
    edges = [(0, 1, 1.0), (1, 2, 1.0)] + [(2, 100 + i, 5.0) for i in range(200)] + [(0, 500 + i, 1.5) for i in range(200)]
    edges += [(500 + i, 900 + i, 1.5) for i in range(200)]
    both = P.undirected(spark.createDataFrame(edges, "src int, dst int, cost double"))
    route = P.cheapest_route(both, 0, 2)
    assert [(r.pos, r.node, r.cost) for r in route.rows.orderBy("pos").collect()] == [(0, 0, 0.0), (1, 1, 1.0), (2, 2, 2.0)]
    assert sum(route.expanded) < 10


def test_route_edge_cases(spark):
    df = spark.createDataFrame([(1, 2, 1.0), (2, 1, 4.0), (3, 4, 1.0), (None, 2, 1.0), (1, 4, None), (1, 1, 0.0)],
                               "src int, dst int, cost double")
    assert P.cheapest_route(df, 1, 4).rows.collect() == [] and P.cheapest_route(df, 1, 4).cost is None
    assert [tuple(r) for r in P.cheapest_route(df, 2, 2).rows.collect()] == [(0, 2, 0.0)]
    assert P.cheapest_route(df, 2, 1).cost == 4.0
    assert P.cheapest_route(df.limit(0), 1, 2).rows.collect() == []
    with pytest.raises(ValueError):
        P.cheapest_route(spark.createDataFrame([(1, 2, -1.0)], "src int, dst int, cost double"), 1, 2)


def test_a_small_frontier_does_not_move_the_edges(spark, monkeypatch):
    """All edges used to be shuffled and sorted in every round, however few nodes were open."""
    df = spark.createDataFrame([(i, (i + j + 1) % 9, float(j + 1)) for i in range(9) for j in range(3)],
                               "src int, dst int, cost double")
    side = P._Side(df, 0, "int", 8)
    go = side.dist.where("active").select(F.col("node").alias("src"), F.col("dist").alias("upto"))
    assert "hashpartitioning" not in side._offers(go)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(P, "SMALL_FRONTIER", 0)
    far = side._offers(go).select("src", "dst", "cost", "upto").collect()
    monkeypatch.undo()
    assert sorted(far) == sorted(side._offers(go).select("src", "dst", "cost", "upto").collect()) and len(far) == 3
