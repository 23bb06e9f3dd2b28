import collections
import random

import pytest

from quarry.operators import heavy as H


def frame(spark, values, parts=6):
    return spark.createDataFrame([(v, 1) for v in values], "word string, count int").repartition(parts)


def brute(values, n):
    return sorted(collections.Counter(values).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:n]


def check(spark, values, n, **kw):
    t = H.top_values_exact(frame(spark, values), "word", n, **kw)
    assert [tuple(r) for r in t.rows.collect()] == brute(values, n)
    return t


def test_skewed_values_are_proven_by_their_bounds(spark):
    rng = random.Random(2)
    values = [f"w{int(rng.paretovariate(0.9)) % 5000}" for _ in range(20000)] + ["hot"] * 9000 + [None] * 4000
    t = check(spark, values, 10, capacity=300)
    assert t.proof == "bound" and t.rounds == 1


def test_a_failed_bound_is_tried_again_with_more_counters(spark):
    rng = random.Random(3)
    values = [f"w{rng.randrange(400)}" for _ in range(6000)] + ["a"] * 60
    t = check(spark, values, 5, capacity=16)
    assert t.proof == "bound" and t.rounds > 1


def test_flat_values_are_counted_in_full(spark):
    values = [f"w{i % 900}" for i in range(1800)]
    t = check(spark, values, 4, capacity=8, most=100)
    assert t.proof == "full count"


def test_edge_cases(spark):
    assert check(spark, [], 3).rows.collect() == []
    check(spark, [None, None, ""], 5)
    check(spark, ["x"] * 10, 1)
    check(spark, ["é" * 100_000, "y", "y"], 2)


@pytest.mark.parametrize("capacity", [1, 3, 50])
def test_summary_bounds_hold(spark, capacity):
    rng = random.Random(capacity)
    values = [f"w{int(rng.paretovariate(1)) % 60}" for _ in range(3000)]
    rows = H.summaries(frame(spark, values), "word", capacity).collect()
    error = sum(r["error"] for r in rows if r["error"] is not None)
    low = collections.Counter()
    for r in rows:
        if r["error"] is None:
            low[r["value"]] += r["count"]
    for v, c in collections.Counter(values).items():
        assert low[v] <= c <= low[v] + error
