import random

import pytest
from pyspark.sql import functions as F

from quarry.operators.placing import pack, place_by_key


@pytest.mark.parametrize("seed", range(5))
def test_packing_is_fair_and_cuts_only_large_keys(seed):
    rng = random.Random(seed)
    counts = {f"k{i}": int(rng.paretovariate(0.8)) for i in range(rng.choice([3, 40, 500]))}
    counts["hot"] = sum(counts.values()) // 2 + 1
    p = rng.choice([1, 4, 16])
    where, load = pack(counts, p)
    share = -(-sum(counts.values()) // p)
    assert set(where) == set(counts) and sum(load) == sum(counts.values())
    assert all(len(where[u]) == 1 for u, n in counts.items() if n <= share)
    assert max(load) <= 2 * share and (p == 1 or len(where["hot"]) > 1)


def place(spark, rows, partitions, **kw):
    df = spark.createDataFrame([(i, k, "clash") for i, k in enumerate(rows)], "id int, k string, unit string").repartition(3)
    placed = place_by_key(df, F.col("k"), partitions, F.col("id"), **kw)
    got = placed.rows.select("id", "k", F.spark_partition_id().alias("p")).collect()
    assert sorted(r.id for r in got) == list(range(len(rows)))
    sizes = [sum(r.p == i for r in got) for i in range(partitions)]
    return placed, got, sizes


def test_hot_key_is_spread_and_others_stay_together(spark):
    rows = ["hot"] * 6000 + [f"k{i % 50}" for i in range(3000)] + [None] * 100
    placed, got, sizes = place(spark, rows, 6)
    at = {}
    for r in got:
        at.setdefault(r.k, set()).add(r.p)
    assert len(at["hot"]) > 1 and placed.cut == 1 and all(len(p) == 1 for k, p in at.items() if k != "hot")
    assert max(sizes) <= 1.3 * len(rows) / 6


def test_more_keys_than_are_counted_one_by_one(spark):
    placed, got, sizes = place(spark, [f"k{i}" for i in range(3000)], 5, most_keys=64)
    at = {}
    for r in got:
        at.setdefault(r.k, set()).add(r.p)
    assert all(len(p) == 1 for p in at.values()) and max(sizes) <= 1.3 * 600


def test_empty_and_single(spark):
    assert place(spark, [], 3)[2] == [0, 0, 0]
    assert place(spark, ["a"], 3)[0].largest == 1
    assert place(spark, ["null", None], 2)[0].largest == 1  # the text null is another key than null
