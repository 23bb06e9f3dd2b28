"""One key holding a third of the rows: results stay right and the hot key
does not land in one task where the operator can split it."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import tables as T


def _skewed(spark, n=30000):
    # key 0 holds a third of the rows; the rest are spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id").alias("v"))


def test_serial_number_splits_hot_value(spark):
    df = _skewed(spark)
    order = [F.col("k").asc(), F.col("v").asc()]
    ranged = T._ranged(df, order, 8)
    sizes = [r["c"] for r in ranged.groupBy(F.shiftright("_mid", 33).alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()]
    assert max(sizes) < 0.25 * df.count()  # the hot value is cut by the tiebreak
    ours = {(r.v, r.serial) for r in T.serial_number(df, order, partitions=8).collect()}
    ref = {(r.v, r.rn) for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert ours == ref


def test_keep_last_and_top_k_with_hot_key(spark):
    df = _skewed(spark).repartition(6)
    last = {r.k: r.v for r in T.keep_last(df, ["k"], ["v"]).collect()}
    assert last[0] == 29997 and len(last) == 1001
    top = T.top_per_group(df, "k", [F.desc("v")], 3).where("k = 0").collect()
    assert sorted(r.v for r in top) == [29991, 29994, 29997]
    plan = T.top_per_group(df, "k", [F.desc("v")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_salted_range_join_matches_unsalted(spark):
    pts = spark.range(3000).select(F.col("id").alias("pid"),
                                   F.concat(F.lit("10.0.0."), (F.col("id") % 3).cast("string")).alias("ip"))
    groups = spark.createDataFrame([(1, ["10.0.0.0-10.0.0.1"]), (2, ["10.0.0.1-10.0.0.2"])], "g int, ips array<string>")
    a = {(r.pid, r.g) for r in T.range_membership_join(pts, groups, "ip", "ips", ["g"]).collect()}
    b = {(r.pid, r.g) for r in T.range_membership_join(pts, groups, "ip", "ips", ["g"], salt_buckets=8).collect()}
    assert a == b and len(a) == 4000
