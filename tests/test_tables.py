import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import tables as T


def test_keep_last_by_order_and_null_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), (None, 5, "n1"), (None, 7, "n2"), ("b", 1, "w")],
        "k string, ts int, v string")
    out = {(r.k, r.v) for r in T.keep_last(df, ["k"], ["ts"]).collect()}
    assert out == {("a", "y"), (None, "n2"), ("b", "w")}
    first = {(r.k, r.v) for r in T.keep_first(df, ["k"], ["ts"]).collect()}
    assert first == {("a", "x"), (None, "n1"), ("b", "w")}


def test_serial_number_equals_single_partition_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice([None, *range(40)]), f"k{i:04d}") for i in range(1000)]
    df = spark.createDataFrame(rows, "v int, k string").repartition(5)
    order = [F.col("v").asc_nulls_first(), F.col("k").asc()]
    ours = {(r.k, r.serial) for r in T.serial_number(df, order, partitions=4).collect()}
    ref = {(r.k, r.rn) for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert ours == ref
    assert T.cap_rows(T.serial_number(df, order, partitions=3), "serial", 10).count() == 10


def test_anti_join_keeps_items_without_detail(spark):
    items = spark.createDataFrame([("1",), ("2",), ("3",), (None,)], "item string")
    detail = spark.createDataFrame([("2",), ("2",), (None,)], "item string")
    out = T.anti_join(items, detail, "item", "item", keep_null_key="item_detail")
    assert sorted((r.item or "", r.item_detail) for r in out.collect()) == [("", None), ("1", None), ("3", None)]


def test_join_prefixed_renames_clashes(spark):
    a = spark.createDataFrame([("1", "ok", 5)], "item string, status string, x int")
    b = spark.createDataFrame([("1", "bad", 7)], "item string, status string, y int")
    out = T.join_prefixed(a, b, "item", "item")
    assert out.columns == ["item", "status", "x", "detail_item", "detail_status", "y"]


def _groups(spark):
    return spark.createDataFrame([
        (1, ["10.0.0.5-10.0.0.5"]),             # lo = hi
        (2, ["10.0.0.1-10.0.0.10", "10.0.0.8-10.0.0.20"]),  # two ranges, both can match
        (3, ["192.168.1.100-192.168.1.200"]),
        (4, ["10.0.0.9-10.0.0.3"]),              # empty range
    ], "g int, ips array<string>")


def test_range_membership_last_octet(spark):
    pts = spark.createDataFrame([(1, "10.0.0.5"), (2, "10.0.0.9"), (3, "10.0.0.20"), (4, "172.16.0.150"),
                                 (5, "bad.address"), (6, "10.0.0.300")], "id int, ip string")
    out = {(r.id, r.g) for r in T.range_membership_join(pts, _groups(spark), "ip", "ips", ["g"]).collect()}
    # 172.16.0.150 matches group 3 on the last octet alone, as in the source.
    assert out == {(1, 1), (1, 2), (2, 2), (3, 2), (4, 3)}
    salted = T.range_membership_join(pts, _groups(spark), "ip", "ips", ["g"], salt_buckets=4)
    assert {(r.id, r.g) for r in salted.collect()} == out
    # Row predicate form agrees.
    j = pts.join(_groups(spark), T.in_any_range(F.col("ip"), F.col("ips")))
    assert {(r.id, r.g) for r in j.collect()} == out


def test_range_membership_full_address(spark):
    pts = spark.createDataFrame([(1, "10.0.0.5"), (4, "172.16.0.150"), (7, "192.168.1.150")], "id int, ip string")
    out = {(r.id, r.g) for r in
           T.range_membership_join(pts, _groups(spark), "ip", "ips", ["g"], point_key=["id"], match="full").collect()}
    assert out == {(1, 1), (1, 2), (7, 3)}


def test_pivot_first_with_default(spark):
    df = spark.createDataFrame([(1, "m1", 4.0, 2), (1, "m1", 5.0, 1), (1, "m2", 2.0, 1), (2, "m3", 1.0, 1)],
                               "user int, movie string, rating double, ts int")
    vals = T.top_values(df, "movie", 2)
    assert vals == ["m1", "m2"]
    out = {r.user: (r.top1, r.top2) for r in
           T.pivot_first(df, "user", "movie", "rating", "ts", vals, 3.0, names=["top1", "top2"]).collect()}
    assert out == {1: (5.0, 2.0), 2: (3.0, 3.0)}


def test_numeric_summary_is_population(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "r double")
    r = T.numeric_summary(df, "r").first()
    assert (r.n, r.mean, r.max, r.min) == (4, 2.5, 4.0, 1.0)
    assert abs(r.stdev - 1.118033988749895) < 1e-12


def test_histograms(spark):
    df = spark.createDataFrame([("01-Jan-1995",), ("x",), ("01-Jan-1990",), ("05-May-1995",)], "d string")
    assert {(r.age, r["count"]) for r in T.age_histogram(df, "d", sentinel=1990).collect()} == {(3, 2)}
    assert {(r.age, r["count"]) for r in T.age_histogram(df, "d").collect()} == {(3, 2), (8, 1)}
    h = T.value_histogram(spark.createDataFrame([(1,), (1,), (2,)], "v int"), "v").collect()
    assert [(r.v, r["count"]) for r in h] == [(2, 1), (1, 2)]


def test_observed_counters_one_pass(spark):
    df = spark.newSession().range(1, 11, numPartitions=3)
    m = T.observed_counters(df, {"total": F.sum("id"), "values": F.sort_array(F.collect_list("id"))})
    assert m["total"] == 55
    assert list(m["values"]) == list(range(1, 11))


def test_top_per_group_and_composite_sort(spark):
    df = spark.createDataFrame([(5, 15), (4, 25), (10, 13), (4, 1), (2147483647, -2147483648), (-2147483648, 0)],
                               "first int, second int")
    out = [(r["first"], r.second) for r in T.composite_sort(df, "first", "second").collect()]
    assert out == [(-2147483648, 0), (4, 1), (4, 25), (5, 15), (10, 13), (2147483647, -2147483648)]
    t = T.top_per_group(df, "first", [F.desc("second")], 1).collect()
    assert {(r["first"], r.second) for r in t} == {(5, 15), (4, 25), (10, 13), (2147483647, -2147483648),
                                                   (-2147483648, 0)}


def test_column_cardinality(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "x int, y string")
    r = T.column_cardinality(df, ["x", "y"]).first()
    assert (r.distinct_x, r.distinct_y) == (2, 2)
