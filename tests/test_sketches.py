import datetime as dt

from quarry.operators import sketches as K


def frame(spark, rows):
    return spark.createDataFrame(rows, "day date, user int, item string, part string")


def counts(sketches, parts=None):
    return {r["column"]: r["estimate"] for r in K.distinct_counts(sketches, parts).collect()}


def test_union_of_days_equals_one_pass_and_counts_within_the_error(spark, tmp_path):
    d = [dt.date(2024, 1, i) for i in range(1, 6)]
    rows = [(d[i % 5], i % 20_000, f"x{i % 37}" if i % 3 else None, "clash") for i in range(60_000)]
    df, path = frame(spark, rows), f"file://{tmp_path}/s"
    assert not K.has_sketches(spark, path)
    for day in d:
        kept = K.add_parts(spark, path, df.where(df.day == day), "day", ["user", "item"])
    assert K.has_sketches(spark, path) and kept.count() == 10
    got, once = counts(kept), counts(K.part_sketches(df, "day", ["user", "item"]).withColumn("part", K.F.lit("all")))
    assert got == once
    assert abs(got["user"] - 20_000) <= 20_000 * K.relative_error() and got["item"] == 37
    late = K.add_parts(spark, path, df.where(df.day == d[0]), "day", ["user", "item"])  # the same rows again
    assert counts(late) == got
    two = counts(late, ["2024-01-01", "2024-01-02"])
    assert abs(two["user"] - 8_000) <= 8_000 * K.relative_error()


def test_edge_cases(spark):
    none = K.part_sketches(frame(spark, []), "day", ["user"])
    assert none.collect() == [] and K.distinct_counts(none).collect() == []
    nulls = K.part_sketches(frame(spark, [(None, None, None, None), (None, 3, None, None)]), "day", ["user", "item"])
    assert counts(nulls) == {"user": 1, "item": 0} and {r.part for r in nulls.collect()} == {None}
