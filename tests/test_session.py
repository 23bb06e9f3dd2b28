from quarry.operators import tables as T
from quarry.session import ensure_checkpoint_dir, shared_path


def test_checkpoint_dir_and_shared_paths(spark):
    root = ensure_checkpoint_dir(spark)
    assert root and spark.sparkContext.getCheckpointDir()
    a, b = shared_path(spark, "x"), shared_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/")) and "/quarry-work/x-" in a


def test_cardinality_approx_switch(spark):
    df = spark.range(5000).selectExpr("id % 37 AS a", "id % 5 AS b")
    exact = T.column_cardinality(df, ["a", "b"]).first()
    approx = T.column_cardinality(df, ["a", "b"], approx=True).first()
    assert (exact.distinct_a, exact.distinct_b) == (37, 5)
    assert abs(approx.distinct_a - 37) <= 2 and approx.distinct_b == 5
