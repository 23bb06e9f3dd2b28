"""The joins of the component search are shuffled at every size."""

from quarry.llm._graph import _joined


def test_salted_copies_are_not_broadcast(spark):
    """The planner does not see that each row is copied ``salt`` times; the driver used to build sixteen times the
    broadcast that the threshold allows, and ran out of memory."""
    spark.range(600).selectExpr("id % 40 + 100 AS u", "id % 90 AS v").distinct().createOrReplaceTempView("component_edges")
    edges = spark.table("component_edges")
    low = edges.groupBy("u").agg({"v": "min"}).withColumnRenamed("min(v)", "m")
    got = _joined(edges, low, 16)
    rows = got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    least = {r["u"]: r["m"] for r in low.collect()}
    assert len(rows) == edges.count() and all(r["m"] == least[r["u"]] for r in rows)
