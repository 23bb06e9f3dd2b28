"""Plan properties the design relies on (see PLANS.md)."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partial_aggregation_and_group_limits(spark):
    q = E.queries()
    assert "partial_max_by" in _plan(q["keep_last_per_key"](spark, SF))
    assert "WindowGroupLimit" in _plan(q["map_at_k"](spark, SF))
    assert "WindowGroupLimit" in _plan(q["top_rows_per_user"](spark, SF))


def test_serial_number_has_no_data_wide_single_partition_window(spark):
    plan = _plan(E.queries()["items_without_detail_ranked"](spark, SF))
    # the only window is over the per-partition counts (one row per range partition)
    assert plan.count("Window [") == 1 and "sum(_n#" in plan
    assert "row_number()" not in plan


def test_scan_prunes_columns(spark):
    plan = _plan(E.queries()["top_rows_per_user"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_metrics_scan_their_tables_once(spark):
    q = E.queries()
    for name in ("prediction_error", "implicit_error"):
        plan = _plan(q[name](spark, SF))
        assert plan.count("FileScan") == 2, name  # lineitem and orders
    assert _plan(q["map_at_k"](spark, SF)).count("FileScan") == 0  # the pair counts were stored


def test_messages_are_parsed_once(spark):
    q = E.queries()
    for name in ("json_defaults", "json_rejects", "substring_route", "first_seen_registry"):
        plan = _plan(q[name](spark, SF))
        assert plan.count("from_json") == 1 and plan.count("FileScan") == 1, name
