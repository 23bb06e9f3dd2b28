"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import pytest

import __spark_entry__ as E
from quarry import plans

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["item", "o_custkey", "o_orderstatus", "o_totalprice", "item_long", "serial"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_declared():
    assert set(E.oracle_sql()) <= set(E.queries())
    q, o = plans.queries(), plans.oracle_sql()
    assert set(q) <= set(E.queries()) and set(o) <= set(q)
    # predictions themselves have no SQL; the ``*_model_check`` queries compare each fitted model with one
    assert set(q) - set(o) == {"als_explicit", "als_implicit", "als_top_items", "als_item_neighbours", "map_at_k_model",
                               "classify_spam_lr", "classify_lang_nb", "classify_tree", "kmeans_docs"}


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    sdf = df.toPandas()
    odf = duck.execute(E.oracle_sql()[name]).df()
    assert _rows(sdf) == _rows(odf)
    # No query may plan a cross product.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan
    # No query leaves a cached frame behind.
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
