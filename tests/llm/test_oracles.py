"""Every operator query that has SQL against it, on the smallest tables."""

import duckdb
import pytest

from quarry.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf001, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf001}/{t}.parquet'")
    df = QUERIES[name](spark, sf001)
    cols = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    assert sorted((tuple(r) for r in df.select(*cols).collect()), key=str) == sorted(want, key=str) and want
