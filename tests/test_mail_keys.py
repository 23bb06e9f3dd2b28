import duckdb

from quarry.plans import oracle_sql, queries


def test_labels_stay_with_their_mail_past_a_million_documents(spark, tmp_path):
    docs = [(1234567, "far"), (123567, "near"), (1234568, "bare"), (7, "low")]
    labels = [(1234567, 0, 1), (123567, 1, 0), (7, 1, 0)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries()["mail_lines"](spark, str(tmp_path)).collect()
    assert sorted(r.line for r in got) == ["0:low", "0:near", "1:far", "null:bare"]
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.execute(oracle_sql()["mail_lines"]).fetchall()
    assert sorted((r.key, r.label, r.line) for r in got) == sorted(want)
    index = {tuple(r) for r in queries()["index_labels"](spark, str(tmp_path)).select("key", "label").collect()}
    assert index == {("000_007", "0"), ("123_567", "0"), ("1234_567", "1")}
    assert index == set(con.execute(oracle_sql()["index_labels"]).fetchall())


def test_utf8_mails_are_decoded_without_python(spark, tmp_path):
    from quarry.sources.io import read_mail_corpus

    (tmp_path / "000").mkdir()
    (tmp_path / "000" / "001").write_bytes("é\r\nb\rc\nd".encode() + b"\xff")
    index = spark.createDataFrame([("000_001", "1")], "key string, label string")
    df = read_mail_corpus(spark, f"{tmp_path}/*", index, charset="UTF-8")
    assert [tuple(r) for r in df.collect()] == [("000", "000_001", "1", "ébcd\ufffd")]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    legacy = read_mail_corpus(spark, f"{tmp_path}/*", index, charset="latin-1")
    assert legacy.first().text == "Ã©bcdÿ"
