import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.sources import io


def test_ordinal_scan(spark):
    df = spark.createDataFrame([(1, "a")], "key int, value string")
    assert io.ordinal_scan(df, [1, 0]).columns == ["value", "key"]
    with pytest.raises(IndexError):
        io.ordinal_scan(df, [100])


def test_named_documents_and_fields(spark):
    lines = spark.createDataFrame([("3abc.txt\thello\tworld",), ("5x_txt\tbody",)], "value string")
    got = [(r.name, r.content) for r in io.named_documents(lines).collect()]
    assert got == [("3abc", "hello\tworld"), ("5x", "body")]  # the dot in the separator is any character
    d = spark.createDataFrame([("1::2::5::9",), ("7::8",)], "value string")
    r = d.select(*io.split_fields(F.col("value"), "::", 3, ["u", "m", "r"])).collect()
    assert [tuple(x) for x in r] == [("1", "2", "5"), ("7", "8", None)]


def test_mail_corpus(spark):
    root = tempfile.mkdtemp(prefix="quarry-mail-")
    os.makedirs(f"{root}/data/000")
    with open(f"{root}/data/000/001", "wb") as f:
        f.write("第一行\r\n第二行\n".encode("gbk"))
    with open(f"{root}/data/000/002", "wb") as f:
        f.write(b"plain text")
    index = spark.createDataFrame([("SPAM ../data/000/001",), ("ham ../data/000/003",)], "value string")
    idx = io.parse_mail_index(index)
    assert {(r.key, r.label) for r in idx.collect()} == {("000_001", "1"), ("000_003", "0")}
    corpus = io.read_mail_corpus(spark, f"{root}/data/*/*", idx)
    got = {r.key: (r.label, r.text) for r in corpus.collect()}
    assert got == {"000_001": ("1", "第一行第二行"), "000_002": ("null", "plain text")}
    io.write_mail_corpus(corpus, f"{root}/out")
    lines = {r.value for r in spark.read.text(f"{root}/out/folder=000").collect()}
    assert lines == {"1:第一行第二行", "null:plain text"}


def test_csv_export_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="quarry-csv-")
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "k int, v string")
    io.export_csv(df, f"{root}/csv", files=2)
    back = io.read_table(spark, "csv", f"{root}/csv", schema=df.schema, header="true")
    assert sorted(back.collect()) == sorted(df.collect())
    assert len([f for f in os.listdir(f"{root}/csv") if f.endswith(".csv")]) <= 2
