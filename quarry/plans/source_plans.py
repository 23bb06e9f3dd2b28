"""Driver queries: text records, appends, address predicate, mail decoding
(inventory O01, O10, O13, O18, O32, O33, O77)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import tables as T
from quarry.plans.clean_plans import MAIL_KEY_SQL, mail_index, mail_path
from quarry.plans.registry import query
from quarry.plans.table_plans import _CUSTOMER_SQL, _ip_points
from quarry.session import shared_path
from quarry.sources import io
from quarry.sources.io import load


@query("text_records", ops="O01 O32 O33", sql="""
SELECT 'rating' AS kind, CAST(l_orderkey AS VARCHAR) AS f1, CAST(l_partkey AS VARCHAR) AS f2,
       CAST(l_linenumber AS VARCHAR) AS f3 FROM lineitem
UNION ALL
SELECT 'user', CAST(c_custkey AS VARCHAR), c_mktsegment, NULL FROM customer WHERE c_custkey % 3 <> 0
""")
def text_records(spark, sf):
    """``::`` and ``,`` records written as text files, scanned as lines and cut
    into fields; a record that is short of fields has nulls, and comma records
    of another width than two are left out."""
    base = shared_path(spark, "text_records")
    li = load(spark, sf, "lineitem")
    li.select(F.concat_ws("::", "l_orderkey", "l_partkey", "l_linenumber").alias("value")).write.text(f"{base}/a.dat")
    c = load(spark, sf, "customer")
    extra = F.when(F.col("c_custkey") % 3 == 0, F.lit("extra"))
    c.select(F.concat_ws(",", "c_custkey", "c_mktsegment", extra).alias("value")).write.text(f"{base}/b.csv")
    names = ["f1", "f2", "f3"]
    ratings = io.read_lines(spark, f"{base}/*.dat").select(
        F.lit("rating").alias("kind"), *io.split_fields(F.col("value"), "::", 3, names))
    users = io.read_lines(spark, [f"{base}/b.csv"]).where(F.size(F.split("value", ",")) == 2)
    return ratings.unionByName(users.select(F.lit("user").alias("kind"),
                                            *io.split_fields(F.col("value"), ",", 3, names)))


@query("append_twice", ops="O10 O13 O14", sql=_CUSTOMER_SQL)
def append_twice(spark, sf):
    """Two appends to one table, with writer options, read back whole."""
    path, c = shared_path(spark, "append_twice"), load(spark, sf, "customer")
    for part in (0, 1):
        io.write_table(c.where(F.col("c_custkey") % 2 == part), "parquet", path, mode="append",
                       compression="gzip", maxRecordsPerFile=5_000_000)
    return io.read_table(spark, "parquet", path)


@query("address_predicate", ops="O77", sql="""
WITH p AS (
  SELECT event_id, user_id % 256 AS last,
         '10.' || (user_id % 4) || '.' || (user_id % 7) || '.' || (user_id % 256) AS ip FROM events)
SELECT event_id, ip FROM p WHERE last BETWEEN 10 AND 24 OR last BETWEEN 200 AND 255
""")
def address_predicate(spark, sf):
    ranges = F.array(F.lit("10.0.0.10-10.0.0.24"), F.lit("10.9.9.200-10.9.9.255"), F.lit("bad"))
    return _ip_points(spark, sf).where(T.in_any_range(F.col("ip"), ranges)).select("event_id", "ip")


@query("mail_lines", ops="O18 O19", sql=f"""
WITH m AS (SELECT {MAIL_KEY_SQL} AS key, replace(text, chr(10), '') AS text FROM documents),
i AS (SELECT {MAIL_KEY_SQL} AS key, CASE WHEN toxic = 1 THEN '1' ELSE '0' END AS label FROM labels)
SELECT key, coalesce(label, 'null') AS label, coalesce(label, 'null') || ':' || text AS line FROM m LEFT JOIN i USING (key)
""")
def mail_lines(spark, sf):
    """Mails as bytes (made from the documents), decoded, joined by their folder_file key to the parsed index, as
    ``label:text`` lines."""
    docs = load(spark, sf, "documents")
    mails = docs.select(F.concat_ws("_", *mail_path()).alias("key"),
                        io.decoded(F.encode("text", "UTF-8"), "UTF-8").alias("text"))
    return io.label_lines(mails, io.parse_mail_index(mail_index(load(spark, sf, "labels"))))


@query("named_documents", ops="O99", sql="""
SELECT lang || CAST(doc_id AS VARCHAR) AS name, text AS content FROM documents
""")
def named_documents(spark, sf):
    """``name.txt<TAB>content`` records cut at the first separator; a text may hold tabs and line breaks."""
    d = load(spark, sf, "documents")
    lines = d.select(F.concat(F.col("lang"), F.col("doc_id").cast("string"), F.lit(".txt\t"), F.col("text")).alias("value"))
    return io.named_documents(lines)
