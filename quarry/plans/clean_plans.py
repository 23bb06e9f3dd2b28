"""Driver queries: message cleaning and streaming (families A and D's ETL)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import padded
from quarry.operators.clean import clean_messages, first_seen_flagged
from quarry.plans.registry import query
from quarry.sources.io import load, parse_mail_index
from quarry.sources.schemas import DETAIL_FIELDS, ITEM_FIELDS

# Split point of the events: earlier rows form the key registry.
REGISTRY_SPLIT = "2024-01-02 00:00:00"


def item_message_columns() -> dict:
    """Message fields made from an event row; a null field is left out of the JSON."""
    return {
        "city": F.when(F.col("event_type") != "error", (F.col("user_id") % 50).cast("string")),
        "score": F.floor("value").cast("int"),
        "industry": F.col("event_type"),
        "companyName": F.concat(F.lit("c"), F.col("user_id").cast("string")),
        "province": F.when(F.col("value") <= 40, F.lit("p") ),
        "item": F.when(~((F.col("event_type") == "view") & (F.col("value") < 5)), F.col("user_id").cast("string")),
        "crateTime": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "regStatus": F.col("props"),
        "regCapital": F.when(F.col("event_type") == "purchase", F.col("value")),
    }


def item_messages(events: DataFrame) -> DataFrame:
    """(event_id, ts, value) with ``value`` the JSON text of one message.

    Purchases carry ``regCapital`` (detail messages, routed away); errors
    above 45 are cut short, so they are malformed and go to the rejects.
    """
    cols = item_message_columns()
    js = F.to_json(F.struct(*[c.alias(k) for k, c in cols.items()]))
    bad = (F.col("event_type") == "error") & (F.col("value") > 45)
    return events.select("event_id", "ts", F.when(bad, F.substring(js, 1, 10)).otherwise(js).alias("value"))


_ITEM_SQL = """
WITH m AS (
  SELECT event_id, ts, event_type,
    CASE WHEN event_type <> 'error' THEN CAST(user_id % 50 AS VARCHAR) ELSE '0' END AS city,
    CAST(CAST(floor(value) AS INT) AS VARCHAR) AS score,
    event_type AS industry,
    'c' || user_id AS "companyName",
    CASE WHEN value <= 40 THEN 'p' ELSE '0' END AS province,
    CASE WHEN event_type = 'view' AND value < 5 THEN '0' ELSE CAST(user_id AS VARCHAR) END AS item,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS "crateTime",
    props AS "regStatus"
  FROM events WHERE NOT (event_type = 'error' AND value > 45))
"""

_ITEM_COLS = 'event_id, city, score, industry, "companyName", province, item, "crateTime", "regStatus"'


@query("json_defaults", ops="O02 O28 O29", sql=_ITEM_SQL + f"SELECT {_ITEM_COLS} FROM m")
def json_defaults(spark, sf):
    msgs = item_messages(load(spark, sf, "events"))
    rows, _rejects = clean_messages(msgs, ITEM_FIELDS, keep=["event_id"])
    return rows


@query("substring_route", ops="O27", sql=_ITEM_SQL + f"SELECT {_ITEM_COLS} FROM m WHERE event_type <> 'purchase'")
def substring_route(spark, sf):
    msgs = item_messages(load(spark, sf, "events"))
    rows, _rejects = clean_messages(msgs, ITEM_FIELDS, exclude="regCapital", keep=["event_id"])
    return rows


@query("json_rejects", ops="O28 (reject output)", sql="""
SELECT event_id FROM events WHERE event_type = 'error' AND value > 45
""")
def json_rejects(spark, sf):
    msgs = item_messages(load(spark, sf, "events"))
    _rows, rejects = clean_messages(msgs, ITEM_FIELDS, keep=["event_id"])
    return rejects.select("event_id")


_FIRST_SEEN_SQL = _ITEM_SQL + f"""
, reg AS (SELECT DISTINCT item FROM m WHERE event_type <> 'purchase' AND ts < TIMESTAMP '{REGISTRY_SPLIT}'),
b AS (SELECT * FROM m WHERE event_type <> 'purchase' AND ts >= TIMESTAMP '{REGISTRY_SPLIT}')
SELECT {_ITEM_COLS} FROM b
WHERE NOT EXISTS (SELECT 1 FROM reg WHERE reg.item = b.item)
QUALIFY row_number() OVER (PARTITION BY item ORDER BY ts, event_id) = 1
"""


@query("first_seen_registry", ops="O15 O35", sql=_FIRST_SEEN_SQL)
def first_seen_registry(spark, sf):
    msgs = item_messages(load(spark, sf, "events"))
    rows, _ = clean_messages(msgs, ITEM_FIELDS, exclude="regCapital", keep=["event_id", "ts"])
    split = F.lit(REGISTRY_SPLIT).cast("timestamp_ntz")  # the column is a local timestamp
    return first_seen_flagged(rows, F.col("ts") < split, ["item"], ["ts", "event_id"]).drop("ts")


def _label_lines(spark, sf):
    lab = load(spark, sf, "labels")
    docs = load(spark, sf, "documents").select("doc_id", "text")
    return lab.join(docs, "doc_id").select("doc_id", F.concat(F.col("toxic").cast("string"), F.lit(":"), F.col("text")).alias("line"))


@query("label_text_cut", ops="O34", sql="""
SELECT l.doc_id, CAST(l.toxic AS VARCHAR) AS label, d.text AS text
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
""")
def label_text_cut(spark, sf):
    lines = _label_lines(spark, sf)
    return lines.select("doc_id", F.substring("line", 1, 1).alias("label"), F.expr("substring(line, 3)").alias("text"))


def mail_path(doc_id: str = "doc_id") -> tuple:
    """Folder and file name of a mail, three digits each at least."""
    d = F.col(doc_id)
    return padded((d / 1000).cast("bigint"), 3), padded(d % 1000, 3)


def _padded_sql(x: str) -> str:
    return f"CASE WHEN length(CAST({x} AS VARCHAR)) < 3 THEN lpad(CAST({x} AS VARCHAR), 3, '0') ELSE CAST({x} AS VARCHAR) END"


MAIL_KEY_SQL = f"{_padded_sql('doc_id // 1000')} || '_' || {_padded_sql('doc_id % 1000')}"


def mail_index(labels):
    """Index lines like ``spam ../data/000/001``, the word in either case."""
    word = (F.when(F.col("toxic") == 1, F.when(F.col("quality") == 1, F.lit("SPAM")).otherwise(F.lit("spam")))
            .otherwise(F.lit("ham")))
    return labels.select(F.concat(word, F.lit(" ../data/"), F.concat_ws("/", *mail_path())).alias("value"))


@query("index_labels", ops="O19", sql=f"""
SELECT {MAIL_KEY_SQL} AS key, CASE WHEN toxic = 1 THEN '1' ELSE '0' END AS label FROM labels
""")
def index_labels(spark, sf):
    return parse_mail_index(mail_index(load(spark, sf, "labels")))


def detail_message(events: DataFrame) -> DataFrame:
    """Detail messages (16 fields) from purchase events; some fields absent."""
    base = {f: F.concat(F.lit(f[:3] + "-"), F.col("event_id").cast("string")) for f in DETAIL_FIELDS}
    base["item"] = F.col("user_id").cast("string")
    base["regCapital"] = F.col("value")
    base["busScope"] = F.when(F.col("value") > 20, base["busScope"])
    base["industry"] = F.col("event_type")
    js = F.to_json(F.struct(*[c.alias(k) for k, c in base.items()]))
    return events.where(F.col("event_type") == "purchase").select("event_id", "ts", js.alias("value"))


_DETAIL_SQL_COLS = ", ".join(
    ["CAST(user_id AS VARCHAR) AS item" if f == "item" else
     "CAST(value AS VARCHAR) AS \"regCapital\"" if f == "regCapital" else
     "CASE WHEN value > 20 THEN 'bus-' || event_id ELSE '0' END AS \"busScope\"" if f == "busScope" else
     "event_type AS industry" if f == "industry" else
     f"'{f[:3]}-' || event_id AS \"{f}\"" for f in DETAIL_FIELDS])


@query("json_scan", ops="O02", sql="""
SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(user_id % 50 AS VARCHAR) END AS city,
       CAST(floor(value) AS BIGINT) AS score,
       CASE WHEN event_type = 'view' AND value < 5 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS item,
       CAST(NULL AS VARCHAR) AS rejected
FROM events WHERE NOT (event_type = 'error' AND value > 45)
UNION ALL
SELECT -1, NULL, -1, NULL, '{"score":' || left(CAST(CAST(floor(value) AS INT) AS VARCHAR), 1)
FROM events WHERE event_type = 'error' AND value > 45
""")
def json_scan(spark, sf):
    """Messages written as JSON lines to the shared folder, then scanned with a
    given schema (no inference pass). Malformed lines come back too, with
    their text in ``_corrupt_record``: the rejects."""
    from quarry.session import shared_path
    from quarry.sources.io import read_json

    ev = load(spark, sf, "events")
    msgs = item_messages(ev)
    js = msgs.select(F.when(F.col("value").startswith("{") & F.col("value").endswith("}"),
                            F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(","),
                                     F.expr("substring(value, 2)")))
                     .otherwise(F.col("value")).alias("value"))
    path = shared_path(spark, "json_scan")
    js.write.mode("overwrite").text(path)
    schema = "event_id bigint, city string, score bigint, item string, _corrupt_record string"
    none = F.lit(-1).cast("bigint")
    return read_json(spark, path, schema).select(
        F.coalesce("event_id", none).alias("event_id"), "city", F.coalesce("score", none).alias("score"), "item",
        F.col("_corrupt_record").alias("rejected"))
