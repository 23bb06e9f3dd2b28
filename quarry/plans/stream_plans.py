"""Driver queries that run the streaming jobs to completion (``availableNow``)
over the events table as a file stream, then read their sinks back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.plans.clean_plans import _DETAIL_SQL_COLS, _ITEM_COLS, _ITEM_SQL, detail_message, item_messages
from quarry.plans.registry import query
from quarry.session import shared_path
from quarry.sources.io import load, stored
from quarry.sources.schemas import DETAIL_FIELDS, DETAIL_SCHEMA, ITEM_FIELDS, ITEM_TYPED_SCHEMA
from quarry.streaming import jobs
from quarry.streaming.key_registry import KeyRegistry


def events_stream(spark, sf):
    """The events table as a file stream (one file: one micro-batch)."""
    schema = load(spark, sf, "events").schema
    return jobs.file_stream(spark, sf, "parquet", schema, glob="events.parquet")


def event_parts(spark, sf, parts=4):
    """The events cut into ``parts`` time ranges, in order, each of about as many rows; most users recur in several."""
    ev = load(spark, sf, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    bounds = ev.agg(F.approx_percentile(at, [i / parts for i in range(1, parts)], F.lit(1000))).first()[0]
    part = sum(((at > F.lit(b)).cast("int") for b in bounds), F.lit(0))
    return [ev.where(part == i) for i in range(parts)]


@query("stream_clean_items", ops="O07 O15 O16 O27 O28 O29 O35 O67 O68 O71", sql=_ITEM_SQL + f"""
, f AS (SELECT * FROM m WHERE event_type <> 'purchase'
        QUALIFY row_number() OVER (PARTITION BY item ORDER BY ts, event_id) = 1)
SELECT 'parquet' AS sink, {_ITEM_COLS} FROM f UNION ALL SELECT 'json' AS sink, {_ITEM_COLS} FROM f
UNION ALL SELECT 'registry', 0, NULL, NULL, NULL, NULL, NULL, item, NULL, NULL FROM f
""")
def stream_clean_items(spark, sf):
    """Four runs of one job, each resumed from the checkpoint with the events that came since; keys recur. Both sinks
    and the key registry are returned."""
    base = shared_path(spark, "stream_clean_items")
    schema = load(spark, sf, "events").schema
    for i, part in enumerate(event_parts(spark, sf)):
        part.write.parquet(f"{base}/events/part{i}")
        arrived = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/events")
        jobs.await_all(jobs.clean_and_register(
            item_messages(arrived), key=["item"], order=["ts", "event_id"],
            cleaner=jobs.item_cleaner(ITEM_FIELDS, exclude="regCapital", keep=["event_id", "ts"]),
            sinks={"parquet": f"{base}/items", "json": f"{base}/index"},
            registry_path=f"{base}/registry", checkpoint=f"{base}/_checkpoint",
            reject_path=f"{base}/rejects", drop_cols=["ts"]))
    cols = ["event_id", *ITEM_FIELDS]
    schema = "event_id bigint, " + ", ".join(f"{c} string" for c in ITEM_FIELDS)
    rows = spark.read.schema(schema).parquet(f"{base}/items").select(F.lit("parquet").alias("sink"), *cols)
    index = spark.read.schema(schema).json(f"{base}/index").select(F.lit("json").alias("sink"), *cols)
    registry = KeyRegistry(spark, f"{base}/registry", ["item"], {"item": T.StringType()})
    keys = registry.keys().select(F.lit("registry").alias("sink"), "item")
    out = rows.unionByName(index).unionByName(keys, allowMissingColumns=True)
    return out.withColumn("event_id", F.coalesce("event_id", F.lit(0).cast("bigint")))


@query("stream_clean_detail", ops="O69", sql=f"""
SELECT {_DETAIL_SQL_COLS} FROM events WHERE event_type = 'purchase'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
""")
def stream_clean_detail(spark, sf):
    base = shared_path(spark, "stream_clean_detail")
    msgs = detail_message(events_stream(spark, sf))
    qs = jobs.clean_and_register(
        msgs, key=["item"], order=["ts", "event_id"],
        cleaner=jobs.item_cleaner(DETAIL_FIELDS, exclude=None, keep=["event_id", "ts"]),
        sinks={"json": f"{base}/index"}, registry_path=f"{base}/registry",
        checkpoint=f"{base}/_checkpoint", reject_path=f"{base}/rejects", drop_cols=["ts", "event_id"])
    jobs.await_all(qs)
    # The index sink is JSON; read it back with the fixed all-string schema.
    return spark.read.schema(DETAIL_SCHEMA).json(f"{base}/index").select(*DETAIL_FIELDS)


@query("stream_typed", ops="O08 O70 O71", sql=_ITEM_SQL + """
SELECT event_id, city, CAST(score AS INT) AS score, industry, "companyName", province, item, "crateTime", "regStatus"
FROM m
""")
def stream_typed(spark, sf):
    base = shared_path(spark, "stream_typed")
    msgs = item_messages(events_stream(spark, sf))
    qs = jobs.clean_and_register(
        msgs, key=["item"], order=["event_id"],
        cleaner=jobs.item_cleaner(ITEM_FIELDS, exclude=None, typed={"score": "int"}, keep=["event_id"]),
        sinks={"json": f"{base}/index"}, registry_path=None,
        checkpoint=f"{base}/_checkpoint", reject_path=f"{base}/rejects", trigger={"availableNow": True})
    jobs.await_all(qs)
    schema = T.StructType(ITEM_TYPED_SCHEMA.fields + [T.StructField("event_id", T.LongType())])
    return spark.read.schema(schema).json(f"{base}/index").select("event_id", *ITEM_FIELDS)


@query("stream_first_seen", ops="O67 (state store)", sql="""
SELECT DISTINCT user_id FROM events
""")
def stream_first_seen(spark, sf):
    base = shared_path(spark, "stream_first_seen")
    s = jobs.dedup_stream(events_stream(spark, sf).select("user_id"), ["user_id"])
    (s.writeStream.format("parquet").option("path", f"{base}/keys")
     .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{base}/keys")


@query("log_replay_groups", ops="O09", sql="""
SELECT CAST(user_id AS VARCHAR) AS "group", CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS topic,
       count(*) AS entries
FROM events GROUP BY 1, 2
""")
def log_replay_groups(spark, sf):
    base = shared_path(spark, "log_replay")
    log = events_stream(spark, sf).select(
        F.col("user_id").cast("string").alias("group"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("topic"))
    jobs.replay_counts(log, f"{base}/counts", f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/counts")


@query("resume_offsets", ops="O06 O07", sql="""
WITH e AS (SELECT event_type AS topic, CAST(user_id % 4 AS INT) AS part, event_id FROM events),
b AS (SELECT max(event_id) AS top FROM events),
held AS (SELECT topic, part, min(event_id) AS earliest, max(event_id) + 1 AS latest FROM e, b
         WHERE event_id * 2 >= top GROUP BY topic, part),
stored AS (SELECT topic, part, max(event_id) + 1 AS until FROM e, b
           WHERE topic <> 'signup' AND NOT (topic = 'view' AND part = 3)
             AND event_id * 10 < top * CASE WHEN part = 0 THEN 3 ELSE 8 END GROUP BY topic, part),
j AS (SELECT h.*, s.until, bool_or(s.until IS NULL) OVER (PARTITION BY topic) AS fresh
      FROM held h LEFT JOIN stored s USING (topic, part)),
st AS (SELECT topic, part, latest, CASE WHEN fresh OR until < earliest THEN earliest ELSE until END AS start,
              CASE WHEN NOT fresh AND until < earliest THEN earliest - until ELSE 0 END AS skipped,
              CASE WHEN fresh THEN 'reset' WHEN until < earliest THEN 'clamped' ELSE 'resumed' END AS why FROM j)
SELECT st.topic, st.part AS partition, start, latest AS until, skipped, why, count(e.event_id) AS n_rows, latest AS next_start
FROM st LEFT JOIN e ON e.topic = st.topic AND e.part = st.part AND e.event_id >= st.start AND e.event_id < st.latest
GROUP BY ALL
""")
def resume_offsets(spark, sf):
    """Event types as topics, users as partitions, the later half of the events still held: where a group starts, what
    it then reads, and where it starts once that is committed."""
    from quarry.streaming import offsets as O

    ev = load(spark, sf, "events").select(F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
                                          "event_id")
    top = ev.agg(F.max("event_id")).first()[0]
    held = ev.where(F.col("event_id") * 2 >= top).groupBy("topic", "partition").agg(
        F.min("event_id").alias("earliest"), (F.max("event_id") + 1).alias("latest"))
    reach = F.when(F.col("partition") == 0, 3).otherwise(8)
    known = (F.col("topic") != "signup") & ~((F.col("topic") == "view") & (F.col("partition") == 3))
    before = ev.where(known & (F.col("event_id") * 10 < F.lit(top) * reach)).groupBy("topic", "partition").agg(
        (F.max("event_id") + 1).alias("until"))
    path = shared_path(spark, "offsets")
    O.commit_offsets(before, path, 0)
    starts = stored(O.start_offsets(O.stored_offsets(spark, path), held), "starts")
    span = (F.col("event_id") >= F.col("start")) & (F.col("event_id") < F.col("until"))
    read = starts.join(ev, ["topic", "partition"], "left").groupBy(*starts.columns).agg(
        F.count(F.when(span, 1)).alias("n_rows"))
    O.commit_offsets(starts, path, 1)
    after = O.start_offsets(O.stored_offsets(spark, path), held).select("topic", "partition", F.col("start").alias("next_start"))
    return read.join(after, ["topic", "partition"])


@query("stream_first_seen_horizon", ops="O67 (horizon)", sql="""
SELECT DISTINCT user_id FROM events
""")
def stream_first_seen_horizon(spark, sf):
    """First-seen with a horizon longer than the events reach, so that no key is forgotten."""
    base = shared_path(spark, "stream_first_seen_horizon")
    ev = events_stream(spark, sf).select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    s = jobs.dedup_stream(ev, ["user_id"], event_time="ts", horizon="3660 days").select("user_id")
    (s.writeStream.format("parquet").option("path", f"{base}/keys")
     .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema("user_id bigint").parquet(f"{base}/keys")


@query("stream_production_trigger", ops="O08 O70 O72", sql=_ITEM_SQL + """
SELECT event_id, item FROM m
""")
def stream_production_trigger(spark, sf):
    """The socket job under its own interval: the first batch runs at once, the query is stopped when it is done."""
    base = shared_path(spark, "stream_production_trigger")
    query_, = jobs.clean_and_register(
        item_messages(events_stream(spark, sf)), key=["item"], order=["event_id"],
        cleaner=jobs.item_cleaner(ITEM_FIELDS, exclude=None, typed={"score": "int"}, keep=["event_id"]),
        sinks={"json": f"{base}/index"}, registry_path=None, checkpoint=f"{base}/_checkpoint",
        trigger=jobs.production_trigger("socket"))
    try:
        query_.processAllAvailable()
    finally:
        query_.stop()
    return spark.read.schema("event_id bigint, item string").json(f"{base}/index").select("event_id", "item")
