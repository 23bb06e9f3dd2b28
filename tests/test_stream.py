"""Streaming jobs: several micro-batches from a file source, compared with
the batch result on the same rows; a replayed batch is idempotent."""

import tempfile

from pyspark.sql import types as T

from quarry.operators.clean import clean_messages, first_seen
from quarry.sources.schemas import ITEM_FIELDS
from quarry.streaming import jobs
from quarry.streaming.key_registry import KeyRegistry

ROWS = [
    (1, 1, '{"item":"a","city":"x"}'), (2, 1, '{"item":"b","city":"y"}'), (3, 1, '{"item":"a","city":"z"}'),
    (4, 2, '{"item":"c"}'), (5, 2, '{"item":"a","city":"late"}'), (6, 2, 'not json'),
    (7, 3, '{"item":"b","regCapital":"1"}'), (8, 3, '{"item":"d"}'), (9, 3, '{"city":"no item"}'),
]


def test_stream_equals_batch_and_replay_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    src = f"{root}/src"
    for b in (1, 2, 3):  # one file per micro-batch, written in order
        part = [(i, v) for i, bb, v in ROWS if bb == b]
        spark.createDataFrame(part, "id int, value string").coalesce(1).write.parquet(f"{src}/b{b}")
    stream = (spark.readStream.schema("id int, value string").option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    qs = jobs.clean_and_register(stream, key=["item"], order=["id"], sinks={"parquet": f"{root}/out"},
                                 cleaner=jobs.item_cleaner(ITEM_FIELDS, exclude="regCapital", keep=["id"]),
                                 registry_path=f"{root}/reg", checkpoint=f"{root}/ck", reject_path=f"{root}/rej")
    jobs.await_all(qs)
    out = spark.read.parquet(f"{root}/out")
    assert out.select("run", "batch_id").distinct().count() == 3
    run = out.select("run").first()[0]
    got = {(r.item, r.id) for r in out.collect()}

    # Batch form on the same rows: first row per item over everything.
    allrows = spark.createDataFrame([(i, v) for i, _, v in ROWS], "id int, value string")
    brows, _ = clean_messages(allrows, ITEM_FIELDS, exclude="regCapital", keep=["id"])
    want = {(r.item, r.id) for r in first_seen(brows, spark.createDataFrame([], "item string"), ["item"], ["id"]).collect()}
    assert got == want == {("a", 1), ("b", 2), ("c", 4), ("d", 8), ("0", 9)}
    assert {r.value for r in spark.read.parquet(f"{root}/rej").collect()} == {"not json"}

    # Replay batch 1 through the batch function: it overwrites its own output.
    before = out.count()
    replay = spark.createDataFrame([(i, v) for i, b, v in ROWS if b == 1], "id int, value string")
    r1, _ = clean_messages(replay, ITEM_FIELDS, exclude="regCapital", keep=["id"])
    reg = KeyRegistry(spark, f"{root}/reg", ["item"], {"item": r1.schema["item"].dataType})
    again = first_seen(r1, reg.known(r1, run, 0), ["item"], ["id"])
    jobs._write_batch(again, "parquet", f"{root}/out", run, 0)
    assert spark.read.parquet(f"{root}/out").count() == before
    assert not reg.register(again, run, 0) and reg.keys().count() == len(want)


def test_state_store_dedup_across_batches(spark):
    root = tempfile.mkdtemp(prefix="quarry-dedup-")
    src = f"{root}/src"
    for b, keys in enumerate([["a", "b"], ["b", "c"], ["a", "d"]]):
        spark.createDataFrame([(k,) for k in keys], "item string").coalesce(1).write.parquet(f"{src}/part{b}")
    stream = spark.readStream.schema("item string").option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true").parquet(src)
    q = (jobs.dedup_stream(stream, ["item"]).writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(r.item for r in spark.read.parquet(f"{root}/out").collect())
    assert got == ["a", "b", "c", "d"]


def test_replay_counts(spark):
    root = tempfile.mkdtemp(prefix="quarry-replay-")
    spark.createDataFrame([("g1", "t1"), ("g1", "t1"), ("g2", None), (None, None)], "group string, topic string") \
        .write.parquet(f"{root}/log")  # the last entry did not decode
    log = spark.readStream.schema("group string, topic string").parquet(f"{root}/log")
    jobs.replay_counts(log, f"{root}/out", f"{root}/ck")
    got = {(r.group, r.topic, r.entries) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {("g1", "t1", 2), ("g2", None, 1)}


def test_dedup_within_horizon(spark):
    root = tempfile.mkdtemp(prefix="quarry-horizon-")
    src = f"{root}/src"
    batches = [[("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:00:01")],
               [("a", "2024-01-01 00:00:05"), ("c", "2024-01-01 00:00:06")]]
    for b, rows in enumerate(batches):
        spark.createDataFrame(rows, "item string, t string").selectExpr("item", "CAST(t AS TIMESTAMP) AS ts") \
            .coalesce(1).write.parquet(f"{src}/part{b}")
    stream = spark.readStream.schema("item string, ts timestamp").option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true").parquet(src)
    q = (jobs.dedup_stream(stream, ["item"], event_time="ts", horizon="1 hour").writeStream.format("parquet")
         .option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.item for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b", "c"]


def test_new_checkpoint_loses_and_repeats_nothing(spark):
    """The same sinks under two checkpoints: batch numbers restart, outputs do not collide."""
    root = tempfile.mkdtemp(prefix="quarry-two-runs-")
    for n, keys in enumerate([["a", "b"], ["b", "c"]]):
        spark.createDataFrame([(i, f'{{"item":"{k}"}}') for i, k in enumerate(keys)], "id int, value string") \
            .coalesce(1).write.parquet(f"{root}/src{n}")
        stream = spark.readStream.schema("id int, value string").parquet(f"{root}/src{n}")
        jobs.await_all(jobs.clean_and_register(
            stream, key=["item"], order=["id"], sinks={"parquet": f"{root}/out"}, registry_path=f"{root}/reg",
            cleaner=jobs.item_cleaner(ITEM_FIELDS, exclude=None, keep=["id"]), checkpoint=f"{root}/ck{n}"))
    assert sorted(r.item for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b", "c"]
    reg = KeyRegistry(spark, f"{root}/reg", ["item"], {"item": T.StringType()})
    assert sorted(r.item for r in reg.keys().collect()) == ["a", "b", "c"]


def test_missing_offsets_are_reported(spark):
    rows = spark.createDataFrame([("t", 0, 5), ("t", 0, 6), ("t", 0, 9), ("t", 1, 1), ("t", 1, 2)],
                                 "topic string, partition int, offset bigint")
    got = [tuple(r) for r in jobs.missing_offsets(rows).collect()]
    assert got == [("t", 0, 5, 9, 2)]


def test_production_trigger_starts_a_query(spark):
    q = (spark.readStream.format("rate").load().writeStream.format("noop")
         .trigger(**jobs.production_trigger("socket")).start())
    q.stop()
    assert jobs.production_trigger()["processingTime"] == "600 seconds"
