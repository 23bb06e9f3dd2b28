"""Micro-batch cleaning jobs on Structured Streaming (inventory O06-O09,
O16, O67-O72).

One streaming plan per job: source -> substring routing -> JSON map ->
defaults -> first-seen -> ``foreachBatch`` sinks. Offsets live in the
checkpoint (they replace the stored group offsets of the source job), state
lives in the state store or in the key registry table, and every sink write
is keyed by ``batch_id`` so a replayed batch overwrites its own output
instead of adding to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import fixed
from quarry.operators.clean import clean_flagged, first_seen, split_flagged
from quarry.streaming.key_registry import KeyRegistry


# ---------------------------------------------------------------- sources

def topic_stream(spark: SparkSession, servers: str, topics: str, starting: str = "earliest",
                 fail_on_loss: bool = False) -> DataFrame:
    """Log-topic source (O06): resume comes from the checkpoint; with none,
    ``startingOffsets`` plays the reset policy (earliest = ``smallest``) or
    names each partition's offset (``offsets.starting_json``).
    Offsets that fell out of retention are skipped, as the source's
    per-partition clamp does; topic, partition and offset come along so that
    ``missing_offsets`` reports what was skipped. ``fail_on_loss`` stops instead."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("subscribe", topics)
            .option("startingOffsets", starting).option("failOnDataLoss", str(fail_on_loss).lower()).load()
            .select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                    "topic", "partition", "offset"))


def missing_offsets(rows: DataFrame) -> DataFrame:
    """(topic, partition, first, last, missing): offsets inside each range that no row has."""
    return (rows.groupBy("topic", "partition")
            .agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("_n"))
            .select("topic", "partition", "first", "last", (F.col("last") - F.col("first") + 1 - F.col("_n")).alias("missing"))
            .where("missing > 0"))


def file_stream(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str,
                glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """File-source stream (stands in for socket and topic sources in tests, O08)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(path)


def _write_batch(df: DataFrame, fmt: str, root: str, run: str, batch_id: int) -> None:
    df.write.mode("overwrite").format(fmt).save(f"{root}/run={run}/batch_id={batch_id}")


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The streaming query's id, kept in its checkpoint. Batch numbers restart
    at 0 under a new checkpoint, so outputs are told apart by it."""
    line = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return line.split('"id":"')[1].split('"')[0]


# ---------------------------------------------------------------- jobs

def clean_and_register(stream: DataFrame, *, key: Sequence[str], order: Sequence[str | Column],
                       sinks: dict[str, str], registry_path: str | None, checkpoint: str,
                       cleaner=None, reject_path: str | None = None,
                       trigger: dict | None = None, drop_cols: Sequence[str] = ()):
    """Run one cleaning stream to its sinks; returns the started query.

    One streaming query reads the source once. Per micro-batch: persist the
    batch (it feeds several writes, O16) and skip it when empty (O71); split
    it with ``cleaner`` (a function DataFrame -> (rows, rejects)) when given,
    writing the rejects under ``reject_path`` in the same layout; when
    ``registry_path`` is given keep the first row per key and drop keys
    registered before (O35, O67); write each sink under
    ``run=<query id>/batch_id=N`` (overwrite, so a replay is idempotent, and a
    new checkpoint never touches an earlier run's output); register the new
    keys last, as a run of the ``KeyRegistry`` (O15, O07).
    """
    spark = stream.sparkSession
    trig = trigger or {"availableNow": True}

    def run_batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()  # before the emptiness test, so the batch is computed once
        if df.isEmpty():
            df.unpersist()
            return
        registry = None
        try:
            run = run_of(spark, checkpoint)
            rows, held = df, None
            if cleaner is not None:
                rows, rejects, held = cleaner(df)
                if reject_path is not None:
                    _write_batch(rejects, "parquet", reject_path, run, batch_id)
            out = rows
            if registry_path is not None:
                registry = KeyRegistry(spark, registry_path, key, {k: rows.schema[k].dataType for k in key})
                out = first_seen(rows, registry.known(rows, run, batch_id), key, order)
            out = out.drop(*drop_cols)
            if registry_path is not None:
                out = out.persist()
            for fmt, root in sinks.items():
                _write_batch(out, fmt, root, run, batch_id)
            if registry_path is not None:
                registry.register(out, run, batch_id)  # one row per key already
                out.unpersist()
            if held is not None:
                held.unpersist()
        finally:
            if registry is not None:
                registry.release()
            df.unpersist()

    q = (stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
         .trigger(**trig).start())
    return [q]


def production_trigger(kind: str = "topic") -> dict:
    """Micro-batch interval of the source jobs (O72): 600 s for the topic
    jobs, 10 s for the socket job. ``clean_and_register(trigger=...)`` takes
    it; tests and driver queries use availableNow."""
    return {"processingTime": fixed.TOPIC_BATCH_INTERVAL if kind == "topic" else fixed.SOCKET_BATCH_INTERVAL}


def await_all(queries) -> None:
    for q in queries:
        q.awaitTermination()


def item_cleaner(fields: Sequence[str], *, exclude: str | None, typed: dict[str, str] | None = None,
                 keep: Sequence[str] = ()):
    """The cleaning graph as a per-batch function for ``clean_and_register``:
    the batch is parsed once into a flagged frame, persisted, and split."""
    def clean(df: DataFrame):
        flagged = clean_flagged(df, fields, exclude=exclude, typed=typed, keep=keep).persist()
        rows, rejects = split_flagged(flagged, fields, keep=keep)
        return rows, rejects, flagged
    return clean


def dedup_stream(rows: DataFrame, key: Sequence[str], event_time: str | None = None,
                 horizon: str | None = None) -> DataFrame:
    """Cross-batch first-seen in the state store (O67, H8). Without a horizon
    the state never expires, as in the source; with one, state older than the
    watermark is dropped."""
    if event_time and horizon:
        return rows.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(key))
    return rows.dropDuplicates(list(key))


def replay_counts(log: DataFrame, out_path: str, checkpoint: str) -> None:
    """Bounded log replay (O09): read everything available, then stop; count
    entries per (group, topic). An entry that did not decode (no group) is
    skipped, as the source logs and skips it; group-only entries keep a null
    topic. Complete-mode aggregate, rewritten per batch."""
    agg = (log.where(F.col("group").isNotNull())
           .groupBy("group", "topic").agg(F.count(F.lit(1)).alias("entries")))

    def run_batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(out_path)

    (agg.writeStream.outputMode("complete").foreachBatch(run_batch)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
