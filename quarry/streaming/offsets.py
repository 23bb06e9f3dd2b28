"""Where a log-topic job starts and what it has read, as tables (inventory O06, O07).

Stored offsets of a group and the ranges that the log still holds are two
tables; what a job reads next is a join of them. A group offset that retention
has overtaken moves up to the earliest offset held, in that partition alone; a
topic that the group has not consumed starts at the earliest or the latest
offset, as the reset policy says. The offsets that a batch has read are written
under the batch's number, so writing them again changes nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.io import path_exists

SCHEMA = "topic string, partition int, until bigint, batch_id bigint"


def start_offsets(stored: DataFrame, held: DataFrame, reset: str = "smallest", whole_topic: bool = True) -> DataFrame:
    """(topic, partition, start, until, skipped, why): the range to read next of every partition held.

    ``stored`` (topic, partition, until) is the group's position, ``held``
    (topic, partition, earliest, latest) what the log has; ``latest`` is the
    next offset to be written. ``why`` is ``resumed``, ``clamped`` (with the
    number of offsets ``skipped``) or ``reset``. As in the source job a topic
    of which some partition has no stored offset counts as not consumed, all of
    it is reset; with ``whole_topic=False`` only such partitions are. A stored
    offset beyond the log's end stays, the range is then empty. Stored
    partitions that the log does not hold are left out. Any reset policy but
    ``smallest`` means the latest offset. Repeated stored rows: the largest.
    """
    at = stored.where("until IS NOT NULL").groupBy("topic", "partition").agg(F.max("until").alias("_at"))
    both = held.select("topic", "partition", "earliest", "latest").join(at, ["topic", "partition"], "left")
    fresh = F.col("_at").isNull()
    if whole_topic:  # one row per topic, joined back
        topics = both.groupBy("topic").agg(F.max(fresh).alias("_fresh"))
        both, fresh = both.join(topics, "topic"), F.col("_fresh")
    begin = F.col("earliest") if reset.lower() == "smallest" else F.col("latest")
    old = F.col("_at") < F.col("earliest")
    return both.select(
        "topic", "partition", F.when(fresh, begin).when(old, F.col("earliest")).otherwise(F.col("_at")).alias("start"),
        F.col("latest").alias("until"),
        F.when(~fresh & old, F.col("earliest") - F.col("_at")).otherwise(F.lit(0)).cast("bigint").alias("skipped"),
        F.when(fresh, F.lit("reset")).when(old, F.lit("clamped")).otherwise(F.lit("resumed")).alias("why"))


def starting_json(starts: DataFrame) -> str:
    """The ``startingOffsets`` option of the topic source; one number per topic partition reaches the driver."""
    out: dict = {}
    for r in starts.select("topic", "partition", "start").collect():
        out.setdefault(r["topic"], {})[str(r["partition"])] = r["start"]
    return json.dumps(out, sort_keys=True)


def commit_offsets(read: DataFrame, path: str, batch_id: int) -> None:
    """Store the end of what a batch has read (topic, partition, until) under its number."""
    read.select("topic", F.col("partition").cast("int").alias("partition"), F.col("until").cast("bigint").alias("until")) \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def stored_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(topic, partition, until) as the last batch that read a partition left it; no rows before the first commit."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "topic string, partition int, until bigint")
    rows = spark.read.schema(SCHEMA).parquet(path)
    return rows.groupBy("topic", "partition").agg(F.max_by("until", "batch_id").alias("until"))
