"""Helpers the operators share: written intermediate tables, sampling of labels, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import shared_path, table_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads the table, and every later
    use sees the same rows in the same files.
    """
    spark = df.sparkSession
    path = shared_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(col: str, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (null id: 0)."""
    return F.coalesce(F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(mod)), F.lit(0))


def id_hash(col: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(col))


def lowest(hashed: str, share: Column | float) -> Column:
    """Whether a 64-bit hash lies in the lowest ``share`` of its range (all, from 1 on)."""
    share = F.lit(share) if isinstance(share, float) else share
    edge = (share * F.lit(2.0 ** 63) * 2 - F.lit(2.0 ** 63)).cast("decimal(38,0)")
    return (share >= 1) | (F.col(hashed).cast("decimal(38,0)") < edge)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int,
                    seed: int = 7) -> DataFrame:
    """(text, y) of at most ``per_class`` labelled documents of each class 0 and 1.

    The choice is the lowest id hashes among rows that ``learn`` admits, taken
    on the narrow label table. The classes are counted first and only about
    four times the wanted number of hashes is sorted, so what meets in one task
    does not grow with the table. The at most ``2 * per_class`` chosen ids are
    the broadcast side (a bound fixed by the parameter), so the texts are
    scanned once and never shuffled.
    """
    lab = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & learn)
           .groupBy("doc_id").agg(F.max(label).alias("y")).withColumn("_h", id_hash("doc_id", seed)))
    n = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    pick = None
    for y in (0, 1):
        part = lab.where((F.col("y") == y) & lowest("_h", 4.0 * per_class / max(n.get(y, 0), 1)))
        part = part.orderBy("_h", "doc_id").limit(per_class).drop("_h")
        pick = part if pick is None else pick.unionByName(part)
    return (docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id")
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y"))


def class_rate(labels: DataFrame, label: str, learn: Column) -> float:
    """Share of label 1 among the rows that may be learnt from (0.5 when there are none)."""
    r = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & learn)
         .agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("k")).first())
    return min(max(r["k"] / r["n"], 1e-4), 1 - 1e-4) if r["n"] else 0.5


def log_odds(p: float) -> float:
    import math

    return math.log(p / (1 - p))


def score_texts(docs: DataFrame, scorer, held_out: Column, fields: str) -> DataFrame:
    """``scorer(texts) -> list of numpy columns`` over whole texts, batch by batch.

    Returns doc_id, held_out and the columns that ``fields`` declares. Only
    ``text`` reaches the scorer.
    """
    import pyarrow as pa

    src = docs.select("doc_id", held_out.alias("held_out"), "text")
    id_type = src.schema["doc_id"].dataType.simpleString()
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                cols = scorer([t.as_py() for t in b.column(2)])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, cols)],
                                                 names=["doc_id", "held_out", *names])

    return src.mapInArrow(run, f"doc_id {id_type}, held_out boolean, {fields}")


def keep_texts(docs: DataFrame, decide) -> DataFrame:
    """The rows of ``docs``, all columns, whose whole text ``decide(texts) -> booleans`` keeps; no shuffle."""
    import pyarrow as pa

    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                b = batch.slice(lo, 512)
                yield b.filter(pa.array([bool(x) for x in decide([t.as_py() for t in b.column(at)])], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
