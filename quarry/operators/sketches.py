"""Distinct counts that are kept, not recomputed (inventory O53).

A distinct-count sketch (HyperLogLog, built-in) is stored for every part of a
table, a day for instance, and every column asked for. A new day adds its
sketches and touches no earlier row; the count over any set of days is the
union of their sketches. The union of sketches has the registers of the sketch
of all the rows, so nothing is lost by cutting the table into days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.io import path_exists

#: log2 of the number of registers; the relative standard error is about 1.04 / sqrt(2 ** PRECISION).
PRECISION = 14


def relative_error(precision: int = PRECISION, deviations: float = 3.0) -> float:
    """The relative error that a count stays within, at so many standard deviations."""
    return deviations * 1.04 / 2 ** (precision / 2)


def part_sketches(df: DataFrame, part: str | Column, cols: Sequence[str], precision: int = PRECISION) -> DataFrame:
    """part, column, sketch, rows: one row per part and column.

    Sketches are built inside the map tasks and merged, so a day that holds a
    third of all rows reaches the shuffle as one sketch per task. Nulls are not
    counted; a column that is null throughout a part has the empty sketch. A
    null part is a part.
    """
    p = F.col(part) if isinstance(part, str) else part
    aggs = [F.hll_sketch_agg(F.col(c).cast("string"), precision).alias(f"s{i}") for i, c in enumerate(cols)]
    wide = df.groupBy(p.cast("string").alias("part")).agg(F.count(F.lit(1)).alias("rows"), *aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)])
    return wide.select("part", "rows", F.explode(pairs).alias("p")).select("part", "p.column", "p.sketch", "rows")


def add_parts(spark: SparkSession, path: str, df: DataFrame, part: str | Column, cols: Sequence[str],
              precision: int = PRECISION) -> DataFrame:
    """Add the sketches of ``df``'s parts to the table at ``path`` and return that table.

    A part that is there already gets a second sketch; the union takes both, so
    late rows, and the same rows again, are counted right. ``rows`` counts them again.
    """
    part_sketches(df, part, cols, precision).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def distinct_counts(sketches: DataFrame, parts: Sequence[str] | None = None) -> DataFrame:
    """column, estimate, sketch over all parts or the ones named; an empty table gives no rows."""
    chosen = sketches if parts is None else sketches.where(F.col("part").isin(list(parts)))
    out = chosen.groupBy("column").agg(F.hll_union_agg("sketch").alias("sketch"))
    return out.select("column", estimate(F.col("sketch")).alias("estimate"), "sketch")


def estimate(sketch: Column) -> Column:
    """The count a sketch stands for. The union with itself changes no register; it makes the estimate depend on the
    registers alone and not on the order in which they were filled, so that equal sketches give equal counts."""
    return F.hll_sketch_estimate(F.hll_union(sketch, sketch))


def has_sketches(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)
