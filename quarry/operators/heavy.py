"""The most frequent values without shuffling every value (inventory O51, O61, O66).

Each task keeps a summary of at most ``capacity`` counters (Misra-Gries): when
it overflows, the counter just past the capacity is taken off every counter and
added to the summary's error. A value's true count then lies between its
counter and counter plus error, in one task and, as both add up, over all
tasks. The values that the bounds leave in question, the survivors, are counted
exactly in a second pass. The list is proven when its last exact count exceeds
what any other value can reach; if not, the pass is repeated with a larger
capacity, and when even ``MOST`` counters a task are too few, because the
values hardly repeat, every value is counted.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.sources.io import stored

CAPACITY = 4096
MOST = 1 << 18
GROWTH = 8


class Top(NamedTuple):
    """``rows`` (value, count) of the list, ``proof``: "bound" or "full count", and how many ``rounds`` were run."""

    rows: DataFrame
    proof: str
    rounds: int


def _cut(held: Counter, capacity: int) -> tuple[Counter, int]:
    """The counters less the (capacity + 1)-th largest one, and that one."""
    if len(held) <= capacity:
        return held, 0
    n = np.fromiter(held.values(), np.int64, len(held))
    off = int(np.partition(n, len(n) - capacity - 1)[len(n) - capacity - 1])
    return Counter({v: c - off for v, c in held.items() if c > off}), off


def summaries(values: DataFrame, column: str, capacity: int) -> DataFrame:
    """value, count of every task's counters; the row with ``error`` set holds what the task took off."""
    src = values.select(column)
    kind = src.schema[column].dataType.simpleString()

    def run(batches):
        held, error, arrow = Counter(), 0, None
        for b in batches:
            arrow = b.schema.field(0).type
            counted = b.column(0).value_counts()  # one pass over the batch, not row by row
            held.update(dict(zip(counted.field("values").to_pylist(), counted.field("counts").to_pylist())))
            if len(held) > 4 * capacity:
                held, off = _cut(held, capacity)
                error += off
        held, off = _cut(held, capacity)
        if arrow is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([*held, None], arrow), pa.array([*held.values(), 0], pa.int64()),
                 pa.array([None] * len(held) + [error + off], pa.int64())], names=["value", "count", "error"])

    return src.mapInArrow(run, f"value {kind}, count bigint, error bigint")


def top_values_exact(values: DataFrame, column: str, n: int, capacity: int = CAPACITY, most: int = MOST) -> Top:
    """The ``n`` most frequent values of a column with their exact counts, ties to the smaller value.

    A null is a value like any other; an empty table gives no rows. With ``n``
    not below the number of values the result is the whole value histogram (O51).
    """
    order = [F.desc("count"), F.asc_nulls_first("value")]
    capacity, rounds = max(capacity, 2 * n), 0
    while capacity <= most:
        rounds += 1
        parts = stored(summaries(values, column, capacity), "value-summaries")
        error = parts.agg(F.sum("error")).first()[0]
        if error is None:
            break  # no rows
        low = stored(parts.where("error IS NULL").groupBy("value").agg(F.sum("count").alias("low")), "value-bounds")
        nth = low.orderBy(F.desc("low")).limit(n).agg(F.min("low"), F.count(F.lit(1))).first()  # n rows
        floor = nth[0] if nth[1] == n else 0
        if error == 0:
            rows = low.select("value", F.col("low").alias("count"))
            return Top(rows.orderBy(*order).limit(n), "bound", rounds)
        if error < floor:  # a value that no summary holds cannot reach the list
            survivors = low.where(F.col("low") + F.lit(error) >= F.lit(floor)).select("value")
            src = values.select(F.col(column).alias("value"))
            counted = (src.join(survivors, src["value"].eqNullSafe(survivors["value"]), "left_semi")
                       .groupBy("value").agg(F.count(F.lit(1)).alias("count")))
            return Top(counted.orderBy(*order).limit(n), "bound", rounds)
        capacity *= GROWTH
    full = values.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return Top(full.orderBy(*order).limit(n), "full count", rounds)
