"""Partitions derived from keys, none of them hot (inventory O98).

Rows are counted per key, keys are packed into partitions, largest first, each
into the partition that holds least; a key with more rows than a fair share is
cut into pieces by a hash of the row and each piece packed like a key. Rows
then go straight to their partition by number.
"""

from __future__ import annotations

from itertools import chain
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys are counted one by one up to this number; beyond it, hash buckets of keys are packed in their place.
MOST_KEYS = 4096
#: A key of more than this many fair shares is cut, into pieces of at most a ``PIECES``-th of that.
FAIR = 1.0
PIECES = 4


class Placed(NamedTuple):
    """``rows``: the table, repartitioned; ``number``: the partition of a row as an expression; ``largest``: rows of
    the fullest partition by plan; ``cut``: units (keys or buckets) that were cut."""

    rows: DataFrame
    number: Column
    largest: int
    cut: int


def pack(counts: dict, partitions: int, fair: float = FAIR) -> tuple[dict, list[int]]:
    """unit -> partition of each of its pieces, and the rows per partition. Largest piece first, ties by unit."""
    share = max(1, -(-sum(counts.values()) * fair // partitions))
    pieces = []
    for unit, n in counts.items():
        k = 1 if n <= share else min(partitions, int(-(-n * PIECES // share)))
        pieces += [(n // k + (i < n % k), str(unit), i, unit) for i in range(k)]
    load, where = [0] * partitions, {}
    for n, _, i, unit in sorted(pieces, key=lambda x: (-x[0], x[1], x[2])):
        p = min(range(partitions), key=lambda j: (load[j], j))
        load[p] += n
        where.setdefault(unit, {})[i] = p
    return {u: [d[i] for i in sorted(d)] for u, d in where.items()}, load


def place_by_key(df: DataFrame, key: Column, partitions: int, row_id: Column | None = None, fair: float = FAIR,
                 most_keys: int = MOST_KEYS) -> Placed:
    """``df`` in ``partitions`` partitions, rows of a key together unless the key is too large for one.

    ``row_id`` says by what a large key's rows are dealt out (default: all
    columns; rows equal in it stay together). A null key is a key. With more
    than ``most_keys`` keys, hash buckets of keys are packed: the table that
    reaches the driver has at most that many rows either way.
    """
    row_id = row_id if row_id is not None else F.struct(*[F.col(c) for c in df.columns])
    text = F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("null"))
    sizes = df.groupBy(text.alias("unit")).agg(F.count(F.lit(1)).alias("n"))
    if sizes.limit(most_keys + 1).count() > most_keys:
        text = F.pmod(F.xxhash64(text), F.lit(most_keys)).cast("string")
        sizes = df.groupBy(text.alias("unit")).agg(F.count(F.lit(1)).alias("n"))
    where, load = pack({r["unit"]: r["n"] for r in sizes.collect()}, partitions, fair)
    if not where:
        return Placed(df.repartitionById(partitions, F.lit(0)), F.lit(0), 0, 0)
    table = F.create_map(*chain.from_iterable((F.lit(u), F.array(*map(F.lit, p))) for u, p in sorted(where.items())))
    parts = F.element_at(table, text)
    number = F.element_at(parts, (F.pmod(F.xxhash64(F.lit(11), row_id), F.size(parts).cast("bigint")) + 1).cast("int"))
    return Placed(df.repartitionById(partitions, number), number, max(load), sum(len(p) > 1 for p in where.values()))
