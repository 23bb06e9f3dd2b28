"""Table jobs: keep-last, joins, serial numbers, range join, pivot, profiles,
counters, ranking (inventory O22-O66).

All of it is DataFrame code planned by Catalyst. Where a side is broadcast,
its size is fixed by a parameter (serial-number offsets); everything else is
left to AQE, which turns a sort-merge join into a broadcast only from measured
shuffle sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from quarry import fixed
from quarry.functions.columns import address_number, col_of, octet

# ---------------------------------------------------------------- dedup

def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order``.

    The source job keeps the last row in arrival order, which a table does not
    have; the caller names the order, and with none every non-key column is
    the order (H4). ``max_by`` over a struct is partially aggregated on the
    map side, so a key holding a third of the rows is reduced to one row per
    input partition before the shuffle. Null keys form one group.
    """
    rest = [c for c in df.columns if c not in keys]
    if order is None:
        order = rest
    ord_struct = F.struct(*[col_of(c) for c in order])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ord_struct).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the row with the least ``order`` (first seen)."""
    rest = [c for c in df.columns if c not in keys]
    ord_struct = F.struct(*[col_of(c) for c in order])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), ord_struct).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


# ---------------------------------------------------------------- joins

def anti_join(items: DataFrame, detail: DataFrame, item_key: str, detail_key: str,
              keep_null_key: str | None = None) -> DataFrame:
    """Items with no detail row (O38): left-outer + is-null written as ``left_anti``.

    The detail side is projected to its key and deduplicated before the join:
    the shuffle carries one column, and the partial aggregate removes repeated
    keys on the map side (detail rows cluster by key, several per item).
    ``keep_null_key`` adds the null detail key column the left-outer form
    carries, when the output shape must match.
    """
    d = detail.select(F.col(detail_key).alias("_dkey")).distinct()
    out = items.join(d, items[item_key] == d["_dkey"], "left_anti")
    if keep_null_key:
        out = out.withColumn(keep_null_key, F.lit(None).cast(detail.schema[detail_key].dataType))
    return out


def join_prefixed(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  prefix: str = "detail_", how: str = "inner") -> DataFrame:
    """Equi-join keeping both sides; clashing right-side names get ``prefix``."""
    clash = set(left.columns) & set(right.columns)
    r = right.select(*[F.col(c).alias(prefix + c if c in clash else c) for c in right.columns])
    rk = prefix + right_key if right_key in clash else right_key
    return left.join(r, left[left_key] == r[rk], how)


def lookup_titles(df: DataFrame, titles: DataFrame, key: str, title: str,
                  order: Sequence[str] | None = None) -> DataFrame:
    """Id to title (O43): last title wins for a repeated id; an absent id gives null.

    Titles are deduplicated per id first (map-side combined), then joined;
    AQE broadcasts them when their measured size allows.
    """
    t = keep_last(titles.select(key, title, *(order or [])), [key], order or [title]).select(key, title)
    return df.join(t, key, "left")


# ---------------------------------------------------------------- serial number

def serial_number(df: DataFrame, order: Sequence[Column], name: str = "serial",
                  partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Global 1-based row number in ``order`` without a single-partition window (H5).

    Rows are range-partitioned on the order (the range bounds are sampled on
    the whole key, so a hot value is split by the tiebreak columns) and sorted
    inside each partition; ``monotonically_increasing_id`` then carries the
    partition index in its upper bits and the row index inside the partition
    in its lower 33 bits. Partition sizes (one row per partition, a number we
    fix) get a running offset and are broadcast back. The numbered frame is
    checkpointed to the shared folder so a lost executor cannot re-sample
    other bounds. ``order`` must be a total order (include a unique tiebreak).
    """
    spark = df.sparkSession
    if checkpoint:
        from quarry.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = _ranged(df, order, n)
    if checkpoint:
        ranged = ranged.checkpoint(eager=True)
    ranged = ranged.select("*", F.shiftright("_mid", 33).alias("_pid"),
                           F.col("_mid").bitwiseAND((1 << 33) - 1).alias("_loc"))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    # ``offsets`` has at most ``n`` rows: a size fixed by the parameter above.
    return (ranged.join(F.broadcast(offsets), "_pid")
            .select(*[F.col(c) for c in df.columns], (F.col("_off") + F.col("_loc") + 1).cast("bigint").alias(name)))


def _ranged(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Range-partitioned on the whole order, sorted inside each partition,
    with ``_mid`` = (partition index << 33) + row index in the partition."""
    return (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .withColumn("_mid", F.monotonically_increasing_id()))


def cap_rows(df: DataFrame, serial: str, n: int | None = None) -> DataFrame:
    """Row cap after ranking (O63): serial numbers up to ``n``; all rows unless a cap is asked for."""
    return df if n is None else df.where(F.col(serial) <= n)


# ---------------------------------------------------------------- range join

def _merged_ranges(g: DataFrame, key: Sequence[str], rest: Sequence[str]) -> DataFrame:
    """Overlapping and adjoining [_lo, _hi] of one group made one range."""
    w = Window.partitionBy(*key).orderBy("_lo", "_hi")
    before = F.max("_hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    g = g.withColumn("_new", F.when(before.isNull() | (F.col("_lo") > before + 1), 1).otherwise(0))
    g = g.withColumn("_isle", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (g.groupBy(*key, "_isle").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
                                         *[F.first(c).alias(c) for c in rest]).drop("_isle"))


_SHIFTS = (24, 16, 8, 0)


def _address_blocks(lo: Column, hi: Column) -> Column:
    """The aligned blocks (shift, block) that make up an address range exactly:
    at each octet boundary the blocks inside the range that no wider one
    covers, so at most 510 per boundary however wide the range is."""
    def some(shift, a, b):
        return F.when(a <= b, F.transform(F.sequence(a, b), lambda x: F.struct(F.lit(shift).alias("shift"), x.alias("blk")))
                      ).otherwise(F.array().cast("array<struct<shift:int,blk:bigint>>"))
    out, wider = [], None
    for s in _SHIFTS:
        size = 1 << s
        first = F.floor((lo + (size - 1)) / F.lit(size)).cast("bigint")
        last = (F.floor((hi + 1) / F.lit(size)) - 1).cast("bigint")
        if wider is None:
            out.append(some(s, first, last))
        else:
            a, b = wider[0] * 256, (wider[1] + 1) * 256
            inside = wider[0] <= wider[1]
            out.append(some(s, first, F.when(inside, F.least(last, a - 1)).otherwise(last)))
            out.append(F.when(inside, some(s, F.greatest(first, b), last))
                       .otherwise(F.array().cast("array<struct<shift:int,blk:bigint>>")))
        wider = (first, last)
    return F.concat(*out)


def range_membership_join(points: DataFrame, groups: DataFrame, ip: str, ranges: str,
                          group_key: Sequence[str], point_key: Sequence[str] | None = None,
                          match: str = "last_octet", salt_buckets: int = 16) -> DataFrame:
    """Points whose address falls in any ``a.b.c.lo-a.b.c.hi`` range of a group.

    A group's overlapping ranges are merged first, so every (point, group)
    pair comes out once and nothing needs deduplicating after the join.
    ``match="last_octet"`` reproduces the source: only the fourth octet counts
    and a range is its octet values. ``match="full"`` compares the 32-bit
    address: a range is the aligned blocks that make it up, a point looks up
    the one block it lies in at each of the four octet boundaries. Both are
    equi-joins; no theta join is planned.

    Many points may share a key (there are only 256 octets): ``salt_buckets``
    spreads each key over that many tasks, the point side by a hash of the
    point (repeatable on retry), the group side copied once per bucket.
    """
    g = groups.select(*[F.col(c) for c in groups.columns], F.explode_outer(F.col(ranges)).alias("_rng"))
    lo_addr = F.get(F.split("_rng", "-"), 0)
    hi_addr = F.get(F.split("_rng", "-"), 1)
    keep = [c for c in groups.columns if c != ranges]
    rest = [c for c in keep if c not in group_key]
    if match == "last_octet":
        lo, hi = octet(lo_addr, 3).cast("bigint"), octet(hi_addr, 3).cast("bigint")
        blocks = F.transform(F.sequence("_lo", "_hi"), lambda x: F.struct(F.lit(0).alias("shift"), x.alias("blk")))
        number, shifts = octet(ip, 3).cast("bigint"), (0,)
    elif match == "full":
        lo, hi = address_number(lo_addr), address_number(hi_addr)
        blocks, number, shifts = _address_blocks(F.col("_lo"), F.col("_hi")), address_number(ip), _SHIFTS
    else:
        raise ValueError("match must be 'last_octet' or 'full'")
    g = g.select(*keep, lo.alias("_lo"), hi.alias("_hi")).where(F.col("_lo") <= F.col("_hi"))
    g = _merged_ranges(g, group_key, rest).select(*keep, F.inline(blocks).alias("shift", "blk"))
    # the address is parsed once, behind the generator, and looked up per boundary
    cols = points.columns
    p = points.select(*cols, F.inline(F.array(F.struct(number.alias("_num"))))).where(F.col("_num").isNotNull())
    p = p.select(*cols, F.inline(F.array(*[F.struct(F.lit(s).alias("shift"), F.shiftright("_num", s).alias("blk"))
                                           for s in shifts])))
    on = ["shift", "blk"]
    if salt_buckets > 1:
        p = p.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salt_buckets)))
        g = g.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)).cast("array<bigint>")))
        on.append("_salt")
    return p.join(g, on).drop(*on)


def in_any_range(ip: Column, ranges: Column) -> Column:
    """Row predicate form of the source UDF (O77): fourth octet inside any range."""
    o = octet(ip, 3)
    return F.exists(ranges, lambda r: o.between(octet(F.get(F.split(r, "-"), 0), 3),
                                                octet(F.get(F.split(r, "-"), 1), 3)))


# ---------------------------------------------------------------- pivot

def top_values(df: DataFrame, col: str, k: int) -> list:
    """The ``k`` most frequent values (count desc, value asc); ``k`` rows reach the driver."""
    rows = df.groupBy(col).count().orderBy(F.desc("count"), F.asc(col)).limit(k).collect()
    return [r[0] for r in rows]


def pivot_first(df: DataFrame, row_key: str, pivot_col: str, value: str, order: str,
                values: Sequence, default, names: Sequence[str] | None = None) -> DataFrame:
    """Pivot over a given value list, earliest ``value`` per cell, ``default`` when absent.

    ``first`` in the source is order-dependent; ``min_by(value, order)`` fixes
    the answer. Passing the value list saves the distinct-values job. The
    default is applied after the pivot: Spark aggregates per (row, pivot
    value) first, so a default inside the aggregate would never see the
    cells that have no rows.
    """
    names = list(names) if names else [str(v) for v in values]
    out = df.groupBy(row_key).pivot(pivot_col, list(values)).agg(F.min_by(F.col(value), F.col(order)))
    return out.select(row_key, *[F.coalesce(F.col(f"`{v}`"), F.lit(default)).alias(n)
                                 for v, n in zip(values, names)])


# ---------------------------------------------------------------- profiles

def numeric_summary(df: DataFrame, col: str) -> DataFrame:
    """count, mean, population stdev, max, min (O50, ``stats()`` in the source)."""
    c = F.col(col)
    return df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("stdev"),
                  F.max(c).alias("max"), F.min(c).alias("min"))


def value_histogram(df: DataFrame, col: str) -> DataFrame:
    """Value counts ordered by frequency then value (O51); stays distributed."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy("count", col)


def group_sizes(df: DataFrame, key: str) -> DataFrame:
    """Rows per key (O47, O52); a partial count per partition before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("size"))


def column_cardinality(df: DataFrame, cols: Sequence[str], approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Distinct count per column (O53); ``approx`` switches to HyperLogLog++.

    Several exact counts in one aggregate would copy every row once per
    column (Expand); here each column is counted from a scan of itself alone
    and the one-row results are put side by side.
    """
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(f"distinct_{c}") for c in cols])
    rows = None
    for c in cols:
        one = df.select(c).agg(F.count_distinct(c).alias("n")).select(F.lit(c).alias("c"), "n")
        rows = one if rows is None else rows.unionByName(one)
    return rows.agg(*[F.max(F.when(F.col("c") == c, F.col("n"))).alias(f"distinct_{c}") for c in cols])


def age_histogram(df: DataFrame, date_text: str, ref_year: int = fixed.AGE_REFERENCE_YEAR,
                  sentinel: int | None = None) -> DataFrame:
    """Age from the third ``-`` part of a date text.

    Only unparseable dates are left out. The source maps unknown dates to 1990
    and then drops every 1990, real ones too; ``sentinel`` does the same.
    """
    year = F.get(F.split(F.col(date_text), "-"), 2).try_cast("int")
    d = df.select(year.alias("_y")).where(F.col("_y").isNotNull())
    if sentinel is not None:
        d = d.where(F.col("_y") != sentinel)
    return d.select((F.lit(ref_year) - F.col("_y")).alias("age")).groupBy("age").agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------- counters

def observed_counters(df: DataFrame, metrics: dict[str, Column], name: str = "counters") -> dict:
    """Counters computed as a side effect of one pass (accumulators in the source).

    ``DataFrame.observe`` merges the partial values on the executors; only the
    final metric row reaches the driver. The pass is a ``noop`` write.

    Give it a frame read through its own session (``spark.newSession()``,
    same cluster) when the main session later scores models that keep a
    training summary: in Spark 4.1 registering an ``Observation`` leaves the
    session unserialisable, and such models capture the session in their
    scoring closures.
    """
    obs = Observation(name)
    observed = df.observe(obs, *[m.alias(k) for k, m in metrics.items()])
    observed.write.format("noop").mode("overwrite").save()
    return obs.get


# ---------------------------------------------------------------- ranking

def top_per_group(df: DataFrame, key: str, order: Sequence[Column], k: int, rank_name: str = "rank") -> DataFrame:
    """First ``k`` rows per key (O65). ``row_number() <= k`` is planned with a
    partial ``WindowGroupLimit`` before the shuffle, so a hot key sends at
    most ``k`` rows per map partition."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= k)


def composite_sort(df: DataFrame, first: str, second: str, *tiebreak: str) -> DataFrame:
    """Ascending by first then second (O62); no overflow, unlike an int-subtracting comparator."""
    return df.orderBy(first, second, *tiebreak)
