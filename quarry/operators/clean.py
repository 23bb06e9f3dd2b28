"""Message cleaning: parse-or-reject, defaults, substring routing, first-seen
keys, nested-document flattening (inventory O23, O27-O35, O60, O73-O74).

Each function maps a DataFrame to a DataFrame, so the same code runs in a
batch job and inside a streaming plan or ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import col_of, map_field_or_default
from quarry.operators.tables import keep_first

MAP_TYPE = "map<string,string>"


def exclude_substring(df: DataFrame, needle: str, value: str = "value") -> DataFrame:
    """Drop raw messages containing ``needle`` before parsing."""
    return df.where(~F.col(value).contains(needle))


def parse_json_map(df: DataFrame, value: str = "value", out: str = "_m") -> DataFrame:
    """Parse each message to a string map.

    ``from_json`` with a map type gives null for malformed text and for
    top-level arrays or scalars, so a null map is the reject test. Numbers and
    nested objects arrive as their JSON text, which suits all-string rows. The
    parse stands behind a one-row generator: filters on its result stay above
    it, so Catalyst does not copy the parser into them.
    """
    return df.select("*", F.inline(F.array(F.struct(F.from_json(F.col(value), MAP_TYPE).alias(out)))))


def split_rejects(parsed: DataFrame, m: str = "_m") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) halves of a parsed frame."""
    return parsed.where(F.col(m).isNotNull()), parsed.where(F.col(m).isNull()).drop(m)


def fields_with_defaults(m: Column, fields: Sequence[str], defaults: dict[str, str] | None = None,
                         default: str = "0") -> list[Column]:
    """One column per field: the map value, or the default when the key is
    absent (O29). A JSON null that is present stays null."""
    defaults = defaults or {}
    return [map_field_or_default(m, f, defaults.get(f, default)).alias(f) for f in fields]


def clean_flagged(df: DataFrame, fields: Sequence[str], value: str = "value",
                  exclude: str | None = None, typed: dict[str, str] | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """One pass over raw messages: ``keep`` columns, the fields with defaults
    (typed where asked), the raw ``value`` and a ``_rejected`` flag (malformed
    JSON, or a typed field that does not convert). Rows and rejects are two
    filters of this frame, so a caller can persist it once and parse once."""
    if exclude:
        df = exclude_substring(df, exclude, value)
    parsed = parse_json_map(df, value)
    raw = parsed.select(*[F.col(k) for k in keep], F.col(value),
                        F.col("_m").isNull().alias("_bad_json"),
                        *fields_with_defaults(F.col("_m"), fields))
    bad = F.col("_bad_json")
    conv = {f: F.col(f).try_cast(t) for f, t in (typed or {}).items()}
    for f, c in conv.items():
        bad = bad | (F.col(f).isNotNull() & c.isNull())
    return raw.select(*[F.col(k) for k in keep], F.col(value), bad.alias("_rejected"),
                      *[conv.get(f, F.col(f)).alias(f) for f in fields])


def split_flagged(flagged: DataFrame, fields: Sequence[str], value: str = "value",
                  keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a ``clean_flagged`` frame."""
    rows = flagged.where(~F.col("_rejected")).select(*[F.col(k) for k in keep], *[F.col(f) for f in fields])
    rejects = flagged.where(F.col("_rejected")).select(*[F.col(k) for k in keep], F.col(value))
    return rows, rejects


def clean_messages(df: DataFrame, fields: Sequence[str], value: str = "value",
                   exclude: str | None = None, typed: dict[str, str] | None = None,
                   keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Raw messages to (rows, rejects): optional substring exclusion, JSON
    parse, per-field defaults, optional typed fields by ``try_cast``.

    A typed field that does not convert sends the row to the rejects (the
    socket job threw on it). ``keep`` carries extra input columns through.
    """
    flagged = clean_flagged(df, fields, value, exclude, typed, keep)
    return split_flagged(flagged, fields, value, keep)


def first_seen(batch: DataFrame, registry: DataFrame, key: Sequence[str], order: Sequence[str | Column],
               reject_default: str | None = None) -> DataFrame:
    """Rows whose key was never seen before.

    The first row per key inside the batch is kept (``min_by`` on ``order``,
    partially aggregated), then keys already in the registry are removed with
    a ``left_anti`` join. Check-and-set is one set operation, so parallel
    duplicates cannot both pass. ``reject_default`` drops rows whose key is
    the default value of a missing field.
    """
    if reject_default is not None:
        batch = batch.where(F.col(key[0]) != reject_default)
    firsts = keep_first(batch, key, order)
    return firsts.join(registry.select(*key), list(key), "left_anti")


def first_seen_flagged(rows: DataFrame, known: Column, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``first_seen`` when registered and new rows stand in one frame, told
    apart by ``known``: a key with a registered row is dropped, any other keeps
    its first row. One aggregate, one pass."""
    rest = [c for c in rows.columns if c not in key]
    ord_struct = F.struct(*[col_of(c) for c in order])
    best = rows.withColumn("_known", known).groupBy(*key).agg(
        F.max("_known").alias("_known"), F.min_by(F.struct(*[F.col(c) for c in rest]), ord_struct).alias("_row"))
    return (best.where(~F.col("_known"))
            .select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*rows.columns))


def flatten_company_nodes(docs: DataFrame, label: str = "Company") -> DataFrame:
    """Nested graph documents to distinct (node_id, name) of ``label`` nodes.

    Projects ``content.data.nodes.{id, properties.name, labels}`` as three
    arrays (O23), drops documents without them (O30), zips them so the three
    stay aligned within each document (O39, H2), explodes with the position
    (O60, O73), takes the first label (null when the list is empty, O74),
    keeps ``label`` nodes (O31) and removes duplicates (O45).
    """
    d = docs.select(F.col("content.data.nodes.id").alias("ids"),
                    F.col("content.data.nodes.properties.name").alias("names"),
                    F.col("content.data.nodes.labels").alias("labels"))
    d = d.where(F.col("ids").isNotNull() & F.col("names").isNotNull() & F.col("labels").isNotNull())
    z = d.select(F.posexplode(F.arrays_zip("ids", "names", "labels")).alias("pos", "n"))
    nodes = z.select("pos", F.col("n.ids").alias("node_id"), F.col("n.names").alias("name"),
                     F.get(F.col("n.labels"), 0).alias("first_label"))
    return nodes.where(F.col("first_label") == label).select("node_id", "name").distinct()
