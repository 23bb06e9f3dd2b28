"""Scans and sinks (inventory O01-O05, O10-O15, O17-O21, O99).

Connector formats (search index, document store) go through the same two
calls, ``read_table`` / ``write_table``; when the connector jar is absent the
caller passes ``fmt="parquet"`` and a path, and the job code is unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import shared_path, table_path


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied tables (parquet, schema from the file). Splits are
    left to the files' row groups and ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(table_path(sf_dir, name))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for frames that
    several passes read (a model fit, several aggregates). Unlike a cache it
    leaves nothing behind in the session and survives a lost executor."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of the file system that holds it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_table(spark: SparkSession, fmt: str, path: str | None = None,
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Generic connector scan: ``spark.read.format(fmt).options(**o).load(path)``."""
    r = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        r = r.schema(schema)
    return r.load(path) if path is not None else r.load()


def write_table(df: DataFrame, fmt: str, path: str | None = None, mode: str = "append",
                partitions: int | None = None, partition_by: Sequence[str] | None = None,
                **options) -> None:
    """Generic connector sink; ``partitions`` fixes the file count."""
    if partitions:
        df = df.repartition(partitions)
    w = df.write.format(fmt).mode(mode).options(**{k: str(v) for k, v in options.items()})
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path is None:
        w.save()
    else:
        w.save(path)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text-line scan with glob paths (O01); one row per line in ``value``."""
    return spark.read.text(path if isinstance(path, str) else list(path))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON-lines scan (O02); schema inferred unless given (give it in production)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def ordinal_scan(df: DataFrame, ordinals: Sequence[int]) -> DataFrame:
    """Project columns by position (O05); an ordinal out of range is an error."""
    n = len(df.columns)
    bad = [i for i in ordinals if i < 0 or i >= n]
    if bad:
        raise IndexError(f"column ordinals {bad} out of range for {n} columns")
    return df.select(*[F.col(f"`{df.columns[i]}`") for i in ordinals])


def split_fields(line: Column, sep_regex: str, n: int, names: Sequence[str]) -> list[Column]:
    """First ``n`` fields of a delimited line (O33); missing fields are null."""
    parts = F.split(line, sep_regex)
    return [F.get(parts, i).alias(names[i]) for i in range(n)]


def named_documents(lines: DataFrame) -> DataFrame:
    """``name.txt<TAB>content`` lines to (name, content).

    The separator is the regex ``.txt\\t`` with an unescaped dot, so any
    character before ``txt`` matches, as in the source job.
    """
    parts = F.split(F.col("value"), ".txt\t", 2)
    return lines.select(F.get(parts, 0).alias("name"), F.get(parts, 1).alias("content"))


def export_csv(df: DataFrame, path: str, files: int | None = None, rows_per_file: int = 5_000_000) -> None:
    """CSV with header, overwrite (O12). Files follow the data, at most
    ``rows_per_file`` rows each; ``files`` fixes their number instead."""
    write_table(df, "csv", path, mode="overwrite", partitions=files, header="true", maxRecordsPerFile=rows_per_file)


def export_parquet(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite",
                   rows_per_file: int = 5_000_000) -> None:
    """Columnar write (O10, O11), files as in ``export_csv``."""
    write_table(df, "parquet", path, mode=mode, partitions=files, maxRecordsPerFile=rows_per_file)


def read_mail_corpus(spark: SparkSession, root_glob: str, index: DataFrame,
                     charset: str = "GBK") -> DataFrame:
    """Whole-file mail corpus (O18): one row per file, lines joined with no
    separator, label from the index (O19) by a left join; a file missing from
    the index gets the label text ``null``.

    Returns (folder, key, label, text). UTF-8 is decoded by Spark, other
    charsets in an Arrow UDF; bytes that do not decode become U+FFFD either way.
    """
    @F.pandas_udf(T.StringType())
    def _legacy(b: pd.Series) -> pd.Series:
        return b.map(lambda x: None if x is None else bytes(x).decode(charset, errors="replace"))

    utf8 = charset.upper() in ("UTF-8", "UTF8")
    text = without_breaks(F.make_valid_utf8(F.col("content").cast("string")) if utf8 else _legacy("content"))
    files = (spark.read.format("binaryFile").load(root_glob)
             .select("path", "content"))
    parts = F.split(F.col("path"), "/")
    n = F.size(parts)
    files = files.select(
        F.element_at(parts, n - 1).alias("folder"),
        F.concat_ws("_", F.element_at(parts, n - 1), F.element_at(parts, n)).alias("key"),
        text.alias("text"))
    return (files.join(index, "key", "left")
            .select("folder", "key", F.coalesce(F.col("label"), F.lit("null")).alias("label"), "text"))


def without_breaks(text: Column) -> Column:
    return F.regexp_replace(text, "\\r\\n|\\n|\\r", "")


def decoded(raw: Column, charset: str) -> Column:
    """Bytes to text with Spark's own decoder, line breaks removed; for the
    charsets it knows (UTF-8, UTF-16, ISO-8859-1, US-ASCII)."""
    return without_breaks(F.decode(raw, charset))


def label_lines(mails: DataFrame, index: DataFrame) -> DataFrame:
    """(key, label, line): mails joined to their index by key, ``label:text``; the
    label of a mail that is not in the index is the text ``null`` (O18)."""
    label = F.coalesce(F.col("label"), F.lit("null"))
    return mails.join(index, "key", "left").select("key", label.alias("label"),
                                                   F.concat_ws(":", label, "text").alias("line"))


def parse_mail_index(lines: DataFrame) -> DataFrame:
    """Index line ``spam ../data/000/001`` to (key ``000_001``, label 1/0)."""
    tok = F.split(F.col("value"), " ")
    path = F.split(F.get(tok, 1), "/")
    return lines.select(
        F.concat_ws("_", F.get(path, 2), F.get(path, 3)).alias("key"),
        F.when(F.lower(F.get(tok, 0)) == "spam", F.lit("1")).otherwise(F.lit("0")).alias("label"))


def write_mail_corpus(df: DataFrame, out_dir: str) -> None:
    """One output folder per input folder with ``label:text`` lines."""
    (df.select("folder", F.concat_ws(":", "label", "text").alias("value"))
       .write.mode("overwrite").partitionBy("folder").text(out_dir))
