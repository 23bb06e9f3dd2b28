"""A training-data pipeline of five stages over ``documents``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that
the stage before kept. Its result is written to the shared folder as Parquet
and read back as the next stage's input, so a lost executor never repeats an
earlier stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm._shared import keep_texts, materialise, read, remainder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document whose best language scores less than this is taken as no known language. With five languages or fewer
#: no score is that low; texts in a language that was not learned fail by ``KernelLanguageModel.judge``.
LEAST_LANGUAGE_SCORE = 0.2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the attention model predicts to be of good quality."""
    from quarry.llm.attention_quality import THRESHOLD, fit_quality

    model = fit_quality(docs, read(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return keep_texts(docs.select(*COLUMNS), lambda texts: model.score(texts) >= THRESHOLD)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that are in one of the learned languages."""
    from quarry.llm.kernel_langid import UNKNOWN, fit_language

    model = fit_language(docs, remainder("doc_id", 4) != 2)

    def known(texts):
        pred, score, known = model.value.judge(texts)
        return [p != UNKNOWN and k and s >= LEAST_LANGUAGE_SCORE for p, s, k in zip(pred, score, known)]

    return keep_texts(docs.select(*COLUMNS), known)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group, the one with the smallest id; rows without an id come after all others.

    Rows are told apart by id and text hash, so rows that share an id are judged each by its own text.
    """
    from quarry.llm.bayes_jaccard import jaccard_classes

    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                   F.xxhash64(F.lit(1), "text").alias("h1"), F.xxhash64(F.lit(2), "text").alias("h2"))
    docs = docs.select(*COLUMNS, row.alias("_row"))
    classes = jaccard_classes(docs.select(F.col("_row").alias("doc_id"), "text"))
    first = classes.where("kept").select(F.col("doc_id").alias("_row")).distinct()
    nth = F.row_number().over(Window.partitionBy("_row").orderBy("lang", "source", "n_chars"))
    kept = docs.join(first.hint("merge"), "_row", "left_semi").withColumn("_r", nth).where("_r = 1")
    return kept.select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated 200-byte strings out of the texts."""
    from quarry.llm.suffix_dedup import remove_repeats

    out = remove_repeats(docs.select(*COLUMNS), as_text=True)
    return out.select("doc_id", F.col("kept").alias("text"), "lang", "source",
                      F.length("kept").cast(docs.schema["n_chars"].dataType).alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 1024 tokens."""
    from quarry.llm.best_fit_packing import pack

    return pack(docs)


STAGES = [("quality classifier", quality), ("language ID", language), ("n-gram Jaccard join", near_duplicates),
          ("suffix-array dedup", repeats), ("best-fit packing", packing)]

#: SQL can express none of the learned stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
