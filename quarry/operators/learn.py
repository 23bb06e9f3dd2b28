"""Learners and evaluators on ``pyspark.ml`` (inventory O57, O85-O104).

Each model is one ``Pipeline`` fitted once; the fitted pipeline carries its
own IDF and feature width, so training and scoring cannot disagree (H7).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (HashingTF, IDF, IndexToString, SQLTransformer, StringIndexer, Tokenizer,
                                VectorAssembler, VectorIndexer)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import fixed
from quarry.operators.text import WORD_PATTERN

#: Texts are dealt to so many tasks that each has about so many bytes.
TASK_BYTES = 64 << 20


def text_features(text_col: str = "text", num_features: int = fixed.LR_FEATURES, raw_tokens: bool = False) -> list:
    """Tokens -> hashed term frequencies -> IDF.

    The token stage is a ``SQLTransformer`` over ``regexp_extract_all``, so
    it runs in generated code and is saved with the model; ``raw_tokens``
    uses the whitespace ``Tokenizer`` for pre-spaced text instead.
    """
    if raw_tokens:
        tok = Tokenizer(inputCol=text_col, outputCol="words")
    else:
        pat = WORD_PATTERN.replace("\\", "\\\\")
        tok = SQLTransformer(statement=f"SELECT *, regexp_extract_all(lower(`{text_col}`), '{pat}', 0) AS words "
                                       "FROM __THIS__")
    return [tok, HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features),
            IDF(inputCol="tf", outputCol="features")]


def text_classifier(kind: str, label_col: str = "label", text_col: str = "text",
                    num_features: int = fixed.LR_FEATURES, smoothing: float = fixed.NB_SMOOTHING,
                    max_iter: int = 100) -> Pipeline:
    """Text classification pipeline: ``nb`` multinomial naive Bayes (O92) or
    ``lr`` multinomial logistic regression by L-BFGS (O93)."""
    if kind == "nb":
        model = NaiveBayes(smoothing=smoothing, modelType="multinomial", labelCol=label_col)
    elif kind == "lr":
        model = LogisticRegression(family="multinomial", maxIter=max_iter, labelCol=label_col)
    else:
        raise ValueError("kind must be 'nb' or 'lr'")
    return Pipeline(stages=[*text_features(text_col, num_features), model])


def fit_tree(df: DataFrame, feature_cols: Sequence[str], label_col: str, max_depth: int = fixed.TREE_DEPTH,
             max_categories: int = 4) -> PipelineModel:
    """String label indexer, vector assembler, categorical indexer, gini tree
    (O100-O102), fitted; then a converter from the predicted index back to
    the label text, made from the fitted indexer's labels (O100). A row with a
    missing or non-finite feature cannot be learnt from and is left out of the
    fit; ``predict_rows`` keeps it."""
    li = StringIndexer(inputCol=label_col, outputCol="indexedLabel", handleInvalid="keep")
    va = VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="skip")
    vi = VectorIndexer(inputCol="features", outputCol="indexedFeatures", maxCategories=max_categories,
                       handleInvalid="keep")
    dt = DecisionTreeClassifier(labelCol="indexedLabel", featuresCol="indexedFeatures", impurity="gini",
                                maxDepth=max_depth)
    fitted = Pipeline(stages=[li, va, vi, dt]).fit(df)
    back = IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=fitted.stages[0].labels)
    return PipelineModel(stages=[*fitted.stages, back])


def predict_rows(model: PipelineModel, df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """Every row of ``df`` with its predictions; a row with a missing or
    non-finite feature keeps its place with null predictions."""
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in feature_cols])
    scored = model.transform(df.where(ok))
    return scored.unionByName(df.where(~F.coalesce(ok, F.lit(False))), allowMissingColumns=True)


def cluster_features(df: DataFrame, text_col: str = "text", num_features: int = fixed.KMEANS_FEATURES) -> DataFrame:
    """``df`` with its TF-IDF vectors in ``features`` (O96), dealt evenly: a fit reads them in every iteration, and a
    file of one row group would leave all of it to one task. A task is dealt about ``TASK_BYTES`` of text."""
    text = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    even = df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-text // TASK_BYTES)))
    return Pipeline(stages=text_features(text_col, num_features)).fit(even).transform(even)


def kmeans(k: int = fixed.KMEANS_K, seed: int = fixed.KMEANS_SEED) -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol="features")


def kmeans_estimator(text_col: str = "text", k: int = fixed.KMEANS_K, seed: int = fixed.KMEANS_SEED,
                     num_features: int = fixed.KMEANS_FEATURES) -> Pipeline:
    """TF-IDF then k-means with a fixed seed (O96), as one pipeline that can be saved."""
    return Pipeline(stages=[*text_features(text_col, num_features), kmeans(k, seed)])


def within_set_sse(model: PipelineModel) -> float:
    """Within-set sum of squared errors (O97); ``computeCost`` is gone in 4.x."""
    return model.stages[-1].summary.trainingCost


def evaluate(pred: DataFrame, label_col: str, metric: str = "accuracy", prediction_col: str = "prediction") -> float:
    """Evaluator with the metric named explicitly (O103)."""
    return MulticlassClassificationEvaluator(labelCol=label_col, predictionCol=prediction_col,
                                             metricName=metric).evaluate(pred)


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Equal predictions over rows (O95) as one aggregate row."""
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def cluster_purity(df: DataFrame, cls: str, pred: str) -> DataFrame:
    """Per class: count of the most common (class - prediction) offset, the
    class size, and their ratio (O57). Two small aggregations, no per-class
    partitioning of rows."""
    off = df.select(cls, (F.col(cls) - F.col(pred)).alias("offset"))
    counts = off.groupBy(cls, "offset").agg(F.count(F.lit(1)).alias("c"))
    return (counts.groupBy(cls).agg(F.max("c").alias("best"), F.sum("c").alias("total"))
            .withColumn("rate", F.col("best") / F.col("total")))


def train_test_split(df: DataFrame, id_col: str | None = None, train_fraction: float = fixed.TRAIN_FRACTION,
                     seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Train / test split (O90). With ``id_col``, a hash of the id decides, so
    a rerun or a recomputed partition gives the same split; without it,
    ``randomSplit`` with a seed (repeatable only over the same partitioning)."""
    if id_col is not None:
        percent = int(round(train_fraction * 100))
        train = F.pmod(F.xxhash64(F.col(id_col)), F.lit(100)) < percent
        return df.where(train), df.where(~train)
    a, b = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return a, b


def partition_by_first_char(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Key-derived partitioner: rows whose ``key`` starts with the same
    character share a partition (O98). With few distinct first characters
    this concentrates rows in few tasks, so per-class counting uses
    ``cluster_purity``'s aggregation instead; this is for co-locating output."""
    return df.repartition(partitions, F.substring(F.col(key), 1, 1))


def overall_purity(per_class: DataFrame) -> DataFrame:
    return per_class.agg((F.sum("best") / F.sum("total")).alias("rate"))


def save(model: PipelineModel, path: str) -> None:
    """Model save."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
