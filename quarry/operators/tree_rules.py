"""A fitted decision tree as one column expression (inventory O102, O104).

The nodes of the tree, the category codes of the fitted indexer and the label
texts are written out as a nested ``CASE``; the text can be stored, read by
people, and scored by any Spark SQL, without the model, its runtime or a
feature vector. It runs in generated code like any other column.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Rules(NamedTuple):
    """``label`` and ``index``: expressions for the predicted label text and its number; size of the tree."""

    label: str
    index: str
    depth: int
    nodes: int


def _name(col: str) -> str:
    return "`" + col.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(x: float) -> str:
    return f"{x!r}D" if x == x and abs(x) != float("inf") else f"double('{x}')"


def _test(split, cols: Sequence[str], categories: dict[int, dict[float, int]]) -> str:
    """The condition under which a row goes left."""
    i = split.featureIndex()
    col = f"CAST({_name(cols[i])} AS DOUBLE)"
    if split.getClass().getSimpleName() == "CategoricalSplit":
        left = {int(c) for c in split.leftCategories()}
        known = categories[i]
        goes = [v for v, code in known.items() if code in left]
        test = f"{col} IN ({', '.join(_number(v) for v in sorted(goes))})" if goes else "FALSE"
        n, unseen = split.numCategories(), len(known)  # ``unseen`` is the code of values that the fit did not see
        # a split keeps the smaller of its two sides: a code beyond its range is then on the other one
        if unseen in left or (unseen >= n and len(left) > n // 2):
            every = ", ".join(_number(v) for v in sorted(known))
            test = f"({test} OR {col} NOT IN ({every}))"
        return test
    return f"{col} <= {_number(split.threshold())}"


def compile_tree(model: PipelineModel, feature_cols: Sequence[str]) -> Rules:
    """The rules of a ``fit_tree`` model. A row with a missing or NaN feature has a null prediction, as in
    ``predict_rows``."""
    indexer, _, vectors, tree, back = model.stages
    maps = vectors._java_obj.javaCategoryMaps()
    categories = {int(k): {float(v): int(c) for v, c in dict(maps[k]).items()} for k in maps}
    size = [0, 0]

    def write(node, depth: int, leaf) -> str:
        size[0], size[1] = max(size[0], depth), size[1] + 1
        if node.getClass().getSimpleName() == "LeafNode":
            return leaf(int(node.prediction()))
        test = _test(node.split(), feature_cols, categories)
        return f"CASE WHEN {test} THEN {write(node.leftChild(), depth + 1, leaf)} " \
               f"ELSE {write(node.rightChild(), depth + 1, leaf)} END"

    root = tree._java_obj.rootNode()
    labels = back.getLabels()
    index = write(root, 0, lambda p: f"{p}D")
    depth, nodes = size
    label = write(root, 0, lambda p: _text(labels[p]) if p < len(labels) else "NULL")
    whole = " AND ".join(f"NOT isnan(CAST({_name(c)} AS DOUBLE)) AND {_name(c)} IS NOT NULL" for c in feature_cols)
    return Rules(*(f"CASE WHEN {whole} THEN {x} END" for x in (label, index)), depth, nodes)


def save_rules(spark: SparkSession, rules: Rules, path: str) -> None:
    """One line of text each: label, index, depth, nodes."""
    lines = spark.createDataFrame([(i, str(v)) for i, v in enumerate(rules)], "i int, value string")
    lines.coalesce(1).write.mode("overwrite").json(path)


def load_rules(spark: SparkSession, path: str) -> Rules:
    label, index, depth, nodes = (r["value"] for r in spark.read.schema("i int, value string").json(path)
                                  .orderBy("i").collect())
    return Rules(label, index, int(depth), int(nodes))


def score_rules(df: DataFrame, rules: Rules, label: str = "predictedLabel", index: str = "prediction") -> DataFrame:
    """Every row with its predicted number and label text."""
    return df.select("*", F.expr(rules.index).cast("double").alias(index), F.expr(rules.label).cast("string").alias(label))
