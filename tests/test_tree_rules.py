import random

import pytest

from quarry.operators import learn as L
from quarry.operators import tree_rules as TR


def records(spark, n, seed, extra=()):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.uniform(-5, 5), float(rng.choice([-1, 0, 2])), rng.choice([0.1, 0.25, 3.0, 1e-9])
        flag = "it's" if a > 1 and b == 2 else ("back\\slash" if b == -1 and c > 0.2 else "plain")
        rows.append((i, a, b, c, flag if rng.random() < 0.9 else "noise"))
    return spark.createDataFrame(rows + list(extra), "id int, f0 double, `f.1` double, f2 double, flag string")


@pytest.mark.parametrize("seed,cats", [(1, 4), (2, 2)])
def test_rules_equal_the_model_on_every_row(spark, seed, cats, tmp_path):
    odd = [(9000, None, 2.0, 0.1, "plain"), (9001, float("nan"), 2.0, 0.1, "plain"), (9002, 1.0, None, 0.1, "x"),
           (9003, 1.0, 77.0, 0.1, "plain"), (9004, 1.0, 2.0, -55.5, "plain"), (9005, -0.0, 0.0, 0.1, None)]
    df = records(spark, 600, seed, odd).withColumnRenamed("f.1", "f1")
    cols = ["f0", "f1", "f2"]
    model = L.fit_tree(df.where("id < 9000"), cols, "flag", max_categories=cats)
    rules = TR.compile_tree(model, cols)
    tree = model.stages[3]
    assert (rules.depth, rules.nodes) == (tree.depth, tree.numNodes)
    path = f"file://{tmp_path}/rules"
    TR.save_rules(spark, rules, path)
    assert TR.load_rules(spark, path) == rules
    both = TR.score_rules(L.predict_rows(model, df.select("id", *cols), cols), rules, "text", "number").collect()
    assert len(both) == 606
    for r in both:
        assert (r.text, r.number) == (r.predictedLabel, r.prediction), r
    assert {r.id for r in both if r.text is None} == {9000, 9001, 9002}


def test_single_leaf_and_empty_table(spark):
    df = spark.createDataFrame([(float(i), "one") for i in range(9)], "x double, flag string")
    rules = TR.compile_tree(L.fit_tree(df, ["x"], "flag"), ["x"])
    assert (rules.depth, rules.nodes) == (0, 1)
    assert {r.predictedLabel for r in TR.score_rules(df, rules).collect()} == {"one"}
    assert TR.score_rules(df.limit(0), rules).collect() == []
