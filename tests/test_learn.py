import tempfile

from pyspark.sql import functions as F

from quarry.operators import learn as L


def _docs(spark):
    en = ["the cat sat on the mat", "a dog and a cat", "the mat was red", "dogs and cats play"]
    fr = ["le chat est sur le tapis", "un chien et un chat", "le tapis rouge", "les chiens jouent"]
    rows = [(i, t, "en") for i, t in enumerate(en * 5)] + [(100 + i, t, "fr") for i, t in enumerate(fr * 5)]
    return spark.createDataFrame(rows, "doc_id int, text string, lang string").withColumn(
        "label", F.when(F.col("lang") == "fr", 1.0).otherwise(0.0))


def test_text_classifiers_and_save_load(spark):
    d = _docs(spark)
    for kind in ("nb", "lr"):
        m = L.text_classifier(kind, num_features=256).fit(d)
        pred = m.transform(d)
        assert L.evaluate(pred, "label") > 0.95
        acc = L.accuracy(pred, "label", "prediction").first()
        assert acc.n == 40 and acc.accuracy > 0.95
        path = tempfile.mkdtemp(prefix="quarry-model-") + "/m"
        L.save(m, path)
        again = L.load(path).transform(d).select("doc_id", "prediction")
        assert sorted(again.collect()) == sorted(pred.select("doc_id", "prediction").collect())


def test_tree_pipeline_iris_like(spark):
    rows = []
    for i in range(60):
        lab = ["setosa", "versicolor", "virginica"][i % 3]
        base = {"setosa": 1.0, "versicolor": 4.0, "virginica": 6.0}[lab]
        rows.append((f"{base + (i % 5) * 0.1},{3.0},{base * 0.8},{0.2 * base},{lab}",))
    rows.append(("",))
    rows.append(("1,2,3,4",))
    lines = spark.createDataFrame(rows, "value string")
    parts = F.split("value", ",")
    rec = lines.where(F.size(parts) == 5).select(*[F.get(parts, i).cast("double").alias(f"f{i}") for i in range(4)],
                                                  F.get(parts, 4).alias("label"))
    assert rec.count() == 60
    m = L.fit_tree(rec, ["f0", "f1", "f2", "f3"], "label")
    pred = m.transform(rec)
    assert pred.where(F.col("predictedLabel") == F.col("label")).count() == 60
    one = spark.createDataFrame([(1.2, 3.0, 0.8, 0.2)], "f0 double, f1 double, f2 double, f3 double")
    assert m.transform(one.withColumn("label", F.lit("setosa"))).first().predictedLabel == "setosa"
    assert "DecisionTreeClassificationModel" in m.stages[3].toDebugString
    assert "maxDepth" in m.stages[3].explainParams() and m.stages[3].getOrDefault("impurity") == "gini"


def test_kmeans_and_purity(spark):
    d = _docs(spark)
    m = L.kmeans_estimator("text", k=2, seed=1, num_features=256).fit(d)
    assert L.within_set_sse(m) >= 0
    pred = m.transform(d).select(F.when(F.col("lang") == "fr", 1).otherwise(0).alias("cls"), "prediction")
    purity = L.cluster_purity(pred, "cls", "prediction")
    assert purity.count() == 2
    overall = L.overall_purity(purity).first().rate
    assert 0.5 <= overall <= 1.0


def test_partition_by_first_char(spark):
    df = spark.createDataFrame([("a1",), ("a2",), ("b1",), ("c9",)], "name string")
    parts = L.partition_by_first_char(df, "name", 3).rdd.glom().collect()
    by_char = {}
    for i, rows in enumerate(parts):
        for r in rows:
            by_char.setdefault(r.name[0], set()).add(i)
    assert all(len(v) == 1 for v in by_char.values())


def test_train_test_split(spark):
    df = spark.range(2000)
    tr, te = L.train_test_split(df, "id")
    assert tr.count() + te.count() == 2000 and 1200 < tr.count() < 1600
    assert sorted(r.id for r in tr.collect()) == sorted(r.id for r in L.train_test_split(df, "id")[0].collect())
    a, b = L.train_test_split(df, seed=7)
    assert a.count() + b.count() == 2000


def test_features_are_dealt_by_size(spark, monkeypatch):
    """Twelve cores used to mean twelve tasks, however much text there was."""
    monkeypatch.setattr(L, "TASK_BYTES", 100, raising=False)
    df = spark.createDataFrame([("some words of text " * 3,)] * 200, "text string")
    out = L.cluster_features(df, num_features=16)
    assert out.rdd.getNumPartitions() >= 100 and out.count() == 200
