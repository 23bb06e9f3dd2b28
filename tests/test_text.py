import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.functions.columns import split_words
from quarry.operators import text as X


def test_split_words_jvm_rules(spark):
    df = spark.createDataFrame([("a b",), ("",), ("   ",), ("a  b ",), (" a",)], "line string")
    got = [r.w for r in df.select(split_words(F.col("line")).alias("w")).collect()]
    assert got == [["a", "b"], [""], [], ["a", "", "b"], ["", "a"]]


def test_word_count_over_lines(spark):
    df = spark.createDataFrame([("a b\nb c\n",), ("b\n\nc",)], "text string")
    counts = {r.word: r["count"] for r in X.word_count(X.words(X.text_lines(df))).collect()}
    assert counts == {"a": 1, "b": 3, "c": 2, "": 1}


def test_tokens_phrases_and_stop_words(spark):
    df = spark.createDataFrame([("The Big Data and big-data, 数据 ok",)], "text string")
    toks = df.select(X.tokens("text", phrases=["big data"]).alias("t")).first().t
    assert toks == ["bigdata", "big", "data", "数", "据", "ok"]  # blanks inside a token go


def test_tfidf_matches_formula(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b"]), (3, [])], "doc_id int, toks array<string>")
    tf = X.term_counts(docs, "doc_id", "toks")
    out = {(r.doc_id, r.term): r.tfidf for r in X.tfidf(tf, "doc_id", 3).collect()}
    assert math.isclose(out[(1, "a")], 2 * math.log(4 / 2))
    assert math.isclose(out[(1, "b")], 1 * math.log(4 / 3))


def test_exact_naive_bayes_equals_pyspark_ml(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer, StringIndexer

    rows = [(1, "en", "the cat sat on the mat"), (2, "en", "a cat and a dog"), (3, "fr", "le chat et le chien"),
            (4, "fr", "le chat sur le tapis"), (5, "de", "die katze und der hund"), (6, "de", "der hund"),
            (7, "en", "dog on mat"), (8, "fr", "chien chat"), (9, "de", "katze katze hund"), (10, "en", "the dog and a mat")]
    df = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    tok = df.select("doc_id", "lang", X.tokens("text", stop_words=None).alias("toks"))
    train, test = tok.where("doc_id <= 6"), tok.where("doc_id > 6")
    tf = X.term_counts(tok, "doc_id", "toks")
    model = X.ExactNaiveBayes(1.0).fit(tf.join(train.select("doc_id"), "doc_id", "left_semi"),
                                       train.select("doc_id", "lang"), "doc_id", "lang")
    ours = {r.doc_id: r.prediction for r in
            model.predict(tf.join(test.select("doc_id"), "doc_id", "left_semi"), test.select("doc_id", "lang"),
                          "doc_id").collect()}
    cv = CountVectorizer(inputCol="toks", outputCol="features").fit(train)
    si = StringIndexer(inputCol="lang", outputCol="label").fit(train)
    nb = NaiveBayes(smoothing=1.0, modelType="multinomial").fit(si.transform(cv.transform(train)))
    pred = nb.transform(cv.transform(test))
    labels = si.labels
    ref = {r.doc_id: labels[int(r.prediction)] for r in pred.collect()}
    assert ours == ref


def test_hash_split_is_repeatable(spark):
    df = spark.range(1000)
    a = df.where(X.hash_split("id")).count()
    assert a == df.where(X.hash_split("id")).count()
    assert 600 < a < 800


@pytest.mark.parametrize("hot_terms", [1, 4, 50_000])
def test_exact_naive_bayes_shuffles_only_rare_terms(spark, monkeypatch, hot_terms):
    rows = [(1, "en", "the cat the dog the"), (2, "fr", "le chat le chien"), (3, "en", "dog dog cat xyz"),
            (4, None, "the the cat le"), (5, None, "le chien xyz unseen"), (6, None, "")]
    toks = (spark.createDataFrame(rows, "doc_id int, lang string, text string")
            .select("doc_id", "lang", F.explode_outer(F.split("text", " ")).alias("term")).where("term <> ''")
            .withColumn("tf", F.lit(1)))  # occurrences, not counts, with their label
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id int, lang string")
    monkeypatch.setattr(X.ExactNaiveBayes, "HOT_TERMS", hot_terms)
    lam = 0.5
    model = X.ExactNaiveBayes(lam).fit(toks.where("doc_id <= 3"), docs.where("doc_id <= 3"), "doc_id", "lang")
    got = {r.doc_id: r.prediction for r in model.predict(toks.where("doc_id > 3").drop("lang"), docs.where("doc_id > 3"), "doc_id").collect()}
    known = Counter(), {"en": Counter(), "fr": Counter()}
    for _, lang, text in rows[:3]:
        known[0].update(text.split())
        known[1][lang].update(text.split())
    want = {}
    for i, _, text in rows[3:]:
        want[i] = max(("en", "fr"), key=lambda c: math.log((2 if c == "en" else 1) + lam) + sum(
            math.log((known[1][c][w] + lam) / (known[1][c].total() + lam * len(known[0]))) for w in text.split() if w in known[0]))
    assert got == want


def test_naive_bayes_scores_shuffles_no_term_counts(spark, tmp_path, monkeypatch):
    import duckdb

    from quarry.plans import text_plans
    from quarry.plans.registry import REGISTRY

    kept = {}

    def stored(df, name):
        kept[name] = df
        return store(df, name)

    store = text_plans.stored
    monkeypatch.setattr(text_plans, "stored", stored)
    spark.createDataFrame([(1, "The cat", "en"), (2, "le chat", "fr"), (2, "le chien", "en"), (3, "chat chat", "fr"), (4, None, "en")],
                          "doc_id int, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1,), (2,), (2,), (9,)], "doc_id int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted((r.doc_id, r.lang, r.prediction) for r in text_plans.naive_bayes_scores(spark, str(tmp_path)).collect())
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert got == sorted(duck.sql(REGISTRY["naive_bayes_scores"].sql).fetchall()) and len(got) == 2
    assert list(kept) == ["tokens"] and kept["tokens"].count() == 5  # a row a text, no rows of (document, term)
