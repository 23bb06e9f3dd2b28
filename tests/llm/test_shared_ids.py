import random

import corpus_pipeline as C
from quarry.llm.bayes_jaccard import jaccard_classes

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    copied, alone = "one two three four five six seven eight", "quite another text that nobody else has here"
    third = "a passage that only rows without any id hold at all"
    rows = [(5, copied), (7, copied), (7, alone), (8, third + " x"), (8, third + " x"), (None, copied), (None, third),
            (None, third), (None, "the last of the rows is alone as well"), (None, None), (9, "")]
    for k in (1, -1):  # whichever row comes first
        df = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows[::k]], SCHEMA).repartition(3)
        got = sorted(((r.doc_id, r.text) for r in C.near_duplicates(spark, df, "").collect()), key=str)
        assert got == sorted([(5, copied), (7, alone), (8, third + " x"), (None, "the last of the rows is alone as well"),
                              (None, None), (9, ""), *([(None, third)] if not near(third) else [])], key=str)


def near(text):
    """Whether ``text`` and the same with a word more are alike (word 5-grams, Jaccard 0.8)."""
    from quarry.llm import _bytes

    a, b = set(_bytes.shingles(text).tolist()), set(_bytes.shingles(text + " x").tolist())
    return len(a & b) / len(a | b) >= 0.8


def test_two_thousand_null_ids_are_told_apart(spark):
    """As many rows are compared as when every row has its own id; nothing is joined all against all."""
    import time

    from pyspark.sql import functions as F

    rng = random.Random(4)
    texts = []
    for g in range(500):
        words = [f"w{rng.randrange(9000)}" for _ in range(40)]
        texts += [" ".join(words)] * 2 + [" ".join([*words[:-1], f"x{i}"]) for i in range(2)]
    rows = list(enumerate(texts))
    with_ids = spark.createDataFrame(rows, "doc_id bigint, text string")
    took, links = [], []
    for df in (with_ids, with_ids.withColumn("doc_id", F.lit(None).cast("bigint")), with_ids.withColumn("doc_id", F.col("doc_id") % 3)):
        t = time.time()
        out = jaccard_classes(df).collect()
        took.append(time.time() - t)
        links.append(sorted(r.n_links for r in out))
        assert len(out) == 2000
    assert links[0] == links[1] == links[2] == [3] * 2000
    assert max(took[1:]) < 4 * took[0] + 5
