import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.operators import phrases as P
from quarry.operators import text as X


def both(spark, texts, phrases):
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], "id int, text string, row string, pos string")
    table = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    got = {r.id: r.toks for r in P.phrase_tokens(docs, table).collect()}
    known = [p for p in phrases if p]
    want = {r.id: r.t for r in docs.select("id", X.tokens("text", phrases=known, stop_words=None).alias("t")).collect()}
    return got, want


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_regex(spark, seed):
    rng = random.Random(seed)
    parts = ["a", "b", "ab", "ba", "aB", " ", "  ", "-", "日", "期", "é", "1", "+", "\n"]
    phrases = list({"".join(rng.choice(parts) for _ in range(rng.choice([1, 2, 3, 5]))) for _ in range(25)})
    phrases = [p for p in phrases if p.strip()] + ["日  期", "ab", "a b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 30]))) for _ in range(60)] + ["ab" * 40 + "c"]
    got, want = both(spark, texts, phrases)
    for i, t in enumerate(texts):
        assert got[i] == want[i], (t, phrases)


def test_phrase_that_ends_inside_a_word(spark):
    got, want = both(spark, ["of thereof the", "xof the of then"], ["of the", "reof the", "n"])
    assert got == want and got[0] == ["ofthe", "reofthe"]


def test_nulls_empty_texts_and_empty_dictionary(spark):
    got, want = both(spark, [None, "", "One two", "x\u0001y"], [None, ""])
    assert got == want == {0: None, 1: [], 2: ["one", "two"], 3: ["x", "y"]}
    none = spark.createDataFrame([], "text string")
    assert P.phrase_tokens(none, spark.createDataFrame([("a",)], "phrase string")).collect() == []
    twice = spark.createDataFrame([("a b a b",)] * 2, "text string")
    out = P.phrase_tokens(twice, spark.createDataFrame([("A B",)], "phrase string"), stop_words=["b"]).collect()
    assert [r.toks for r in out] == [["ab", "ab"]] * 2


def test_ten_thousand_phrases_and_a_long_text(spark):
    words = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "klmnprst"]
    phrases = [f"{a} {b}" for a in words[:100] for b in words[100:200]]
    rng = random.Random(1)
    long = " ".join(rng.choice(words) for _ in range(20_000))
    docs = spark.createDataFrame([(long,), ("no match here",)], "text string")
    out = P.phrase_tokens(docs, spark.createDataFrame([(p,) for p in phrases], "phrase string"))
    got = [r.toks for r in out.orderBy(F.desc(F.length("text"))).collect()]
    held, want, at = set(phrases), [], 0
    tokens = long.split(" ")
    while at < len(tokens):
        pair = " ".join(tokens[at:at + 2])
        want.append(re.sub(" ", "", pair) if pair in held else tokens[at])
        at += 2 if pair in held else 1
    assert got == [want, ["no", "match", "here"]]


def test_one_lookup_a_token_where_phrases_have_one_form(spark, monkeypatch):
    kept = {}

    def stored(df, name):
        kept[name] = store(df, name)
        return kept[name]

    store = P.stored
    monkeypatch.setattr(P, "stored", stored)
    phrases = ["of " + "x" * n + " " for n in range(1, 9)]
    got, want = both(spark, ["of xx of xxx, of  x of xxxxxxxxx of x"], phrases)
    assert got == want and got[0][0] == "ofxx"
    assert [len(r.forms) for r in kept["phrase-beginnings"].collect()] == [1]  # however many lengths there are
    assert "phrase-starts" not in kept  # nothing ends inside a word: no second pass over the texts


def test_a_control_character_is_no_blank(spark):
    got, want = both(spark, ["x\u0001y z", "x y z"], ["x y "])
    assert got == want == {0: ["x", "y", "z"], 1: ["xy", "z"]}
