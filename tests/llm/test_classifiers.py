import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import _bytes
from quarry.llm.attention_quality import FEATURES, AttentionModel, encode_passages, score_quality
from quarry.llm.kernel_langid import KernelLanguageModel, identify, ngram_codes
from quarry.llm.toxicity import THRESHOLD, CounterfactualModel, features, score_toxicity, swapped_texts

SF = "/root/testdata/sf0.1"
EDGE = [(1, None), (2, ""), (3, "  \n 123 !!"), (4, "the words of this"), (4, "the words of this"), (None, "no id"),
        (5, "long words " * 20000)]
DOCS = "doc_id bigint, text string"


def edge_docs(spark):
    return (spark.createDataFrame(EDGE, DOCS).withColumn("lang", F.lit("en"))
            .withColumn("score", F.lit("clash")).withColumn("held_out", F.lit("clash")).withColumn("y", F.lit(3)))


def held_out(spark, result, column, mod, rest):
    lab = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", column)
    crc = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod)) == rest
    rows = result.join(lab, "doc_id").withColumn("should", crc).collect()
    assert all(r["held_out"] == r["should"] for r in rows)
    return [r for r in rows if r["held_out"]]


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        rank[s == v] = rank[s == v].mean()
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = score_quality(docs, labels)
    rows = held_out(spark, out, "quality", 5, 0)
    y, s = np.asarray([r.quality for r in rows]), np.asarray([r.score for r in rows])
    assert auc(y, s) > 0.98 and ((s >= 0) & (s <= 1)).all()
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.99


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = held_out(spark, score_toxicity(docs, labels), "toxic", 4, 2)
    y, s = np.asarray([r.toxic for r in rows]), np.asarray([r.score for r in rows])
    assert auc(y, s) > 0.95
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.02
    assert np.mean([r.predicted for r in rows if r.toxic == 1]) > 0.8


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_counterfactual_penalty_spares_group_mentions():
    """Toxic training texts name a group more often than others do; the penalty takes that weight away."""
    rng = np.random.default_rng(0)
    fill = [f"w{i}" for i in range(30)]
    texts, y = [], []
    for i in range(600):
        t = list(rng.choice(fill, 8))
        bad = i % 3 == 0
        if bad and rng.random() < 0.8:
            t.append("idiot")
        if rng.random() < (0.7 if bad else 0.05):
            t.append("muslim")
        texts.append(" ".join(t))
        y.append(float(bad))
    vocab = np.unique(np.concatenate([features(t) for t in texts]))

    def fit(fairness):
        m = CounterfactualModel(vocab, ridge=1.0, fairness=fairness)
        rows = [m.known(features(t)) for t in texts]
        swaps = [[m.known(features(s)) for s in swapped_texts(t)] for t in texts]
        return m.fit(rows, swaps, np.asarray(y))

    plain, fair = fit(0.0), fit(5.0)
    neutral, mention = "w1 w2 w3 person", "w1 w2 w3 muslim"
    gap = lambda m: abs(m.score(mention) - m.score(neutral))
    assert plain.score(mention) > THRESHOLD and gap(plain) > 0.3  # a neutral mention is called toxic
    assert gap(fair) < 0.05 and fair.score(mention) < THRESHOLD
    assert fair.score("w1 idiot") > THRESHOLD


def test_swaps_cover_every_term_of_a_text():
    assert swapped_texts("nothing here") == []
    a, b, c = swapped_texts("Women and men")
    assert a == "men and girls" and c == "people and people" and b != a


@pytest.mark.parametrize("run", ["quality", "toxic", "lang"])
def test_edge_cases(spark, run):
    docs, none = edge_docs(spark), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    labels = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (None, 1, 1), (1, None, None), (4, 1, 1)], none.schema)

    def score(d, lab):
        if run == "quality":
            return score_quality(d, lab, F.lit(True))
        return score_toxicity(d, lab, F.lit(True)) if run == "toxic" else identify(d, F.lit(True))

    for lab in (labels, none):
        rows = score(docs, lab).collect()
        assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
        same = [r for r in rows if r.doc_id == 4]
        assert same[0] == same[1]
    assert score(docs.limit(0), labels).count() == 0
    if run == "lang":
        assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {1: "und", 2: "und", 3: "und"}
        assert identify(docs.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred <> 'und'").count() == 0


def test_kernel_is_the_shared_presence_of_ngrams():
    m = KernelLanguageModel(landmarks=4).fit(["abc abd", "bcd cde", "xyz xyy", "zzy xzx"], ["a", "a", "b", "b"])
    texts = ["abc zz", "yxz", ""]
    sets = [set(ngram_codes(t, m.alphabet)[0].tolist()) for t in texts]
    marks = [set(ngram_codes(t, m.alphabet)[0].tolist()) for t in ("abc abd", "xyz xyy", "bcd cde", "zzy xzx")]
    vocab = set().union(*marks)
    k = m._kernel([ngram_codes(t, m.alphabet)[0] for t in texts])
    for i, s in enumerate(sets):
        for j, x in enumerate(marks):
            want = len(s & x) / (max(len(s & vocab), 1) * len(x)) ** 0.5
            assert k[i, j] == pytest.approx(want, rel=1e-5)
    assert m.score(["abc", "xyz"])[0] == ["a", "b"]


def test_attention_finds_the_passage_that_decides():
    rng = np.random.default_rng(2)
    bags, y = [], []
    for i in range(300):
        b = rng.normal(size=(rng.integers(2, 9), 5))
        b[:, 0] = 0
        if i % 2:
            b[rng.integers(len(b)), 0] = 4
        bags.append(b)
        y.append(1.0 - i % 2)
    m = AttentionModel(epochs=200).fit(bags, np.asarray(y))
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
    x = np.clip((np.concatenate(bags) - m.mean) / m.std, -8, 8)
    out, att = m._forward(x, first)[-1], m._forward(x, first)[4]
    assert np.mean((out > 0) == (np.asarray(y) > 0.5)) > 0.97
    hot = np.concatenate(bags)[:, 0] == 4
    share = np.asarray([att[f:f + len(b)][hot[f:f + len(b)]].sum() for f, b in zip(first, bags)])[1::2]
    even = np.asarray([1 / len(b) for b in bags])[1::2]
    assert share.mean() > 1.5 * even.mean()


def test_passages_cover_the_whole_text():
    t = "Words of a text.\n" * 300 + "%%% $$$"
    x = encode_passages(t)
    assert x.shape == (round(len(t) / 400), FEATURES) and x[-1, 8:].sum() > x[0, 8:].sum()
    assert encode_passages(None).shape == (1, FEATURES) and not encode_passages("").any()


def test_word_hashes():
    assert len(_bytes.words("Éa b_1, c-d")) == 4
    assert (_bytes.words("A b") == _bytes.words("a  B")).all()
    assert len(_bytes.shingles("a b c d e f")) == 2 and len(_bytes.shingles("a b")) == 1
    assert len(_bytes.shingles("a b c d e a b c d e f", 5)) == 6  # one of the seven runs repeats
