"""The fitted models against plain reference computations: objectives worked out densely, scores one text at a time."""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import kernel_langid as K
from quarry.llm.attention_quality import FEATURES, AttentionModel, encode_passages, score_quality, fit_quality
from quarry.llm.toxicity import CounterfactualModel, features, fit_toxicity, score_toxicity

SF = "/root/testdata/sf0.01"


def sigmoid(z):
    return 1 / (1 + math.exp(-min(max(z, -30), 30)))


# ---------------------------------------------------------------- toxicity

def toxicity_objective(w, rows, swapped, y, ridge, fairness):
    d = len(w) - 1
    total = ridge / 2 * sum(v * v for v in w[:d])
    for r, others, label in zip(rows, swapped, y):
        z = w[d] + sum(w[j] for j in r)
        total += math.log1p(math.exp(-z)) if label else math.log1p(math.exp(z))
        for o in others:
            change = sum(w[j] for j in o) - sum(w[j] for j in r)
            total += fairness / 2 * change * change
    return total


def test_toxicity_fit_minimises_its_objective():
    rng = np.random.default_rng(3)
    rows = [np.flatnonzero(rng.random(12) < 0.3) for _ in range(80)]
    y = np.asarray([float(3 in r or rng.random() < 0.2) for r in rows])
    swapped = [[np.setdiff1d(np.append(r, 7), [3])] if 3 in r else [] for r in rows]
    model = CounterfactualModel(np.arange(12, dtype=np.uint64), ridge=0.7, fairness=2.0).fit(rows, swapped, y)
    w = np.append(model.weights, model.bias)
    best = toxicity_objective(w, rows, swapped, y, 0.7, 2.0)
    for j in range(13):  # central differences: the gradient is zero
        e = np.zeros(13)
        e[j] = 1e-4
        up, down = (toxicity_objective(w + s * e, rows, swapped, y, 0.7, 2.0) for s in (1, -1))
        assert abs(up - down) / 2e-4 < 1e-3 and up >= best - 1e-9 and down >= best - 1e-9


def test_toxicity_query_equals_scores_worked_out_word_by_word(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    learn = ~(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2)
    model = fit_toxicity(docs, labels, learn)
    weight = dict(zip(model.vocab.tolist(), model.weights.tolist()))
    got = {r.doc_id: r for r in score_toxicity(docs, labels).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        held = set()
        for word in set(re.findall(r"[A-Za-z0-9_\x80-\U0010ffff]+", (r.text or "").lower())):
            held |= set(features(word).tolist())
        want = sigmoid(model.bias + sum(weight.get(h, 0.0) for h in held))
        assert abs(got[r.doc_id].score - want) < 1e-9 and got[r.doc_id].predicted == int(want >= 0.3)


# ---------------------------------------------------------------- quality

def quality_score(p, bag):
    """One bag, passage by passage."""
    h = [np.tanh(x @ p["w"] + p["b"]) for x in bag]
    e = [float(np.sum(np.tanh(v @ p["v"]) * (1 / (1 + np.exp(-(v @ p["u"])))) * p["a"])) for v in h]
    att = np.exp(np.asarray(e) - max(e))
    att /= att.sum()
    return float(sum(a * v for a, v in zip(att, h)) @ p["c"] + p["d"][0])


def quality_loss(p, bags, y):
    total = 0.0
    for bag, label in zip(bags, y):
        z = quality_score(p, bag)
        total += math.log1p(math.exp(-z)) if label else math.log1p(math.exp(z))
    return total / len(y)


def test_quality_steps_follow_the_gradient_of_its_objective():
    rng = np.random.default_rng(5)
    bags = [rng.normal(size=(rng.integers(1, 5), FEATURES)).astype(np.float32) for _ in range(12)]
    y = (rng.random(12) < 0.5).astype(float)
    settings = dict(hidden=3, gate=2, decay=0.0, seed=1)
    start = AttentionModel(epochs=0, **settings).fit(bags, y)
    step = AttentionModel(epochs=1, rate=1e-3, **settings).fit(bags, y)
    scaled = [np.clip((b - start.mean) / start.std, -8, 8) for b in bags]
    checked = 0
    for name, value in start.p.items():
        for at in list(np.ndindex(value.shape))[:60]:
            slope = 0.0
            for s in (1e-5, -1e-5):
                moved = {n: v.copy() for n, v in start.p.items()}
                moved[name][at] += s
                slope += np.sign(s) * quality_loss(moved, scaled, y)
            slope /= 2e-5
            if abs(slope) > 1e-5:  # the first step of the fit is the learning rate against the sign of the slope
                assert abs(step.p[name][at] - value[at] + 1e-3 * np.sign(slope)) < 1e-5, (name, at)
                checked += 1
    assert checked > 50


def test_quality_query_equals_scores_worked_out_passage_by_passage(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    learn = ~(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0)
    model = fit_quality(docs, labels, learn)
    got = {r.doc_id: r for r in score_quality(docs, labels).collect()}
    for r in docs.select("doc_id", "text").collect():
        bag = np.clip((encode_passages(r.text) - model.mean) / model.std, -8, 8)
        want = sigmoid(quality_score(model.p, bag) + model.shift)
        assert abs(got[r.doc_id].score - want) < 1e-6


# ---------------------------------------------------------------- language

def test_kernel_ridge_solves_its_normal_equations():
    rng = np.random.default_rng(2)
    words = {"a": ["alpha", "beta", "gamma"], "b": ["uno", "dos", "tres"], "c": ["ein", "zwei", "drei"]}
    langs = ["a", "b", "c"] * 14 + ["a"] * 8
    texts = [" ".join(rng.choice(words[k], 5)) for k in langs]
    model = K.KernelLanguageModel(landmarks=9, ridge=0.01).fit(texts, langs)
    # the kernel by sets: shared n-grams over the roots of both sizes, counted within the landmarks' n-grams
    sets = [set(K.ngram_codes(t, model.alphabet)[0].tolist()) for t in texts]
    order = sorted((langs[:i].count(k), i) for i, k in enumerate(langs))
    marks = [sets[i] for _, i in order[:9]]
    held = set().union(*marks)
    kernel = lambda s: np.asarray([len(s & m) / math.sqrt(max(len(s & held), 1)) / math.sqrt(len(m)) for m in marks])
    k_nm, k_mm = np.stack([kernel(s) for s in sets]), np.stack([kernel(s) for s in marks])
    y = np.asarray([[1.0 if k == lang else -1.0 for lang in model.langs] for k in langs])
    n_of = {k: langs.count(k) for k in model.langs}
    c = np.asarray([1 / n_of[k] for k in langs])
    c *= len(c) / c.sum()
    bias = (c[:, None] * y).sum(0) / c.sum()
    assert np.allclose(bias, model.bias)
    # weighted ridge in the Nystrom space: minimise sum c (y - bias - K w)^2 + ridge n w' K_mm w over w
    def objective(w):
        return (c[:, None] * (y - bias - k_nm @ w) ** 2).sum() + 0.01 * len(texts) * np.einsum("ij,ik,kj->", w, k_mm, w)

    best = objective(model.weights)
    for _ in range(60):
        assert objective(model.weights + rng.normal(size=model.weights.shape) * 10 ** rng.uniform(-4, 0)) >= best - 1e-6
    pred, score = model.score(texts)
    out = k_nm @ model.weights + model.bias
    assert pred == [model.langs[i] for i in out.argmax(1)]
    assert np.allclose(score, np.clip((out.max(1) + 1) / 2, 0, 1), atol=1e-5)
