"""Toxicity classifier with counterfactual regularisation (operator 4).

Logistic regression over the presence of words and word beginnings (4, 6 and
8 bytes). In every labelled text that names a group, the group's terms are
swapped for other terms of their set, and for a neutral noun; the fit penalises the squared change of the score (in log
odds), so that naming a group does not count as toxic by itself.

Bounds (documented parameters): ``per_class`` labelled documents of each
class are learnt from, ``vocabulary`` words have a weight. Words are counted
in Spark over the sample; every document is scored whole.

Defined cases: null and empty texts get the score of a text without any
known word; with no labels every score is 0.5 or the label rate; repeated
rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import _bytes
from quarry.llm._shared import class_rate, labelled_sample, log_odds, materialise, remainder, score_texts

#: Sets of terms that may stand for one another; the last of each is the neutral noun.
IDENTITY = (
    ("women", "men", "girls", "boys", "people"),
    ("woman", "man", "girl", "boy", "person"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "believers"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "religious"),
    ("black", "white", "asian", "african", "latino", "european", "human"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer", "human"),
    ("immigrants", "refugees", "foreigners", "natives", "residents"),
    ("old", "young", "elderly", "disabled", "deaf", "blind", "average"),
    ("femmes", "hommes", "filles", "garçons", "gens"),
    ("frauen", "männer", "mädchen", "jungen", "leute"),
    ("mujeres", "hombres", "chicas", "chicos", "gente"),
)
THRESHOLD = 0.3


_BEGINNINGS = (4, 6, 8)


def features(text: str | None) -> np.ndarray:
    """Distinct hashes of the text's words and of their beginnings."""
    return np.unique(_bytes.words(text, _BEGINNINGS))


def _swaps(step: int | None) -> dict[str, str]:
    """Term -> the next of its set (or, without a step, its neutral noun)."""
    out: dict[str, str] = {}
    for group in IDENTITY:
        for i, w in enumerate(group[:-1]):
            out.setdefault(w, group[-1] if step is None else group[(i + step) % (len(group) - 1)])
    return out


_SWAPS = tuple(_swaps(s) for s in (1, 2, None))
_TERMS = re.compile(r"\b(" + "|".join(sorted(_SWAPS[0])) + r")\b")


def swapped_texts(text: str) -> list[str]:
    """The lower-cased text after each kind of swap; nothing if it names no group."""
    low = text.lower()
    if not _TERMS.search(low):
        return []
    return [_TERMS.sub(lambda m, s=s: s[m[1]], low) for s in _SWAPS]


class CounterfactualModel:
    """Weights of the known words (sorted hashes); ``fit`` by Newton steps."""

    def __init__(self, vocab: np.ndarray, ridge: float = 1.0, fairness: float = 5.0):
        self.vocab, self.ridge, self.fairness = np.sort(vocab), ridge, fairness
        self.weights, self.bias = np.zeros(len(vocab)), 0.0

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the known words among ``hashes``, each once."""
        if not len(self.vocab) or not len(hashes):
            return np.zeros(0, np.int64)
        i = np.minimum(np.searchsorted(self.vocab, hashes), len(self.vocab) - 1)
        return np.unique(i[self.vocab[i] == hashes])

    def fit(self, rows: list[np.ndarray], swapped: list[list[np.ndarray]], y: np.ndarray, rate: float | None = None):
        n, d = len(rows), len(self.vocab)
        x = np.zeros((n, d + 1))
        x[:, d] = 1
        for i, r in enumerate(rows):
            x[i, r] = 1
        change = []
        for i, others in enumerate(swapped):
            for o in others:
                z = -x[i, :d]
                z[o] += 1
                if z.any():
                    change.append(z)
        penal = np.zeros((d + 1, d + 1))
        penal[np.arange(d), np.arange(d)] = self.ridge
        if change:
            c = np.asarray(change)
            penal[:d, :d] += self.fairness * c.T @ c
        w = np.zeros(d + 1)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (p - y) + penal @ w
            hess = x.T @ (x * (p * (1 - p))[:, None]) + penal + 1e-6 * np.eye(d + 1)
            step = np.linalg.solve(hess, grad)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        self.weights, self.bias = w[:d], float(w[d])
        k = y.sum()
        if rate is not None and 0 < k < n:  # the sample is balanced, the corpus is not
            self.bias += log_odds(rate) - log_odds(k / n)
        return self

    def score(self, text: str | None) -> float:
        z = self.bias + self.weights[self.known(features(text))].sum()
        return float(1 / (1 + np.exp(-min(max(z, -30), 30))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = 3000, vocabulary: int = 400,
                 ridge: float = 1.0, fairness: float = 5.0) -> CounterfactualModel:
    rate = class_rate(labels, "toxic", learn)
    sample = labelled_sample(docs, labels, "toxic", learn, per_class)

    def hashes(batches):
        for b in batches:
            texts = [t.as_py() for t in b.column(1)]
            h = [features(t).view(np.int64) for t in texts]
            s = [[features(o).view(np.int64).tolist() for o in swapped_texts(t)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(2), pa.array(h, pa.list_(pa.int64())), pa.array(s, pa.list_(pa.list_(pa.int64())))],
                names=["y", "h", "s"])

    rows = materialise(sample.mapInArrow(hashes, "y int, h array<bigint>, s array<array<bigint>>"),
                       "toxicity-sample")
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        model = CounterfactualModel(np.zeros(0, np.uint64))
        model.bias = log_odds(rate)
        return model
    a, c = F.col("a"), F.col("b")  # texts of class 1 and of class 0 with the word
    chi = (F.pow(a * F.lit(n0) - c * F.lit(n1), F.lit(2)) / ((a + c) * (F.lit(n1 + n0) - a - c + 1)))
    counts = (rows.select("y", F.explode("h").alias("w")).groupBy("w")
              .agg(F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b")))
    named = rows.where(F.size("s") > 0).select(F.explode("s").alias("o"), "h")
    moved = (named.select(F.explode(F.array_union(F.array_except("h", "o"), F.array_except("o", "h"))).alias("w"))
             .distinct())  # what swaps change: features of IDENTITY's terms only, a fixed list
    # a term that no labelled text holds keeps weight 0, so a penalised weight cannot hide in it
    moved = moved.join(counts.select("w"), "w", "left_semi")
    top = counts.orderBy(chi.desc(), "w").limit(vocabulary).select("w")
    chosen = np.asarray([r["w"] for r in top.union(moved).collect()], np.int64)
    vocab = np.unique(chosen.view(np.uint64))
    model = CounterfactualModel(vocab, ridge, fairness)

    def known(batches):
        as_hashes = lambda x: np.asarray(x, np.int64).view(np.uint64)
        for b in batches:
            x = [model.known(as_hashes(v.as_py())).tolist() for v in b.column(1)]
            s = [[model.known(as_hashes(o)).tolist() for o in v.as_py()] for v in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(x, pa.list_(pa.int64())), pa.array(s, pa.list_(pa.list_(pa.int64())))],
                names=["y", "x", "s"])

    got = rows.select("y", "h", "s").mapInArrow(known, "y int, x array<bigint>, s array<array<bigint>>").collect()  # <= 2 * per_class rows
    as_index = lambda v: np.asarray(v, np.int64)
    return model.fit([as_index(r["x"]) for r in got], [[as_index(o) for o in r["s"]] for r in got],
                     np.asarray([r["y"] for r in got], float), rate)


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, held_out: Column | None = None,
                   **fit) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    held_out = held_out if held_out is not None else remainder("doc_id", 4) == 2
    model = fit_toxicity(docs, labels, learn if learn is not None else ~(remainder("doc_id", 4) == 2), **fit)

    def scorer(texts):
        s = np.asarray([model.score(t) for t in texts], float)
        return [s, (s >= THRESHOLD).astype(np.int32)]

    return score_texts(docs, scorer, held_out, "score double, predicted int")
