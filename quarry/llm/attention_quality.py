"""Quality classifier by attention-based multiple-instance learning (operator 10).

A document is a bag of passages (fixed-size byte windows over the whole
text). Every passage is encoded from its character classes, word lengths and
repetitions by one tanh layer; gated attention (tanh times sigmoid) gives each
passage a weight; the weighted mean of the passage codes is scored. Only the
document's label is learnt from, so the model finds the passages that matter.

Bounds (documented parameters): ``per_class`` labelled documents of each
class. Every document is encoded and scored whole.

Defined cases: null and empty texts are a bag of one empty passage; with no
labels the score is the label rate; repeated rows are scored each; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from quarry.llm import _bytes
from quarry.llm._shared import class_rate, labelled_sample, log_odds, remainder, score_texts

PASSAGE = 400
THRESHOLD = 0.3
_MARKS = b"%*$#&!|.,;:?-/<>=()@\"'_"
_CLASSES = 8 + len(_MARKS)


def _class_table() -> np.ndarray:
    t = np.zeros(256, np.int64)  # 0: controls and the rest
    t[97:123], t[65:91], t[48:58], t[128:] = 1, 2, 3, 4
    t[32], t[10], t[9] = 5, 6, 7
    for i, c in enumerate(_MARKS):
        t[c] = 8 + i
    return t


_CLASS = _class_table()
FEATURES = _CLASSES + 5


def encode_passages(text: str | None, size: int = PASSAGE) -> np.ndarray:
    """One row of features per passage, the whole text covered."""
    b = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, round(len(b) / size))
    out = np.zeros((n, FEATURES), np.float32)
    if not len(b):
        return out
    at = np.arange(len(b)) * n // len(b)
    length = np.bincount(at, minlength=n).astype(float)
    out[:, :_CLASSES] = np.bincount(at * _CLASSES + _CLASS[b], minlength=n * _CLASSES).reshape(n, -1) / length[:, None]
    space = (b == 32) | (b == 10) | (b == 9)
    edge = np.diff(np.concatenate([[1], space.astype(np.int8), [1]]))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(start):
        where = at[start]
        count = np.maximum(np.bincount(where, minlength=n), 1)
        out[:, _CLASSES] = np.bincount(where, end - start, n) / count / 10
        out[:, _CLASSES + 1] = np.bincount(where, end - start > 20, n) / count
        h = _bytes.span_hash(_bytes.prefix_hash(b), start, end)
        for k, col in ((1, 2), (4, 3)):  # words, and runs of four, seen before in the text
            m = len(h) - k + 1
            if m > 0:
                g = h[:m].copy()
                for i in range(1, k):
                    g = g * np.uint64(31) + h[i:i + m]
                seen = np.ones(m)
                seen[np.unique(g, return_index=True)[1]] = 0
                out[:, _CLASSES + col] = np.bincount(where[:m], seen, n) / count
        ends = b[end - 1]
        out[:, _CLASSES + 4] = np.bincount(where, (_CLASS[ends] >= 8) & (ends != 46) & (ends != 44), n) / count
    return out


class AttentionModel:
    """Encoder, gated attention and score; ``fit`` by full-batch Adam on bounded data."""

    def __init__(self, hidden: int = 16, gate: int = 8, epochs: int = 150, rate: float = 0.02, decay: float = 1e-3,
                 seed: int = 10):
        self.hidden, self.gate, self.epochs, self.rate, self.decay, self.seed = hidden, gate, epochs, rate, decay, seed
        self.p: dict[str, np.ndarray] = {}
        self.shift = 0.0

    def _forward(self, x: np.ndarray, first: np.ndarray):
        p = self.p
        bag = np.zeros(len(x), np.int64)
        bag[first[1:]] = 1
        bag = np.cumsum(bag)
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["a"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        att = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(att[:, None] * h, first)
        out = z @ p["c"] + p["d"][0]
        return bag, h, t, g, att, z, out

    def fit(self, bags: list[np.ndarray], y: np.ndarray, prior: float | None = None) -> "AttentionModel":
        rng = np.random.default_rng(self.seed)
        x = np.concatenate(bags).astype(np.float64)
        first = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
        self.mean, self.std = x.mean(0), np.maximum(x.std(0), 1e-3)
        x = np.clip((x - self.mean) / self.std, -8, 8)
        d, k, m = x.shape[1], self.hidden, self.gate
        self.p = {"w": rng.normal(0, d ** -0.5, (d, k)), "b": np.zeros(k), "v": rng.normal(0, k ** -0.5, (k, m)),
                  "u": rng.normal(0, k ** -0.5, (k, m)), "a": rng.normal(0, m ** -0.5, m),
                  "c": rng.normal(0, k ** -0.5, k), "d": np.zeros(1)}
        m1 = {n: np.zeros_like(v) for n, v in self.p.items()}
        m2 = {n: np.zeros_like(v) for n, v in self.p.items()}
        for step in range(1, self.epochs + 1):
            bag, h, t, g, att, z, out = self._forward(x, first)
            do = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y) / len(y)
            dz = do[:, None] * self.p["c"]
            dh = att[:, None] * dz[bag]
            da = (h * dz[bag]).sum(1)
            de = att * (da - np.add.reduceat(att * da, first)[bag])
            dt, dg = de[:, None] * self.p["a"] * g * (1 - t * t), de[:, None] * self.p["a"] * t * g * (1 - g)
            dh += dt @ self.p["v"].T + dg @ self.p["u"].T
            dx = dh * (1 - h * h)
            grad = {"w": x.T @ dx, "b": dx.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ de,
                    "c": z.T @ do, "d": np.asarray([do.sum()])}
            for n, v in self.p.items():
                q = grad[n] + (self.decay * v if v.ndim == 2 else 0)
                m1[n] = 0.9 * m1[n] + 0.1 * q
                m2[n] = 0.999 * m2[n] + 0.001 * q * q
                v -= self.rate * (m1[n] / (1 - 0.9 ** step)) / (np.sqrt(m2[n] / (1 - 0.999 ** step)) + 1e-8)
        share = float(y.mean())
        if prior is not None and 0 < share < 1:  # the sample is balanced, the corpus is not
            self.shift = log_odds(prior) - log_odds(share)
        return self

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        if not self.p:
            return np.full(len(texts), 1 / (1 + np.exp(-self.shift)))
        bags = [encode_passages(t) for t in texts]
        first = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
        x = np.clip((np.concatenate(bags) - self.mean) / self.std, -8, 8)
        return 1 / (1 + np.exp(-np.clip(self._forward(x, first)[-1] + self.shift, -30, 30)))


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = 1500) -> AttentionModel:
    rate = class_rate(labels, "quality", learn)
    sample = labelled_sample(docs, labels, "quality", learn, per_class)

    def bags(batches):
        for b in batches:
            x = [encode_passages(t.as_py()).ravel() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(x, pa.list_(pa.float32()))],
                                             names=["doc_id", "y", "x"])

    id_type = sample.schema["doc_id"].dataType.simpleString()
    got = sample.mapInArrow(bags, f"doc_id {id_type}, y int, x array<float>").toArrow()  # <= 2 * per_class documents
    model = AttentionModel()
    model.shift = log_odds(rate)
    order = np.argsort(np.asarray(got["doc_id"].to_pylist()), kind="stable") if got.num_rows else []
    y = np.asarray(got["y"].to_pylist(), float)
    if len(set(y.tolist())) < 2:
        return model
    x = [np.asarray(v.values.to_numpy()).reshape(-1, FEATURES) for v in got["x"].combine_chunks()]
    return model.fit([x[i] for i in order], y[order], rate)


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column | None = None, held_out: Column | None = None,
                  per_class: int = 1500) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    held_out = held_out if held_out is not None else remainder("doc_id", 5) == 0
    model = fit_quality(docs, labels, learn if learn is not None else ~(remainder("doc_id", 5) == 0), per_class)

    def scorer(texts):
        s = model.score(texts)
        return [s, (s >= THRESHOLD).astype(np.int32)]

    return score_texts(docs, scorer, held_out, "score double, predicted int")
