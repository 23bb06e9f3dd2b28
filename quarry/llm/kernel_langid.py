"""Language identification by a string kernel (operator 9).

Kernel: blended-spectrum presence kernel, the number of distinct character
n-grams (n = 1..3, letters lower-cased, everything else one separator) that
two texts share, normalised to 1 on the diagonal. Nystrom: the kernel against
a bounded set of landmark texts, times the inverse square root of the
landmarks' own kernel, gives features; one-versus-rest kernel ridge regression
is then linear. Scoring is one product of a presence matrix with the landmark
matrix and one with the weights, per batch of texts.

Whether a text is in a learned language at all is told by another measure, as
the outputs of any text sum to 2 - L and so the best one is never low: the share
of the text's distinct 3-grams that landmarks of the predicted language hold.
The least share that passes is fixed from the learning rows' own shares, a
landmark never counting for itself. Letters outside the alphabet look alike
here, so with more than 126 learned letters a foreign script can pass.

Bounds (documented parameters): ``per_lang`` training texts a language and
``max_train`` in all, ``landmarks`` landmark texts, 126 letters of their own
(rarer letters share one class). Every document is scored whole.

Defined cases: null text, empty text and text without a letter give ``und``
with score 0; with nothing to learn from, every prediction is ``und``; rows
that repeat are scored each; columns other than doc_id, text, lang are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._shared import id_hash, lowest, remainder, score_texts

UNKNOWN = "und"
_BASE = 128
_SIZES = (_BASE, _BASE ** 2, _BASE ** 3)
_STARTS = (0, _BASE, _BASE + _BASE ** 2)
#: A text passes with more than this part of the share that all but ``_LOW`` of the learning rows reach.
_PART, _LOW = 0.75, 0.01


def _letter_table(alphabet: str) -> np.ndarray:
    """Class of each code point: 0 no letter, 1.. the alphabet, 127 other letters."""
    t = np.zeros(0x110000, np.uint8)
    t[[c for c in range(0x110000) if chr(c).isalpha()]] = _BASE - 1
    for i, ch in enumerate(alphabet):
        t[ord(ch)] = i + 1
    return t


_TABLES: dict[str, np.ndarray] = {}


def ngram_codes(text: str | None, alphabet: str) -> tuple[np.ndarray, bool]:
    """Codes of all 1-, 2- and 3-grams of the text, and whether it holds a letter."""
    if alphabet not in _TABLES:
        _TABLES[alphabet] = _letter_table(alphabet)
    if not text:
        return np.zeros(0, np.int64), False
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = _TABLES[alphabet][cp].astype(np.int32)
    if not c.any():
        return np.zeros(0, np.int64), False
    two = c[:-1] * _BASE + c[1:]
    three = two[:-1] * _BASE + c[2:] if len(c) > 2 else c[:0]
    return np.concatenate([c, two + _STARTS[1], three + _STARTS[2]]), True


class KernelLanguageModel:
    """Landmark matrix and weights; ``fit`` on bounded texts, ``score`` on batches."""

    def __init__(self, landmarks: int = 160, ridge: float = 1e-3):
        self.landmarks, self.ridge = landmarks, ridge
        self.langs: list[str] = []

    def _presence(self, codes: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(codes), self.matrix.shape[0] + 1), np.float32)
        for row, c in zip(x, codes):
            row[self.slot[c]] = 1
        return x[:, :-1]

    def _kernel(self, codes: list[np.ndarray]) -> np.ndarray:
        x = self._presence(codes)
        own = np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
        return (x @ self.matrix / own).astype(np.float64)

    def _share(self, codes: np.ndarray, lang: int, own: int = 0) -> float:
        """Share of the distinct 3-grams (all n-grams of shorter texts) in more than ``own`` landmarks of a language."""
        three = codes[codes >= _STARTS[2]]
        return float((self.held[self.slot[np.unique(three if len(three) else codes)], lang] > own).mean())

    def fit(self, texts: list[str], langs: list[str]) -> "KernelLanguageModel":
        lower = [t.lower() for t in texts]
        freq: dict[str, int] = {}
        for t in lower:
            for ch in set(t):
                if ch.isalpha():
                    freq[ch] = freq.get(ch, 0) + 1
        self.alphabet = "".join(sorted(freq, key=lambda ch: (-freq[ch], ch))[: _BASE - 2])
        codes, keep = [], []
        for i, t in enumerate(texts):
            c, ok = ngram_codes(t, self.alphabet)
            if ok:
                codes.append(np.unique(c))
                keep.append(langs[i])
        self.langs = sorted(set(keep))
        if not self.langs:
            return self
        y = np.where(np.asarray(keep)[:, None] == np.asarray(self.langs)[None, :], 1.0, -1.0)
        turn = {k: 0 for k in self.langs}  # landmarks: the languages take turns
        order = []
        for i, k in enumerate(keep):
            order.append((turn[k], i))
            turn[k] += 1
        pick = [i for _, i in sorted(order)[: self.landmarks]]
        vocab = np.unique(np.concatenate([codes[i] for i in pick]))
        self.slot = np.full(sum(_SIZES), len(vocab), np.int32)
        self.slot[vocab] = np.arange(len(vocab))
        self.matrix = np.zeros((len(vocab), len(pick)), np.float32)
        for j, i in enumerate(pick):
            self.matrix[self.slot[codes[i]], j] = 1
        at = {k: j for j, k in enumerate(self.langs)}
        self.held = np.zeros((len(vocab) + 1, len(self.langs)), np.int32)
        for j, i in enumerate(pick):
            self.held[:-1, at[keep[i]]] += self.matrix[:, j] > 0
        mark = set(pick)
        shares = [self._share(c, at[keep[i]], int(i in mark)) for i, c in enumerate(codes)]
        self.least_share = _PART * float(np.quantile(shares, _LOW))
        self.matrix /= np.sqrt(self.matrix.sum(0, keepdims=True))
        km = np.vstack([self._kernel([codes[i]]) for i in pick])
        val, vec = np.linalg.eigh((km + km.T) / 2)
        root = vec / np.sqrt(np.maximum(val, 1e-6))
        phi = np.vstack([self._kernel(codes[i:i + 64]) for i in range(0, len(codes), 64)]) @ root
        n_lang = np.maximum((y > 0).sum(0), 1)
        weight = (1.0 / n_lang)[np.argmax(y, 1)]
        weight *= len(weight) / weight.sum()
        bias = np.average(y, axis=0, weights=weight)
        gram = phi.T @ (phi * weight[:, None]) + self.ridge * len(phi) * np.eye(phi.shape[1])
        self.weights = root @ np.linalg.solve(gram, phi.T @ ((y - bias) * weight[:, None]))
        self.bias = bias
        return self

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return self._judge(texts, False)[:2]

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """As ``score``, and whether the text is in the predicted language rather than in none of those learned."""
        return self._judge(texts, True)

    def _judge(self, texts: list[str | None], shares: bool) -> tuple[list[str], np.ndarray, np.ndarray]:
        known = np.zeros(len(texts), bool)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), known
        pred, score = [], np.zeros(len(texts))
        for at in range(0, len(texts), 64):
            got = [ngram_codes(t, self.alphabet) for t in texts[at:at + 64]]
            out = self._kernel([c for c, _ in got]) @ self.weights + self.bias
            best = out.argmax(1)
            for i, (c, ok) in enumerate(got):
                pred.append(self.langs[best[i]] if ok else UNKNOWN)
                if ok:
                    score[at + i] = min(max((out[i, best[i]] + 1) / 2, 0.0), 1.0)
                    known[at + i] = shares and self._share(c, best[i]) > self.least_share
        return pred, score, known


def training_texts(docs: DataFrame, learn: Column, per_lang: int = 300, max_train: int = 3000,
                   seed: int = 9) -> DataFrame:
    """(lang, text): the lowest id hashes of each language, at most ``max_train`` rows.

    Chosen on the narrow (doc_id, lang) columns. The languages are counted
    first (at most the ``max_train`` most frequent ones, which is all a sample
    of that size can hold) and only about four times the wanted number of
    hashes is ranked, so no task's share grows with the table. The chosen ids
    are the bounded broadcast side.
    """
    ids = (docs.where(learn & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
           .select("doc_id", "lang", id_hash("doc_id", seed).alias("_h")))
    langs = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "lang").limit(max_train)
    ids = ids.join(F.broadcast(langs), "lang").where(lowest("_h", F.lit(4.0 * per_lang) / F.col("_n"))).drop("_n")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id"))
    pick = (ids.withColumn("_r", rank).where(F.col("_r") <= per_lang).orderBy("_r", "_h", "doc_id").limit(max_train)
            .select("doc_id", "lang", "_r").dropDuplicates(["doc_id", "lang"]))
    return (docs.where(learn & F.col("text").isNotNull()).select("doc_id", "lang", "text")
            .join(F.broadcast(pick), ["doc_id", "lang"]).select("lang", "text", "_r", "doc_id"))


def fit_language(docs: DataFrame, learn: Column, per_lang: int = 300, max_train: int = 3000, landmarks: int = 160):
    """The model, as a broadcast variable (its size is bounded by the parameters)."""
    rows = training_texts(docs, learn, per_lang, max_train).limit(max_train).collect()
    rows.sort(key=lambda r: (r["_r"], r["lang"], r["doc_id"], r["text"]))
    model = KernelLanguageModel(landmarks).fit([r["text"] for r in rows], [r["lang"] for r in rows])
    return docs.sparkSession.sparkContext.broadcast(model)


def identify(docs: DataFrame, learn: Column | None = None, held_out: Column | None = None, **fit) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    held_out = held_out if held_out is not None else remainder("doc_id", 4) == 2
    shared = fit_language(docs, learn if learn is not None else ~(remainder("doc_id", 4) == 2), **fit)

    def scorer(texts):
        pred, score = shared.value.score(texts)
        return [pred, score]

    return score_texts(docs, scorer, held_out, "lang_pred string, score double")
