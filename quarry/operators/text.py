"""Text features: lines, words, tokens, term frequencies, TF-IDF, exact
multinomial naive Bayes (inventory O01, O46, O75, O84-O92, O99).

Tokenising is done with built-in regex functions, so it stays in codegen.
The exact-term forms keep (doc, term) rows distributed; only per-class
numbers (a model of a few rows) and the document count reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import col_of, split_words
from quarry.sources.io import stored

# Our stop-word list for English tokens (not the source's list,
# which belongs to a third-party segmenter).
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it",
              "its", "of", "on", "that", "the", "to", "was", "were", "will", "with"]

# Word runs of letters; Han characters are single tokens.
WORD_PATTERN = r"[\p{L}&&[^\p{IsHan}]]+|\p{IsHan}"


def text_lines(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Whole texts to lines, as a line reader would see the file (O01):
    ``\\n`` separates lines and one final line break ends the last line."""
    body = F.regexp_replace(F.col(text), r"\n\z", "")
    return df.select(*keep, F.explode_outer(F.split(body, "\n")).alias("line")).where(F.col("line").isNotNull())


def words(lines: DataFrame, line: str = "line", sep: str = " ", keep: Sequence[str] = ()) -> DataFrame:
    """Split lines on a separator and explode (O75), JVM split rules."""
    return (lines.select(*keep, F.explode_outer(split_words(F.col(line), sep)).alias("word"))
            .where(F.col("word").isNotNull()))


def word_count(words_df: DataFrame, word: str = "word") -> DataFrame:
    """Count per word (O46); partial counts are combined before the shuffle."""
    return words_df.groupBy(word).agg(F.count(F.lit(1)).alias("count"))


def phrase_pattern(phrases: Sequence[str] = (), base: str = WORD_PATTERN) -> str:
    """Regex alternation with user phrases first, longest first."""
    import re

    ps = sorted({p.lower() for p in phrases}, key=lambda p: (-len(p), p))
    return "|".join([re.escape(p) for p in ps] + [base])


def tokens(text: str | Column, phrases: Sequence[str] = (), stop_words: Sequence[str] | None = STOP_WORDS,
           pattern: str | None = None) -> Column:
    """Lower-cased tokens of a raw text with stop words removed.

    Stands in for the dictionary segmenter: letter runs, single Han
    characters, and the user phrases kept whole. Blanks inside a token (only
    phrases or a given pattern can have them) are removed, and a token left
    empty stays a token (O84).
    """
    pat = pattern or phrase_pattern(phrases)
    toks = F.regexp_extract_all(F.lower(col_of(text)), F.lit(pat), 0)
    if phrases or pattern:
        toks = F.transform(toks, lambda t: F.replace(t, F.lit(" "), F.lit("")))
    if stop_words:
        toks = F.filter(toks, lambda t: ~t.isin(*stop_words))
    return toks


def term_counts(docs: DataFrame, doc_id: str, toks: str, stop_words: Sequence[str] | None = None) -> DataFrame:
    """(doc_id, term, tf): raw term counts per document (O88, exact-term form).

    ``explode_outer`` (then dropping its null row) rather than ``explode``:
    the latter lets Catalyst infer ``size(tokens) > 0`` and push it, with the
    whole tokeniser, below an earlier repartition into the scan stage. Stop
    words are dropped after the explode with a plain ``isin``: an array
    lambda would give each copy of this subtree fresh variable ids, so two
    readers of the counts could not share one shuffle.
    """
    t = docs.select(doc_id, F.explode_outer(toks).alias("term")).where(F.col("term").isNotNull())
    if stop_words:
        t = t.where(~F.col("term").isin(*stop_words))
    return t.groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("tf"))


def idf_table(tf: DataFrame, doc_id: str, n_docs: int) -> DataFrame:
    """(term, idf) with ``idf = ln((N + 1) / (df + 1))``, Spark's IDF formula.

    ``tf`` has one row per (doc, term) with ``tf >= 1``, so counting rows
    with ``tf > 0`` per term is the document frequency. Referencing ``tf``
    through a nullable expression keeps this reader's input subtree identical
    to the other reader's (a plain ``count(tf)`` is rewritten to ``count(1)``
    and the column pruned), so the shuffle under both is shared and the
    documents are tokenised once.
    """
    return (tf.groupBy("term").agg(F.count(F.when(F.col("tf") > 0, F.lit(1))).alias("df"))
            .select("term", F.log((F.lit(float(n_docs + 1))) / (F.col("df") + 1)).alias("idf")))


def tfidf(tf: DataFrame, doc_id: str, n_docs: int) -> DataFrame:
    """(doc_id, term, tf, tfidf). The term table is joined back on ``term``;
    AQE broadcasts it when its measured size allows, else a skew-aware
    sort-merge join splits hot terms."""
    idf = idf_table(tf, doc_id, n_docs)
    return tf.join(idf, "term").select(doc_id, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def hash_split(id_col: str | Column, train_tenths: int = 7) -> Column:
    """Repeatable train/test split on a stable id (O90): True for training."""
    return F.pmod(F.xxhash64(col_of(id_col)), F.lit(10)) < train_tenths


class ExactNaiveBayes:
    """Multinomial naive Bayes over exact terms, smoothing ``lam``.

    Same formulas as ``pyspark.ml``'s multinomial model, with the vocabulary
    of the training set as the feature space:
    ``pi_c = ln(n_c + lam) - ln(N + C*lam)``,
    ``theta_ct = ln(cnt_ct + lam) - ln(sum_t cnt_ct + V*lam)``.
    Scoring never builds the (class x vocabulary) matrix nor a (document x
    class) cross product: ``score = pi_c - den_c * len_d + sum_t tf * ln(cnt_ct + lam)``;
    the per-class constants are the model (C rows) and travel as literals.

    Term counts are only summed, so a term may come in several rows of a
    document (every occurrence with ``tf`` 1, say). Most occurrences are of few
    terms: the terms that make up at least one part in ``HOT_TERMS`` of the
    training set, at most that many, are broadcast, and only occurrences of
    the others are shuffled to the model.
    """

    HOT_TERMS = 50_000

    def __init__(self, lam: float = 1.0):
        self.lam = lam

    def fit(self, tf: DataFrame, labels: DataFrame, doc_id: str, label: str) -> "ExactNaiveBayes":
        """``labels``: a row per training document; ``tf`` has their terms, with or without the column ``label``."""
        lam = self.lam
        lt = tf if label in tf.columns else tf.join(labels.select(doc_id, label), doc_id)
        # One row per term: its count in every class it was seen with. Read by
        # the fit's totals and by every scoring pass, so it is stored once.
        counts = lt.groupBy("term", label).agg(F.sum("tf").alias("cnt"))
        self.terms = stored(counts.groupBy("term").agg(
            F.map_from_entries(F.collect_list(F.struct(label, "cnt"))).alias("by_class")), "term-model")
        vocab = self.terms.count()
        totals = self.terms.select(F.explode("by_class").alias(label, "cnt")).groupBy(label).agg(F.sum("cnt").alias("tot"))
        # one row per class: a label of a classifier, a short list
        per_class = {r[0]: (r[1], r[2]) for r in
                     labels.groupBy(label).agg(F.count(F.lit(1)).alias("n")).join(totals, label, "left").collect()}
        n_docs = sum(v[0] for v in per_class.values())
        c = len(per_class)
        self.classes = sorted(per_class)
        self.pi = {k: math.log(v[0] + lam) - math.log(n_docs + c * lam) for k, v in per_class.items()}
        self.den = {k: math.log((v[1] or 0) + vocab * lam) for k, v in per_class.items()}
        self.label = label
        self.least_hot = sum(v[1] or 0 for v in per_class.values()) / self.HOT_TERMS
        return self

    def predict(self, tf: DataFrame, docs: DataFrame, doc_id: str, out: str = "prediction") -> DataFrame:
        lam = F.lit(self.lam)
        seen = F.aggregate(F.map_values("by_class"), F.lit(0).cast("bigint"), lambda a, n: a + n)
        logs = [F.log(F.coalesce(F.try_element_at("by_class", F.lit(c)), F.lit(0)) + lam) for c in self.classes]
        weights = self.terms.select("term", (seen >= F.lit(self.least_hot)).alias("hot"), F.array(*logs).alias("w"))
        hot = F.broadcast(weights.where("hot").drop("hot"))  # at most HOT_TERMS rows
        tf = tf.select(doc_id, "term", "tf")
        rare = tf.join(hot.select("term"), "term", "left_anti").join(weights.where("NOT hot").drop("hot"), "term")
        met = tf.join(hot, "term").unionByName(rare)
        part = [F.sum(F.col("tf") * F.get("w", F.lit(i))).alias(f"_s{i}") for i in range(len(self.classes))]
        sparse = met.groupBy(doc_id).agg(F.sum("tf").alias("_len"), *part)
        d = docs.join(sparse, doc_id, "left")
        ln = F.coalesce(F.col("_len"), F.lit(0)).cast("double")
        scores = [F.struct((F.lit(self.pi[c]) - F.lit(self.den[c]) * ln
                            + F.coalesce(F.col(f"_s{i}"), F.lit(0.0))).alias("s"), F.lit(c).alias("c"))
                  for i, c in enumerate(self.classes)]
        best = F.greatest(*scores) if len(scores) > 1 else scores[0]
        return d.select(*docs.columns, best["c"].alias(out))
