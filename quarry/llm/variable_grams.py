"""Spelling variant grouping by a variable-length gram index (operator 11).

Two words are near when they differ by exactly one inserted, deleted or
replaced code point. Words are taken apart into grams of ``Q_LEAST`` to
``Q_MOST`` characters by a gram dictionary pruned by frequency: from every
position the gram grows while it is still frequent, so common beginnings get
long grams and rare ones short grams, and no list grows past the frequency
bound unless its grams cannot grow any more. A gram reads only its own
characters (the end of the word is one of them), so an edit affects just the
grams that cover the place of the edit: the largest number of grams over any
one character bounds what an edit can spoil. Of two near words, both keep all
but that many grams, so one of the ``bound + 1`` rarest grams of each is the
same gram at the same place, counted from the start or from the end. Only those
lists are merged: an equi-join on (gram, place, length), each pair verified in
the JVM where it is met.

The dictionary is broadcast; it holds at most ``ENTRIES`` grams of each length,
because a gram must have more than ``occurrences / ENTRIES`` occurrences to be
listed. Words are counted inside the tasks before they are shuffled. A word of
m characters has at most (2 m + 1) * alphabet near words, so no word's group is
unbounded, however many rows it came from.

Defined cases: a null text has no words; a null doc_id is the empty string in
the hash; rows that repeat a doc_id or a text count each; an empty table, or one
without a word that is long and frequent enough, gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import materialise

MIN_LENGTH = 6
MIN_COUNT = 5
#: A run loses a character when this divides its hash.
NOISE = 199
#: A word's form is at least so many times as frequent.
RATIO = 5
Q_LEAST, Q_MOST = 2, 5
#: A gram with at most this many occurrences in the vocabulary is not extended.
LIST = 16
ENTRIES = 50_000
FLUSH = 200_000
END = "\0"


def words_of(text: str | None, doc_id: str | None, min_length: int = MIN_LENGTH, noise: int = NOISE) -> Counter:
    """The text's words of at least ``min_length`` code points, after the deletions that the hash asks for."""
    out: Counter = Counter()
    if not text:
        return out
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: A-Z only
    seed = zlib.crc32(f"{doc_id or ''}:".encode())
    for run, n in Counter(re.findall("[a-zÀ-ÿ]{%d,}" % min_length, low)).items():
        h = zlib.crc32(run.encode(), seed)
        if h % noise == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < min_length:
                continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
               noise: int = NOISE) -> DataFrame:
    """word, n of every distinct word that is long and frequent enough."""

    def run(batches):
        def rows(c):
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())],
                                              names=["word", "n"])

        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                held.update(words_of(text.as_py(), doc_id.as_py(), min_length, noise))
                if len(held) > FLUSH:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    src = docs.select(F.col("doc_id").cast("string"), "text")
    return (src.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def gram_dictionary(words: DataFrame, q_least: int, q_most: int, list_size: int = LIST,
                    entries: int = ENTRIES) -> dict[str, int]:
    """Frequency of every gram that is too frequent to stay short; at most ``entries`` of each length."""
    total = words.agg(F.sum(F.length("word"))).first()[0] or 0
    most = max(list_size, -(-total // entries))
    grams = words.select(F.explode(F.expr(
        f"flatten(transform(sequence(1, length(word)), p -> transform(sequence({q_least}, {q_most}), "
        f"q -> IF(p + q <= length(word) + 2, substring(concat(word, char(0)), p, q), NULL))))")).alias("gram"))
    listed = grams.where("gram IS NOT NULL").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    got = listed.toPandas()
    return dict(zip(got["gram"].tolist(), got["n"].tolist()))


def decompose(word: str, frequent, q_least: int, q_most: int) -> list[tuple[str, int]]:
    """(gram, position): from every position the shortest gram that is not frequent, or the longest there is."""
    s, out = word + END, []
    for p in range(len(word)):
        q = q_least
        while q < q_most and p + q < len(s) and s[p:p + q] in frequent:
            q += 1
        out.append((s[p:p + q], p))
    return out


def affected(grams: list[tuple[str, int]], length: int) -> int:
    """The most grams that one edit can touch: an insertion between two characters touches fewer than either."""
    over = [0] * (length + 1)
    for g, p in grams:
        for i in range(p, min(p + len(g), length)):
            over[i] += 1
    return max(over)


def posted(word: str, frequent, q_least: int, q_most: int) -> list[tuple[str, int]]:
    """The rarest grams of the word, one more than an edit can affect."""
    grams = decompose(word, frequent, q_least, q_most)
    grams.sort(key=lambda x: (frequent.get(x[0], 0), x))
    return grams[:affected(grams, len(word)) + 1]


def postings(words: DataFrame, frequent: dict[str, int], q_least: int, q_most: int) -> DataFrame:
    """word, n, length, gram, pos: the lists that are merged."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        for batch in batches:
            of, grams, pos = [], [], []
            words_here = batch.column(0).to_pylist()
            for i, w in enumerate(words_here):
                for g, p in posted(w, shared.value, q_least, q_most):
                    of.append(i), grams.append(g), pos.append(p)
            at = pa.array(of, pa.int64())
            length = pa.array([len(words_here[i]) for i in of], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), length, pa.array(grams, pa.string()),
                 pa.array(pos, pa.int32())], names=["word", "n", "length", "gram", "pos"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, length int, gram string, pos int")


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH, list_size: int = LIST,
               entries: int = ENTRIES) -> DataFrame:
    """a, n_a, b, n_b: every pair of near words once."""
    if min_length <= Q_LEAST:
        raise ValueError("words must be longer than the shortest gram")
    q_most = min(Q_MOST, min_length - 1)  # a word then always keeps a gram that no single edit touches
    frequent = gram_dictionary(words, Q_LEAST, q_most, list_size, entries)
    lists = materialise(postings(words, frequent, Q_LEAST, q_most), "gram-lists")
    # an unaffected gram stands at the same place from the start, or one further in a word that is one longer
    probe = lists.select(F.col("word").alias("a"), F.col("n").alias("n_a"), "gram", F.explode(F.expr(
        "array(named_struct('pos', pos, 'length', length), named_struct('pos', pos, 'length', length + 1), "
        "named_struct('pos', pos + 1, 'length', length + 1))")).alias("at"),
        F.col("length").alias("own")).select("a", "n_a", "gram", "own", "at.*")
    build = lists.select(F.col("word").alias("b"), F.col("n").alias("n_b"), "gram", "pos", "length")
    met = probe.join(build, ["gram", "pos", "length"]).where(
        "(own < length OR a < b) AND levenshtein(a, b, 1) = 1")
    return met.select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last form that is reached, by pointer doubling (forms grow in frequency, so they end)."""
    jump = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = jump.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        step = jump.join(up, F.col("root") == F.col("_w"), "left")
        step = materialise(step.select("word", F.coalesce("_r", "root").alias("root"),
                                       F.col("_r").isNotNull().alias("moved")), "spelling-roots")
        jump = step.drop("moved")
        if step.where("moved").isEmpty():
            return jump


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, noise: int = NOISE,
                      ratio: int = RATIO, list_size: int = LIST, entries: int = ENTRIES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = materialise(vocabulary(docs, min_length, min_count, noise), "vocabulary")
    pairs = materialise(near_pairs(words, min_length, list_size, entries), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("b"))
    best = best.select("word", "n_near", F.col("b.near").alias("near"), (-F.col("b.rank")).alias("near_n"))
    has = F.col("near_n") >= ratio * F.col("n")
    out = words.join(best, "word", "left").select(
        "word", F.when(has, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has, F.col("near_n")).alias("form_n"))
    out = materialise(out, "spelling-forms")
    return (out.join(roots(out.where("form IS NOT NULL")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


ORACLE_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
      AS c FROM range(256) r(i))),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
coded AS (
  SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(length(x) // 2), lambda i:
             ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM coded, steps),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form,
         CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
walk AS (
  SELECT word, word AS reached, 0 AS step FROM forms
  UNION ALL SELECT k.word, f.form, k.step + 1 FROM walk k JOIN forms f ON f.word = k.reached WHERE f.form IS NOT NULL),
tops AS (SELECT word, arg_max(reached, step) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN tops USING (word)
"""
