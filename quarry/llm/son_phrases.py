"""Phrase collocation mining by SON partitioning (operator 12).

Documents are dealt into a few shards by hash. Every shard is mined completely,
level by level, at a local support lowered in proportion to its share of the
language's words, ``ceil(support * share)``: a phrase that reaches the support
overall reaches the local one in at least one shard. The union of the locally
frequent phrases is then counted globally and exactly, as text, in one more
pass over all documents, and candidates are scored by their weakest cut.

A shard is a share of the whole corpus, not a task: each task counts the
phrases of its own slices in numpy and the partial counts meet by phrase and
shard, so neither a shard nor a language is ever gathered. Three things make
this cheap, and all of them can only add candidates, never lose one: local
counts are kept under a hash of the phrase; a phrase of k words is only looked
at where both its parts of k - 1 words are locally frequent; the last pass only
looks at candidates. Both memberships are Bloom filters of a fixed size
(``FILTER_CELLS`` longs): what a collision lets through is dropped by the exact
count, and a filter too small for the corpus costs time only.

Texts are split at piece breaks into slices of about ``SLICE`` bytes, so a long
text or a large batch is never held in wide arrays; a piece without any break
stays whole.

Defined cases: a null text is empty; a null lang is ``und``; an empty table, or
one without a phrase of the support, gives no rows; rows that repeat count each;
words are told apart byte by byte; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import _bytes
from quarry.llm._shared import materialise

SUPPORT = 10
MAX_WORDS = 3
SHARDS = 2
TOP = 2000
#: A candidate inside a longer one goes when the longer one has at least this share (percent) of its occurrences.
COVERED = 50
#: A power of two, at most 2**20 (8 MB): two bits a phrase are taken from the upper 52 bits of its hash.
FILTER_CELLS = 1 << 20
_PART = 1 << 13
SLICE = 1 << 19
#: Partial counts that a task puts together before it hands them on; a quarter as many where they are text.
HELD = 1 << 19
SALT = 8
#: Lower 12 bits of a key: language bucket and shard.
_SHARD_BITS, _LANG_BITS = 4, 8
_U = np.uint64

# class of a byte: 0 part of a word, 1 blank, 2 end of a piece
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the offsets of its rows (null: empty)."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    buffers = column.buffers()
    at = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def _slices(data: np.ndarray, starts: np.ndarray, size: int):
    """(from, to) of consecutive slices that end where a piece or a row does."""
    ends = np.union1d(np.flatnonzero(_CLASS[data] == 2) + 1, starts) if len(data) > size else np.zeros(0, np.int64)
    lo = 0
    while lo < len(data):
        hi = len(data)
        if hi - lo > size:
            k = np.searchsorted(ends, lo + size, "right") - 1
            if k < 0 or ends[k] <= lo:  # no break within the slice: up to the next one
                k += 1
                while k < len(ends) and ends[k] <= lo:
                    k += 1
            hi = int(ends[k]) if k < len(ends) else hi
        yield lo, hi
        lo = hi


class Words:
    """The words of a slice: codes into ``words`` (distinct), their pieces and their rows."""

    def __init__(self, data: np.ndarray, row_starts: np.ndarray, first_row: int):
        kind = _CLASS[data]
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = kind == 0
        fresh = np.zeros(len(data) + 1, bool)  # a row starts here: nothing crosses
        fresh[row_starts] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | fresh[1:]
        begin = np.flatnonzero(start[:-1])
        # words stand back to back once blanks and breaks are taken out
        body = _LOWER[data[inside[:-1]]]
        stop = np.flatnonzero(inside[:-1] & (~inside[1:] | fresh[1:])) + 1
        offsets = np.zeros(len(begin) + 1, np.int64)
        np.cumsum(stop - begin, out=offsets[1:])
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [
            None, pa.py_buffer(offsets), pa.py_buffer(body)])
        coded = column.dictionary_encode()
        self.words = coded.dictionary
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        cut = fresh[:-1] | (kind == 2)
        self.piece = np.cumsum(cut, dtype=np.int32)[begin]
        self.row = np.searchsorted(row_starts, begin, "right") - 1 + first_row

    def hashes(self) -> np.ndarray:
        """64-bit hash of every distinct word."""
        at = np.frombuffer(self.words.buffers()[1], np.int64)[:len(self.words) + 1]
        if not len(self.words):
            return np.zeros(0, _U)
        raw = np.frombuffer(self.words.buffers()[2], np.uint8)[at[0]:at[-1]]
        return _bytes.span_hash(_bytes.prefix_hash(raw), at[:-1] - at[0], at[1:] - at[0])


def _each_slice(batch: pa.RecordBatch, size: int = SLICE):
    """``Words`` of every slice of the batch's first column, in order; only a few rows are copied at a time."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    row = 0
    while row < batch.num_rows:
        done = int(upto[row - 1]) if row else 0
        last = max(int(np.searchsorted(upto, done + size, "right")), row + 1)
        data, at = _offsets(batch.column(0).slice(row, last - row))
        starts = at[:-1]
        for lo, hi in _slices(data, np.unique(starts), size):
            first, stop = int(np.searchsorted(at, lo, "right")) - 1, int(np.searchsorted(starts, hi, "left"))
            yield Words(data[lo:hi], np.maximum(at[first:stop] - lo, 0), row + first)
        row = last


def _fold(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _bytes.mix(h * _U(0x9E3779B97F4A7C15) + word)


def _string_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each string of a short dictionary."""
    out = np.zeros(len(words), _U)
    for i, w in enumerate(words):
        b = np.frombuffer(w.as_py().encode("utf-8", "surrogatepass"), np.uint8)
        out[i] = _bytes.mix(_bytes.prefix_hash(b)[-1:] + _U(len(b)))[0]
    return out


def in_filter(cells: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are set; ``make_filter`` takes the same bits."""
    most, ok = _U(len(cells) - 1), np.ones(len(h), bool)
    for low in (12, 38):
        place = (h >> _U(low)) & most
        ok &= (cells[place.astype(np.int64)] >> ((h >> _U(low + 20)) & _U(63))) & _U(1) != 0
    return ok


def make_filter(keys: DataFrame, cells: int = FILTER_CELLS):
    """A broadcast Bloom filter of the column ``key``; its ``cells`` longs reach the driver in parts of 64 KB."""
    if cells & (cells - 1) or not 0 < cells <= FILTER_CELLS:
        raise ValueError("cells must be a power of two up to FILTER_CELLS")
    two = F.array(*[F.expr(f"struct(shiftrightunsigned(key, {low}) & {cells - 1}L AS cell, "
                           f"shiftleft(1L, CAST(shiftrightunsigned(key, {low + 20}) & 63L AS INT)) AS mask)")
                    for low in (12, 38)])
    by_cell = keys.select(F.explode(two).alias("b")).groupBy("b.cell").agg(F.bit_or("b.mask").alias("mask"))

    def pack(t: pa.Table) -> pa.Table:
        cell = t.column("cell").to_numpy()
        part = np.zeros(_PART, np.int64)
        part[cell % _PART] = t.column("mask").to_numpy()
        return pa.table({"part": pa.array([int(cell[0]) // _PART], pa.int64()), "bits": pa.array([part.tobytes()])})

    packed = by_cell.groupBy(F.floor(F.col("cell") / F.lit(_PART))).applyInArrow(pack, "part bigint, bits binary")
    out = np.zeros(max(cells, _PART), np.int64)
    for r in packed.toLocalIterator():
        out[r["part"] * _PART:(r["part"] + 1) * _PART] = np.frombuffer(r["bits"], np.int64)
    return keys.sparkSession.sparkContext.broadcast(out[:cells].view(_U))


class _Batch:
    """A batch of (text, lang, shard): per slice, where phrases of each length start and what they hash to."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch = batch
        lang = batch.column(1).dictionary_encode()
        self.langs = lang.dictionary
        self.lang = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.shard = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        self.base = _string_hashes(self.langs)

    def slices(self, size: int):
        for w in _each_slice(self.batch, size):
            if len(w.code):
                yield w, w.hashes(), self.base[self.lang[w.row]]

    @staticmethod
    def starts(w: Words, k: int) -> np.ndarray:
        n = max(len(w.code) - k + 1, 0)
        return np.flatnonzero(w.piece[:n] == w.piece[k - 1:k - 1 + n])

    @staticmethod
    def hashed(base, word, code, at, k: int) -> np.ndarray:
        h = base[at]
        for i in range(k):
            h = _fold(h, word[code[at + i]])
        return h


def language_bucket(base: np.ndarray) -> np.ndarray:
    return base & _U((1 << _LANG_BITS) - 1)


def local_counts(docs: DataFrame, lengths: tuple[int, ...], parts=None, size: int = SLICE) -> DataFrame:
    """key, n: partial counts of the phrases of so many words, one row per slice that has it.

    A key is 52 bits of the hash of language and phrase, the language's bucket and the shard. ``parts``, a broadcast
    filter, must hold both parts of one word less.
    """

    def counts(batches):
        for batch in batches:
            b = _Batch(batch)
            for w, word, base in b.slices(size):
                low = (language_bucket(base) << _U(_SHARD_BITS)) | b.shard[w.row].astype(_U)
                for k in lengths:
                    at = b.starts(w, k)
                    if parts is not None:
                        for shift in (0, 1):
                            at = at[in_filter(parts.value, b.hashed(base, word, w.code, at + shift, k - 1))]
                    if not len(at):
                        continue
                    key = b.hashed(base, word, w.code, at, k)
                    key = (key >> _U(12) << _U(12)) | low[at]
                    yield np.unique(key, return_counts=True)

    def merged(held):
        key, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(key, kind="stable")  # sorted runs: a merge
        key, n = key[order], n[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(key[first].view(np.int64)), pa.array(np.add.reduceat(n, first))],
                                          names=["key", "n"])

    def run(batches):
        held, size_held = [], 0
        for key, n in counts(batches):
            held.append((key, n))
            size_held += len(key)
            if size_held > HELD:
                yield merged(held)
                held, size_held = [], 0
        if held:
            yield merged(held)

    return docs.mapInArrow(run, "key bigint, n bigint")


def exact_counts(docs: DataFrame, lengths: tuple[int, ...], whole, size: int = SLICE) -> DataFrame:
    """lang, phrase, n: partial counts, as text, of the phrases that the broadcast filter ``whole`` holds."""

    def counts(batches):
        for batch in batches:
            b = _Batch(batch)
            for w, word, base in b.slices(size):
                v, lang = len(w.words), b.lang[w.row]
                code, above = lang * v + w.code, len(b.langs) * v
                for k in range(1, max(lengths) + 1):
                    if k > 1:
                        m = max(len(code) - 1, 0)
                        if above * v >= 1 << 62:  # the next code would not fit: number the phrases so far
                            code = np.unique(code, return_inverse=True)[1]
                            above = len(code)
                        code, above = code[:m] * v + w.code[k - 1:k - 1 + m], above * v
                    at = b.starts(w, k) if k in lengths else np.zeros(0, np.int64)
                    at = at[in_filter(whole.value, b.hashed(base, word, w.code, at, k))]
                    if not len(at):
                        continue
                    _, where, n = np.unique(code[at], return_index=True, return_counts=True)
                    pick = at[where]
                    cols = [w.words.take(pa.array(w.code[pick + i])) for i in range(k)]
                    text = pc.binary_join_element_wise(*cols, pa.scalar(b" ", pa.large_binary())) if k > 1 else cols[0]
                    yield pa.table([b.langs.take(pa.array(lang[pick])), text.cast(pa.binary()), pa.array(n, pa.int64())],
                                   names=["lang", "phrase", "n"])

    def merged(held):
        t = pa.concat_tables(held).group_by(["lang", "phrase"]).aggregate([("n", "sum")]).combine_chunks()
        for b in t.to_batches():
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("phrase").view(pa.string()), b.column("n_sum")],
                                             names=["lang", "phrase", "n"])

    def run(batches):
        held, rows = [], 0
        for t in counts(batches):
            held.append(t)
            rows += t.num_rows
            if rows > HELD // 4:
                yield from merged(held)
                held, rows = [], 0
                pa.default_memory_pool().release_unused()
        if held:
            yield from merged(held)

    return docs.mapInArrow(run, "lang string, phrase string, n bigint")


def word_totals(docs: DataFrame) -> DataFrame:
    """lang, low, n: word occurrences by language and by the lower bits of the keys, from word beginnings alone."""

    def run(batches):
        for batch in batches:
            b = _Batch(batch)
            data, at = _offsets(batch.column(0))
            n = np.zeros(batch.num_rows, np.int64)
            for r in range(batch.num_rows):
                inside = _CLASS[data[at[r]:at[r + 1]]] == 0
                n[r] = np.count_nonzero(inside[1:] & ~inside[:-1]) + int(len(inside) > 0 and inside[0])
            low = (language_bucket(b.base[b.lang]) << _U(_SHARD_BITS)).astype(np.int64) | b.shard
            yield pa.RecordBatch.from_arrays([b.langs.take(pa.array(b.lang)), pa.array(low), pa.array(n)],
                                             names=["lang", "low", "n"])

    return docs.mapInArrow(run, "lang string, low bigint, n bigint").groupBy("lang", "low").agg(F.sum("n").alias("n"))


def local_supports(totals: DataFrame, support: int) -> DataFrame:
    """low, least: the local support by bucket and shard, the lowest one where languages share a bucket (4096 rows)."""
    share = totals.where("n > 0").withColumn("n_all", F.sum("n").over(Window.partitionBy("lang")))
    return share.groupBy("low").agg(F.min(F.expr(
        f"greatest(1L, ({support}L * n + n_all - 1) div n_all)")).alias("least"))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, max_words: int = MAX_WORDS, shards: int = SHARDS,
                     cells: int = FILTER_CELLS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of every phrase of 1 to ``max_words`` words with f >= ``support``, and (lang, n) of all words."""
    if not 0 < shards <= 1 << _SHARD_BITS:
        raise ValueError("from 1 to 16 shards")
    src = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"),
                      F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"))
    totals = materialise(word_totals(src), "phrase-totals")
    least = F.broadcast(local_supports(totals, support))  # a row per bucket and shard at most

    def mined(lengths, parts=None):
        sums = local_counts(src, lengths, parts).groupBy("key").agg(F.sum("n").alias("n"))
        low = F.col("key").bitwiseAND(F.lit((1 << (_SHARD_BITS + _LANG_BITS)) - 1))
        found = sums.withColumn("low", low).join(least, "low").where("n >= least").select("key")
        return materialise(found, f"phrases-{lengths[-1]}")

    level = union = mined((1, 2))
    for k in range(3, max_words + 1):
        level = mined((k,), make_filter(level, cells))
        union = union.unionByName(level)
    counted = exact_counts(src, tuple(range(1, max_words + 1)), make_filter(union, cells))
    # whatever a collision let in has f < support: SON misses no phrase that reaches it
    f = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= support)
    return materialise(f, "phrase-counts"), totals.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, support: int = SUPPORT, max_words: int = MAX_WORDS, shards: int = SHARDS,
                 top: int | None = TOP, covered: int = COVERED, cells: int = FILTER_CELLS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` collocations (None: all)."""
    f, totals = frequent_phrases(docs, support, max_words, shards, cells)
    words = F.split("phrase", " ")
    cand = f.withColumn("w", words).where(F.size("w") > 1).select("lang", "phrase", F.col("f").alias("a"), "w")
    cand = cand.withColumn("_s", F.pmod(F.xxhash64("phrase"), F.lit(SALT)).cast("int"))
    cuts = cand.select("lang", "phrase", "a", "_s", F.explode(F.expr(
        "transform(sequence(1, size(w) - 1), k -> struct(k, array_join(slice(w, 1, k), ' ') AS head, "
        "array_join(slice(w, k + 1, size(w) - k), ' ') AS tail))")).alias("c")).select("lang", "phrase", "a", "_s", "c.*")
    # the parts of frequent phrases are frequent; a very common word is looked up by SALT tasks, not one
    part = f.where(F.size(words) < max_words).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    head = part.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"), "_s")
    tail = part.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"), "_s")
    scored = cuts.join(head, ["lang", "head", "_s"]).join(tail, ["lang", "tail", "_s"])
    scored = scored.withColumn("score", F.expr(
        "(CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))) "
        "div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    weakest = weakest.select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    inside = cand.where(F.size("w") > 2).select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, size(w) - 1), k -> transform(sequence(1, size(w) - k + 1), "
        "i -> array_join(slice(w, i, k), ' '))))")).alias("phrase"))
    longest = inside.groupBy("lang", "phrase").agg(F.max("a").alias("_in"))
    kept = weakest.join(longest, ["lang", "phrase"], "left").where(f"_in IS NULL OR 100 * _in < {covered} * a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = kept.withColumn("_s", F.pmod(F.xxhash64(F.lit(1), "phrase"), F.lit(4 * SALT)))
    if top is not None:  # a language's first rows come from those of its parts: no task sees a whole language
        part = Window.partitionBy("lang", "_s").orderBy(*order)
        ranked = ranked.withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (
    SELECT lang, ws, k, unnest(range(1, len(ws) + 2 - k)) AS i FROM words, (VALUES (1), (2), (3)) ks(k)
    WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:k], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)),
scored AS (
  SELECT s.lang, s.phrase, s.a, s.c, h.f AS l, t.f AS r, (1000000 * s.a * s.a) // (h.f * t.f) AS score
  FROM cuts s JOIN f h ON h.lang = s.lang AND h.phrase = s.head JOIN f t ON t.lang = s.lang AND t.phrase = s.tail),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest([1, 2]) AS i FROM cand WHERE k = 3) GROUP BY ALL),
ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
  FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.phrase = w.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
