import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import son_phrases as S

SCHEMA = "doc_id bigint, text string, lang string, phrase string, shard string, n string"


def table(spark, rows):
    """Documents with columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, t, g, "clash", "clash", "clash") for i, t, g in rows], SCHEMA)


def brute(rows, support, max_words=3, top=2000, covered=50):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    out = collections.defaultdict(list)
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= support}
    for (lang, p), a in cand.items():
        cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        longer = [b for (g, q), b in cand.items() if g == lang and len(q) > len(p)
                  and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if not any(100 * b >= covered * a for b in longer):
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(v)[:top], 1))


def corpus(seed, docs=120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "été", "ÉTÉ", "x-y", "a b", "日本", "new", "york", "city", "z" * 50]
    rows = []
    for i in range(docs):
        t = ""
        for _ in range(rng.choice([0, 3, 40])):
            t += rng.choice(words[:rng.choice([3, 12])]) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "!\r"])
            if rng.random() < 0.2:
                t += "New York City "
        rows.append((rng.choice([i, 7, None]), t, rng.choice(["en", "en", "fr", None, ""])))
    return rows + [(1, None, "en"), (2, "", None), (3, "only " * 30, "de"), (3, "only " * 30, "de")]


@pytest.mark.parametrize("seed,shards,max_words,cells", [(1, 3, 3, 1 << 16), (2, 1, 2, 1), (3, 5, 4, 2)])
def test_equals_brute_force(spark, seed, shards, max_words, cells):
    rows = corpus(seed)
    got = S.collocations(table(spark, rows), support=5, max_words=max_words, shards=shards, cells=cells)
    want = brute(rows, 5, max_words)
    assert len(want) > 20
    assert sorted(tuple(r) for r in got.collect()) == want


def test_short_list_and_ties(spark):
    rows = [(i, "b c. a b! d e", "en") for i in range(12)]
    got = S.collocations(table(spark, rows), top=2)
    assert [(r["rank"], r.phrase, r.score) for r in got.orderBy("rank").collect()] == [
        (1, "d e", 1000000), (2, "a b", 500000)]


def test_empty_tables(spark):
    for rows in ([], [(1, None, None)], [(1, "...", "en"), (2, "one two", "en")]):
        assert S.collocations(table(spark, rows)).collect() == []


def test_every_frequent_phrase_reaches_a_local_support(spark):
    """All of a phrase's occurrences in one shard, or spread as thinly as can be."""
    rows = [(i, "left right", "en") for i in range(10)] + [(99, "up down, " * 10, "en")]
    rows += [(1000 + i, f"w{i} v{i}", "en") for i in range(200)]
    got = S.collocations(table(spark, rows), shards=4)
    assert {r.phrase: r.a for r in got.collect()} == {"left right": 10, "up down": 10}


def test_slices_of_long_texts_and_products_beyond_64_bits(spark):
    rows = [(1, ("alpha beta gamma, " * 4000 + "delta epsilon ") * 3, "en"), (2, "x" * 300000 + " y", "en")]
    src = table(spark, rows).select("text", "lang", F.lit(0).alias("shard"))
    one = S.local_counts(src, (1, 2, 3)).groupBy("key").agg(F.sum("n")).collect()
    cut = S.local_counts(src, (1, 2, 3), size=1000).groupBy("key").agg(F.sum("n")).collect()
    assert sorted(one) == sorted(cut) and len(one) > 10
    big = 3_000_000_000_000
    score = spark.range(1).select(F.expr(
        f"(CAST(1000000 AS DECIMAL(7,0)) * (CAST({big}L AS DECIMAL(15,0)) * CAST({big}L AS DECIMAL(15,0)))) div "
        f"(CAST({big + 1}L AS DECIMAL(15,0)) * CAST({big}L AS DECIMAL(15,0)))").alias("s")).first().s
    assert score == 1000000 * big * big // ((big + 1) * big)


def test_words_of_a_batch():
    column = pa.array(["Ab c", None, "", "d", ".E  f\t"])
    w, = S._each_slice(pa.RecordBatch.from_arrays([column], names=["t"]))
    assert [w.words[c].as_py() for c in w.code] == [b"ab", b"c", b"d", b"e", b"f"]
    assert w.row.tolist() == [0, 0, 3, 4, 4]
    assert len({tuple(w.piece[w.row == r]) for r in (0, 3, 4)}) == 3 and w.piece[0] == w.piece[1]
    assert len(np.unique(w.hashes())) == 5


def test_filter_holds_what_was_put_in(spark):
    keys = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 3000, np.int64)
    held = S.make_filter(spark.createDataFrame([(int(k),) for k in keys], "key bigint"), 1 << 14).value
    assert S.in_filter(held, keys.view(np.uint64)).all()
    other = np.random.default_rng(4).integers(0, 1 << 64, 3000, np.uint64)
    assert S.in_filter(held, other).mean() < 0.01
