import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm._grouping import suffix_arrays
from quarry.llm.suffix_dedup import remove_repeats, runs


def brute(rows, length):
    seen = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def operator(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("spans", F.lit("clash"))
    out = remove_repeats(df, **kw).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("h"))
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_suffix_arrays_equal_sorting():
    rng = np.random.default_rng(1)
    for trial in range(60):
        texts = [rng.integers(0, rng.integers(1, 6), rng.integers(0, 60)) for _ in range(rng.integers(1, 8))]
        texts.append(np.tile(rng.integers(0, 3, rng.integers(1, 6)), 12))
        for t, s in zip(texts, suffix_arrays(texts)):
            b = bytes(t.tolist())
            assert s.tolist() == sorted(range(len(b)), key=lambda i: b[i:])


@pytest.mark.parametrize("length,gram,lane", [(20, 8, 16), (20, 8, 2), (12, 12, 4)])
def test_equals_brute_force_on_planted_repeats(spark, length, gram, lane):
    rng = random.Random(length + lane)
    passage = ["".join(rng.choice("abcd é") for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 50))) for _ in range(3)]
        if i % 2:
            p = list(rng.choice(passage))
            if i % 3 == 0:
                p[rng.randrange(60)] = "X"
            parts.insert(1, "".join(p))
        if i % 10 == 0:
            parts.append("zy" * rng.randrange(1, 40))
        rows.append((i, "".join(parts)))
    rows += [(200 + i, rows[3][1]) for i in range(5)]
    assert operator(spark, rows, length=length, gram=gram, lane=lane) == brute(rows, length)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "short"), (4, "a" * 700), (5, "q" * 199), (6, "q" * 200), (None, "w" + "xyz" * 90),
            (7, "k" * 201), (8, "é" * 99 + "!"), (9, "é" * 99 + "!" + "é" * 120)]
    assert operator(spark, rows) == brute(rows, 200)
    twice = [(1, "abcdefghij" * 15 + "tail" * 20)] * 2
    assert operator(spark, twice) == brute(twice, 200)
    assert operator(spark, [(1, "x")][:0] or []) == []


def test_a_run_that_meets_its_gram_twice_is_seen():
    text = b"0123456789" * 5
    key, _, start, windows, twice = runs(text, 20, 8)
    assert twice.any() and windows.sum() == len(text) - 19 and (np.diff(start) > 0).all()


def test_given_table_and_text_form(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert operator(spark, rows) == brute(rows, 200)
    text = remove_repeats(docs, as_text=True)
    assert text.schema["kept"].dataType.simpleString() == "string" and text.count() == len(rows)
