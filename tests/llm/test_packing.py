import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm.best_fit_packing import (CAPACITY, WordTokenizer, configuration_shares, cut, dearest_configuration, pack,
                                         pack_histogram)

ODD = ["a  b\n\nc \n d\t e", "\x1c x\x85y  z\xa0 q", "don't  it's '  s", "  ", "é中文  ñ　x", " \n", "a \x1c b",
       "a ​ b", "x\n", "a ", "a\n\n b \n", "  a", "a \x85 b", "a  \nb", "a \n b", "q" * 5000, "<|endoftext|>"]


def reference_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer_library(spark, sf001):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").limit(60).collect()]
    tok = WordTokenizer()
    for t in texts:
        ids = reference_ids(t)
        assert tok(t) == struct.pack(f"<{len(ids)}I", *ids), t[:40]
    small = WordTokenizer(room=3)  # a memory that overflows changes nothing
    assert [small(t) for t in ODD] == [tok(t) for t in ODD]


def test_cut_gives_full_pieces_after_the_first():
    assert cut(1, 4) == [(0, 1)]
    assert cut(4, 4) == [(0, 4)]
    assert cut(10, 4) == [(0, 2), (2, 4), (6, 4)]


def test_knapsack_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        price = np.where(rng.random(13) < 0.5, rng.random(13), 0.0)
        price[0] = 0
        best = np.zeros(13)
        for c in range(1, 13):
            best[c] = max([best[c - 1]] + [best[c - n] + price[n] for n in range(1, c + 1)])
        a = dearest_configuration(price, 12)
        assert (a * np.arange(13)).sum() <= 12
        assert (a * price).sum() == pytest.approx(best[12])


def test_histogram_is_packed_whole_and_tight():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 400, 129)
    counts[0] = 0
    plan = pack_histogram(counts, 128)
    total = sum(n * a for a, n in zip(plan.configs, plan.copies))
    assert (total == counts).all()
    assert all((a * np.arange(129)).sum() <= 128 for a in plan.configs)
    bound = -(-int((counts * np.arange(129)).sum()) // 128)
    assert plan.sequences <= bound * 1.02 + 1
    assert configuration_shares(np.zeros(129), 128) == []


def check(rows, docs):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for d, t in docs:
        ids = reference_ids(t) + [2]
        got = sorted(by_doc[d], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in got] == cut(len(ids), CAPACITY)
        for r in got:
            part = ids[r.start:r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= CAPACITY
    return len(places)


def test_pack_places_every_piece(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    rows = pack(docs).collect()
    n = check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert n <= -(-sum(r.length for r in rows) // CAPACITY) * 1.05 + 1


def test_pack_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "word " * 3000), (4, "same"), (5, "same"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("length", F.lit("clash"))
    check(pack(df).collect(), rows)
    assert pack(df.limit(0)).count() == 0
    twice = pack(df.where("doc_id = 4").union(df.where("doc_id = 4"))).collect()
    assert len(twice) == 2 and len({(r.sequence_id, r.offset) for r in twice}) == 2
