import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import _bytes
from quarry.llm._graph import connected_components, forest
from quarry.llm.bayes_jaccard import (HASHES, STEP, fewest_matches, jaccard_classes, signature, surviving_pairs,
                                      verified)
from quarry.llm.permutation_index import InvertedFiles, orders, search
from quarry.llm.projection_dedup import vector_components


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    n = 400
    pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(300)] + [(i, i + 1) for i in range(300, 380)]
    pairs += [(0, i) for i in range(100, 200)]  # a hub
    got = {r.id: r.comp for r in connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    want = roots(n, pairs)
    assert all(got.get(i, i) == want[i] for i in range(n))
    assert len(got) == len({x for p in pairs for x in p if p[0] != p[1]})
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_forest_spans():
    assert forest(4, [(0, 1), (1, 2), (0, 2), (3, 3)]) == [(0, 1), (1, 2)]


def brute_jaccard(rows):
    sets = [set(_bytes.shingles(t).tolist()) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    links = collections.Counter(x for p in pairs for x in p)
    root = roots(len(rows), pairs)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root[i]] = min(low.get(root[i], d), d)
    return sorted(((d, low.get(root[i], None), links[i]) for i, (d, _) in enumerate(rows)), key=str)


def jaccard(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("node", F.lit("clash"))
    out = jaccard_classes(df, **kw).collect()
    assert all(r.kept == (r.doc_id == r.class_id) for r in out)
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in out), key=str)


@pytest.mark.parametrize("block", [96, 7])
def test_jaccard_equals_brute_force(spark, block):
    rng = random.Random(block)
    rows = []
    for g in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([6, 30, 200]))]
        for _ in range(rng.choice([1, 2, 30])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 3, 6])):
                t[rng.randrange(len(t))] = f"x{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(t)))
    assert jaccard(spark, rows, block=block) == brute_jaccard(rows)


def test_jaccard_edge_cases(spark):
    rows = [(9, None), (8, ""), (7, "!!! ..."), (6, "two words"), (5, "Two, WORDS!"), (4, "a b c d e f " * 4000),
            (3, "a b c d e f " * 3999), (2, "same id one two three four five"), (2, "same id other words of it here"),
            (1, "same id one two three four five"), (None, "two words"), (None, None)]
    got = jaccard(spark, rows)
    want = [(d, d if c is None else c, n) for d, c, n in brute_jaccard(rows)]
    assert got == sorted(want, key=str)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert jaccard_classes(df.limit(0)).count() == 0


def test_pruning_is_safe_and_prunes():
    least = fewest_matches(0.8, 1e-6)
    assert len(least) == HASHES // STEP and least == sorted(least) and least[-1] > 0.55 * HASHES
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
    sets = [np.unique(base)]
    for share in (0.02, 0.05, 0.1, 0.5):
        x = base.copy()
        x[: int(share * 300)] = rng.integers(0, 2 ** 63, int(share * 300)).astype(np.uint64)
        sets.append(np.unique(x))
    sets.append(np.unique(rng.integers(0, 2 ** 63, 300).astype(np.uint64)))
    sig = np.asarray([signature(s) for s in sets])
    i, j = surviving_pairs(sig, None, least)
    kept = set(zip(i.tolist(), j.tolist()))
    assert {(0, 1), (0, 2), (0, 3)} <= kept and (0, 5) not in kept and (0, 4) not in kept
    few = verified(sets, i, j, 0.8)
    many = verified(sets, np.tile(i, 9), np.tile(j, 9), 0.8)[: len(i)]  # the matrix form agrees with the set form
    assert (few == many).all()


def clusters(seed, n=300, dim=16):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, dim))
    x = np.concatenate([centre[rng.integers(0, 12, n)] + 0.22 * rng.normal(size=(n, dim)), rng.normal(size=(n, dim))])
    x[5] = x[7] = x[9]
    return x


def test_projection_passes_equal_brute_force(spark):
    x = clusters(1)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [None] * 16), (1004, [float("nan")] * 16),
           (1005, [float("inf")] * 16), (1006, [1.0, 2.0]), (5, rows[5][1]), (None, rows[5][1])]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").withColumn("node", F.lit(1))
    got = vector_components(df, block=64, pair_block=32).collect()
    ids = [i for i, _ in rows] + [5, None]
    y = np.concatenate([x, x[5:6], x[5:6]])
    u = y / np.sqrt((y * y).sum(1, keepdims=True))
    hit = u @ u.T >= 0.95
    np.fill_diagonal(hit, False)
    root = roots(len(y), list(zip(*np.nonzero(hit))))
    low = {}
    for i, r in zip(ids, root):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    want = sorted(((i, int(n), low[r]) for i, n, r in zip(ids, hit.sum(1), root)), key=str)
    want = sorted(want + [(i, 0, i) for i in range(1000, 1007)], key=str)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == want
    assert vector_components(df.limit(0)).count() == 0


def test_footrule_from_inverted_files():
    rng = np.random.default_rng(3)
    x, p = rng.normal(size=(40, 8)), rng.normal(size=(12, 8))
    o = orders(x, p, 5)
    files = InvertedFiles(o, 12)
    for q in o[:6]:
        got = files.footrule(q)
        for i, e in enumerate(o):
            place = lambda s, v: int(np.flatnonzero(s == v)[0]) if v in s else 5
            assert got[i] == sum(abs(place(q, v) - place(e, v)) for v in {*q, *e})


def brute_search(ids, x, every, k):
    out = []
    for i, v in zip(ids, x):
        if i % every == 0:
            s = np.asarray([float(np.dot(v, w)) for w in x])
            order = sorted((-s[j], ids[j]) for j in range(len(ids)) if ids[j] != i)[:k]
            out += [(i, r + 1, j) for r, (_, j) in enumerate(order)]
    return out


def test_search_recall_and_form(spark):
    x = clusters(2)
    ids = list(range(len(x)))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in zip(ids, x)],
                               "vec_id bigint, embedding array<double>").withColumn("score", F.lit("clash"))
    got = search(df, every=20, least=120, pivots=128, block=200).collect()
    want = brute_search(ids, x, 20, 20)
    pairs = {(r.query_id, r.vec_id) for r in got}
    assert len(pairs & {(q, v) for q, _, v in want}) / len(want) > 0.9
    for r in got:
        assert r.score == pytest.approx(float(np.dot(x[r.query_id], x[r.vec_id])), rel=1e-12)
    whole = search(df, every=20, least=10_000, block=200).collect()  # all reranked: exact
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in whole) == sorted(want)


def test_search_edge_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [1.0, None]), (20, [0.5, 0.5]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (40, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in search(df).collect())
    assert got == [(0, 1, 1), (0, 2, 20), (0, 3, 2), (20, 1, 0), (20, 2, 1), (20, 3, 2)]
    assert search(df.limit(0)).count() == 0
    hot = spark.createDataFrame([(i, [1.0, 0.5]) for i in range(100)], df.schema)
    assert sorted(r.vec_id for r in search(hot).where("query_id = 20").collect()) == [*range(20)]
