import numpy as np
import pandas as pd
import pytest

from quarry.operators import recommend as R
from quarry.operators import topk


def frame(spark, ids, m):
    return spark.createDataFrame([(int(i), [float(x) for x in v], "clash") for i, v in zip(ids, m)],
                                 "id bigint, features array<double>, score string")


def brute(q_ids, q, i_ids, x, k, cosine=False, exclude=False):
    out = []
    for a, u in zip(q_ids, q):
        rows = []
        for b, v in zip(i_ids, x):
            if exclude and a == b:
                continue
            s = float((u * v).sum())
            if cosine:
                d = np.sqrt((u * u).sum()) * np.sqrt((v * v).sum())
                if d == 0:
                    continue
                s /= d
            rows.append((-s, b))
        rows.sort()
        if not (cosine and not u.any()):
            out += [(a, b, round(-s, 9), i) for i, (s, b) in enumerate(rows[:k], 1)]
    return sorted(out)


def got(t):
    return sorted((r["query"], r["item"], round(r["score"], 9), r["rank"]) for r in t.rows.collect())


@pytest.mark.parametrize("norms", ["unit", "log-normal", "equal directions"])
def test_inner_product_equals_brute_force(spark, norms):
    rng = np.random.default_rng(len(norms))
    x = rng.normal(size=(700, 12))
    x /= np.sqrt((x * x).sum(1))[:, None]
    if norms == "log-normal":
        x *= np.exp(rng.normal(size=700) * 1.5)[:, None]
    if norms == "equal directions":
        x = np.round(x[:10], 1)[rng.integers(0, 10, 700)] * rng.integers(1, 6, 700)[:, None]
    q = rng.normal(size=(150, 12))
    q_ids, i_ids = np.arange(150).tolist(), (np.arange(700) * 7 % 1009).tolist()
    t = topk.top_k(frame(spark, q_ids, q), frame(spark, i_ids, x), 10, block=32)
    assert got(t) == brute(q_ids, q, i_ids, x, 10)
    scored = t.scored.first()[0]
    assert scored <= 150 * 700
    if norms == "log-normal":
        assert scored < 150 * 700 / 2, scored  # small norms cannot reach the list


def test_cosine_neighbours_of_all_rows(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16)) * 3
    x = centres[rng.integers(0, 12, 600)] + rng.normal(size=(600, 16)) * 0.2
    x[5] = x[6] = x[7]
    x[9] = 0.0
    ids = list(range(600))
    src = frame(spark, ids, x)
    t = topk.top_k(src, src, 11, cosine=True, exclude_same=True, block=40)
    assert got(t) == brute(ids, x, ids, x, 11, True, True)
    assert t.scored.first()[0] < 600 * 600 / 3  # other clusters are ruled out by their angle
    few = topk.top_k(src, src, 11, cosine=True, exclude_same=True, block=40, max_blocks=2)
    assert got(few) == got(t)


def test_edge_cases(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [0.0, 0.0]), (5, [2.0, 0.0]), (5, [0.0, 3.0]),
            (6, []), (7, [1.0, None]), (None, [1.0, 1.0])]
    src = spark.createDataFrame(rows, "id bigint, features array<double>")
    out = topk.top_k(src, src, 3).rows.collect()
    want = {(1, 5, 2.0), (1, 1, 1.0), (1, None, 1.0)}
    assert {(r["query"], r["item"], r["score"]) for r in out if r["query"] == 1} == want
    assert sum(r["query"] == 5 for r in out) == 6  # rows that share an id, each its own list
    assert sum(r["query"] == 4 for r in out) == 3  # a zero vector scores 0 with everything
    assert {r["query"] for r in topk.top_k(src, src, 3, cosine=True).rows.collect()} == {1, 5, None}
    none = src.limit(0)
    assert topk.top_k(none, src, 3).rows.collect() == [] == topk.top_k(src, none, 3).rows.collect()
    assert topk.top_k(src, none, 3).scored.first()[0] == 0
    bad = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id int, features array<double>")
    with pytest.raises(Exception, match="components"):
        topk.top_k(bad, bad, 1).rows.collect()


def test_model_ranking_over_als_factors(spark):
    rng = np.random.default_rng(8)
    r = spark.createDataFrame([(int(u), int(i), float(1 + (u * 3 + i) % 5)) for u in range(40) for i in rng.integers(0, 60, 9)],
                              "user int, item int, rating double")
    model = R.fit_als(r, rank=6, iters=3)
    k = 5
    t = R.top_items_all(model, k, block=16)
    users = {x["id"]: np.asarray(x["features"], float) for x in model.userFactors.collect()}
    items = {x["id"]: np.asarray(x["features"], float) for x in model.itemFactors.collect()}
    want = brute(list(users), list(users.values()), list(items), list(items.values()), k)
    assert got(t) == want
    one = R.top_items_for_user(model, 3, k).collect()
    assert [x["item"] for x in one] == [w[1] for w in sorted(want, key=lambda w: w[3]) if w[0] == 3]
    m = R.map_at_k_of_model(model, r, k).first()
    actual = {}
    for x in r.collect():
        actual.setdefault(x.user, []).append(x.item)
    total = 0.0
    for u in users:
        hits = score = 0
        for pos, (_, i, _, _) in enumerate(sorted((w for w in want if w[0] == u), key=lambda w: w[3])):
            if i in actual[u]:
                hits += 1
                score += hits / (pos + 1)
        total += score / min(len(actual[u]), k)
    assert m.n_users == len(users) and abs(m.mapk - total / len(users)) < 1e-9


@pytest.mark.parametrize("block", [1024, 16])
def test_pairs_above_equal_brute_force(spark, block):
    rng = np.random.default_rng(block)
    x = np.concatenate([rng.integers(0, 4, size=(150, 8)), np.repeat(rng.integers(0, 3, size=(10, 8)), 6, 0)]).astype(float)
    ids = rng.permutation(len(x)).tolist()
    got = sorted((r.a, r.b, round(r.score, 9)) for r in topk.pairs_above(frame(spark, ids, x), 0.9, block=block).collect())
    norm = np.sqrt((x * x).sum(1))
    want = []
    for i in range(len(x)):
        for j in range(i):
            if norm[i] and norm[j]:
                s = float((x[i] * x[j]).sum() / (norm[i] * norm[j]))
                if s >= 0.9 - 1e-9:
                    want.append((*sorted((ids[i], ids[j])), round(s, 9)))
    assert got == sorted(want) and len(want) > 100


def test_pairs_above_edge_cases(spark):
    rows = [("a", [1.0, 0.0]), ("b", [2.0, 0.0]), ("b", [3.0, 0.0]), (None, [1.0, 0.0]), ("z", [0.0, 0.0]), ("n", None)]
    src = spark.createDataFrame(rows, "id string, features array<double>")
    assert sorted(tuple(r) for r in topk.pairs_above(src, 0.5).collect()) == [("a", "b", 1.0), ("a", "b", 1.0)]
    assert topk.pairs_above(src.limit(0), 0.5).collect() == []
    with pytest.raises(ValueError):
        topk.pairs_above(src, 0.0)


def test_letter_cosine_equals_the_character_join(spark):
    from quarry.operators import similar as S

    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcXYZ -1"), rng.integers(0, 9))) for _ in range(120)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    a = {(r.key_a, r.key_b, round(r.cosine, 9)) for r in S.char_cosine_join(df, "k", "t", 0.8, S.LATIN_CLASS).collect()}
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "abcdefghijklmnopqrstuvwxyz"
    assert a == {(r.key_a, r.key_b, round(r.cosine, 9)) for r in S.letter_cosine_join(df, "k", "t", 0.8, letters).collect()}


def test_equal_vectors_are_scored_once(spark):
    """Every row of equal queries and items used to be scored: 400 by 600 here."""
    rng = np.random.default_rng(5)
    q, x = rng.integers(-4, 5, (4, 3)) / 4 + 0.125, rng.integers(-4, 5, (6, 3)) / 4
    users = spark.createDataFrame([(i, q[i % 4].tolist()) for i in range(400)], "id int, features array<double>")
    items = spark.createDataFrame([(i, x[i * 7 % 6].tolist()) for i in range(600)], "id int, features array<double>")
    t = topk.top_k(users, items, 5, block=64)
    got = {}
    for r in t.rows.collect():
        got.setdefault(r["query"], []).append((r["rank"], r["item"], r["score"]))
    for u in range(400):
        best = sorted((-float((q[u % 4] * x[i * 7 % 6]).sum()), i) for i in range(600))[:5]
        assert sorted(got[u]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert len(got) == 400 and t.scored.first()["scored"] <= 4 * 30


def test_a_query_block_is_sent_once_to_a_tile(spark):
    """It used to be sent once for every item block that it needs."""
    n, width, tile = 64, 3, 4
    rng = np.random.default_rng(6)
    summary = pd.DataFrame({"blk": range(12), "centre": list(rng.normal(size=(12, width))), "widest": 3.2, "most": 1.0, "least": 1.0})
    shared = type("Shared", (), {"value": topk._Bounds(summary, False)})()
    one = pd.DataFrame([(0, n, rng.normal(size=(n, width)).tobytes(), list(range(12)), None)],
                       columns=["qblk", "rows", "mat", "visit", "kth"])
    out = pd.concat(topk._wanted(shared, width, tile)([one]))
    assert sorted(out["igrp"]) == [0, 1, 2] and sorted(b for x in out["blks"] for b in x) == list(range(12))
