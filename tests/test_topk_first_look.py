"""Tiles of the top-k search: a first look in single precision, the score itself in double precision."""

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.operators import topk

SCHEMA = to_arrow_schema(T.StructType([
    T.StructField("query", T.LongType()), T.StructField("item", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("qblk", T.IntegerType()), T.StructField("pos", T.IntegerType()), T.StructField("pairs", T.LongType())]))


def _tile(q, x, least, k, cosine=False, exclude_same=False):
    left = pa.table({"qblk": [0], "blks": [[0]], "open": [[np.packbits(np.ones(len(q), bool)).tobytes()]],
                     "least": [least.tobytes()], "q_ids": [list(range(len(q)))], "q_mat": [q.tobytes()]})
    right = pa.table({"b": [0], "ids": [list(range(len(x)))], "mat": [x.tobytes()]})
    out = topk._scored(k, q.shape[1], cosine, exclude_same, SCHEMA)(left, right)
    assert out.column("pairs").to_pylist()[-1] == len(q) * len(x)
    return {(r["query"], r["item"]): r["score"] for r in out.to_pylist() if r["pairs"] is None}


def test_known_bounds_spare_the_selection(monkeypatch):
    """Every block used to be searched for its own k-th score, which took most of the time, though that of earlier
    rounds was known."""
    r = np.random.default_rng(3)
    q, x = r.normal(size=(300, 50)), r.normal(size=(700, 50)) * r.lognormal(size=(700, 1))
    score = q @ x.T
    least = -np.sort(-score, 1)[:, 9]
    select, seen = np.partition, []
    monkeypatch.setattr(np, "partition", lambda a, *b, **c: seen.append(a.size) or select(a, *b, **c))
    got = _tile(q, x, least - 1e-12, 10)
    assert not seen
    assert set(got) == {(i, j) for i in range(300) for j in np.argsort(-score[i])[:10]}
    assert all(abs(v - score[i, j]) < 1e-9 for (i, j), v in got.items())
    assert set(_tile(q, x, np.full(300, -np.inf), 10)) == set(got) and sum(seen) == 300 * 700


def test_differences_below_single_precision_count():
    r = np.random.default_rng(4)
    for scale in (1e-60, 1.0, 1e60):  # beyond the range of single precision too
        base = r.normal(size=20)
        x = (base + 1e-9 * r.normal(size=(400, 20))) * scale
        q = r.normal(size=(30, 20))
        for cosine in (False, True):
            score = (q[:, None, :] * x[None]).sum(2)
            if cosine:
                score /= np.sqrt((q * q).sum(1))[:, None] * np.sqrt((x * x).sum(1))[None]
            for same in (False, True):
                s = score.copy()
                if same:
                    s[np.arange(30), np.arange(30)] = -np.inf
                want = {(i, int(j)) for i in range(30) for j in np.lexsort((np.arange(400), -s[i]))[:5]}
                for least in (np.full(30, -np.inf), -np.sort(-s, 1)[:, 4]):
                    got = _tile(q, x, least, 5, cosine, same)
                    assert want <= set(got) and all(got[p] == score[p] for p in want)
                    assert all(got[p] >= s[p[0]][[j for i, j in want if i == p[0]]].min() for p in got)


def test_zero_vectors_and_zero_blocks():
    q = np.array([[0.0, 0.0], [1.0, -1.0]])
    x = np.zeros((4, 2))
    got = _tile(q, x, np.array([-np.inf, -np.inf]), 2)
    assert set(got.values()) == {0.0} and {p[0] for p in got} == {0, 1}
    assert _tile(q, x, np.array([0.0, 1.0]), 2).keys() == {(0, 0), (0, 1)}
