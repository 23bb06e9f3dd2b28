import numpy as np
import pytest

from quarry.llm.permutation_index import filled, search


@pytest.mark.parametrize("spread", [0.5, 1.0])
def test_recall_holds_for_vectors_of_unequal_norms(spark, spread):
    rng = np.random.default_rng(int(spread * 10))
    u = rng.normal(size=(6000, 32))
    x = u / np.sqrt((u * u).sum(1))[:, None] * np.exp(rng.normal(size=6000) * spread)[:, None]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in search(df, every=100, least=64).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in range(0, 6000, 100):
        s = x @ x[q]
        s[q] = -np.inf
        want = set(np.argsort(-s)[:20].tolist())
        hits, total = hits + len(want & got[q]), total + 20
    assert hits / total >= 0.97


def test_filled_vectors_keep_inner_products():
    x = np.random.default_rng(1).normal(size=(40, 5))
    top = np.sqrt((x * x).sum(1)).max()
    f = filled(x, top)
    assert np.allclose((f * f).sum(1), 1)
    assert np.allclose(np.c_[x, np.zeros(40)] @ f.T * top, x @ x.T)
