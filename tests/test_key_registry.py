"""The key registry: runs, filters, merges, replays, and what a batch has to read."""

import os

import numpy as np
import pytest
from pyspark.sql import types as T

from quarry.streaming.key_registry import BUCKETS, KeyRegistry, bloom, may_hold

TYPES = {"a": T.StringType(), "b": T.IntegerType()}


def keys(spark, rows):
    return spark.createDataFrame(rows, "a string, b int")


def registry(spark, tmp_path, **kw):
    return KeyRegistry(spark, f"file://{tmp_path}/reg", ["a", "b"], TYPES, **kw)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def live_files(reg, tmp_path):
    m = reg.manifest()
    return sum(f.endswith(".parquet") for r in m["runs"] for d in ("keys", "filters")
               for f in os.listdir(f"{tmp_path}/reg/runs/{r['id']}/{d}"))


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(1)
    held, other = (rng.integers(-(1 << 63), 1 << 63, 20000, np.int64) for _ in range(2))
    f = bloom(held)
    assert may_hold(f, held).all() and may_hold(f, other).mean() < 0.02
    assert may_hold(bloom(held[:1]), held[:1]).all() and not may_hold(bloom(held[:0]), other).any()


def test_fifty_batches_keep_few_files(spark, tmp_path):
    reg = registry(spark, tmp_path, fan_in=4)
    seen = set()
    for n in range(50):
        rows = [(f"k{n}-{i}", i) for i in range(3)] + ([("old", 1)] if n % 10 == 0 else [])
        new = [r for r in rows if r not in seen]
        seen.update(new)
        assert reg.register(keys(spark, new), "s", n)
    m = reg.manifest()
    assert len(m["runs"]) <= 3 * 3 and live_files(reg, tmp_path) <= 2 * len(m["runs"])
    assert len(os.listdir(f"{tmp_path}/reg/runs")) <= len(m["runs"]) + 4  # the last merge's sources are kept
    assert len([f for f in os.listdir(f"{tmp_path}/reg/manifest") if f.endswith(".json")]) <= 4
    assert got(reg.keys()) == sorted(seen, key=str)
    assert got(reg.known(keys(spark, [("k7-1", 1), ("k7-1", 2), ("never", 0), ("old", 1)]), "s", 50)) == [("k7-1", 1), ("old", 1)]
    assert got(reg.known(keys(spark, [(f"new{i}", i) for i in range(200)]), "s", 50)) == []
    few = reg.files_read
    reg.known(keys(spark, [(f"fresh{i}", 1) for i in range(3)]), "s", 50)
    assert reg.files_read == 0 and few <= len(m["runs"])


def test_replay_ignores_its_own_keys_also_after_merges(spark, tmp_path):
    reg = registry(spark, tmp_path, fan_in=2)
    for n in range(5):
        reg.register(keys(spark, [(f"k{n}", n)]), "s", n)
    assert max(r["level"] for r in reg.manifest()["runs"]) >= 1
    # batch 3 again: its own key and later ones are not known, earlier ones are
    batch = keys(spark, [("k3", 3), ("k4", 4), ("k2", 2)])
    assert got(reg.known(batch, "s", 3)) == [("k2", 2)]
    before = reg.manifest()
    assert not reg.register(keys(spark, [("k3", 3)]), "s", 3)
    assert reg.manifest() == before and reg.keys().count() == 5
    # another streaming run sees all of them, whatever its batch number
    assert got(reg.known(batch, "other", 0)) == [("k2", 2), ("k3", 3), ("k4", 4)]


def test_crash_between_run_and_manifest_and_during_a_merge(spark, tmp_path, monkeypatch):
    reg = registry(spark, tmp_path, fan_in=2)
    reg.register(keys(spark, [("a", 1)]), "s", 0)
    with monkeypatch.context() as m:
        m.setattr(KeyRegistry, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            reg.register(keys(spark, [("b", 2)]), "s", 1)
    assert got(reg.known(keys(spark, [("a", 1), ("b", 2)]), "s", 1)) == [("a", 1)]
    with monkeypatch.context() as m:
        m.setattr(KeyRegistry, "compact", lambda self: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            reg.register(keys(spark, [("b", 2)]), "s", 1)
    assert not reg.register(keys(spark, [("b", 2)]), "s", 1)  # counted before the merge was lost
    reg.compact()
    assert got(reg.keys()) == [("a", 1), ("b", 2)] and len(reg.manifest()["runs"]) == 1


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    one, two = registry(spark, tmp_path, fan_in=3), registry(spark, tmp_path, fan_in=3)
    real, turn = KeyRegistry._commit, []

    def late(self, m):
        if self is one and not turn:
            turn.append(1)
            two.register(keys(spark, [("two", 2)]), "t", 0)  # takes the next number first
        return real(self, m)

    monkeypatch.setattr(KeyRegistry, "_commit", late)
    one.register(keys(spark, [("one", 1)]), "s", 0)
    assert got(one.keys()) == [("one", 1), ("two", 2)] == got(two.keys())


def test_nulls_empty_batches_and_many_files(spark, tmp_path):
    reg = registry(spark, tmp_path, rows_per_file=100)
    assert got(reg.known(keys(spark, [("x", 1)]), "s", 0)) == [] and got(reg.keys()) == []
    assert reg.register(keys(spark, []), "s", 0) and reg.manifest()["runs"] == []
    rows = [(None, 1), ("x", None), (None, None)] + [(f"k{i}", i) for i in range(997)]
    reg.register(keys(spark, rows), "s", 1)
    run, = reg.manifest()["runs"]
    assert run["files"] == 10 and len(os.listdir(f"{tmp_path}/reg/runs/{run['id']}/keys")) >= 10
    probe = [(None, 1), (None, 2), ("x", None), (None, None), ("k5", 5), ("k5", 6)]
    assert got(reg.known(keys(spark, probe), "s", 2)) == sorted([(None, 1), ("x", None), (None, None), ("k5", 5)], key=str)
    assert BUCKETS == 64
