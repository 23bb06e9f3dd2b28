"""Key registry as sorted runs with Bloom filters and merges (inventory O15, O35, O67).

A registry holds the keys that streams have seen. Every batch adds one *run*:
its keys sorted by bucket (a hash range) in as few files as their number asks
for, and one Bloom filter per bucket. Runs of a level are merged into one run
of the next level as soon as there are ``fan_in`` of them, so after n batches
there are at most ``fan_in * log(n)`` runs, each of a few large files.

To find which keys of a batch are known, the batch's keys meet the filters of
their own buckets (shuffled by bucket, nothing is broadcast); only the runs and
buckets in which some key may lie are then read and compared exactly. A batch
of keys that were never seen reads, but for a filter's false positives, no key
file at all.

The list of live runs is a numbered manifest file, written once and never
changed: a new one is created with the next number, and the creation fails if
another writer was faster, who is then read and the step repeated. Folders that
a crash leaves behind are in no manifest. A run keeps the streaming run and
batch that brought each key, also through merges, so a replayed batch ignores
its own keys; a batch that the manifest already counts is not added again.
Folders of merged runs are kept for one more merge, for readers under way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
FAN_IN = 4
ROWS_PER_FILE = 1_000_000
BITS_PER_KEY = 12
PROBES = 5
_U = np.uint64


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    """PROBES bit numbers for each 64-bit key hash."""
    h = h.view(_U)
    a, b = h & _U(0xFFFFFFFF), (h >> _U(32)) | _U(1)
    return ((a[:, None] + b[:, None] * np.arange(PROBES, dtype=_U)[None, :]) % _U(bits)).astype(np.int64)


def bloom(h: np.ndarray) -> bytes:
    size = max(64, -(-len(h) * BITS_PER_KEY // 64) * 64)
    bits = np.zeros(size, bool)
    bits[_positions(h, size).ravel()] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(filter_bytes: bytes, h: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(filter_bytes, np.uint8)
    at = _positions(h, len(raw) * 8)
    return ((raw[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(1)


class KeyRegistry:
    """Keys under ``path``, of the columns ``key`` with the given types. ``files_read`` is the number of key files
    that the last ``known`` had to read."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], key_types: dict[str, T.DataType],
                 fan_in: int = FAN_IN, rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.path, self.key = spark, path.rstrip("/"), list(key)
        self.fan_in, self.rows_per_file, self.files_read = fan_in, rows_per_file, 0
        self._held: list[DataFrame] = []
        self.schema = T.StructType([*[T.StructField(k, key_types[k]) for k in key], T.StructField("run", T.StringType()),
                                    T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType()),
                                    T.StructField("h", T.LongType())])

    # -- manifests

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._fs(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def manifest(self) -> dict:
        """The newest manifest: version, live runs, the last batch of each streaming run, runs merged away."""
        names = [n for n in self._names(f"{self.path}/manifest") if n.endswith(".json")]
        if not names:
            return {"version": 0, "runs": [], "batches": {}, "old": []}
        text = self.spark.read.text(f"{self.path}/manifest/{names[-1]}").first()[0]
        return json.loads(text)

    def _commit(self, m: dict) -> bool:
        """Write the next manifest; false when another writer has taken its number."""
        m = {**m, "version": m["version"] + 1}
        fs, p = self._fs(f"{self.path}/manifest/{m['version']:012d}.json")
        _, tmp = self._fs(f"{self.path}/manifest/_{uuid.uuid4().hex}")
        out = fs.create(tmp, True)
        out.write(bytearray(json.dumps(m).encode()))
        out.close()
        if fs.exists(p) or not fs.rename(tmp, p):
            fs.delete(tmp, False)
            return False
        for name in self._names(f"{self.path}/manifest")[:-3]:  # the last few are kept for readers
            fs.delete(self._fs(f"{self.path}/manifest/{name}")[1], False)
        return True

    # -- runs

    def _hashed(self, keys: DataFrame) -> DataFrame:
        h = F.xxhash64(*[F.col(k) for k in self.key])
        return keys.withColumn("h", h).withColumn("bucket", F.pmod(F.col("h"), F.lit(BUCKETS)).cast("int"))

    def _write_run(self, rows: DataFrame, n: int, level: int) -> dict:
        """One run: rows sorted by bucket, and a filter per bucket."""
        run = uuid.uuid4().hex[:12]
        files = max(1, -(-n // self.rows_per_file))
        ranged = rows.repartitionByRange(files, "bucket", "h") if files > 1 else rows.coalesce(1)
        ranged.sortWithinPartitions("bucket", "h").write.parquet(f"{self.path}/runs/{run}/keys")

        def build(t: pa.Table) -> pa.Table:
            bits = bloom(t.column("h").to_numpy())
            return pa.table({"bucket": t.column("bucket").slice(0, 1), "bits": pa.array([bits])})

        stored = self.spark.read.schema(self.schema).parquet(f"{self.path}/runs/{run}/keys")
        filters = stored.select("bucket", "h").groupBy("bucket").applyInArrow(build, "bucket int, bits binary")
        filters.coalesce(files).write.parquet(f"{self.path}/runs/{run}/filters")
        return {"id": run, "level": level, "rows": n, "files": files}

    def _read_runs(self, runs: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/runs/{r}/keys" for r in runs])

    # -- use

    def known(self, batch: DataFrame, run: str, batch_id: int) -> DataFrame:
        """The keys of ``batch`` that were registered before this batch: by any other streaming run, or by an earlier
        batch of this one. Null key parts are keys like any other."""
        m = self.manifest()
        none = self.spark.createDataFrame([], T.StructType(self.schema.fields[:len(self.key)]))
        self.files_read = 0
        if not m["runs"]:
            return none
        keys = self._hashed(batch.select(*self.key).distinct())
        filters = None
        for r in m["runs"]:  # at most fan_in runs a level
            f = (self.spark.read.schema("bucket int, bits binary").parquet(f"{self.path}/runs/{r['id']}/filters")
                 .select("bucket", "bits", F.lit(r["id"]).alias("rid")))
            filters = f if filters is None else filters.unionAll(f)

        def probe(left: pa.Table, right: pa.Table) -> pa.Table:
            h = left.column("h").to_numpy()
            hits = [(may_hold(b.as_py(), h), r.as_py()) for b, r in zip(right.column("bits"), right.column("rid"))]
            at = np.concatenate([np.flatnonzero(ok) for ok, _ in hits] or [np.zeros(0, np.int64)])
            rid = [r for ok, r in hits for _ in range(int(ok.sum()))]
            return left.take(pa.array(at)).append_column("rid", pa.array(rid, pa.string()))

        fields = T.StructType([*self.schema.fields[:len(self.key)], T.StructField("h", T.LongType()),
                               T.StructField("bucket", T.IntegerType()), T.StructField("rid", T.StringType())])
        maybe = keys.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(probe, fields).persist()
        self._held.append(maybe)
        where = maybe.select("rid", "bucket").distinct().collect()  # runs x buckets at most
        if not where:
            return none
        runs = sorted({r["rid"] for r in where})
        self.files_read = sum(r["files"] for r in m["runs"] if r["id"] in runs)
        old = self._read_runs(runs).where(F.col("bucket").isin(sorted({r["bucket"] for r in where})))
        old = old.where((F.col("run") != run) | (F.col("batch_id") < batch_id))
        same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in self.key]
        return (maybe.select(*self.key, "h").distinct().alias("l")
                .join(old.alias("r"), [F.col("l.h") == F.col("r.h"), *same], "left_semi").select(*self.key))

    def release(self) -> None:
        """Let go of what ``known`` keeps; call it when its result has been used."""
        while self._held:
            self._held.pop().unpersist()

    def register(self, keys: DataFrame, run: str, batch_id: int) -> bool:
        """Add a batch's new keys (one row per key) as a run; false when the manifest has this batch already."""
        if self.manifest()["batches"].get(run, -1) >= batch_id:
            return False
        rows = self._hashed(keys.select(*self.key)).select(
            *self.key, F.lit(run).alias("run"), F.lit(batch_id).cast("bigint").alias("batch_id"), "bucket", "h")
        n = rows.count()
        new = [self._write_run(rows, n, 0)] if n else []
        while True:
            m = self.manifest()
            if m["batches"].get(run, -1) >= batch_id:
                return False
            if self._commit({**m, "runs": m["runs"] + new, "batches": {**m["batches"], run: batch_id}}):
                break
        self.compact()
        return True

    def compact(self) -> None:
        """Merge the runs of every level that has ``fan_in`` of them."""
        while True:
            m = self.manifest()
            by_level: dict[int, list[dict]] = {}
            for r in m["runs"]:
                by_level.setdefault(r["level"], []).append(r)
            full = [v for _, v in sorted(by_level.items()) if len(v) >= self.fan_in]
            if not full:
                return
            gone = {r["id"] for r in full[0]}
            merged = self._write_run(self._read_runs(sorted(gone)), sum(r["rows"] for r in full[0]), full[0][0]["level"] + 1)
            while True:
                now = self.manifest()
                if not gone <= {r["id"] for r in now["runs"]}:
                    break  # another writer merged them; ours is in no manifest
                kept = [r for r in now["runs"] if r["id"] not in gone]
                if self._commit({**now, "runs": [*kept, merged], "old": sorted(gone)}):
                    for r in now["old"]:
                        fs, p = self._fs(f"{self.path}/runs/{r}")
                        fs.delete(p, True)
                    break

    def keys(self) -> DataFrame:
        """All registered keys, each once."""
        m = self.manifest()
        if not m["runs"]:
            return self.spark.createDataFrame([], T.StructType(self.schema.fields[:len(self.key)]))
        return self._read_runs([r["id"] for r in m["runs"]]).select(*self.key).distinct()
