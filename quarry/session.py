"""Session construction and shared-folder helpers.

Everything that must outlive a task (checkpoints, sink folders, exported
tables) goes under the folder the cluster names in ``spark.checkpoint.dir``.
A folder of our own is chosen only when that setting is absent and the
master is local (tests, laptop runs).
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _configured_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    for getter in (lambda: spark.conf.get("spark.checkpoint.dir", None),
                   lambda: sc.getConf().get("spark.checkpoint.dir", None)):
        try:
            v = getter()
        except Exception:  # pragma: no cover - conf access differs by deployment
            v = None
        if v:
            return v
    return None


_LOCAL_ROOT: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder root, setting the checkpoint dir if needed.

    Reads ``spark.checkpoint.dir`` from the session. Only a local master may
    fall back to a fresh temporary folder; a cluster without the setting is
    an error, because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    root = _configured_dir(spark) or _LOCAL_ROOT.get(sc.applicationId)
    if root is None:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):  # not local-cluster[..]: its executors are processes apart
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="quarry-ckpt-")
        _LOCAL_ROOT[sc.applicationId] = root
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one job's output."""
    root = ensure_checkpoint_dir(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}quarry-work/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def unused_shuffles_freed(spark: SparkSession, seconds: float = 10.0):
    """Lets the driver collect garbage on entry and every ``seconds`` while the block runs.

    Spark deletes the files of a shuffle once the driver has collected the
    objects that stood for it. A driver that makes little garbage does so
    every 30 minutes, while a long iteration writes a shuffle a minute.
    """
    collect, done = spark.sparkContext._jvm.java.lang.System.gc, threading.Event()

    def run():
        collect()
        while not done.wait(seconds):
            collect()

    worker = threading.Thread(target=run, daemon=True)
    worker.start()
    try:
        yield
    finally:
        done.set()
        worker.join()


def memory_per_core(spark: SparkSession) -> int:
    """Bytes of heap that Spark manages (for execution and storage) for each core of the executor with the least."""
    found = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    executors = [found.apply(i) for i in range(found.size())]
    return min((e.maxMemory() // e.totalCores() for e in executors if e.totalCores() > 0), default=128 << 20)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
