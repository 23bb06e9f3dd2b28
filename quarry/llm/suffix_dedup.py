"""Removal of repeated byte strings by suffix arrays (operator 3).

Every byte covered by a ``length``-byte string that also starts anywhere else
in the corpus (same document included, overlaps count) is removed.

Where the repeats can be is found first. Each window of ``length`` bytes is
keyed by the least hash among its k-byte substrings, so equal windows have
equal keys; consecutive windows with one key form a run, and a run's text is
its content. Runs whose key is met once, and not twice inside the run itself,
cannot repeat and go no further. A content met twice repeats whole.

What is left are keys whose runs differ somewhere. Their distinct contents
come together as one short text per key, and the suffix array of that text is
built by linear grouping construction (``_grouping``): a window repeats when
its suffix shares ``length`` bytes with a neighbour. A key with more contents
than ``lane`` (a common passage in many surroundings) is dealt again by the
windows themselves, so no key is ever gathered in one task.

Defined cases: a null text counts as empty; texts shorter than ``length``
lose nothing; rows that repeat (same id and text) count as two documents and
both lose what they share; a null doc_id is kept as it is.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import _bytes
from quarry.llm._grouping import suffix_arrays
from quarry.llm._shared import materialise

LENGTH = 200
GRAM = 64
LONGEST_RUN = 256
LANE = 16
_U = np.uint64


def _sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over every window of ``w`` values, by doubling."""
    s = 1
    while s * 2 <= w:
        x = op(x[:-s], x[s:])
        s *= 2
    return op(x[: len(x) - (w - s)], x[w - s:]) if s < w else x


def runs(text: bytes, length: int, gram: int):
    """key, content, start, windows, twice: the runs of windows that share their least k-gram hash."""
    b = np.frombuffer(text, np.uint8)
    if len(b) < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, bool)
    h = _bytes.prefix_hash(b)
    _, down = _bytes.POWERS.upto(len(h))
    g = _bytes.mix((h[gram:] - h[:-gram]) * down[: len(h) - gram])
    w = length - gram + 1
    low = _sliding(g, w, np.minimum)
    start = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    size = np.diff(np.concatenate([start, [len(low)]]))
    if size.max() > LONGEST_RUN:  # a long run is cut; its parts keep the key
        parts = -(-size // LONGEST_RUN)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(start, parts) + nth * LONGEST_RUN
        size = np.minimum(LONGEST_RUN, np.repeat(size, parts) - nth * LONGEST_RUN)
    key = low[start]
    # places of a least k-gram: those no greater than the least of every window over them
    padded = np.concatenate([np.zeros(w - 1, _U), low, np.zeros(w - 1, _U)])
    least = np.flatnonzero(g <= _sliding(padded, w, np.maximum))
    a, z = np.searchsorted(least, start), np.searchsorted(least, start + size + w - 1)
    many = z - a
    owner = np.repeat(np.arange(len(start)), many)
    at = least[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(a, many)]
    twice = np.bincount(owner, g[at] == key[owner], len(start)) > 1
    content = _bytes.span_hash(h, start, start + size + length - 1)
    return key.view(np.int64), content.view(np.int64), start, size, twice


_RUN = "key bigint, content bigint, start int, windows int, twice boolean"


def text_key() -> Column:
    """Tells rows apart that share a doc_id."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def find_runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    src = docs.select("doc_id", text_key().alias("_t"), "text")
    id_type = src.schema["doc_id"].dataType.simpleString()
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
    names = ("key", "content", "start", "windows", "twice")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                got = [runs((t.as_py() or "").encode("utf-8", "surrogatepass"), length, gram) for t in b.column(2)]
                cols = [pa.array([g[i].astype(k.to_pandas_dtype()) for g in got], pa.list_(k))
                        for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["doc_id", "_t", *names])

    fields = ", ".join(f"{n} array<{t}>" for n, t in zip(names, ("bigint", "bigint", "int", "int", "boolean")))
    found = materialise(src.mapInArrow(run, f"doc_id {id_type}, _t bigint, {fields}"), "runs")
    return found.select("doc_id", "_t", F.inline(F.arrays_zip(*names)))


def _texts_of_runs(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The text of each wanted run (``seg``), or, where ``split``, the hash of each of its windows (``h``).

    One join brings every document that holds wanted runs together with them.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    per_doc = wanted.groupBy(F.col("doc_id").alias("_d"), F.col("_t").alias("_t2")).agg(
        F.collect_list(F.struct("key", "content", "start", "windows", "cnt", "split")).alias("_w"))
    src = (docs.select("doc_id", text_key().alias("_t"), "text")
           .join(per_doc.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_t2")))
           .select("doc_id", "_t", "text", "_w"))
    kinds = [src.schema["doc_id"], src.schema["_t"]]

    def cut(d, t, x, runs):
        for w in runs:
            s, n = w["start"], w["windows"]
            same = {"doc_id": d, "_t": t, "cnt": w["cnt"]}
            if w["split"]:
                for i in range(s, s + n):
                    yield same | {"start": i, "h": hashlib.blake2b(x[i:i + length], digest_size=16).digest()}
            else:
                yield same | {"start": s, "key": w["key"], "content": w["content"], "seg": x[s:s + n + length - 1]}

    def run(batches):
        for batch in batches:
            out = pa.schema([*(batch.schema.field(k.name) for k in kinds), ("cnt", pa.int64()), ("start", pa.int32()),
                             ("key", pa.int64()), ("content", pa.int64()), ("seg", pa.binary()), ("h", pa.binary())])
            for at in range(0, batch.num_rows, 256):
                rows = []
                for d, t, x, w in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    rows.extend(cut(d, t, x.encode("utf-8", "surrogatepass"), w))
                    if len(rows) > 50_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=out)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=out)

    return src.mapInArrow(run, f"doc_id {id_type}, _t bigint, cnt bigint, start int, key bigint, content bigint, "
                               "seg binary, h binary")


def repeated_windows(lanes: list[list[bytes]], length: int) -> list[list[np.ndarray]]:
    """Per lane and segment, which windows of the segment start at another place of the lane too."""
    texts, starts = [], []
    for segments in lanes:
        lens = np.asarray([len(s) + 1 for s in segments])
        starts.append(np.cumsum(lens) - lens)
        t = np.concatenate([np.concatenate([np.frombuffer(s, np.uint8).astype(np.int16) + 1, [0]]) for s in segments])
        texts.append(t.astype(np.int64))  # 0 ends a segment
    out = []
    for segments, t, at, sa in zip(lanes, texts, starts, suffix_arrays(texts)):
        left = np.concatenate([np.arange(len(s), -1, -1) for s in segments])  # bytes before the segment's end
        window = np.lib.stride_tricks.sliding_window_view(np.pad(t, (0, length)), length)
        a, b = sa[:-1], sa[1:]
        near = np.flatnonzero((left[a] >= length) & (left[b] >= length))
        hit = np.zeros(len(t), bool)
        for c in range(0, len(near), 4096):
            x, y = a[near[c:c + 4096]], b[near[c:c + 4096]]
            same = (window[x] == window[y]).all(1)
            hit[x[same]] = hit[y[same]] = True
        out.append([hit[s:s + len(seg) - length + 1] for s, seg in zip(at, segments)])
    return out


def _flagged(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def _sort_lanes(segments: DataFrame, length: int, id_type: str) -> DataFrame:
    """Spans (doc_id, _t, s, e) of the repeated windows of contents met once."""
    n = max(1, -(-int(segments.agg(F.coalesce(F.sum(F.length("seg")), F.lit(0))).first()[0]) // 1_000_000))
    dealt = segments.withColumn("_g", F.pmod(F.xxhash64(F.lit(11), "key"), F.lit(n)))

    def run(pdf):
        import pandas as pd

        pdf = pdf.drop_duplicates(["key", "content"])
        groups = [part for _, part in pdf.groupby("key", sort=False)]
        groups.sort(key=lambda p: int(p["seg"].map(len).sum()))
        out, todo, size = [], [], 0

        def flush():
            lanes = [p["seg"].tolist() for p in todo]
            for p, hits in zip(todo, repeated_windows(lanes, length) if lanes else []):
                for d, t, st, c, h in zip(p["doc_id"], p["_t"], p["start"], p["cnt"], hits):
                    if c == 1:
                        out.extend((d, t, st + x, st + y + length - 1) for x, y in _flagged(h))
            todo.clear()

        for p in groups:
            todo.append(p)
            size += int(p["seg"].map(len).sum())
            if size > 500_000:
                flush()
                size = 0
        flush()
        return pd.DataFrame(out, columns=["doc_id", "_t", "s", "e"])

    return dealt.groupBy("_g").applyInPandas(run, f"doc_id {id_type}, _t bigint, s int, e int")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, lane: int = LANE) -> DataFrame:
    """doc_id, _t, s, e: byte spans (they may overlap) that repeats cover."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = find_runs(docs, length, gram)
    span = (F.col("start").alias("s"), (F.col("start") + F.col("windows") + F.lit(length - 1)).cast("int").alias("e"))
    keys = (found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("lo"),
                                     F.max("content").alias("hi"), F.max("twice").alias("self"))
            .where((F.col("n") > 1) | F.col("self"))
            .select("key", ((F.col("lo") < F.col("hi")) | ((F.col("n") == 1) & F.col("self"))).alias("mixed")))
    maybe = materialise(found.join(keys, "key"), "run-candidates")
    same = maybe.where(~F.col("mixed")).select("doc_id", "_t", *span)

    mixed = maybe.where("mixed")
    place = F.struct("doc_id", "_t", "start", "windows")
    contents = mixed.groupBy("key", "content").agg(F.count(F.lit(1)).alias("cnt"), F.min(place).alias("p"))
    contents = materialise(contents.select("key", "content", "cnt", "p.*"), "run-contents")
    met = contents.where("cnt > 1").select("key", "content")
    again = mixed.join(met, ["key", "content"]).select("doc_id", "_t", *span)
    per_key = contents.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    sized = contents.join(per_key, "key").withColumn("split", F.col("m") > lane)
    texts = materialise(_texts_of_runs(docs, sized, length), "run-texts")
    lanes = _sort_lanes(texts.where("h is null"), length, id_type)

    many = texts.where("h is not null")
    common = many.groupBy("h").agg(F.sum("cnt").alias("n")).where("n > 1").select("h")
    dealt = many.where("cnt = 1").join(common, "h").select(
        "doc_id", "_t", F.col("start").alias("s"), (F.col("start") + length).alias("e"))
    return same.unionByName(again).unionByName(lanes).unionByName(dealt)


_OUT = ("n_bytes", "n_removed", "n_spans", "spans", "kept")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, lane: int = LANE,
                   as_text: bool = False) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, spans (array of [start, end)) and ``kept`` (the bytes left).

    With ``as_text``, ``kept`` is a string; a character that a cut left
    incomplete is dropped. Columns of ``docs`` with these names are replaced.
    """
    docs = docs.drop(*_OUT, "_t", "_s", "_d", "_t2")
    spans = repeated_spans(docs, length, gram, lane).distinct()
    per_doc = spans.groupBy(F.col("doc_id").alias("_d"), F.col("_t").alias("_t2")).agg(
        F.collect_list(F.struct("s", "e")).alias("_s"))
    src = (docs.withColumn("_t", text_key())
           .join(per_doc.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_t2")), "left")
           .drop("_d", "_t", "_t2"))
    at, text_at = src.columns.index("_s"), src.columns.index("text")
    names = [c for c in src.columns if c != "_s"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_s"]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                b = batch.slice(lo, 512)
                size, gone, merged, kept = [], [], [], []
                for t, s in zip(b.column(text_at), b.column(at)):
                    x, s = (t.as_py() or "").encode("utf-8", "surrogatepass"), s.as_py()
                    out, left, end = [], [], 0
                    for p in sorted((p["s"], p["e"]) for p in s or []):
                        if out and p[0] <= out[-1][1]:
                            out[-1][1] = max(out[-1][1], p[1])
                        else:
                            out.append([p[0], p[1]])
                    for p, q in out:
                        left.append(x[end:p])
                        end = q
                    left.append(x[end:])
                    size.append(len(x)), merged.append([{"start": p, "end": q} for p, q in out])
                    kept.append(b"".join(left)), gone.append(len(x) - len(kept[-1]))
                cols = [b.column(i) for i, c in enumerate(b.schema.names) if c != "_s"]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(size, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array([len(m) for m in merged], pa.int64()), pa.array(merged, kind),
                     pa.array([k.decode("utf-8", "ignore") for k in kept] if as_text else kept,
                              pa.string() if as_text else pa.binary())],
                    names=[*names, "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    extra = ("n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start:bigint,end:bigint>>, kept "
             + ("string" if as_text else "binary"))
    return src.mapInArrow(run, ", ".join([*fields, extra]))
