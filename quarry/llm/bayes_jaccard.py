"""N-gram Jaccard join with Bayesian candidate pruning (operator 6).

Links documents whose sets of five-word shingles have a Jaccard similarity of
at least 0.8. Documents with equal sets are one node. MinHash bands propose
which nodes may be linked; nodes that share bands form candidate components.
Inside a component, blocks are compared pair by pair: MinHash values are
compared sixteen at a time, a pair is dropped as soon as the posterior
probability (uniform prior) that its similarity reaches the threshold falls
below the tolerance, and whatever survives is verified exactly on the shingle
sets. Nothing is emitted per pair: a group returns link counts per node and
the edges of a spanning forest.

Result per document: its class (the smallest doc_id that links reach), the
number of other documents linked to it directly, and whether it represents
its class.

Defined cases: texts without a word (null and empty ones too) link with
nothing and are their own class; a text shorter than five words is one
shingle; equal texts always link; rows that repeat a doc_id are separate
documents for the link count and share the id; a null doc_id stays null and
sorts as larger than any id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import _bytes
from quarry.llm._graph import connected_components, deal_pairs_of_blocks, forest
from quarry.llm._shared import materialise

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 128
BANDS, ROWS = 25, 5
STEP = 16
TOLERANCE = 1e-6
_U = np.uint64

_MULTIPLIERS = _bytes.mix(np.arange(1, HASHES + 1, dtype=_U) * _U(0xD6E8FEB86659FD93)) | _U(1)


def signature(s: np.ndarray) -> np.ndarray:
    """MinHash values (upper 32 bits of the least product) of a non-empty set of hashes."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, _U)
    for at in range(0, len(s), 4096):
        np.minimum(low, (_MULTIPLIERS[:, None] * s[None, at:at + 4096]).min(1), out=low)
    return (low >> _U(32)).astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, the band's number mixed in."""
    x = sig[: BANDS * ROWS].reshape(BANDS, ROWS).astype(_U)
    h = _bytes.mix(np.arange(BANDS, dtype=_U) + _U(0x5851F42D4C957F2D))
    for i in range(ROWS):
        h = _bytes.mix(h ^ (x[:, i] * _U(0x9E3779B97F4A7C15)))
    return h.view(np.int64)


def fewest_matches(threshold: float, tolerance: float) -> list[int]:
    """After each STEP hashes: the fewest equal values that keep P(similarity >= threshold) >= tolerance."""
    s = (np.arange(4000) + 0.5) / 4000
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        m = np.arange(n + 1)[:, None]
        logp = m * np.log(s) + (n - m) * np.log1p(-s)
        p = np.exp(logp - logp.max(1, keepdims=True))
        tail = p[:, s >= threshold].sum(1) / p.sum(1)
        out.append(int(np.argmax(tail >= tolerance)))
    return out


def surviving_pairs(a: np.ndarray, b: np.ndarray | None, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two signature blocks (or of one with itself) that pruning keeps."""
    x = a[:, None, :STEP] == (a if b is None else b)[None, :, :STEP]
    equal = x.sum(2, dtype=np.int32)
    if b is None:
        equal[np.tril_indices(len(a))] = -1
    i, j = np.nonzero(equal >= least[0])
    equal = equal[i, j]
    other = a if b is None else b
    for k in range(1, len(least)):
        if not len(i):
            break
        cols = slice(k * STEP, (k + 1) * STEP)
        equal = equal + (a[i][:, cols] == other[j][:, cols]).sum(1)
        keep = equal >= least[k]
        i, j, equal = i[keep], j[keep], equal[keep]
    return i, j


def verified(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, from the exact sets."""
    size = np.asarray([len(s) for s in sets])
    if not len(i):
        return np.zeros(0, bool)
    if len(i) <= 4 * len(sets):
        both = np.asarray([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j)])
    else:  # many pairs among few sets: products of presence matrices, in strips of shingles
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        _, code, n = np.unique(flat, return_inverse=True, return_counts=True)
        shared = n[code] > 1
        code, owner = np.unique(code[shared], return_inverse=True)[1], owner[shared]
        total = np.zeros((len(sets), len(sets)), np.float32)
        width = int(code.max()) + 1 if len(code) else 0
        for at in range(0, width, 8192):
            part = (code >= at) & (code < at + 8192)
            m = np.zeros((len(sets), min(8192, width - at)), np.float32)
            m[owner[part], code[part] - at] = 1
            total += m @ m.T
        both = total[i, j].astype(np.int64)
    # |A and B| / |A or B| >= t, the quotient as a double like any exact check computes it
    return both / (size[i] + size[j] - both) >= threshold


def row_key(seed: int):
    """Half of a row's 128-bit key. Rows of one key are equal in id and text; a null id is an id like any other."""
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def nodes_of(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2 (row key), node (128-bit hash of the shingle set, null without a word), bands."""
    docs = docs.select("doc_id", "text", row_key(1).alias("k1"), row_key(2).alias("k2"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                node, band = [], []
                for t in b.column(1):
                    s = _bytes.shingles(t.as_py(), SHINGLE)
                    node.append(node_key(s) if len(s) else None)
                    band.append(band_keys(signature(s)) if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), b.column(3), pa.array(node, pa.string()),
                     pa.array(band, pa.list_(pa.int64()))], names=["doc_id", "k1", "k2", "node", "bands"])

    return docs.mapInArrow(run, f"doc_id {id_type}, k1 bigint, k2 bigint, node string, bands array<bigint>")


def node_key(s: np.ndarray) -> str:
    import hashlib

    return hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest()


def compare_groups(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """a, b, n: link counts (b null, n = linked documents) and forest edges (n null) of dealt blocks."""
    least = fewest_matches(threshold, tolerance)

    def run(pdf):
        import pandas as pd

        out: list[tuple] = []
        pdf = pdf.sort_values(["comp", "_i", "_j", "_o", "node"], kind="stable")
        for _, part in pdf.groupby(["comp", "_i", "_j"], sort=False):
            if len(part) < 2:
                continue
            sets = [_bytes.shingles(t, SHINGLE) for t in part["text"]]
            sig = np.asarray([signature(s) for s in sets])
            own, first = part["_o"].to_numpy(), int((part["_o"] == part["_i"].iloc[0]).sum())
            if own[0] == own[-1]:
                i, j = surviving_pairs(sig, None, least)
                if part["_i"].iloc[0] != part["_j"].iloc[0]:
                    continue  # the other block of the pair is empty
            else:
                i, j = surviving_pairs(sig[:first], sig[first:], least)
                j = j + first
            ok = verified(sets, i, j, threshold)
            i, j = i[ok], j[ok]
            weight = part["n"].to_numpy()
            links = np.bincount(i, weight[j], len(part)) + np.bincount(j, weight[i], len(part))
            node = part["node"].tolist()
            out += [(node[x], None, int(links[x])) for x in np.flatnonzero(links)]
            out += [(node[x], node[y], None) for x, y in forest(len(part), zip(i.tolist(), j.tolist()))]
        return pd.DataFrame({"a": pd.Series([r[0] for r in out], dtype=object),
                             "b": pd.Series([r[1] for r in out], dtype=object),
                             "n": pd.array([r[2] for r in out], dtype="Int64")})

    return members.groupBy("_g").applyInPandas(run, "a string, b string, n bigint")


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                    block: int = 96, pack: int = 256) -> DataFrame:
    """doc_id, class_id, n_links, kept: one row per row of ``docs``."""
    feats = materialise(nodes_of(docs), "shingle-nodes")
    nodes = feats.where("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("rep"), F.min(F.struct("k1", "k2")).alias("row"))
    nid = F.xxhash64("node").alias("nid")
    keys = feats.where("node is not null").select(nid, F.explode("bands").alias("k")).distinct()
    low = keys.groupBy("k").agg(F.min("nid").alias("m"), F.max("nid").alias("x")).where("m < x").select("k", "m")
    edges = keys.join(low, "k").where("nid <> m").select(F.col("nid").alias("a"), F.col("m").alias("b"))
    comps = connected_components(edges)  # candidates: a shared band is not yet a link
    members = nodes.withColumn("nid", F.xxhash64("node")).join(
        comps.select(F.col("id").alias("nid"), "comp"), "nid").select("node", "n", "comp", "row.*")
    members = materialise(members, "jaccard-members")
    # One row of every member's text: fetched by row key, so rows that share an id (a null one too) are told apart.
    # Always a shuffled join: the members of candidate components grow with the corpus.
    wanted = docs.select(row_key(1).alias("k1"), row_key(2).alias("k2"), "text").join(
        members.select("k1", "k2").hint("merge"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    dealt = deal_pairs_of_blocks(members, "comp", F.col("node"), block, pack)
    full = dealt.hint("merge").join(wanted, ["k1", "k2"]).drop("k1", "k2")
    found = materialise(compare_groups(full, threshold, tolerance), "jaccard-links")
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("links"))
    tree = found.where("b is not null").select("a", "b")
    classes = connected_components(tree)
    of_class = nodes.join(classes.select(F.col("id").alias("node"), "comp"), "node")
    smallest = of_class.groupBy("comp").agg(F.min("rep").alias("class_id"))
    linked = (of_class.select("node", "comp").join(smallest, "comp").select("node", "class_id"))
    info = (nodes.join(linked, "node", "left").join(links.select(F.col("a").alias("node"), "links"), "node", "left")
            .select("node", F.coalesce("class_id", "rep").alias("class_id"),
                    (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    info = materialise(info, "jaccard-nodes")
    out = feats.select("doc_id", "node").join(info, "node", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      F.col("doc_id").eqNullSafe(F.coalesce("class_id", "doc_id")).alias("kept"))
