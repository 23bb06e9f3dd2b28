"""Best-fit packing of token pieces into fixed-length sequences (operator 1).

The histogram of piece lengths (at most ``capacity`` rows, whatever the
corpus) is the only thing the driver sees. A configuration linear program
over it is solved by multiplicative weights: each round prices the lengths by
how far they are from being covered, a knapsack dynamic program finds the
dearest configuration, and that configuration gets a share. The shares are
rounded down to whole sequences; what is left of the histogram is packed
best-fit, again as configurations with multiplicities. Pieces are then dealt
to their places by (length, rank within the length), in Spark.

Defined cases: a null or empty text is a document of the end id alone; rows
that repeat are packed once each; an empty table gives no rows; columns other
than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._shared import materialise

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.tiktoken"

# ---------------------------------------------------------------- tokens


class WordTokenizer:
    """Byte-level BPE ids of ordinary text as little-endian bytes, remembered per space-separated word.

    A blank before a visible character always starts a new pre-token, so
    words can be looked up one by one. Only a blank followed by white space
    cuts differently; such texts go to the tokenizer whole. The memory holds
    at most ``room`` words and is emptied when full.
    """

    def __init__(self, path: str | None = None, room: int = 600_000):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                special_tokens={})
        self.encode = enc.encode_ordinary

        class Memory(dict):
            def __missing__(mem, word):
                if not word or word[0].isspace():
                    raise KeyError(word)
                if len(mem) >= room:
                    mem.clear()
                mem[word] = v = self._bytes(" " + word)
                return v

        self.memory = Memory()

    def _bytes(self, text: str) -> bytes:
        return np.asarray(self.encode(text), "<u4").tobytes()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        first, *rest = text.split(" ")
        if first[-1:].isspace() and not rest:
            return self._bytes(text)
        try:
            return self._bytes(first) + b"".join(map(self.memory.__getitem__, rest))
        except KeyError:
            return self._bytes(text)


def added_tokens(path: str | None = None) -> dict[str, int]:
    """The added tokens of the ``tokenizers`` json beside the rank file (none, if there is no json)."""
    import public_tokenizers

    path = os.path.splitext(path or public_tokenizers.path(VOCABULARY))[0] + ".json"
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    for t in added:
        if t["lstrip"] or t["rstrip"] or t["single_word"]:
            raise ValueError(f"added token {t['content']!r}: only plain ones are supported")
    return {t["content"]: t["id"] for t in added}


class DocumentTokenizer:
    """Ids as ``tokenizers`` gives them: added tokens are cut out first, each part between them is a text of its own."""

    def __init__(self, path: str | None = None):
        self.words = WordTokenizer(path)
        self.added = {k: np.asarray([v], "<u4").tobytes() for k, v in added_tokens(path).items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def __call__(self, text: str | None) -> bytes:
        if not text or self.cuts is None or not self.cuts.search(text):
            return self.words(text)
        return b"".join(self.added[t] if t in self.added else self.words(t) for t in self.cuts.split(text))


_TOKENIZERS: dict[str | None, DocumentTokenizer] = {}


def tokenizer(path: str | None) -> DocumentTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = DocumentTokenizer(path)
    return _TOKENIZERS[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones, the first takes the rest."""
    head = n % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))]


_PIECES = "doc_id {id}, piece int, start bigint, length bigint, ids_crc32 bigint, _pid int, _k bigint"


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                 tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece, with the map task (`_pid`) and the rank among its pieces of that length (`_k`)."""
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        tok, seen = tokenizer(tokenizer_path), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids, rows = [], []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = tok(t.as_py()) + end
                for p, (s, n) in enumerate(cut(len(x) // 4, capacity)):
                    ids.append(d)
                    rows.append((p, s, n, zlib.crc32(x[4 * s:4 * (s + n)]), seen[n]))
                    seen[n] += 1
            c = np.asarray(rows, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(0).type), pa.array(c[:, 0].astype(np.int32)), pa.array(c[:, 1]),
                 pa.array(c[:, 2]), pa.array(c[:, 3]), pa.array(np.full(len(c), pid, np.int32)), pa.array(c[:, 4])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "_pid", "_k"])

    return docs.mapInArrow(run, _PIECES.format(id=id_type))


# ---------------------------------------------------------------- the configuration program


def dearest_configuration(price: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack by dynamic programming: multiplicities (index = length) of greatest total price."""
    lengths = np.flatnonzero(price > 0)
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    value = price[lengths]
    fit = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := fit[c]:
            v = best[c - lengths[:k]] + value[:k]
            i = int(v.argmax())
            if v[i] > best[c]:
                best[c], take[c] = v[i], lengths[i]
    a, c = np.zeros(capacity + 1, np.int64), capacity
    while c > 0:
        if take[c]:
            a[take[c]] += 1
            c -= take[c]
        else:
            c -= 1
    return a


def configuration_shares(demand: np.ndarray, capacity: int, rounds: int = 250,
                         step: float = 0.35) -> list[tuple[float, np.ndarray]]:
    """Fractional configurations covering ``demand``: multiplicative weights with knapsack pricing.

    Row weights start above the volume bound's dual for long pieces, which are
    the hard ones to place (otherwise full configurations of short pieces tie
    and use them up), and fall exponentially with the share of the row already
    covered; a covered row stops counting. Every round adds ``step`` of the tightest row of the
    priced configuration.
    """
    shares: dict[bytes, list] = {}
    done = np.zeros(len(demand))
    worth = (np.arange(len(demand)) / capacity) ** 1.5
    for _ in range(rounds):
        left = np.maximum(demand - done, 0.0)
        price = np.where(left >= 1, worth * np.exp(-0.5 * np.minimum(done / np.maximum(demand, 1), 1.0)), 0.0)
        if not price.any():
            break
        a = dearest_configuration(price, capacity)
        used = np.flatnonzero(a)
        amount = float((left[used] / a[used]).min())
        amount = max(amount * step, min(amount, 1.0))
        done += amount * a
        shares.setdefault(a.tobytes(), [0.0, a])[0] += amount
    return sorted(((x, a) for x, a in shares.values()), key=lambda s: (-s[0], s[1].tobytes()))


@dataclass
class Plan:
    """Whole configurations: ``copies[i]`` sequences filled as ``configs[i]`` says."""

    configs: list[np.ndarray]
    copies: list[int]

    @property
    def sequences(self) -> int:
        return sum(self.copies)


def pack_histogram(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = 250) -> Plan:
    """Configurations whose multiplicities add up to ``counts`` exactly (index = length)."""
    left = np.asarray(counts, np.int64).copy()
    plan = Plan([], [])

    def use(a: np.ndarray, most: float) -> None:
        used = np.flatnonzero(a)
        n = int(min(most, (left[used] // a[used]).min())) if len(used) else 0
        if n > 0:
            left[used] -= n * a[used]
            plan.configs.append(a)
            plan.copies.append(n)

    if left[capacity]:  # full pieces fill a sequence alone
        a = np.zeros(capacity + 1, np.int64)
        a[capacity] = 1
        use(a, np.inf)
    for x, a in configuration_shares(left.astype(float), capacity, rounds):
        use(a, np.floor(x + 1e-9))
    while left.any():  # best fit for what rounding left: the piece that leaves least room
        a, free, rest = np.zeros(capacity + 1, np.int64), capacity, left.copy()
        while free > 0 and len(fits := np.flatnonzero(rest[: free + 1])):
            n = int(fits[-1])
            m = int(min(rest[n], free // n))
            a[n] += m
            rest[n] -= m
            free -= n * m
        use(a, np.inf)
    return plan


def places(plan: Plan, capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, pieces a sequence, first sequence, offset), by rank."""
    out: dict[int, list] = {}
    ranks, seq = np.zeros(capacity + 1, np.int64), 0
    for a, n in zip(plan.configs, plan.copies):
        offset = 0
        for size in np.flatnonzero(a)[::-1]:
            m = int(a[size])
            out.setdefault(int(size), []).append((ranks[size], m, seq, offset))
            ranks[size] += n * m
            offset += m * int(size)
        seq += n
    return {k: np.asarray(v, np.int64) for k, v in out.items()}


# ---------------------------------------------------------------- the operator


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer_path: str | None = None,
         rounds: int = 250) -> DataFrame:
    """Every piece of ``docs`` with its sequence and offset.

    The tokenised pieces (ids' checksum, no ids) are written once to the
    shared folder. Ranks within a length are (rank in the map task) + (pieces
    of that length in earlier tasks), so a length that holds a third of all
    pieces is never gathered. The table of places goes to the tasks with the
    code: its size is bounded by ``capacity`` and ``rounds``, not by the data.
    """
    pieces = materialise(token_pieces(docs, capacity, end_id, tokenizer_path), "pieces")
    per_task = pieces.groupBy("_pid", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per_task = materialise(
        per_task.select("_pid", "length", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")),
        "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for r in per_task.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    where = places(pack_histogram(counts, capacity, rounds), capacity)

    ranked = pieces.join(per_task.select("_pid", "length", "_before"), ["_pid", "length"]).select(
        *[c for c in pieces.columns if not c.startswith("_")], (F.col("_before") + F.col("_k")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))
    n_col, r_col = ranked.columns.index("length"), ranked.columns.index("sequence_id")

    def deal(batches):
        for batch in batches:
            size, rank = batch.column(n_col).to_numpy(), batch.column(r_col).to_numpy()
            seq, off = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            order = np.argsort(size, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
                if len(part):
                    n = int(size[part[0]])
                    t = where[n]
                    row = t[np.searchsorted(t[:, 0], rank[part], side="right") - 1]
                    k = rank[part] - row[:, 0]
                    seq[part] = row[:, 2] + k // row[:, 1]
                    off[part] = row[:, 3] + n * (k % row[:, 1])
            cols = [batch.column(i) for i in range(batch.num_columns - 2)] + [pa.array(seq), pa.array(off)]
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return ranked.mapInArrow(deal, ranked.schema)
