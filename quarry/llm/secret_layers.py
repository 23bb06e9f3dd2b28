"""Secret scans by a recursive decoding worklist (operator 13).

Every text is a first layer. A layer is scanned for secrets and then unwrapped:
URL and Unicode escapes in place, runs of base64 characters at each of their
four alignments, and compressed data wherever its magic bytes stand. Every
unwrapped layer is a work item of its own, scanned and unwrapped in turn until
nothing new appears. A layer knows for each of its characters which range of
the text it came from, so what is found in it is reported as the span of the
text that hides it: exact for escapes, the base64 characters that carry the
bytes, the whole compressed run for compressed data.

The list ends: escapes and base64 shrink a layer, and a decompressed layer that
was met before at the same place (data that decompresses to itself) is a cycle
and is not taken again. A layer of escapes nested deeper than ``LEVELS`` is
settled in one pass from the left, where every decoded character is tried again
with its neighbours, so the work stays linear in the nesting. Decompressed data
comes in pieces of at most ``PIECE`` characters that are cut where no token is,
so a bomb never fills the memory.

Layers are read as single bytes (latin-1): all patterns are ASCII.

Defined cases: a null text is empty; null ids stay null; rows that repeat are
scanned each; broken escapes, base64 and compressed data are left as they stand
(what a broken compressed run gives before it breaks is scanned); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The patterns of secrets and the least number of characters.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run is a match; shorter ones fail
LEAST_VALUE, LEAST_ACCESS = 8, 16

LEVELS = 8
PIECE = 4 << 20
#: A piece is cut after the last character in its last ``TAIL`` that is part of no token.
TAIL = 1 << 14
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[A-Za-z0-9+/_-]+)*={0,2}")
ESCAPE = re.compile(r"%[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}"
                    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
LONGEST_ESCAPE = 10
MAGIC = re.compile("\x1f\x8b\x08|BZh[1-9]1AY&SY|[\x28]\xb5\x2f\xfd|\xfd7zXZ\0|x[\x01\x9c\xda^]")
TOKEN_END = re.compile(r"[^A-Za-z0-9+/_.=%\\{}&#;:\"' -]")


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base matches of one string, leftmost and non-overlapping within each kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


class Layer:
    """A decoded string and, for each character, the range of the text it came from.

    ``start`` and ``end`` are arrays, None for the text itself, or one pair of numbers where all characters share a
    range. ``touched`` are the ranges of this layer that the last in-place step changed (None: everything is new).
    """

    __slots__ = ("text", "start", "end", "depth", "touched")

    def __init__(self, text, start=None, end=None, depth=0, touched=None):
        self.text, self.start, self.end, self.depth, self.touched = text, start, end, depth, touched

    def span(self, i: int, j: int) -> tuple[int, int]:
        """Where the characters [i, j) came from."""
        if self.start is None:
            return i, j
        if isinstance(self.start, int):
            return self.start, self.end
        return int(self.start[i]), int(self.end[j - 1])

    def map(self, first: np.ndarray, last: np.ndarray):
        """Ranges of the text for characters made of this layer's characters first..last (inclusive)."""
        if self.start is None:
            return first, last + 1
        if isinstance(self.start, int):
            return self.start, self.end
        return self.start[first], self.end[last]

    def key(self, place=None) -> tuple:
        return hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), place


def _escaped(e: str) -> str:
    if e[0] == "%":
        code = int(e[1:], 16)
    elif e[0] == "&":
        code = int(e[3:-1], 16) if e[2] in "xX" else int(e[2:-1])
    else:
        code = int(e[2:].strip("{}"), 16)
    return chr(code if code < 0x110000 and not 0xD800 <= code < 0xE000 else 0xFFFD)


def unescape(layer: Layer) -> Layer | None:
    """The layer with its escapes decoded once, each to one character; None if there are none."""
    found = [(m.start(), m.end()) for m in ESCAPE.finditer(layer.text)]
    if not found:
        return None
    at = np.asarray(found, np.int32)
    inside = np.zeros(len(layer.text) + 1, np.int32)
    np.add.at(inside, at[:, 0] + 1, 1)
    np.add.at(inside, at[:, 1], -1)
    first = np.flatnonzero(np.cumsum(inside[:-1]) == 0).astype(np.int32)  # an escape's first character stands for it
    last = first.copy()
    of = np.searchsorted(first, at[:, 0])
    last[of] = at[:, 1] - 1
    text = ESCAPE.sub(lambda m: _escaped(m[0]), layer.text)
    return Layer(text, *layer.map(first, last), layer.depth + 1, of)


def settle(layer: Layer) -> Layer | None:
    """The layer with its escapes decoded until none is left, in one pass; None if there are none."""
    if not ESCAPE.search(layer.text):
        return None
    out: list[str] = []
    first: list[int] = []
    last: list[int] = []
    changed: list[bool] = []
    for i, c in enumerate(layer.text):
        out.append(c), first.append(i), last.append(i), changed.append(False)
        while True:
            tail = "".join(out[-LONGEST_ESCAPE:])
            cut = max(tail.rfind("%"), tail.rfind("\\"), tail.rfind("&"))
            if cut < 0 or not ESCAPE.fullmatch(tail, cut):
                break
            n = len(tail) - cut
            made, f, l = _escaped(tail[cut:]), first[-n], last[-1]
            del out[-n:], first[-n:], last[-n:], changed[-n:]
            out.append(made), first.append(f), last.append(l), changed.append(True)
    return Layer("".join(out), *layer.map(np.asarray(first, np.int32), np.asarray(last, np.int32)), layer.depth + 1,
                 np.flatnonzero(changed))


def base64_layers(layer: Layer):
    """A layer for each alignment of each run of base64 characters that this layer is the first to hold."""
    for m in BASE64_RUN.finditer(layer.text):
        lo, hi = m.start(), m.end()
        if layer.touched is not None:
            near = np.searchsorted(layer.touched, lo - 1)  # an unchanged run was taken in the layer before
            if near == len(layer.touched) or layer.touched[near] > hi:
                continue
        run = m[0].rstrip("=")
        if "\n" in run:
            where = lo + np.asarray([i for i, c in enumerate(run) if c not in "\r\n"], np.int32)
            run = run.replace("\r", "").replace("\n", "")
        else:
            where = np.arange(lo, lo + len(run), dtype=np.int32)
        run = run.replace("-", "+").replace("_", "/")
        for off in range(4):
            body = run[off:]
            n = len(body) * 6 // 8
            if n < 8:
                continue
            data = _decode(body)[:n]
            i = np.arange(n, dtype=np.int64)
            yield Layer(data.decode("latin-1"), *layer.map(where[off + i * 8 // 6], where[off + (i * 8 + 7) // 6]),
                        layer.depth + 1)


def _decode(body: str) -> bytes:
    return binascii.a2b_base64(body + "A" * (-len(body) % 4))


def _opened(magic: str):
    if magic[0] == "B":
        return bz2.BZ2Decompressor()
    if magic[0] == "\xfd":
        return lzma.LZMADecompressor(lzma.FORMAT_XZ, memlimit=1 << 28)
    if magic[0] == "\x28":
        return zstandard.ZstdDecompressor(max_window_size=1 << 27).decompressobj()
    return zlib.decompressobj(31 if magic[0] == "\x1f" else 15)


def _bytes_from(text: str, at: int, n: int) -> bytes:
    """Up to n characters from ``at`` on as bytes, up to the first that is no byte."""
    part = text[at:at + n]
    try:
        return part.encode("latin-1")
    except UnicodeEncodeError as e:
        return part[:e.start].encode("latin-1")


def _inflate(text: str, at: int, magic: str):
    """(chunk, place after the data read) of what is compressed from ``at`` on; chunks are bounded in size."""
    try:
        d = _opened(magic)
        data = None
        while not d.eof:
            if data is None:  # little input at a time, where the output of a call cannot be bounded
                data = _bytes_from(text, at, 64 if magic[0] == "\x28" else 1024)
                at += len(data)
                if not data:
                    break
            if magic[0] == "\x28":
                chunk, data = d.decompress(data), None
            elif magic[0] in "B\xfd":
                chunk = d.decompress(data, 1 << 16)
                data = None if d.needs_input else b""
            else:
                chunk = d.decompress(data, 1 << 16)
                data = d.unconsumed_tail or None
            if chunk:
                yield chunk, at - len(data or b"") - len(d.unused_data)
        if magic[0] in "\x1fx" and not d.eof:
            yield d.flush(), at
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError):
        return


def compressed_layers(layer: Layer):
    """Layers of at most PIECE characters of whatever compressed data stands in this layer."""
    at = 0
    while m := MAGIC.search(layer.text, at):
        at = m.start() + 1
        if layer.touched is not None:
            k = np.searchsorted(layer.touched, m.start())
            if k == len(layer.touched):
                return  # nothing from here on is new
        held, size, end = [], 0, 0
        for chunk, end in _inflate(layer.text, m.start(), m[0]):
            held.append(chunk)
            size += len(chunk)
            if size >= PIECE:
                whole = b"".join(held).decode("latin-1")
                cut = max((x.end() for x in TOKEN_END.finditer(whole, len(whole) - TAIL)), default=len(whole))
                yield Layer(whole[:cut], *layer.span(m.start(), end), layer.depth + 1)
                held, size = [whole[cut:].encode("latin-1")], len(whole) - cut
        if size:
            yield Layer(b"".join(held).decode("latin-1"), *layer.span(m.start(), end), layer.depth + 1)
        at = max(at, end)


def _unwrapped(layer: Layer):
    inner = (unescape if layer.depth < LEVELS else settle)(layer)
    if inner is not None:
        yield inner
    yield from base64_layers(layer)
    yield from compressed_layers(layer)


def unwrap(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base matches, all matches) of a text, both ordered by start, kind and end.

    The list of work is kept depth first, each layer's inner ones made when they are taken, so what is held at a time
    is one chain of layers.
    """
    base = scan(text or "")
    spans = set(base)
    seen: set = set()
    work = [iter([Layer(text or "")])]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if isinstance(layer.start, int):
            key = layer.key((layer.start, layer.end))
            if key in seen:
                continue  # a cycle, or the same data at the same place again
            seen.add(key)
        if layer.start is not None:
            spans.update((kind, *layer.span(i, j)) for kind, i, j in scan(layer.text))
        work.append(_unwrapped(layer))
    order = {k: i for i, k in enumerate(KINDS)}
    return tuple(sorted(x, key=lambda s: (s[1], order[s[0]], s[2])) for x in (base, spans))


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base (text), spans (text): the counts are those of the base matches."""
    src = docs.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                b = batch.slice(lo, 256)
                found = [unwrap(t.as_py()) for t in b.column(1)]
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *counts, pa.array([_joined(base) for base, _ in found], pa.string()),
                     pa.array([_joined(spans) for _, spans in found], pa.string())],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    return src.mapInArrow(run, f"doc_id {id_type}, n_assign bigint, n_access bigint, n_hex bigint, "
                               "base string, spans string")


def secret_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    return find_secrets(docs).select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"),
                                     "spans")
