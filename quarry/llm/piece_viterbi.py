"""SentencePiece encoding and decoding by streaming Viterbi (operator 8).

The segmentation of greatest total piece score is found left to right. Only a
window is kept: scores for as many positions as the longest piece has
characters, and back pointers since the last commit. Whenever every path that
can still win runs through one boundary, the ids up to it are committed and
forgotten. In the given vocabulary no piece goes on past a blank that follows
another character, so that happens at every word at the latest, and words met
before are taken from a bounded memory of their ids.

Text is prepared as the vocabulary expects: one blank is put in front and
blanks become U+2581. Characters without a piece become their UTF-8 bytes'
pieces, at ten below the lowest score. Of equal paths the one whose last piece
is longest wins.

Decoding joins the pieces and bytes, turns U+2581 into blanks and removes the
first one; it restores every text that holds no U+2581 itself.

Defined cases: null and empty texts have no ids and decode to the empty text;
lone surrogates cannot occur in Spark strings; repeated rows are encoded each;
an empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLANK = "▁"
MODEL = "piece_bpe_32k.model"


class Pieces:
    """Piece table of a vocabulary file: ids, scores, prefixes and byte pieces."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id, self.byte_of, self.table = {}, {}, {}
        for i, piece in enumerate(self.text):
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value], self.byte_of[i] = i, value
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.table[piece] = (sp.get_score(i), i)
        self.unknown_score = min(s for s, _ in self.table.values()) - 10.0
        self.unknown_id = sp.unk_id()
        self.longest = max(map(len, self.table))
        #: pieces as a tree of characters; a node's "" holds the (score, id) of the piece that ends there
        self.tree: dict = {}
        for piece, found in self.table.items():
            node = self.tree
            for ch in piece:
                node = node.setdefault(ch, {})
            node[""] = found
        self.words_part = not any(re.search(f"[^{BLANK}]{BLANK}|\n", p) for p in self.table)

    def bytes_of(self, ch: str) -> tuple[int, ...]:
        raw = ch.encode("utf-8", "surrogatepass")
        return tuple(self.byte_id.get(b, self.unknown_id) for b in raw) if self.byte_id else (self.unknown_id,)


_NEVER = float("-inf")


class StreamingViterbi:
    """Feed prepared text in parts; ids come back as soon as they are certain."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.text, self.best, self.back, self.next, self.reach = "", [0.0], [None], 0, 0

    def feed(self, part: str, last: bool = False) -> list[int]:
        self.text += part
        out: list[int] = []
        tree, longest, text, unknown = self.p.tree, self.p.longest, self.text, self.p.unknown_score
        best, back, reach, j = self.best, self.back, self.reach, self.next
        more = len(text) + 1 - len(best)
        best.extend([_NEVER] * more)
        back.extend([None] * more)
        stop = len(text) if last else len(text) - longest
        short = last and not j and len(text) <= 4 * longest  # one window holds the whole text
        while j < stop:
            if j and not short and (reach <= j or j > 8 * longest):
                self.next, self.reach = j, reach
                cut = j if reach <= j else self._converged(j)
                if cut:
                    out += self._commit(cut)
                    text, best, back, reach, j, stop = self.text, self.best, self.back, self.reach, self.next, stop - cut
            base, node, e = best[j], tree, j
            alone = True
            for ch in text[j:j + longest]:
                node = node.get(ch)
                if node is None:
                    break
                e += 1
                found = node.get("")
                if found is not None:
                    if e == j + 1:
                        alone = False
                    score = base + found[0]
                    if score > best[e]:
                        best[e], back[e] = score, (j, found[1])
            reach = max(reach, e)
            if alone and base + unknown > best[j + 1]:
                best[j + 1], back[j + 1] = base + unknown, (j, None)
            j += 1
        self.next, self.reach = j, reach
        if last:
            out += self._commit(len(text))
        return out

    def _converged(self, j: int) -> int:
        """The last boundary that every surviving path runs through (0: none after the start)."""
        live = {j, *(e for e in range(j + 1, min(j + self.p.longest, len(self.best))) if self.back[e] is not None)}
        while len(live) > 1:
            e = max(live)
            live.remove(e)
            live.add(self.back[e][0])
        return live.pop()

    def _commit(self, end: int) -> list[int]:
        ids, e = [], end
        while e > 0:
            j, i = self.back[e]
            ids.extend((i,) if i is not None else reversed(self.p.bytes_of(self.text[j])))
            e = j
        ids.reverse()
        self.text, base = self.text[end:], self.best[end]
        self.best = [s - base for s in self.best[end:]]
        self.back = [None, *(via and (via[0] - end, via[1]) for via in self.back[end + 1:])]
        self.next, self.reach = max(0, self.next - end), max(0, self.reach - end)
        return ids


def encode_stream(pieces: Pieces, parts: Iterable[str]) -> Iterator[int]:
    """Ids of a text given in parts of any size, as they become certain."""
    v, begun = StreamingViterbi(pieces), False
    for part in parts:
        if part:
            yield from v.feed((part if begun else " " + part).replace(" ", BLANK))
            begun = True
    yield from v.feed("", last=True)


class Encoder:
    """Whole texts to ids, with a bounded memory of words."""

    def __init__(self, path: str | None = None, room: int = 800_000):
        self.pieces = Pieces(path)

        class Memory(dict):
            def __missing__(mem, word):
                if len(mem) >= room:
                    mem.clear()
                ids = StreamingViterbi(self.pieces).feed(word.replace(" ", BLANK), last=True)
                mem[word] = v = np.asarray(ids, "<u4").tobytes()
                return v

        self.memory = Memory()
        # a piece never spans these borders (checked in Pieces), so every path runs through them
        self.words = re.compile(f"[ {BLANK}]*[^ {BLANK}\n]+|[ {BLANK}]+|\n")

    def encode(self, text: str | None) -> np.ndarray:
        """Unsigned 32-bit little-endian ids."""
        if not text:
            return np.zeros(0, "<u4")
        if not self.pieces.words_part:
            return np.fromiter(encode_stream(self.pieces, [text]), "<u4")
        return np.frombuffer(b"".join(map(self.memory.__getitem__, self.words.findall(" " + text))), "<u4")

    def decode(self, ids: Iterable[int]) -> str:
        text, byte_of, out, raw = self.pieces.text, self.pieces.byte_of, [], bytearray()
        for i in ids:
            if i in byte_of:
                raw.append(byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(text[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        joined = "".join(out).replace(BLANK, " ")
        return joined[1:] if joined.startswith(" ") else joined


_ENCODERS: dict[str | None, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids: the ids of every whole text."""
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                ids = [encoder(path).encode(t.as_py()).astype(np.int32) for t in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))],
                                                 names=["doc_id", "ids"])

    return docs.mapInArrow(run, f"doc_id {id_type}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32, text: the checksum of the ids and the text they decode to."""
    encoded = encoded.select("doc_id", "ids")
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                ids = [np.asarray(x.values.to_numpy()) if x.is_valid else np.zeros(0, np.int32) for x in b.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                     pa.array([encoder(path).decode(x.tolist()) for x in ids], pa.string())],
                    names=["doc_id", "n_ids", "ids_crc32", "text"])

    return encoded.mapInArrow(run, f"doc_id {id_type}, n_ids bigint, ids_crc32 bigint, text string")
