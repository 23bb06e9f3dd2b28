"""Vectorised byte and word hashing of whole texts (numpy, one text at a time)."""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_U = np.uint64


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int = _P):
        self.base, self.inv = base | 1, pow(base | 1, -1, 1 << 64)
        self.n = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 14)
            up, down = np.ones(self.n, _U), np.ones(self.n, _U)
            up[1:], down[1:] = _U(self.base), _U(self.inv)
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


POWERS = Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (shift-xor-multiply)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def prefix_hash(b: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """H with H[j]-H[i] = sum of (byte+1)*P**position over [i, j)."""
    up, _ = powers.upto(len(b) + 1)
    h = np.zeros(len(b) + 1, _U)
    np.cumsum((b.astype(_U) + _U(1)) * up[: len(b)], out=h[1:])
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """Hash of each byte span, independent of where it stands."""
    _, down = powers.upto(len(h))
    return mix((h[end] - h[start]) * down[start])


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 95]] = True
_WORD[128:] = True


def words(text: str | None, beginnings: tuple[int, ...] = ()) -> np.ndarray:
    """Hash of every word of the lower-cased text, in order.

    With ``beginnings``, the hashes of the words' first so many bytes follow,
    for the words that are longer. A word is a maximal run of ASCII letters, digits, underscores and
    non-ASCII characters. Null and empty texts have none.
    """
    if not text:
        return np.zeros(0, _U)
    b = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    w = np.zeros(len(b) + 2, np.int8)
    w[1:-1] = _WORD[b]
    d = np.diff(w)
    start, end = np.flatnonzero(d == 1), np.flatnonzero(d == -1)
    h = prefix_hash(b)
    out = [span_hash(h, start, end)]
    for k in beginnings:
        s = start[end - start > k]
        out.append(span_hash(h, s, s + k) + _U(k))
    return np.concatenate(out) if beginnings else out[0]


def shingles(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of every run of ``k`` words (a shorter text: all its words as one)."""
    w = words(text)
    if len(w) == 0:
        return w
    k = min(k, len(w))
    n = len(w) - k + 1
    h = np.zeros(n, _U)
    for i in range(k):
        h = h * _U(_P) + w[i:i + n]
    return np.unique(mix(h))
