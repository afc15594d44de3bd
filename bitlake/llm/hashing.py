"""Vectorised hashing of bytes, words and windows (NumPy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
#: Slices are hashed as polynomials over two prime fields: modulo 2^64, odd bases have
#: texts of equal hash that no choice of base removes (the Thue-Morse words).
_FIELDS = ((2147483647, 1171432691), (2147483629, 948362419))
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[tuple[int, int], np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))


def powers(n: int, base: int, prime: int) -> np.ndarray:
    """At least the first ``n`` powers of ``base``."""
    x = _powers.get((base, prime), np.ones(1, np.uint32))
    while len(x) < n:
        x = np.append(x, (x * _U(pow(base, len(x), prime)) % _U(prime)).astype(np.uint32))
    _powers[base, prime] = x
    return x


class Prefix:
    """Hashes of slices of a token array in constant time each: 62 bits, and the length."""

    def __init__(self, tokens: np.ndarray):
        n = len(tokens)
        self.fields = []
        for prime, base in _FIELDS:
            # Terms are below 2^31, so sums of up to 2^33 of them fit.
            sums = np.zeros(n + 1, _U)
            np.cumsum(tokens % _U(prime) * powers(n, base, prime)[:n] % _U(prime), out=sums[1:])
            self.fields.append((_U(prime), sums, powers(n + 1, pow(base, -1, prime), prime)))

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = _U(0)
        for prime, sums, down in self.fields:
            raw = raw << _U(31) | (sums[end] - sums[start]) % prime * down[start] % prime
        return mix(raw ^ ((end - start).astype(_U) * _U(0xD6E8FEB86659FD93)))


def word_bounds(buf: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; ``docs`` has the offsets of the documents
    in ``buf`` and its length, and words never cross them."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~SPACE[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[docs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_tokens(buf: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, starts, ends, offsets of the documents in words)``."""
    s, e = word_bounds(buf, docs)
    tokens = Prefix(BYTE[buf]).slices(s, e) if len(s) else np.zeros(0, _U)
    return tokens, s, e, np.searchsorted(s, docs)


def chunks(column: pa.Array, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a binary column into ``(first row, end row, bytes, offsets)`` of about
    ``most`` bytes; a longer text is a chunk of its own.  No copy is made."""
    if not len(column):
        return
    wide = pa.types.is_large_binary(column.type)
    offs = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offs = offs[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each of the ``len(x) - w + 1`` windows, by block prefix and
    suffix minima."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    pad = -len(x) % w
    blocks = np.append(x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)).reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])
