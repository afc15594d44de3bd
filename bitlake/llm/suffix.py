"""Suffix arrays of small batches, with common prefixes (NumPy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def _ranks(names: np.ndarray) -> np.ndarray:
    order = np.argsort(names)
    there = names[order]
    out = np.empty(len(names), np.int32)
    out[order] = np.cumsum(np.append(False, there[1:] != there[:-1]), dtype=np.int32)
    return out


class SuffixArray:
    """Suffixes of several token sequences laid end to end.  A separator of its
    own ends each, so that common prefixes never leave a sequence.

    ``order`` has the start of each suffix in lexicographic order, and ``lcp[i]``
    the length of the common prefix of suffixes ``i - 1`` and ``i``."""

    def __init__(self, tokens: np.ndarray, ends: np.ndarray):
        """``ends``: position of each sequence's separator slot in ``tokens``."""
        _, ids = np.unique(tokens, return_inverse=True)
        ids = ids.astype(np.int64)
        ids[ends] = ids.max(initial=0) + 1 + np.arange(len(ends))
        self.ids, n = ids, len(ids)
        longest = int(np.diff(ends, prepend=-1).max(initial=1))
        # Names of prefixes of 1, 2, 4 ... tokens: side by side in one number as far
        # as they fit, then ranks of pairs of shorter ones.  What lies past the end
        # does not matter, as the separator before it occurs only once.
        bits = max(1, int(ids.max(initial=0)).bit_length())
        self.levels = [(1, ids)]
        while self.levels[-1][0] < longest:
            h, name = self.levels[-1]
            if name.dtype != np.int32 and 2 * h * bits > 62:
                name = _ranks(name)
                self.levels[-1] = (h, name)
            width = 32 if name.dtype == np.int32 else h * bits
            pair = name.astype(np.int64) << width
            pair[:n - h] |= name[h:]
            self.levels.append((2 * h, _ranks(pair) if width == 32 else pair))
        self.order = np.argsort(self.levels[-1][1], kind="stable")
        a, b = self.order[:-1], self.order[1:]
        same = np.zeros(max(0, n - 1), np.int64)
        for h, rank in reversed(self.levels[:-1]):
            # A match never passes a separator, so positions stay inside.
            same += h * (rank[np.minimum(a + same, n - 1)] == rank[np.minimum(b + same, n - 1)])
        self.lcp = np.zeros(n, np.int64)
        self.lcp[1:] = same

    def runs(self, least: int) -> Iterator[tuple[int, int]]:
        """Ranges ``[i, j)`` of suffixes that share ``least`` tokens with a neighbour."""
        deep = np.append(self.lcp >= least, False)
        edge = np.flatnonzero(np.diff(deep.astype(np.int8), prepend=0))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            yield s - 1, e


def covered(n: int, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of the spans ``[start, start + length)`` as starts and ends."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, start + length, -1)
    on = np.cumsum(step)[:n] > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([0], on.astype(np.int8), [0]))))
    return edge[::2], edge[1::2]
