"""Substring deduplication by prefix-partitioned suffix trees.

Windows of 35 words that occur in more than one place are found and every
covered word is removed.  Suffixes are split by prefixes of variable length:
first by their anchor (:mod:`bitlake.llm.repeats`), which is an eight-word
prefix, then in a task by as many words as it takes to make groups of at most
:data:`SUBTREE` suffixes.  For each group a suffix tree is built from its sorted
suffixes; internal nodes at least 35 words deep whose leaves are preceded by
different words are the maximal repeats.

Defined cases: a null text counts as empty; an empty text keeps nothing (the
digest of the empty text); a text of fewer than 35 words has no window; null ids
and repeated rows each give their own row, and rows that repeat a text of 35
words or more lose all of it; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bitlake.llm.repeats import repeated_spans, with_spans
from bitlake.llm.suffix import SuffixArray, covered

WINDOW = 35
GRAM = 8
#: Suffixes in a subtree, unless they share a whole window.
SUBTREE = 4096


def prefix_groups(lcp: np.ndarray, least: int, most: int) -> list[tuple[int, int]]:
    """Ranges of sorted suffixes, each with a prefix of its own: a range of more
    than ``most`` suffixes is split by a prefix one token longer, until it is
    small enough or the prefix has ``least`` tokens.  Single suffixes are left out."""
    out, todo = [], [(0, len(lcp), 1)]
    while todo:
        i, j, depth = todo.pop()
        if j - i < 2:
            continue
        if depth > 1 and (j - i <= most or depth > least):
            out.append((i, j))
            continue
        cuts = np.flatnonzero(lcp[i + 1:j] < depth) + i + 1
        edges = np.concatenate(([i], cuts, [j]))
        wide = np.diff(edges) > 1
        todo += [(s, e, depth + 1) for s, e in zip(edges[:-1][wide].tolist(), edges[1:][wide].tolist())]
    return out


class SuffixTree:
    """The part of a suffix tree at least ``least`` deep, from sorted suffixes."""

    def __init__(self, lcp: list[int], at: int, least: int):
        self.depth: list[int] = []
        self.leaves: list[tuple[int, int]] = []
        stack: list[tuple[int, int]] = []  # (depth, first leaf) of the open path
        for i, d in enumerate([*lcp[1:], 0], at + 1):
            first = i - 1
            while stack and stack[-1][0] > d:
                depth, first = stack.pop()
                self.depth.append(depth)
                self.leaves.append((first, i))
            if d >= least and (not stack or stack[-1][0] < d):
                stack.append((d, first))


def repeats(tokens: np.ndarray, ends: np.ndarray, least: int = WINDOW,
            subtree: int = SUBTREE) -> Iterator[tuple[int, np.ndarray]]:
    """Maximal repeats of at least ``least`` tokens: ``(length, all places)``."""
    sa = SuffixArray(tokens, ends)
    order, ids = sa.order, sa.ids
    left = np.where(order > 0, ids[order - 1], -1)
    change = np.append(0, np.cumsum(left[1:] != left[:-1]))
    for i, j in prefix_groups(sa.lcp, least, subtree):
        part = sa.lcp[i:j]
        if part[1:].max() < least:
            continue
        tree = SuffixTree(part.tolist(), i, least)
        for depth, (s, e) in zip(tree.depth, tree.leaves):
            if change[e - 1] != change[s]:  # else every leaf has the same word before it
                yield depth, order[s:e]


def solve(tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = list(repeats(tokens, ends))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.concatenate([p for _, p in found])
    return covered(len(tokens), start, np.repeat([n for n, _ in found], [len(p) for _, p in found]))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``."""
    spans = repeated_spans(docs, WINDOW, GRAM, True, solve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, digest = [], [], []
            for t, lo, hi in zip(b.column(1), b.column(2), b.column(3)):
                words = t.as_py().split()
                n = len(words)
                if lo.is_valid:
                    lo, hi = (np.array(x.as_py(), np.int64) for x in (lo, hi))
                    s, e = covered(n, lo, hi - lo)
                    drop = np.zeros(n, bool)
                    for x, y in zip(s.tolist(), e.tolist()):
                        drop[x:y] = True
                    words = [w for w, d in zip(words, drop.tolist()) if not d]
                n_words.append(n)
                n_removed.append(n - len(words))
                digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest)],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return with_spans(docs, spans).mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
           FROM documents),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (SELECT r, i, w[i] AS word,
             CASE WHEN i + {WINDOW - 1} <= len(w) THEN sha256(array_to_string(w[i:i + {WINDOW - 1}], ' ')) END AS g FROM p),
c AS (SELECT r, i, word, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY g) > 1 THEN i END AS again FROM g),
m AS (SELECT r, i, word, coalesce(max(again) OVER (PARTITION BY r ORDER BY i) > i - {WINDOW}, false) AS gone FROM c),
k AS (SELECT r, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM m GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
