"""Suffix-array deduplication by common-prefix intervals.

Bytes covered by a 200-byte string that occurs in more than one place are
removed.  Candidate stretches come from :mod:`bitlake.llm.repeats`; each
memory-sized group of them gets an enhanced suffix array (order, common
prefixes, byte before each suffix).  A scan with a stack visits the tree of
common-prefix intervals; an interval of at least 200 bytes whose suffixes are
preceded by different bytes is a maximal repeat, given out with all its
occurrences.

Defined cases: a null text counts as empty; an empty text keeps nothing (the
digest of the empty text); a text of fewer than 200 bytes has no such string;
null ids and repeated rows each give their own row, and rows that repeat a text
of 200 bytes or more lose all of it; an empty table gives an empty result; other
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

WINDOW = 200
#: Anchors this long rarely repeat by chance.
GRAM = 64


def intervals(sa: SuffixArray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(length, first, end)`` of the common-prefix intervals of at least
    ``least`` tokens, children before parents."""
    size, first, end = [], [], []
    for i, j in sa.runs(least):
        stack: list[tuple[int, int]] = []
        for k, h in enumerate([*sa.lcp[i + 1:j].tolist(), 0], i + 1):
            left = k - 1
            while stack and stack[-1][0] > h:
                n, left = stack.pop()
                size.append(n)
                first.append(left)
                end.append(k)
            if h and (not stack or stack[-1][0] < h):
                stack.append((h, left))
    return np.array(size, np.int64), np.array(first, np.int64), np.array(end, np.int64)


def maximal_repeats(tokens: np.ndarray, ends: np.ndarray, least: int = WINDOW):
    """``(lengths, number of occurrences, all occurrences one after another)``."""
    sa = SuffixArray(tokens, ends)
    size, first, end = intervals(sa, least)
    left = np.where(sa.order > 0, sa.ids[sa.order - 1], -1)
    change = np.append(0, np.cumsum(left[1:] != left[:-1]))
    diverse = change[end - 1] != change[first] if len(size) else np.zeros(0, bool)
    size, first, n = size[diverse], first[diverse], (end - first)[diverse]
    skip = np.cumsum(n) - n
    places = sa.order[np.arange(int(n.sum())) + np.repeat(first - skip, n)]
    return size, n, places


def solve(tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size, n, places = maximal_repeats(tokens, ends)
    return covered(len(tokens), places, np.repeat(size, n))


def suffix_array_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    spans = repeated_spans(docs, WINDOW, GRAM, False, solve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_bytes, n_removed, n_spans, digest = [], [], [], []
            for t, lo, hi in zip(b.column(1), b.column(2), b.column(3)):
                raw = t.as_py()
                kept = hashlib.sha256()
                gone, runs, at = 0, 0, 0
                if lo.is_valid:
                    lo, hi = (np.array(x.as_py(), np.int64) for x in (lo, hi))
                    for s, e in zip(*(x.tolist() for x in covered(len(raw), lo, hi - lo))):
                        kept.update(raw[at:s])
                        gone, runs, at = gone + e - s, runs + 1, e
                kept.update(raw[at:])
                n_bytes.append(len(raw))
                n_removed.append(gone)
                n_spans.append(runs)
                digest.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(digest)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return with_spans(docs, spans).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT r, unnest(range(0, len(h) // 2)) AS i, h FROM d),
g AS (SELECT r, i, h[2 * i + 1:2 * i + 2] AS byte,
             CASE WHEN i + {WINDOW} <= len(h) // 2 THEN md5(h[2 * i + 1:2 * i + {2 * WINDOW}]) END AS g FROM p),
c AS (SELECT r, i, byte, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY g) > 1 THEN i END AS again FROM g),
m AS (SELECT r, i, byte, coalesce(max(again) OVER (PARTITION BY r ORDER BY i) > i - {WINDOW}, false) AS gone FROM c),
e AS (SELECT r, i, byte, gone, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS opens FROM m),
k AS (SELECT r, count(*) FILTER (gone) AS n, count(*) FILTER (opens) AS s,
             string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS kept FROM e GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(s, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
