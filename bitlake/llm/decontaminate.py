"""Benchmark decontamination: word-pair seeds and Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased.  A document is aligned with
an item word by word (match 2, mismatch -1, gap -1, local), and the pair is
reported if the best alignment has at least :data:`SCORE` of the score of an
exact copy.  The threshold is on the alignment alone; seeds only save work:

A *pair* is two words of a text that are neighbours or have one word between
them.  An alignment with ``M`` matches and ``X`` mismatches and gaps reaches
``S = 2 * SCORE * n`` of an item of ``n`` words only if ``X <= 2 * M - S``.  Two
consecutive matches with at most one error between them are a pair on both
sides; all others have two errors or more between them, so there are at least
``S / 2 - 1`` pairs in common, at places of their own, in at most ``3 * n - S``
words of the document.  Up to half of that number, the pairs of an item that the
most documents of the corpus have are left out and not waited for.  Wherever the
others occur often enough in so many words, the passage is aligned.  So copies
of an item make its pairs frequent, but never hide one another.  Items of one or
two words are found where all their words are (a word between them at most).

Test items are taken in blocks of about :data:`BLOCK_BYTES`, each of which is
held against all documents, so a large set of benchmarks costs more passes and
no more memory.  Documents are never shuffled.

Defined cases: null and empty texts, and texts without letters or digits, match
nothing; null ids are given out as they are; equal items are each reported;
repeated documents give rows each; an empty table on either side gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitlake.llm.common import text_or_empty
from bitlake.llm.hashing import chunks, mix, word_tokens

SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_BYTES = 4 << 20
CHUNK = 1 << 21
#: Places of items that are held against the text at a time, about.
PLACES = 1 << 21

#: Everything but ASCII letters and digits and non-ASCII bytes becomes a space.
_WORD = np.arange(256, dtype=np.uint8)
_WORD[:128] = [x if chr(x).isalnum() else 32 for x in range(128)]


def _tokens(buf: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    tokens, _, _, at = word_tokens(_WORD[buf], docs)
    return tokens, at


def _pairs_of(tokens: np.ndarray, at: np.ndarray, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``apart`` places from each other in one document, and
    the positions of the first; 0 apart: of single words."""
    if not apart:
        return tokens, np.arange(len(tokens))
    if len(tokens) <= apart:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    pos = np.flatnonzero(doc[:-apart] == doc[apart:])
    return mix(tokens[pos] * np.uint64(0x9E3779B97F4A7C15) + tokens[pos + apart]), pos


class Seeds:
    """Pairs of a block of items: whose each is, and how to find them quickly."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids, self.items, rows = [], [], []
        for item_id, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            tokens, at = _tokens(raw, np.array([0, len(raw)]))
            if not len(tokens):
                continue
            own = np.concatenate([_pairs_of(tokens, at, k)[0] for k in ((1, 2) if len(tokens) > 1 else (0,))])
            key, n = np.unique(own, return_counts=True)
            rows.append(np.stack([key, np.full(len(key), len(self.items), np.uint64), n.astype(np.uint64)], 1))
            self.ids.append(item_id)
            self.items.append(tokens)
        rows = np.concatenate(rows) if rows else np.zeros((0, 3), np.uint64)
        n = np.array([len(x) for x in self.items], np.int64)
        least = np.ceil(SCORE * MATCH * n - 1e-9).astype(np.int64)
        #: Pairs in common at least, and words of text that they are in at most.
        self.need, self.span = np.maximum(-(-least // 2) - 1, 1), 3 * n - least
        self.apart = ([0] if (n == 1).any() else []) + [1, 2]
        self._set(rows[np.argsort(rows[:, 0], kind="stable")])

    @classmethod
    def of(cls, shared) -> Seeds:
        """From a broadcast of ``vars(seeds)``."""
        own = cls.__new__(cls)
        vars(own).update(shared.value)
        return own

    def _set(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.keys, self.first = np.unique(rows[:, 0], return_index=True)
        bits = min(24, max(20, len(self.keys).bit_length() + 4))
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[(self.keys >> self.shift).astype(np.int64)] = True

    def without_frequent(self, documents: np.ndarray) -> None:
        """Leave out, of each item, the pairs that most documents have, up to half
        of those that a copy needs, and lower what it needs by as many."""
        of = documents[np.searchsorted(self.keys, self.rows[:, 0])]
        item, n = self.rows[:, 1].astype(np.int64), self.rows[:, 2].astype(np.int64)
        order = np.lexsort((-of, item))
        start = np.searchsorted(item[order], np.arange(len(self.items)))
        total = np.cumsum(n[order])
        upto = total - (total - n[order])[start][item[order]]
        out = order[upto <= (self.need // 2)[item[order]]]
        self.need = self.need - np.bincount(item[out], n[out], len(self.items)).astype(np.int64)
        kept = np.ones(len(self.rows), bool)
        kept[out] = False
        self._set(self.rows[kept])

    def hits(self, tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``tokens`` of pairs of the block, and their key numbers."""
        pos, key = [], []
        for apart in self.apart:
            pairs, where = _pairs_of(tokens, at, apart)
            some = np.flatnonzero(self.maybe[(pairs >> self.shift).astype(np.int64)])
            k = np.searchsorted(self.keys, pairs[some])
            ok = (k < len(self.keys)) & (self.keys[np.minimum(k, len(self.keys) - 1)] == pairs[some])
            pos.append(where[some[ok]])
            key.append(k[ok])
        return np.concatenate(pos), np.concatenate(key)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment: ``(score, end in text)``, a row of the table at a
    time.  Gaps along the row are a running maximum."""
    m = len(text)
    slope = np.arange(1, m + 1) * -GAP
    row, best, end = np.zeros(m + 1, np.int64), 0, 0
    for w in item:
        diag = row[:-1] + np.where(text == w, MATCH, MISMATCH)
        new = np.maximum(np.maximum(diag, row[1:] + GAP), 0)
        new = np.maximum.accumulate(new + slope) - slope
        row[1:] = new
        top = int(new.argmax())
        if new[top] > best:
            best, end = int(new[top]), top + 1
    return best, end


def _spans(seeds: Seeds, pos: np.ndarray, key: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """``(document, item, start, end)`` of the passages that have as many pairs of
    the item, close enough, as a copy needs; sorted."""
    ends = np.append(seeds.first[1:], len(seeds.rows))
    n = (ends - seeds.first)[key]
    rows = np.arange(int(n.sum())) + np.repeat(seeds.first[key] - (np.cumsum(n) - n), n)
    p, item = np.repeat(pos, n), seeds.rows[rows, 1].astype(np.int64)
    order = np.lexsort((p, item, np.searchsorted(at, p, "right")))
    p, item = p[order], item[order]
    doc = np.searchsorted(at, p, "right") - 1
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (item[1:] != item[:-1])
    p, item, doc = p[new], item[new], doc[new]
    last = np.arange(len(p)) + seeds.need[item] - 1
    end = np.minimum(last, len(p) - 1)
    ok = np.flatnonzero((last < len(p)) & (doc[end] == doc) & (item[end] == item) & (p[end] - p < seeds.span[item]))
    span, doc, item = seeds.span[item[ok]], doc[ok], item[ok]
    lo, hi = np.maximum(p[end[ok]] - span + 1, at[doc]), np.minimum(p[ok] + span, at[doc + 1])
    yield from zip(*(x.tolist() for x in (doc, item, lo, hi)))


def _pairs(seeds: Seeds, tokens: np.ndarray, at: np.ndarray) -> dict[int, dict[int, float]]:
    """Per document the items it holds, with the best score."""
    pos, key = seeds.hits(tokens, at)
    if not len(pos):
        return {}
    order = np.argsort(pos, kind="stable")
    pos, key = pos[order], key[order]
    # Whole documents at a time, so that the places of their pairs in items stay few.
    doc = np.searchsorted(at, pos, "right") - 1
    places = np.cumsum(np.diff(np.append(seeds.first, len(seeds.rows)))[key])
    cut = np.flatnonzero(np.diff(doc)) + 1
    cut = np.append(0, np.append(cut[np.diff(places[cut - 1] // PLACES, prepend=0) > 0], len(pos)))
    out: dict[int, dict[int, float]] = {}
    group = None
    spans: list[list[int]] = []

    def close() -> None:
        d, i = group
        words = seeds.items[i]
        best = max(align(words, tokens[s:e])[0] for s, e in spans) / (MATCH * len(words))
        if best >= SCORE:
            out.setdefault(d, {})[i] = best

    for x, y in zip(cut[:-1], cut[1:]):
        for d, i, s, e in _spans(seeds, pos[x:y], key[x:y], at):
            if group != (d, i):
                if group:
                    close()
                group, spans = (d, i), [[s, e]]
            elif s <= spans[-1][1] and e - spans[-1][0] <= 8 * seeds.span[i]:
                spans[-1][1] = max(spans[-1][1], e)
            elif e > spans[-1][1]:
                spans.append([s, e])
    if group:
        close()
    return out


def _blocks(benchmark: DataFrame) -> Iterator[Seeds]:
    """The test items, a bounded block at a time."""
    b = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.lower(text_or_empty()).alias("t"))
    total = b.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for i in range(n):
        part = b.filter(F.pmod(F.xxhash64("item_id", "t"), F.lit(n)) == i)
        seeds = Seeds(sorted(((r.item_id, r.t) for r in part.collect()), key=lambda r: (r[0] is None, r)))
        if seeds.items:
            yield seeds


def seed_blocks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> Iterator[Seeds]:
    """Blocks of items with their seeds; documents are counted over all of ``docs``."""
    d = docs.select(F.encode(F.lower(text_or_empty()), "UTF-8").alias("t"))
    for seeds in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(vars(seeds))

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = Seeds.of(shared)
            total = np.zeros(len(own.keys), np.int64)
            for b in batches:
                for _, _, buf, offs in chunks(b.column(0), CHUNK):
                    tokens, at = _tokens(buf, offs)
                    pos, key = own.hits(tokens, at)
                    doc = np.searchsorted(at, pos, "right") - 1
                    once = np.unique(doc * len(total) + key) % max(1, len(total))
                    total += np.bincount(once, minlength=len(total))
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["key", "n"])

        documents = np.zeros(len(seeds.keys), np.int64)
        for r in d.mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).collect():
            documents[r.key] = r.n  # one row a pair of the block at most
        seeds.without_frequent(documents)
        yield seeds


def leaks(spark: SparkSession, seeds: Seeds, text: Column) -> Column:
    """``array<struct<item_id, score>>`` of the items of the block in a text."""
    shared = spark.sparkContext.broadcast(vars(seeds))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64())]))

    @F.arrow_udf("array<struct<item_id:bigint,score:double>>")
    def find(t: pa.Array) -> pa.Array:
        own, out = Seeds.of(shared), []
        for i, j, buf, offs in chunks(t, CHUNK):
            tokens, at = _tokens(buf, offs)
            found = _pairs(own, tokens, at)
            out += [[{"item_id": own.ids[k], "score": round(s, 6)} for k, s in found.get(d, {}).items()]
                    for d in range(j - i)]
        return pa.array(out, kind)

    return find(F.encode(F.lower(text), "UTF-8"))


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it holds: ``doc_id, item_id, score``."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("t"))
    out = None
    for seeds in seed_blocks(spark, docs, benchmark):
        found = d.select("doc_id", F.explode(leaks(spark, seeds, F.col("t"))).alias("x")).select("doc_id", "x.*")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "doc_id bigint, item_id bigint, score double")


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a test item."""
    out = docs
    for seeds in seed_blocks(spark, docs, benchmark):
        out = out.filter(F.size(leaks(spark, seeds, text_or_empty())) == 0)
    return out
