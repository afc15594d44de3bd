"""Packing documents into sequences by length patterns (non-negative least squares).

1. An Arrow pass turns every text into token ids and one end id, and cuts documents
   longer than a sequence into pieces; only longer ones are cut.
2. The number of pieces of each length (at most ``capacity`` rows) goes to the driver.
3. A *pattern* is two or three lengths that fill a sequence exactly.  All patterns of
   lengths that occur are enumerated, and their repeat counts are fitted to the histogram:
   ``min sum of length ** 2 * (pieces of that length - pieces used) ** 2`` over counts of 0
   or more, by coordinate descent on the patterns that gain most (Gauss-Southwell, in
   sweeps of :data:`SWEEP`).  It ends when no pattern would change by half a sequence.  Errors count by length, as
   short pieces are easy to place later and long ones are not.
4. Counts are rounded, never using more pieces than there are; what is left
   is packed best fit, longest first, into the space that is left and into new sequences.
   Sequences with the same space are one row of the plan, so this, too, is work
   on the histogram, whatever the number of documents.
5. Pieces of a length are numbered, in two levels (running sums over chunks of
   at most :data:`CHUNK` pieces, places in a chunk), so a length that a third of all rows
   have is no group of one task; the number says which sequence and offset a piece gets.

The plan that goes to the tasks is a row for each length of a pattern and of a
best-fit step.  Its size is bounded by ``capacity``, not by the documents: at most
``3 * STEPS`` rows of patterns, and about ``capacity * ln(capacity)`` best-fit rows
and their splits (a few ten thousand for 2,048 tokens).

**Tokens.**  :class:`Encoder` looks up the different words of :data:`BYTES` of text together, among those met of
late: about :data:`WORDS` or :data:`CHARS` at most, and as many of the time before, of which those met again stay.  Texts are cut
only where the tokenizer cuts as well: at ASCII white space, and words of ASCII, Latin letters, dashes and quotes
by its pattern; their parts go to its merges at once, other words to the whole tokenizer.  Tests compare whole texts.  This rule is for ``word_bpe_49k.json``
(white space dropped, words apart); ``by_word=False`` encodes whole texts with any file.
Special tokens in a text are ordinary text.

Defined cases: a null text is empty; an empty text is one piece with the end id alone;
a null id is an id; repeated rows are documents of their own; an empty table gives no
rows.  A very long text is encoded whole in one task.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import types
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitlake.llm.common import stage

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
CHUNK = 1 << 16
WORDS = 1 << 19
CHARS = 1 << 24
#: Bytes of text whose words are looked up together, and new words that are learned together.
BYTES = 1 << 23
NEW = 2000
#: Steps of the fit at most; what is not fitted is packed with the rest.
STEPS = 200_000
SWEEP = 512

#: Words of ASCII, Latin letters (all but dotted capital I, whose lower case has a combining mark), dashes and quotes:
#: normal form C and lower case of a letter do not depend on its neighbours.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e\u2010-\u2027]+").fullmatch
#: The tokenizer's own pattern, for lower case of these characters.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017e]+|[0-9]|[!-/:-@\\[-`{-~\u2010-\u2027]+").findall


class Encoder:
    """Token ids of texts, as little-endian 32-bit numbers in bytes."""

    def __init__(self, path: str | None = None, by_word: bool = True):
        from tokenizers import Tokenizer, pre_tokenizers
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.by_word = by_word
        if by_word:
            self.merges = Tokenizer(self.tokenizer.model)
            self.merges.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # Words met of late, and those of the time before.
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.chars = 0

    def encode(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """Null texts are empty."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        if not self.by_word:
            yield from self._encode([t or "" for t in texts.to_pylist()])
            return
        texts = texts.cast(pa.large_string()).fill_null("")
        upto = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BYTES, "right")))
            yield from self._by_word(texts.slice(at, end - at))
            at = end

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_word(self, texts: pa.Array) -> Iterator[bytes]:
        # Lower case at once if that cannot meet a combining mark.
        cut = pc.ascii_split_whitespace(pc.if_else(pc.string_is_ascii(texts), pc.ascii_lower(texts), texts))
        words = cut.flatten().dictionary_encode()
        ids = pa.array(self._ids(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)
        word = np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy()))
        ends = np.append(0, np.cumsum(pc.binary_length(ids).to_numpy()))[word].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        for at, end in zip(ends, ends[1:]):
            yield bytes(data[at:end])

    def _ids(self, words: list[str]) -> list[bytes]:
        if len(self.known) > WORDS or self.chars > CHARS:
            self.known, self.before, self.chars = {}, self.known, 0
        new = self._missing(words)
        for at in range(0, len(new), NEW):
            self._learn(new[at:at + NEW])
        return [*map(self.known.__getitem__, words)]

    def _missing(self, words: Iterable[str]) -> list[str]:
        """Words to be learned; those of the time before are fetched from there."""
        new = [*filterfalse(self.known.__contains__, words)]
        self.chars += sum(map(len, new))
        self.known.update((w, self.before[w]) for w in new if w in self.before)
        return [*filterfalse(self.known.__contains__, new)]

    def _learn(self, words: list[str]) -> None:
        """Ids of new words; those of plain characters are cut here as the tokenizer cuts them."""
        parts = {w: _PARTS(w.lower()) for w in words if _PLAIN(w)}
        rest = [w for w in words if w not in parts]
        self.known.update(zip(rest, self._encode(rest)))
        self._merge(self._missing({p for ps in parts.values() for p in ps}))
        of = self.known.__getitem__
        self.known.update((w, b"".join(map(of, ps))) for w, ps in parts.items() if ps[0] != w)

    def _merge(self, parts: list[str]) -> None:
        """Ids of new parts of words, from one text of them all."""
        e = self.merges.encode(" ".join(parts), add_special_tokens=False)
        ids = np.array(e.ids, "<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(np.array(e.word_ids, np.int64), minlength=len(parts)))).tolist()
        self.known.update((p, ids[at:end]) for p, at, end in zip(parts, [0] + ends, ends))


def worker_encoder(path: str | None, by_word: bool) -> Encoder:
    """The encoder of this Python worker, with the words that its earlier tasks met.
    This module reaches tasks by value, each time anew, so a name in ``sys.modules`` keeps it."""
    kept = sys.modules.setdefault("_packing_encoders", types.ModuleType("_packing_encoders")).__dict__
    key = f"{path}|{by_word}"
    if key not in kept:
        kept[key] = Encoder(path, by_word)
    return kept[key]


def _pieces(path: str | None, capacity: int, end_id: int, by_word: bool):
    """Arrow pass: the pieces of a task's documents, numbered by chunk and length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_encoder(path, by_word)
        end = np.array([end_id], "<u4").tobytes()
        chunk, in_chunk, seen = TaskContext.get().partitionId() << 32, 0, Counter()
        for b in batches:
            out = {k: [] for k in ("chunk", "place", "doc", "piece", "length", "crc")}
            for doc, ids in enumerate(encoder.encode(b.column(1))):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    n = len(part) // 4
                    if in_chunk == CHUNK:
                        chunk, in_chunk, seen = chunk + 1, 0, Counter()
                    out["chunk"].append(chunk)
                    out["place"].append(seen[n])
                    out["doc"].append(doc)
                    out["piece"].append(piece)
                    out["length"].append(n)
                    out["crc"].append(zlib.crc32(part))
                    seen[n] += 1
                    in_chunk += 1
            piece, length = np.array(out["piece"], np.int64), pa.array(out["length"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["chunk"], pa.int64()), pa.array(out["place"], pa.int64()),
                 b.column(0).take(pa.array(out["doc"], pa.int64())), pa.array(piece.astype(np.int32)),
                 pa.array(piece * capacity), length, pa.array(out["crc"], pa.int64())],
                ["chunk", "place", "id", "piece", "start", "length", "ids_crc32"])
    return run


@dataclass
class Plan:
    """Pieces of a length, in the order of their numbers, by sequences: row ``r``
    starts at piece ``first[r]`` of the whole (lengths one after the other) and puts
    its pieces at ``offset[r]`` of the sequences from ``sequence[r]`` on."""
    base: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def patterns(counts: np.ndarray) -> np.ndarray:
    """Rows of three lengths (0: none) that fill a sequence and occur often enough."""
    cap = len(counts) - 1
    have = np.flatnonzero(counts[:cap])
    parts = []
    for a in have[have * 2 <= cap]:
        if counts[cap - a] and (a * 2 < cap or counts[a] > 1):
            parts.append([[a, cap - a, 0]])
        b = have[(have >= a) & (have * 2 <= cap - a)]
        c = cap - a - b
        ok = (counts[c] > 0) & (b > 0)
        need = np.ones(len(b), np.int64) + (b == a)
        ok &= counts[a] >= need + ((c == a) & (b == a))
        ok &= (c != b) | (counts[b] >= 2 + (b == a))
        b, c = b[ok], c[ok]
        parts.append(np.stack([np.full(len(b), a), b, c], axis=1))
    return np.concatenate([np.array(p, np.int64).reshape(-1, 3) for p in parts]) if parts else np.zeros((0, 3), np.int64)


def fit_counts(counts: np.ndarray, rows: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts of the patterns, 0 or more, by least squares."""
    cap = len(counts) - 1
    x = np.zeros(len(rows))
    if not len(rows):
        return x
    weight = (np.arange(cap + 1) / cap) ** 2
    weight[0] = 0
    # A pattern that has a length twice counts it as 2 * 2, three times as 3 * 3.
    same = ((rows[:, 0] == rows[:, 1]) * 2 * weight[rows[:, 0]] + (rows[:, 1] == rows[:, 2]) * 2 * weight[rows[:, 1]]
            + (rows[:, 0] == rows[:, 2]) * 2 * weight[rows[:, 0]])
    norm = weight[rows].sum(axis=1) + same
    root = np.sqrt(norm)
    rest, weights, norms = counts.astype(float).tolist(), weight.tolist(), norm.tolist()
    while steps > 0:
        step = np.maximum((weight * rest)[rows].sum(axis=1) / norm, -x)
        gain = np.abs(step) * root
        best = np.argpartition(-gain, min(SWEEP, len(gain)) - 1)[:SWEEP] if len(gain) > SWEEP else np.arange(len(gain))
        best = best[np.argsort(-gain[best], kind="stable")]
        steps -= len(best)
        moved = 0.0
        for p, lengths in zip(best.tolist(), rows[best].tolist()):
            d = max(sum(weights[n] * rest[n] for n in lengths) / norms[p], -x[p])
            if abs(d) >= 0.5:
                moved = max(moved, abs(d))
                x[p] += d
                for n in lengths:
                    rest[n] -= d
        if moved == 0:
            break
    return x


def plan(counts: np.ndarray, steps: int = STEPS) -> Plan:
    """``counts[n]``: pieces of length ``n``; its last index is the capacity."""
    cap = len(counts) - 1
    base = np.concatenate([[0], np.cumsum(counts)[:-1]])
    used = np.zeros(cap + 1, np.int64)
    rows: list[tuple[int, int, int]] = []
    open_: dict[int, list[tuple[int, int]]] = {}  # space -> (first sequence, how many)
    sequences = 0

    def put(length: int, n: int, sequence: int, offset: int) -> None:
        rows.append((int(base[length] + used[length]), sequence, offset))
        used[length] += n

    if counts[cap]:
        put(cap, int(counts[cap]), 0, 0)
        sequences = int(counts[cap])
    found = patterns(counts)
    x = fit_counts(counts, found, steps)
    left = counts.copy()
    left[cap] = 0
    for p in np.argsort(-x, kind="stable"):
        if x[p] < 0.5:
            break
        lengths = [int(n) for n in found[p] if n]
        n = min(int(x[p] + 0.5), *(int(left[k]) // lengths.count(k) for k in lengths))
        if n:
            at = 0
            for k in sorted(lengths, reverse=True):
                put(k, n, sequences, at)
                left[k] -= n
                at += k
            sequences += n
    spaces = 0  # bit s: there are sequences with s places left
    for k in range(cap - 1, 0, -1):
        todo = int(left[k])
        while todo:
            fits = spaces >> k
            if fits:
                space = k + (fits & -fits).bit_length() - 1
                first, many = open_[space].pop()
                n = min(many, todo)
                if many > n:
                    open_[space].append((first + n, many - n))
                if not open_[space]:
                    spaces ^= 1 << space
            else:
                space, first, n = cap, sequences, -(-todo // (cap // k))
                sequences += n
                n = min(n, todo)
            put(k, n, first, cap - space)
            todo -= n
            if space > k:
                open_.setdefault(space - k, []).append((first, n))
                spaces |= 1 << space - k
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return Plan(base, table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy(), sequences)


def _place(p: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number = b.column("number").to_numpy() + p.base[b.column("length").to_numpy()]
            r = np.searchsorted(p.first, number, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")),
                 pa.array(p.sequence[r] + number - p.first[r]), pa.array(p.offset[r])],
                ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         tokenizer: str | None = None, end_id: int = END_ID, by_word: bool = True, steps: int = STEPS) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``."""
    if capacity < 1:
        raise ValueError("capacity is 1 or more")
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    out = f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    pieces = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _pieces(tokenizer, capacity, end_id, by_word), f"chunk bigint, place bigint, {out}")
    pieces = stage(pieces, "packing-pieces")
    per = stage(pieces.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r.length] = r.n
    upto = F.sum("n").over(Window.partitionBy("length").orderBy("chunk"))
    numbered = pieces.join(per.select("chunk", "length", (upto - F.col("n")).alias("before")), ["chunk", "length"])
    numbered = numbered.select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("number"))
    return (numbered.mapInArrow(_place(plan(counts, steps)), f"{out}, sequence_id bigint, offset bigint")
            .withColumnRenamed("id", id_col))
