"""Repeated windows of a corpus: what the two substring operators share.

A *window* is ``length`` consecutive tokens (words or bytes) of one document.
The task is to mark every token that a window covers whose content also starts
at another place.

1. Anchors.  The anchor of a window is the leftmost of its ``gram``-token grams
   with the least hash.  Equal windows have equal anchors at equal places, so
   they can only be found among windows with the same anchor.  Windows with the
   same anchor position form a *stretch* of consecutive tokens; every window lies
   in exactly one.  There is about one stretch for ``(length - gram) / 2`` tokens.
2. Stretches whose anchor occurs once are left out: they hold no repeat.
3. Equal stretches are one class.  A class with two members is covered whole.
4. The classes of an anchor that has several, one of them with a single member,
   are compared token by token in memory-sized groups of anchors (*solver*: a
   suffix tree or a suffix array).  A group of more than :data:`GROUP` classes,
   however many, is not: its windows are counted by a 128-bit hash instead, an
   aggregate that needs no group in one place.
5. The spans found are joined back to all members of the classes.

Members, classes and spans are only ever joined and aggregated by Spark.
Texts are told apart by polynomial hashes over two prime fields (:class:`Prefix`), 62 bits
of a stretch besides the 62 of its anchor, and stretches are compared by them only within
an anchor.  Rows are told apart by ``doc_id`` and a hash of the text; rows that repeat both
are two places, as they should be.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitlake.llm.common import stage, text_or_empty
from bitlake.llm.hashing import BYTE, Prefix, chunks, mix, sliding_min, word_tokens

#: Classes of one anchor that are compared in one task (about 1.5 MB of bytes).
GROUP = 4096
#: Bytes that a task hashes at a time (they and their hashes fit a cache), and
#: bytes after which it compares the groups that it holds.
CHUNK, COMPARED = 1 << 18, 1 << 17
#: A solver takes (tokens, separator slots) and returns starts and ends of spans.
Solver = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def tokens_of(buf: np.ndarray, docs: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes, and the offsets of the documents in tokens."""
    if words:
        tokens, _, _, at = word_tokens(buf, docs)
        return tokens, at
    return BYTE[buf], docs


def stretches(tokens: np.ndarray, docs: np.ndarray, length: int, gram: int):
    """``(document, start, length, anchor, content)`` of all stretches."""
    n = len(tokens)
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    prefix = Prefix(tokens)
    at = np.arange(n - gram + 1)
    grams = prefix.slices(at, at + gram)
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    anchor = (sliding_min(key, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.arange(n - length + 1)
    doc = np.repeat(np.arange(len(docs) - 1), np.diff(docs))
    keep = doc[first] == doc[first + length - 1]
    first, anchor = first[keep], anchor[keep]
    if not len(first):
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    # A new stretch where the anchor moves (documents have anchors of their own).
    new = np.flatnonzero(np.diff(anchor, prepend=-1))
    s = first[new]
    e = first[np.append(new[1:] - 1, len(first) - 1)] + length
    return doc[s], s - docs[doc[s]], e - s, grams[anchor[new]], prefix.slices(s, e)


def keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, tx, t)``: null ids take part in joins as an id of their own."""
    t = text_or_empty()
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("doc_id", t).alias("tx"),
                       F.encode(t, "UTF-8").alias("t"))


def anchors(docs: DataFrame, length: int, gram: int, words: bool) -> DataFrame:
    """One row per stretch: ``k, tx, a`` (anchor), ``c`` (content), ``start, len``."""
    names = ["k", "tx", "a", "c", "start", "len"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            tx = b.column(1).to_numpy(zero_copy_only=False)
            for i, _, buf, offs in chunks(b.column(2), CHUNK):
                tokens, at = tokens_of(buf, offs, words)
                doc, s, n, a, c = stretches(tokens, at, length, gram)
                if len(doc):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[i + doc]), pa.array(tx[i + doc]), pa.array(a.view(np.int64)),
                        pa.array(c.view(np.int64)), pa.array(s.astype(np.int32)), pa.array(n.astype(np.int32))], names)

    d = keyed(docs).select(F.coalesce("doc_id", F.lit(-(1 << 62))).alias("k"), "tx", "t")
    return d.mapInArrow(run, "k bigint, tx bigint, a bigint, c bigint, start int, len int")


def _texts(docs: DataFrame, wanted: DataFrame, words: bool) -> DataFrame:
    """``(a, c, t)``: the bytes of the wanted stretches ``(k, tx, a, c, start, len)``.
    Rows equal in ``k`` and ``tx`` are read as one, by each task; ``a, c`` that
    several tasks give are merged where they are used."""
    per = wanted.groupBy("k", "tx").agg(F.collect_list(F.struct("a", "c", "start", "len")).alias("w"))
    d = keyed(docs).withColumn("k", F.coalesce("doc_id", F.lit(-(1 << 62))))
    d = d.join(per, ["k", "tx"]).select("t", "w.a", "w.c", "w.start", "w.len", "k", "tx")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for b in batches:
            cols = [[], [], []]
            for t, a, c, start, n, *row in zip(*(b.column(x) for x in range(7))):
                row = tuple(x.as_py() for x in row)
                if row in met:
                    continue
                met.add(row)
                raw = t.as_py()
                s, n = (np.array(x.as_py(), np.int64) for x in (start, n))
                if words:
                    buf = np.frombuffer(raw, np.uint8)
                    _, ws, we, _ = word_tokens(buf, np.array([0, len(buf)]))
                    s, e = ws[s], we[s + n - 1]
                else:
                    e = s + n
                cols[0] += a.as_py()
                cols[1] += c.as_py()
                cols[2] += [raw[x:y] for x, y in zip(s.tolist(), e.tolist())]
                if len(cols[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], ["a", "c", "t"])
                    cols = [[], [], []]
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], ["a", "c", "t"])

    return d.mapInArrow(run, "a bigint, c bigint, t binary")


def _compare(texts: DataFrame, solver: Solver, words: bool) -> DataFrame:
    """``(a, c, lo, hi)``: repeated spans of classes, compared in groups of anchors."""
    def solved(a: np.ndarray, c: np.ndarray, parts: list[bytes]) -> pa.RecordBatch | None:
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        buf = np.frombuffer(b"".join(parts), np.uint8)
        tokens, at = tokens_of(buf, np.append(0, np.cumsum(size)), words)
        n = np.diff(at)
        ends = np.cumsum(n + 1) - 1
        laid = np.zeros(int(ends[-1]) + 1, np.uint64)
        inside = np.ones(len(laid), bool)
        inside[ends] = False
        laid[inside] = tokens
        s, e = solver(laid, ends)
        if not len(s):
            return None
        which = np.searchsorted(ends, s)
        lo = s - (ends - n)[which]
        return pa.RecordBatch.from_arrays([
            pa.array(a[which]), pa.array(c[which]), pa.array(lo.astype(np.int32)),
            pa.array((lo + e - s).astype(np.int32))], ["a", "c", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, c, t, size = [], [], [], 0
        for b in batches:
            for x, y, z in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if a and x == a[-1] and y == c[-1]:
                    continue  # of another row equal in k and tx
                if size > COMPARED and x != a[-1]:
                    if (out := solved(np.array(a), np.array(c), t)) is not None:
                        yield out
                    a, c, t, size = [], [], [], 0
                a.append(x)
                c.append(y)
                t.append(z)
                size += len(z)
        if a and (out := solved(np.array(a), np.array(c), t)) is not None:
            yield out

    return (texts.repartition("a").sortWithinPartitions("a", "c")
            .mapInArrow(run, "a bigint, c bigint, lo int, hi int"))


def _count_windows(texts: DataFrame, length: int, words: bool) -> DataFrame:
    """``(a, c, lo, hi)`` as :func:`_compare`, by counting hashed windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, c, t in zip(*(b.column(x).to_pylist() for x in range(3))):
                buf = np.frombuffer(t, np.uint8)
                tokens, _ = tokens_of(buf, np.array([0, len(buf)]), words)
                at = np.arange(len(tokens) - length + 1)
                h = Prefix(tokens).slices(at, at + length)
                g = Prefix(mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5))).slices(at, at + length)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), a)), pa.array(np.full(len(at), c)), pa.array(h.view(np.int64)),
                    pa.array(g.view(np.int64)), pa.array(at.astype(np.int32))], ["a", "c", "h", "g", "lo"])

    rows = stage(texts.mapInArrow(run, "a bigint, c bigint, h bigint, g bigint, lo int"), "hot-windows")
    often = rows.groupBy("h", "g").count().filter("count > 1").select("h", "g")
    # One row a class with its windows (a few hundred at most), then one a run of them.
    per = rows.join(often, ["h", "g"]).groupBy("a", "c").agg(F.array_sort(F.collect_set("lo")).alias("at"))
    runs = F.expr(f"""aggregate(at, cast(array() as array<struct<lo:int,hi:int>>), (out, x) ->
        if(size(out) > 0 and x <= element_at(out, -1).hi,
           concat(slice(out, 1, size(out) - 1), array(named_struct('lo', element_at(out, -1).lo, 'hi', x + {length}))),
           concat(out, array(named_struct('lo', x, 'hi', x + {length})))))""")
    return per.select("a", "c", F.explode(runs).alias("r")).select("a", "c", "r.lo", "r.hi")


def repeated_spans(docs: DataFrame, length: int, gram: int, words: bool, solver: Solver,
                   group: int = GROUP) -> DataFrame:
    """``(k, tx, spans)``: per row with repeats the token spans ``(lo, hi)`` (they
    may overlap) whose windows occur elsewhere too."""
    found = stage(anchors(docs, length, gram, words), "anchors")
    # Written first, so that the join has two plain exchanges and AQE can split a hot anchor.
    again = stage(found.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a"), "anchors-again")
    found = stage(found.join(again, "a", "left_semi"), "repeated-anchors")
    classes = stage(found.groupBy("a", "c").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "tx", "start", "len")).alias("one")), "classes")
    mixed = classes.groupBy("a").agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least")).filter(
        "classes > 1 and least = 1").select("a", (F.col("classes") > group).alias("hot"))
    wanted = classes.join(mixed, "a").select("a", "c", "hot", "one.*")
    texts = stage(_texts(docs, wanted.drop("hot"), words), "stretch-texts")
    hot = stage(mixed.filter("hot").select("a"), "hot-anchors")
    whole = classes.filter("n > 1").select("a", "c", F.lit(0).alias("lo"), F.col("one.len").alias("hi"))
    if hot.isEmpty():
        spans = _compare(texts, solver, words)
    else:
        spans = _compare(texts.join(hot, "a", "left_anti"), solver, words).unionByName(
            _count_windows(texts.join(hot, "a", "left_semi").dropDuplicates(["a", "c"]), length, words))
    spans = whole.unionByName(spans.join(whole.select("a", "c"), ["a", "c"], "left_anti"))
    return (found.join(spans, ["a", "c"])
            .select("k", "tx", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))
            .groupBy("k", "tx").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``(doc_id, t, lo, hi)`` for every row of ``docs``; null lists: no repeat."""
    d = keyed(docs).withColumn("k", F.coalesce("doc_id", F.lit(-(1 << 62))))
    return d.join(spans, ["k", "tx"], "left").select("doc_id", "t", "spans.lo", "spans.hi")
