"""SimHash near-duplicates: BK-trees over fingerprints.

A document's fingerprint has a bit set if over half of the XXH64 hashes of its
word shingles have it.  Fingerprints that differ in at most ``radius`` bits are
linked; a document's class is its connected component.

Candidate search.  Equal fingerprints are first merged.  The 64 bits are cut
into ``radius + 2`` blocks; two linked fingerprints agree on at least two of
them, so they meet in one of the shards keyed by two blocks' bits.  A shard with
more than :data:`SHARD_ROWS` fingerprints is split again: the bits that its key
does not fix are cut in the same way (same guarantee), up to three times, when a
shard can hold at most 2**18 different fingerprints.  Nothing is dropped.

In every shard a BK-tree is built whose children are keyed by integer Hamming
distance to the parent; each member is looked up, following only edges whose
distance is within ``radius`` of its distance to the node.  A shard passes on
only links that join two groups of its members (at most its size minus one),
which leaves the components as they are.

Trees are not broadcast: the fingerprints of all documents would have to pass
through the driver.  A shuffle brings each shard's members together instead.

Defined cases: a null text counts as empty; a text without words has
fingerprint zero and is linked like any other; null ids count as larger than
every other id; repeated rows give a row each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitlake.llm.common import stage, text_or_empty
from bitlake.llm.graph import components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints in a shard before its key is made longer.
SHARD_ROWS = 4096
_STEP = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # bytes: only A-Z and the six white-space bytes
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[: max(1, n - shingle + 1)].tolist()
    ends = ends[min(shingle, n) - 1:].tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _STEP):
        raw = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + _STEP], ends[at:at + _STEP])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, 64)
        counts += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprint_of(text: Column, shingle: int = SHINGLE) -> Column:
    """The 64 bits of a text column's fingerprints, as a bigint."""
    @F.arrow_udf("bigint")
    def fp(t: pa.Array) -> pa.Array:
        return pa.array(np.fromiter((fingerprint(x.as_py(), shingle) for x in t), np.uint64, len(t)).view(np.int64))

    return fp(F.encode(text, "UTF-8"))


class BKTree:
    """A BK-tree over distinct 64-bit fingerprints, built and searched in bulk."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        self.child: list[dict[int, int]] = [{} for _ in range(len(fps))]
        todo = [np.arange(len(fps))]
        while todo:  # the first member is the node, the others go below it by distance
            members = todo.pop()
            node, rest = int(members[0]), members[1:]
            d = np.bitwise_count(fps[rest] ^ fps[node])
            for k in np.unique(d):
                below = rest[d == k]
                self.child[node][int(k)] = int(below[0])
                todo.append(below)

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """``(node, positions of the queries within radius of it)``."""
        todo = [(0, np.arange(len(queries)))] if len(self.fps) else []
        while todo:
            node, who = todo.pop()
            d = np.bitwise_count(queries[who] ^ self.fps[node]).astype(np.int64)
            hit = who[d <= radius]
            if len(hit):
                yield node, hit
            for k, below in self.child[node].items():
                go = who[np.abs(d - k) <= radius]
                if len(go):
                    todo.append((below, go))


def _links(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join different groups of ``fps`` (a spanning forest)."""
    if len(fps) == 2:
        return [(0, 1)] if int(fps[0] ^ fps[1]).bit_count() <= radius else []
    up = list(range(len(fps)))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    for node, hit in BKTree(fps).search(fps, radius):
        for q in hit.tolist():
            a, b = find(node), find(q)
            if a != b:
                up[a] = b
                out.append((node, q))
    return out


def _blocks(bits: list[int], n: int) -> list[list[int]]:
    return [list(map(int, x)) for x in np.array_split(np.array(bits), n)]


def _masks(fixed: int, radius: int) -> list[int]:
    """Masks that fix two more of the blocks of the bits outside ``fixed``."""
    free = [b for b in range(64) if not fixed >> b & 1]
    return [fixed | sum(1 << x for x in (*a, *b)) for a, b in combinations(_blocks(free, radius + 2), 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def similar(fps: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links ``(u, v)`` over distinct ``fp``: enough for the components."""
    masks, parts, level = [0], [], 0
    rows = fps.select("fp", F.lit(0).alias("mask"))
    while True:
        finer = [m for old in masks for m in _masks(old, radius)]
        per = len(finer) // len(masks)
        lits = F.array(*[F.lit(_signed(m)) for m in finer])
        rows = rows.select("fp", F.explode(F.expr(f"sequence(mask * {per}, mask * {per} + {per - 1})")).alias("mask"))
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.element_at(lits, F.col("mask") + 1)))
        masks, level = finer, level + 1
        if level == 3:
            parts.append(rows)
            break
        hot = rows.groupBy("mask", "key").count().filter(F.col("count") > shard_rows).select("mask", "key")
        hot = stage(hot, "hot-shards")
        if hot.isEmpty():
            parts.append(rows)
            break
        parts.append(rows.join(hot, ["mask", "key"], "left_anti"))
        rows = rows.join(hot, ["mask", "key"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for mask, key, fp in _whole_groups(batches):
            at = np.flatnonzero((np.diff(mask) != 0) | (np.diff(key) != 0)) + 1
            starts, ends = np.append(0, at), np.append(at, len(fp))
            u, v = [], []
            for s, e in zip(*(x[ends - starts > 1].tolist() for x in (starts, ends))):
                own = fp[s:e].view(np.uint64)
                for a, b in _links(own, radius):
                    u.append(int(fp[s + a]))
                    v.append(int(fp[s + b]))
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    out = None
    for p in parts:
        p = p.select(F.col("mask").cast("bigint").alias("mask"), "key", "fp")
        links = p.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(run, "u bigint, v bigint")
        out = links if out is None else out.unionByName(links)
    return out


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of sorted batches, re-cut so that no (first, second) pair of
    columns spans two of them."""
    held: list[np.ndarray] | None = None
    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        if not len(cols[0]):
            continue
        last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield tuple(c[:cut] for c in cols)
        held = [c[cut:] for c in cols]
    if held is not None and len(held[0]):
        yield tuple(held)


def classes(rows: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(fp, root)`` of every fingerprint of ``rows``: its class."""
    fps = stage(rows.select("fp").distinct(), "distinct-fingerprints")
    roots = components(similar(fps, radius, shard_rows))
    return stage(fps.join(roots, fps["fp"] == roots["node"], "left")
                 .select("fp", F.coalesce("root", "fp").alias("root")), "classes")


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                  shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    rows = stage(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                             fingerprint_of(text_or_empty(), shingle).alias("fp")), "fingerprints")
    of = classes(rows, radius, shard_rows)
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    least = first.join(of, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = of.join(least, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
             shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id."""
    row, fp = "__simhash_row", "__simhash_fp"
    held = stage(docs.withColumn(fp, fingerprint_of(text_or_empty(), shingle))
                 .withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    rows = held.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(row).alias("row"), F.col(fp).alias("fp"))
    kept = (rows.join(classes(rows, radius, shard_rows), "fp").groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row")).alias("best"))
            .select(F.col("best.row").alias(row)))
    return held.join(kept, row, "left_semi").drop(row, fp)
