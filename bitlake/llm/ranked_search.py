"""Ranked lexical search by pipelined term partitioning.

The terms of the queries are dealt to ``OWNERS`` term owners, the rarest terms to
the first, each with about the same number of postings.  An *item bundle* (a query
on one slice of the documents) visits the owners one after the other.  At each
stage bundles and the owner's postings are cogrouped by (slice, block of items):
the owner adds the whole-number contributions of its terms to the bundle's sparse
accumulators and passes it on.  After the last stage the best documents of each
bundle are merged by item.

**Postings.**  One Arrow pass over the texts counts the terms that the items have.  A
slice is at most :data:`SLICE_DOCS` consecutive documents of a task and about
:data:`SLICE_TERMS` terms; a term's postings in it are one row with packed positions
and counts, so a term that every document has is one small row a slice, never a hot
key.  The terms of the items go to the tasks as one set while they are fewer than
``broadcast_terms``; beyond, every term's postings are written and joined with the
items' terms by a shuffle (equal results, tested).

**What a bundle need not carry.**  Scores only grow.  Let ``need`` be an item's k-th best
score so far less the most that all terms still to come can add to any document (from the
term's weight and highest count, and the shortest document).  A document that is below
``need`` cannot get into the first k, and no document without accumulator can if ``need``
is above 0.  This is exact, ties included: only scores strictly below are left out.
``prune=False`` carries all of them (equal results, tested).

**Scores.**  ``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` is the only number that is not
whole.  ``m = 100 - b + (b n N) div L``; a term adds
``w * (10^9 tf div (1000 tf + 8 m))`` for every time the item has it.

Defined cases: a null text has no term; such a document is not counted in ``N`` and is
never found; an item without terms has no rows; a null id is an id; repeated rows of
documents are documents of their own, and repeated rows of items are searched and
returned each; equal scores go by document id, null last, equal rows in any order; empty
tables give no rows.  A text is tokenised whole in one task and is a slice of its own if long.  Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitlake.llm.common import stage

TOP = 10
OWNERS = 4
B = 75
SLICE_DOCS = 4096
SLICE_TERMS = 1 << 22
#: Items of one block are searched side by side in a task.
BLOCK_ITEMS = 256
#: So many terms of items, of at most TERM_BYTES bytes in all, are sent to every task.
BROADCAST_TERMS = 1 << 18
TERM_BYTES = 16 << 20

_KEEP = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Bytes of terms, A-Z in lower case; all others are spaces.
TABLE = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _KEEP else 0x20 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(TABLE).split(b" ") if text else []


def _count(text: bytes | None) -> tuple[Counter, int]:
    c = Counter(terms_of(text))
    c.pop(b"", None)
    return c, sum(c.values())


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(row, item, term, q)``: how often each row of ``items`` has each term."""
    id_type = items.schema[item_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, terms, q = [], [], []
            for i, text in enumerate(b.column(2)):
                c, _ = _count(text.as_py())
                at += [i] * len(c)
                terms += c.keys()
                q += c.values()
            rows = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(terms, pa.binary()),
                                              pa.array(q, pa.int64())], ["row", "item", "term", "q"])
    return (items.select(F.monotonically_increasing_id().alias("row"), F.col(item_col).alias("item"),
                         F.col(text_col).cast("string").cast("binary").alias("text"))
            .mapInArrow(run, f"row bigint, item {id_type}, term binary, q bigint"))


def _slices(vocabulary: frozenset[bytes] | None):
    """Arrow pass: per slice a row of the document table (no term: ids and
    lengths) and one row for each term with packed positions and counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, lengths, found = [], [], {}

        def flush():
            s = (task << 32) + number
            terms = [None, *found]
            none = [None] * len(found)
            pos = [None, *(np.array(p, np.uint16).tobytes() for p, _ in found.values())]
            tf = [None, *(np.array(t, np.uint32).tobytes() for _, t in found.values())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s] * len(terms), pa.int64()), pa.array(terms, pa.binary()), pa.array(pos, pa.binary()),
                 pa.array(tf, pa.binary()),
                 pa.array([sum(n > 0 for n in lengths), *(len(p) for p, _ in found.values())], pa.int64()),
                 pa.array([sum(lengths), *(max(t) for _, t in found.values())], pa.int64()),
                 pa.array([min((n for n in lengths if n), default=None), *none], pa.int64()),
                 pa.array([ids, *none], pa.list_(pa.int64())), pa.array([lengths, *none], pa.list_(pa.int64()))],
                ["slice", "term", "pos", "tf", "df", "most", "shortest", "ids", "lengths"])

        total = 0
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                c, n = _count(text.as_py())
                if ids and (len(ids) >= SLICE_DOCS or total + n > SLICE_TERMS):
                    yield from flush()
                    number, total, ids, lengths, found = number + 1, 0, [], [], {}
                at = len(ids)
                ids.append(key)
                lengths.append(n)
                total += n
                for t in (c.keys() if vocabulary is None else c.keys() & vocabulary):
                    p = found.get(t)
                    if p is None:
                        p = found[t] = ([], [])
                    p[0].append(at)
                    p[1].append(c[t])
        if ids:
            yield from flush()
    return run


_SLICE = ("slice bigint, term binary, pos binary, tf binary, df bigint, most bigint, shortest bigint, "
          "ids array<bigint>, lengths array<bigint>")


def _small_vocabulary(terms: DataFrame, most: int) -> frozenset[bytes] | None:
    """The distinct terms, or nothing if they are too many for a broadcast."""
    size = terms.agg(F.count(F.lit(1)), F.sum(F.length("term"))).first()
    if size[0] > most or (size[1] or 0) > TERM_BYTES:
        return None
    return frozenset(bytes(r.term) for r in terms.collect())


def _deal(stats: DataFrame, owners: int) -> list[int]:
    """Weights at which the next owner starts (falling), so that each has about
    the same number of postings.  There are as many rows as distinct weights:
    at most 1000 ln(2N + 2)."""
    by = stats.groupBy("w").agg(F.sum("df").alias("n")).orderBy(F.desc("w")).collect()
    total, run, cuts = sum(r.n for r in by), 0, []
    for r in by:
        run += r.n
        if len(cuts) < owners - 1 and run * owners >= total * (len(cuts) + 1):
            cuts.append(r.w)
    return cuts


def _first(scores: np.ndarray, ids: np.ndarray, null: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` best scores, equal ones by id, null ids last."""
    at = np.arange(len(scores))
    if len(scores) > top:
        at = np.flatnonzero(scores >= np.partition(scores, -top)[-top])
    return at[np.lexsort((ids[at], null[at], -scores[at]))][:top]


_BUNDLE = "slice bigint, block int, row bigint, pos binary, score binary, best array<bigint>, ids array<bigint>"


def _visit(n_docs: int, total: int, b: int, top: int):
    """An owner's step for the bundles of one (slice, block)."""
    def run(key: tuple, bundles: pa.Table, postings: pa.Table) -> pa.Table:
        out: dict[str, list] = {x: [] for x in ("row", "pos", "score", "best", "ids")}
        head, adds = None, {}
        lists = []
        for p in postings.to_pylist():
            if p["lengths"] is not None:
                head = p
            else:
                lists.append(p)
        if head is not None:
            m = np.array([100 - b + b * n * n_docs // total for n in head["lengths"]], np.int64)
            null = np.array([i is None for i in head["ids"]])
            ids = np.array([0 if i is None else i for i in head["ids"]], np.int64)
            need = {x["row"]: x["need"] for x in head["needs"]}
            for p in lists:
                at, tf = np.frombuffer(p["pos"], np.uint16), np.frombuffer(p["tf"], np.uint32).astype(np.int64)
                each = p["w"] * (1_000_000_000 * tf // (1000 * tf + 8 * m[at]))
                for u in p["users"]:
                    adds.setdefault(u["row"], []).append((at, each * u["q"]))
            had = {r["row"]: (r["pos"], r["score"]) for r in bundles.select(["row", "pos", "score"]).to_pylist()}
            for row in had.keys() | adds.keys():
                acc, live = np.zeros(len(m), np.int64), np.zeros(len(m), bool)
                if row in had:
                    old = np.frombuffer(had[row][0], np.uint16)
                    acc[old] = np.frombuffer(had[row][1], np.int64)
                    live[old] = acc[old] >= (need[row] or 0)
                closed = need[row] is not None and need[row] > 0
                if closed and not live.any():
                    continue
                for at, each in adds.get(row, ()):
                    acc[at] += each
                at = np.flatnonzero(live if closed else acc > 0)
                if not len(at):
                    continue
                scores = acc[at]
                first = _first(scores, ids[at], null[at], top)
                out["row"].append(row)
                out["pos"].append(at.astype(np.uint16).tobytes())
                out["score"].append(scores.tobytes())
                out["best"].append(scores[first].tolist())
                out["ids"].append([head["ids"][i] for i in at[first]])
        n = len(out["row"])
        return pa.table([
            pa.array([key[0].as_py()] * n, pa.int64()), pa.array([key[1].as_py()] * n, pa.int32()),
            pa.array(out["row"], pa.int64()), pa.array(out["pos"], pa.binary()), pa.array(out["score"], pa.binary()),
            pa.array(out["best"], pa.list_(pa.int64())), pa.array(out["ids"], pa.list_(pa.int64()))],
            names=["slice", "block", "row", "pos", "score", "best", "ids"])
    return run


def search(docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, b: int = B,
           doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", prune: bool = True,
           broadcast_terms: int = BROADCAST_TERMS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``item_col, rank, doc_col, score`` of the ``top`` documents of each row of ``items``."""
    if top < 1 or owners < 1 or block_items < 1 or not 0 <= b <= 100:
        raise ValueError("top, owners and block_items are 1 or more, b is 0 to 100")
    spark = docs.sparkSession
    item_type = items.schema[item_col].dataType.simpleString()
    asked = stage(item_terms(items, item_col, text_col), "search-items")
    terms = asked.select("term").distinct()
    vocabulary = _small_vocabulary(terms, broadcast_terms)
    texts = docs.select(F.col(doc_col).cast("bigint").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    index = stage(texts.mapInArrow(_slices(vocabulary), _SLICE), "search-index")
    if vocabulary is None:
        lists = index.filter("term IS NOT NULL").join(terms, "term", "left_semi").select(*index.columns)
        index = stage(index.filter("term IS NULL").unionByName(lists), "search-asked-index")
    heads = index.filter("term IS NULL").select("slice", "ids", "lengths", "df", "most", "shortest")
    size = heads.agg(F.sum("df").alias("docs"), F.sum("most").alias("terms"), F.min("shortest").alias("shortest")).first()
    n_docs, total = int(size.docs or 0), int(size.terms or 0)
    empty = spark.createDataFrame([], f"item {item_type}, rank int, id bigint, score bigint")
    if not total:
        return empty.toDF(item_col, "rank", doc_col, "score")
    shortest = 100 - b + b * int(size.shortest) * n_docs // total

    weight = F.floor(1000 * F.log((F.lit(2.0 * n_docs + 2)) / (2 * F.col("df") + 1))).cast("bigint")
    stats = (index.filter("term IS NOT NULL").groupBy("term")
             .agg(F.sum("df").alias("df"), F.max("most").alias("most")).withColumn("w", weight))
    stats = stage(stats.withColumn("most", F.expr(
        f"w * (1000000000L * most div (1000L * most + {8 * shortest}L))")), "search-terms")
    cuts = _deal(stats, owners)
    owner = sum((F.col("w") < c).cast("int") for c in cuts) if cuts else F.lit(0)
    n_items = asked.agg(F.count_distinct("row")).first()[0]
    blocks = max(1, -(-n_items // block_items))
    asked = stage(asked.join(stats, "term").select(
        "row", "item", "term", "q", "w", "most", owner.alias("owner"),
        F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block")), "search-asked")

    bundles = spark.createDataFrame([], _BUNDLE)
    visit = _visit(n_docs, total, b, top)
    last = len(cuts)
    for s in range(last + 1):
        needs = asked.groupBy("block", "row").agg(
            F.sum(F.when(F.col("owner") >= s, F.col("q") * F.col("most")).otherwise(0)).alias("rest"))
        if prune and s:
            best = bundles.select("row", F.explode("best").alias("score"))
            by = Window.partitionBy("row").orderBy(F.desc("score"))
            kth = (best.withColumn("rn", F.row_number().over(by)).filter(F.col("rn") <= top)
                   .groupBy("row").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == top))
            needs = needs.join(kth, "row", "left").withColumn("need", F.col("kth") - F.col("rest"))
        else:
            needs = needs.withColumn("need", F.lit(None).cast("bigint"))
        # At most ``block_items`` entries in a list.
        needs = needs.groupBy("block").agg(F.collect_list(F.struct("row", "need")).alias("needs"))
        head = heads.select("slice", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "ids", "lengths")
        users = (asked.filter(F.col("owner") == s).groupBy("term", "w", "block")
                 .agg(F.collect_list(F.struct("row", "q")).alias("users")))
        if vocabulary is not None:  # then both sides are small by the check above
            users = F.broadcast(users) if n_items <= block_items else users
        lists = index.filter("term IS NOT NULL").select("slice", "term", "pos", "tf").join(users, "term")
        postings = head.join(needs, "block").unionByName(lists.drop("term"), allowMissingColumns=True)
        step = (bundles.select("slice", "block", "row", "pos", "score").groupBy("slice", "block")
                .cogroup(postings.groupBy("slice", "block")).applyInArrow(visit, _BUNDLE))
        if s == last:  # only the best go on
            step = step.select("row", F.explode(F.arrays_zip("best", "ids")).alias("x")).select(
                "row", F.col("x.best").alias("score"), F.col("x.ids").alias("id"))
        bundles = stage(step, f"search-stage{s}")

    by = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = bundles.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    names = asked.select("row", "item").distinct()
    return ranked.join(names, "row").select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"),
                                            F.col("id").alias(doc_col), "score")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
i AS (
  SELECT item_id, row_number() OVER () AS r, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
q AS (SELECT r, item_id, term, count(*)::BIGINT AS q FROM i GROUP BY ALL),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
p AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
      FROM (SELECT r, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
      FROM p, s GROUP BY term, n_docs),
x AS (SELECT q.r, q.item_id, p.r AS d, p.doc_id,
             sum(q.q * w.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - {B} + ({B} * n * n_docs) // total))))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY ALL),
y AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id NULLS LAST, d) AS rank FROM x WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM y WHERE rank <= {TOP}
"""
