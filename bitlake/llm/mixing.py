"""Mixing sources to target weights by a hypergeometric splitting tree (native).

1. Each source gets a target number of words (:func:`source_targets`).
2. A source's documents, in an order given by a hash, form a line of words, laid
   end to end as often as a document may be taken and cut into blocks.  The blocks
   are permuted by a hash, and as many of them as reach the target (the last one cut
   to the word) are drawn: the source's quota of blocks.
3. The quotas of all sources are the root of a binary tree whose leaves are the
   output shards.  A node gives its left child half of its blocks, drawn without
   replacement: going through its blocks source by source, each goes left with
   probability (left places open) / (blocks not yet seen).  That is a draw from
   the multivariate hypergeometric distribution, and quotas stay exact.
4. A source's drawn blocks, in their permuted order, are dealt out to the leaves in
   disjoint runs as long as the leaf's quota; in a shard, pieces are ordered by
   a hash.

At most about ``shards * BLOCKS_PER_SHARD`` blocks and one per source are drawn, so
the tree is small however large the data; a block has the words of
:data:`BLOCK_DOCS` average documents or more, so that few documents are cut.  Positions on a source's line come
from two levels of running sums over about ``sqrt(rows)`` hash ranges of about
``sqrt(rows)`` rows, so a source with a third of all rows is spread as well.

Defined cases: a null text has size 0; a null source is a source, ordered
last; a document without words is never taken (0); rows that repeat both id and
text have one place on the line each and, being equal, may swap them (they share a hash
range, so many such rows are one task's sort); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bitlake.llm.common import WORD, hash52, stage, text_or_empty

SHARDS = 16
BLOCKS_PER_SHARD = 64
BLOCK_DOCS = 4
#: A document is taken at most so many times.
REPEATS = 3
SEED = 11


def source_targets(sizes: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """``(source, idx, source_size, target, words)`` from ``(source, source_size)``.

    Weights go 1, 2, 3, 1, ... by source.  ``target`` is the level at which
    ``sum(min(repeats * size, weight * level))`` is the sum of all sizes: what
    repeated capping and resharing by weight ends in.  Sources are walked in the
    order in which they reach their cap; sums are integers, so exact.  The
    windows without a partition go over one row per source."""
    by_name = W.orderBy(F.col("source").isNull(), "source")
    s = sizes.withColumn("idx", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", (F.col("idx") % 3 + 1).cast("bigint"))
    cap_order = W.orderBy(F.col("source_size") / F.col("weight"), "idx")
    total = F.sum("source_size").over(W.partitionBy())
    before = F.coalesce(F.sum("source_size").over(
        cap_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    s = s.select("*", (total - repeats * before).alias("num"),
                 F.sum("weight").over(cap_order.rowsBetween(0, W.unboundedFollowing)).alias("den"))
    free = F.col("num") * F.col("weight") <= repeats * F.col("source_size") * F.col("den")
    first = F.min(F.when(free, F.struct(F.col("source_size") / F.col("weight"), F.col("idx"),
                                        F.col("num"), F.col("den")))).over(W.partitionBy())
    s = s.withColumn("first", first)
    here = F.struct(F.col("source_size") / F.col("weight"), F.col("idx"))
    level = F.struct(F.col("first.col1"), F.col("first.idx"))
    target = F.when(here < level, (repeats * F.col("source_size")).cast("double")).otherwise(
        (F.col("weight") * F.col("first.num")) / F.col("first.den"))
    return s.select("source", "idx", "source_size", target.alias("target"),
                    F.floor(target + 0.5).cast("bigint").alias("words"))


def split_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``(shard, idx, n)`` from ``(idx, n)``; ``shards`` is a power of two."""
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    q = quotas.select(F.lit(1).alias("node"), "idx", F.col("n").cast("bigint").alias("n"))
    for _ in range(shards.bit_length() - 1):
        nodes = q.groupBy("node").agg(
            F.array_sort(F.collect_list(F.struct("idx", "n"))).alias("v"), F.sum("n").alias("total"))
        # Algorithm S over the node's blocks, one source after the other.
        one = f"""aggregate(sequence(1L, x.n),
            named_struct('left', st.left, 'seen', st.seen, 'got', 0L),
            (a, j) -> named_struct(
              'left', a.left - if(pmod(xxhash64({seed}, node, x.idx, j), 1048576) / 1048576 * a.seen < a.left, 1L, 0L),
              'seen', a.seen - 1L,
              'got', a.got + if(pmod(xxhash64({seed}, node, x.idx, j), 1048576) / 1048576 * a.seen < a.left, 1L, 0L)))"""
        kind = "array<struct<idx:int,l:bigint,r:bigint>>"
        drawn = f"""aggregate(filter(v, x -> x.n > 0),
            named_struct('left', (total + 1) div 2, 'seen', total, 'out', cast(array() as {kind})),
            (st, x) -> transform(array({one}), d -> named_struct('left', d.left, 'seen', d.seen,
              'out', concat(st.out, array(named_struct('idx', x.idx, 'l', d.got, 'r', x.n - d.got)))))[0]).out"""
        q = (nodes.select("node", F.explode(F.expr(drawn)).alias("d"))
             .select(F.explode(F.array(
                 F.struct((F.col("node") * 2).alias("node"), F.col("d.idx").alias("idx"), F.col("d.l").alias("n")),
                 F.struct((F.col("node") * 2 + 1).alias("node"), F.col("d.idx").alias("idx"), F.col("d.r").alias("n"))
             )).alias("c")).select("c.*"))
    return q.select((F.col("node") - shards).cast("int").alias("shard"), "idx", "n")


def deal_blocks(targets: DataFrame, block: int, shards: int = SHARDS, seed: int = SEED,
                repeats: int = REPEATS) -> DataFrame:
    """``(idx, block, keep, shard)`` of the drawn blocks: their first ``keep`` words are taken."""
    supply = repeats * F.col("source_size")
    blocks = targets.filter("words > 0").select("idx", "words", supply.alias("supply"), F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.ceil(supply / F.lit(block)).cast("bigint") - 1)).alias("block"))
    size = F.least(F.lit(block).cast("bigint"), F.col("supply") - F.col("block") * block)
    order = W.partitionBy("idx").orderBy(hash52(F.lit(seed), "idx", "block"), "block")
    before = F.sum(size).over(order.rowsBetween(W.unboundedPreceding, 0)) - size
    drawn = blocks.select("idx", "block", (F.row_number().over(order) - 1).alias("rank"),
                          F.least(size, F.col("words") - before).alias("keep")).filter("keep > 0")
    runs = split_quotas(drawn.groupBy("idx").agg(F.count(F.lit(1)).alias("n")), shards, seed).filter("n > 0")
    upto = F.sum("n").over(W.partitionBy("idx").orderBy("shard"))
    runs = runs.select("idx", "shard", (upto - F.col("n")).alias("lo"), upto.alias("hi"))
    return (drawn.join(runs, "idx").filter("rank >= lo and rank < hi")
            .select("idx", "block", "keep", "shard"))


def mix(docs: DataFrame, shards: int = SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD,
        repeats: int = REPEATS, seed: int = SEED, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per document and piece of it in a block (one without a piece if it has no
    words): ``doc_id, size, source_size, target, place`` (unique per input row),
    ``words`` taken of the piece (0 unless its block is drawn), ``shard``, ``block`` and
    ``sort_key`` in the shard."""
    # Of id and text: rows without id, or of one id, spread; only rows equal in both tie.
    h = hash52(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text_or_empty()))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("bigint").alias("size"), h.alias("h"),
        *[F.col(c) for c in extra])
    rows = stage(rows, "mix-sizes")
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = stage(source_targets(per, repeats).join(
        per.select(F.col("source").alias("__s"), "rows"), F.col("__s").eqNullSafe(F.col("source"))).drop("__s"),
        "mix-targets")
    total, words, n = targets.agg(F.sum("words"), F.sum("source_size"), F.sum("rows")).first()
    block = max(1, -(-(total or 0) // (shards * blocks_per_shard)), -(-BLOCK_DOCS * (words or 0) // (n or 1)))

    # Places on the line: running sums over hash ranges, then inside each range.
    t = targets.select(F.col("source").alias("__s"), "idx", "source_size", "target",
                       F.col("words").alias("quota"),
                       F.ceil(F.sqrt("rows")).cast("bigint").alias("ranges"))
    rows = rows.join(F.broadcast(t) if t.count() <= 100_000 else t,
                     F.col("__s").eqNullSafe(F.col("source"))).drop("__s", "source")
    rows = rows.withColumn("range", F.shiftright(F.shiftright("h", 20) * F.col("ranges"), 32))
    sums = rows.groupBy("idx", "range").agg(F.sum("size").alias("n"))
    base = sums.select("idx", "range", (F.sum("n").over(W.partitionBy("idx").orderBy("range")) - F.col("n")).alias("base"))
    inside = W.partitionBy("idx", "range").orderBy("h", "doc_id", "size")
    rows = rows.select("*", (F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")).alias("off"),
                       F.row_number().over(inside).alias("__n"))
    rows = rows.join(base, ["idx", "range"]).withColumn("start", F.col("base") + F.col("off"))

    pieces = F.expr(f"""flatten(transform(
        filter(sequence(0, {repeats - 1}), e -> size > 0 and quota > 0),
        e -> transform(
          sequence((e * source_size + start) div {block}, (e * source_size + start + size - 1) div {block}),
          b -> named_struct('block', b,
            'lo', greatest(e * source_size + start - b * {block}, 0L),
            'hi', least(e * source_size + start + size - b * {block}, {block}L)))))""")
    rows = rows.select("doc_id", "idx", "size", "source_size", "target", *extra,
                       F.concat_ws("-", "idx", "range", "__n").alias("place"),
                       F.explode_outer(pieces).alias("p"))
    rows = rows.select("doc_id", "idx", "size", "source_size", "target", *extra, "place", "p.*")
    dealt = stage(deal_blocks(targets, block, shards, seed, repeats), "mix-blocks")
    some = targets.count() <= 100_000  # then the drawn blocks are few, too
    return (rows.join(F.broadcast(dealt) if some else dealt, ["idx", "block"], "left")
            .withColumn("words", F.when(F.col("keep") > F.col("lo"), F.least("hi", "keep") - F.col("lo")).otherwise(0))
            .withColumn("sort_key", F.xxhash64(F.lit(seed), "shard", "block", "place"))
            .drop("idx", "lo", "hi", "keep"))


def taken(pieces: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Words taken per document: ``doc_id, size, source_size, target, taken``.
    What counts is in the blocks that were drawn and dealt to a shard."""
    return (pieces.groupBy("place", "doc_id", "size", "source_size", "target", *extra)
            .agg(F.sum("words").cast("bigint").alias("taken")).drop("place"))


def mix_documents(docs: DataFrame, shards: int = SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD,
                  repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """The mix as rows of ``docs``: each as often as its taken words, rounded to
    whole texts, say, in a hashed order in each partition."""
    row = "__mix_row"
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    words = taken(mix(rows, shards, blocks_per_shard, repeats, seed, extra=(row,)), extra=(row,))
    copies = (words.select(row, F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + 0.5).cast("int").alias("__mix_n"))
              .filter("__mix_n > 0"))
    out = rows.join(copies, row).withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_n"))))
    return (out.sortWithinPartitions(F.xxhash64(F.lit(seed), row, "__mix_copy"))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
i AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight,
             row_number() OVER (ORDER BY source NULLS LAST) AS idx FROM s),
l AS (SELECT *, (sum(source_size) OVER () - {REPEATS} * coalesce(sum(source_size) OVER (
               ORDER BY source_size / weight, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS num,
             (sum(weight) OVER (ORDER BY source_size / weight, idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS den,
             row_number() OVER (ORDER BY source_size / weight, idx) AS pos FROM i),
f AS (SELECT num, den, pos FROM l WHERE num * weight <= {REPEATS} * source_size * den ORDER BY pos LIMIT 1),
t AS (SELECT l.source, idx, source_size, CASE WHEN l.pos < f.pos THEN ({REPEATS} * source_size)::DOUBLE
             ELSE (weight * f.num) / f.den END AS target FROM l, f),
q AS (SELECT row_number() OVER () AS rn, d.doc_id, idx - 1 AS idx, size, source_size, target, quota,
             (sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
      FROM d JOIN (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM t) t ON d.source IS NOT DISTINCT FROM t.source),
z AS (SELECT greatest(1, ((SELECT sum(floor(target + 0.5)) FROM t)::BIGINT + {SHARDS * BLOCKS_PER_SHARD - 1}) // {SHARDS * BLOCKS_PER_SHARD},
             ((SELECT {BLOCK_DOCS} * sum(size) + count(*) - 1 FROM d) // (SELECT count(*) FROM d))::BIGINT)::BIGINT AS block),
b AS (SELECT idx, quota, b, least(block, {REPEATS} * source_size - b * block) AS len,
             ('0x' || substr(md5('{SEED}:' || idx || ':' || b), 1, 13))::BIGINT AS h
      FROM (SELECT DISTINCT idx, quota, source_size, block, unnest(range(({REPEATS} * source_size + block - 1) // block)) AS b
            FROM q, z WHERE quota > 0)),
k AS (SELECT idx, b, least(len, quota - (sum(len) OVER (PARTITION BY idx ORDER BY h, b ROWS UNBOUNDED PRECEDING) - len))::BIGINT AS keep
      FROM b),
p AS (SELECT rn, idx, size, e * source_size + start AS p0, block,
             unnest(range((e * source_size + start) // block, (e * source_size + start + size - 1) // block + 1)) AS b
      FROM q, z, (SELECT unnest(range({REPEATS})) AS e) WHERE size > 0),
w AS (SELECT rn, sum(greatest(0, least(p0 + size - p.b * block, block, keep) - greatest(p0 - p.b * block, 0)))::BIGINT AS taken
      FROM p JOIN k ON k.idx = p.idx AND k.b = p.b AND keep > 0 GROUP BY rn)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM q LEFT JOIN w USING (rn)
"""
