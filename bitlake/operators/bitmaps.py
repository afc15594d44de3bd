"""Packed bitmap rollup of the facts (E5).

One row per ``(field, row_id, bucket)`` holding a 32,768-bit bitmap of the
columns ``bucket*32768 .. bucket*32768+32767`` (Spark's built-in bitmap
functions).  A shard of 2^20 ids is exactly 32 buckets.  Repeated queries
then combine bitmaps instead of scanning id pairs:

* count   = sum of ``bitmap_count``
* union   = ``bitmap_or_agg`` per bucket
* intersect: OR each operand to one bitmap per bucket, keep buckets present
  in all ``k`` operands (``HAVING count(*) = k``), then ``bitmap_and_agg``
* difference: the first operand's bitmap AND the complement of the others' OR;
  the complement is taken on the hex digits, four bits at a time
* range: OR of whole months and of the days at its edges (:func:`calendar_cover`)
  from a rollup by month and day (:func:`time_bitmap_index`)
* columns: the set positions of each bitmap, nibble by nibble.

A bitmap is 4 KiB whatever its fill, so the rollup pays off for rows with
more than about one set bit per 512 ids of a bucket; sparse rows are
cheaper as id pairs in the facts.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_BUCKET = 32768


def bitmap_index(facts: DataFrame) -> DataFrame:
    """Rollup ``(field, row_id, bucket, bitmap)``.  The ids are shuffled, not bitmaps: a
    partial bitmap is 4 KiB for however few bits, in each task and group."""
    return (facts
            .select("field", "row_id",
                    F.expr(f"col_id div {BITS_PER_BUCKET}").alias("bucket"),
                    F.pmod(F.col("col_id"), F.lit(BITS_PER_BUCKET)).alias("pos"))
            .repartition("field", "row_id", "bucket")
            .groupBy("field", "row_id", "bucket")
            .agg(F.bitmap_construct_agg("pos").alias("bitmap")))


def row_bitmap(rollup: DataFrame, field: str, row_id: int) -> DataFrame:
    return (rollup.where((F.col("field") == F.lit(field)) & (F.col("row_id") == F.lit(int(row_id))))
            .select("bucket", "bitmap"))


def or_bitmaps(*ops: DataFrame) -> DataFrame:
    u = reduce(lambda a, b: a.unionByName(b), ops)
    return u.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def and_bitmaps(*ops: DataFrame) -> DataFrame:
    tagged = [or_bitmaps(op).withColumn("_op", F.lit(i)) for i, op in enumerate(ops)]
    u = reduce(lambda a, b: a.unionByName(b), tagged)
    return (u.groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("_k"), F.bitmap_and_agg("bitmap").alias("bitmap"))
            .where(F.col("_k") == F.lit(len(ops)))
            .select("bucket", "bitmap"))


def not_bitmap(bitmap: str) -> Column:
    """Complement of a packed bitmap: every hex digit ``d`` becomes ``15 - d``."""
    return F.unhex(F.translate(F.hex(bitmap), "0123456789ABCDEF", "FEDCBA9876543210"))


def minus_bitmaps(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Buckets of ``first`` without the bits of any other operand; a bucket that
    the others lack stays as it is, one that ends up empty is left out."""
    keep = or_bitmaps(first).withColumn("_first", F.lit(1))
    if not others:
        return keep.drop("_first")
    drop = or_bitmaps(*others).select("bucket", not_bitmap("bitmap").alias("bitmap"), F.lit(0).alias("_first"))
    return (keep.unionByName(drop).groupBy("bucket")
            .agg(F.max("_first").alias("_first"), F.bitmap_and_agg("bitmap").alias("bitmap"))
            .where((F.col("_first") == 1) & (F.bitmap_count("bitmap") > 0)).select("bucket", "bitmap"))


def bitmap_columns(bm: DataFrame) -> DataFrame:
    """``col_id`` of every set bit.  Two steps, so that empty bytes cost one
    comparison each: the bytes that are not 0, then their bits."""
    bytes_ = bm.select("bucket", F.hex("bitmap").alias("h")).select("bucket", F.explode(F.expr(
        f"filter(transform(sequence(0, {BITS_PER_BUCKET // 8 - 1}), i -> named_struct('i', i, 'b', substring(h, 2 * i + 1, 2))),"
        " x -> x.b <> '00')")).alias("x"))
    byte = F.conv(F.col("x.b"), 16, 10).cast("int")
    bits = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda k: F.expr("0") != byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), k)))
    return bytes_.select("bucket", F.col("x.i").alias("i"), F.explode(bits).alias("k")).select(
        (F.col("bucket") * BITS_PER_BUCKET + F.col("i") * 8 + F.col("k")).cast("long").alias("col_id"))


def time_bitmap_index(facts: DataFrame) -> DataFrame:
    """Rollup ``(field, row_id, period, bucket, bitmap)`` of the facts that have a day, by
    month (``period`` yyyyMM) and by day (yyyyMMdd).  Both come from one pass: the ids of
    a month and bucket are shuffled once (not bitmaps, see :func:`bitmap_index`) and make
    its month and day bitmaps where they arrive."""
    month = F.year("day") * 100 + F.month("day")
    periods = F.array(F.col("month"), F.col("month") * 100 + F.dayofmonth("day"))
    return (facts.where(F.col("day").isNotNull())
            .select("field", "row_id", "day", month.alias("month"),
                    F.expr(f"col_id div {BITS_PER_BUCKET}").alias("bucket"),
                    F.pmod(F.col("col_id"), F.lit(BITS_PER_BUCKET)).alias("pos"))
            .repartition("field", "row_id", "bucket", "month")
            .select("field", "row_id", "month", F.explode(periods).alias("period"), "bucket", "pos")
            .groupBy("field", "row_id", "month", "period", "bucket")
            .agg(F.bitmap_construct_agg("pos").alias("bitmap"))
            .select("field", "row_id", "period", "bucket", "bitmap"))


def calendar_cover(start: _dt.date, end: _dt.date) -> list[int]:
    """Periods that make up ``start <= day < end``: whole months (yyyyMM) and the
    days (yyyyMMdd) of the months that it has in part; at most 60 days and a month key for each month."""
    out = []
    while start < end:
        after = _dt.date(start.year + start.month // 12, start.month % 12 + 1, 1)
        if start.day == 1 and after <= end:
            out.append(start.year * 100 + start.month)
            start = after
        else:
            out.append(start.year * 10_000 + start.month * 100 + start.day)
            start += _dt.timedelta(days=1)
    return out


def bitmap_cardinality(bm: DataFrame) -> DataFrame:
    return bm.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("long").alias("count"))


def bitmap_row_counts(rollup: DataFrame, field: str) -> DataFrame:
    """Distinct columns per row of a field (TopN input) from the rollup."""
    return (rollup.where(F.col("field") == F.lit(field))
            .groupBy("row_id").agg(F.sum(F.bitmap_count("bitmap")).cast("long").alias("Count")))


class BitmapIndex:
    """Count / union / intersect / difference / TopN / columns from the rollup, and
    time ranges from a rollup by period (``times``), in any nesting: every
    operand and answer is a ``(bucket, bitmap)`` frame.

    :meth:`rows` resolves the values of a call to row ids with one read of the
    row dictionary.  ``columns`` gives ids, or values with a column dictionary.
    """

    def __init__(self, rollup: DataFrame, row_dict: DataFrame, name: str, fields: list[str] | None = None,
                 times: DataFrame | None = None, col_dict: DataFrame | None = None):
        self.rollup = rollup
        self.row_dict = row_dict.where(F.col("index") == F.lit(name))
        self.fields = fields
        self.times = times
        self.col_dict = None if col_dict is None else col_dict.where(F.col("index") == F.lit(name))

    def _check(self, field: str) -> None:
        if self.fields is not None and field not in self.fields:
            raise ValueError(f"field {field!r} is not in the rollup; it has {', '.join(self.fields)}")

    def rows(self, *pairs: tuple[str, str]) -> list[DataFrame]:
        """The bitmaps of several ``(field, value)``; unseen values have none."""
        for f, _ in pairs:
            self._check(f)
        hits = (self.row_dict.where(F.col("field").isin(*{f for f, _ in pairs}) & F.col("row_val").isin(*{v for _, v in pairs}))
                .select("field", "row_val", "row_id").collect())
        ids = {(r["field"], r["row_val"]): r["row_id"] for r in hits}
        return [row_bitmap(self.rollup, p[0], ids[p]) if p in ids
                else self.rollup.where(F.lit(False)).select("bucket", "bitmap") for p in pairs]

    def row(self, field: str, value: str) -> DataFrame:
        return self.rows((field, value))[0]

    def range(self, field: str, value: str, start, end) -> DataFrame:
        """Bits of ``start <= day < end`` (bounds floored to the day) by whole months and
        edge days; bits without a day never match."""
        from ..plans.query import _day
        self._check(field)
        if self.times is None:
            raise ValueError("this rollup has no periods")
        hit = self.row_dict.where((F.col("field") == F.lit(field)) & (F.col("row_val") == F.lit(value))).first()
        periods = calendar_cover(_day(start), _day(end))
        if hit is None or not periods:
            return self.times.where(F.lit(False)).select("bucket", "bitmap")
        return or_bitmaps(self.times.where(
            (F.col("field") == F.lit(field)) & (F.col("row_id") == F.lit(int(hit["row_id"])))
            & F.col("period").isin(*periods)).select("bucket", "bitmap"))

    def union(self, *ops: DataFrame) -> DataFrame:
        return or_bitmaps(*ops)

    def difference(self, first: DataFrame, *others: DataFrame) -> DataFrame:
        return minus_bitmaps(first, *others)

    def columns(self, bm: DataFrame) -> DataFrame:
        """The set columns: ``col_val``, or ``col_id`` without a column dictionary."""
        ids = bitmap_columns(or_bitmaps(bm))
        if self.col_dict is None:
            return ids
        from .codec import decode_distinct
        return decode_distinct(ids, self.col_dict).select("col_val")

    def intersect(self, *ops: DataFrame) -> DataFrame:
        return and_bitmaps(*ops)

    def count(self, bm: DataFrame) -> DataFrame:
        return bitmap_cardinality(bm)

    def topn(self, field: str, n: int | None = None) -> DataFrame:
        self._check(field)
        d = self.row_dict.where(F.col("field") == F.lit(field)).select("row_id", "row_val")
        out = (bitmap_row_counts(self.rollup, field).join(d, "row_id", "left")
               .select(F.coalesce("row_val", F.lit("")).alias("Key"), "Count")
               .orderBy(F.desc("Count"), F.asc("Key")))
        return out.limit(int(n)) if n is not None else out
