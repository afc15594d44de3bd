"""Set queries over bits: Row, Range, Union, Intersect, Difference, Count,
TopN, nesting and batches of calls (G1-G7, E2-E4).

An :class:`Index` wraps a bit relation ``(field, row, col, day)`` in one of
two spaces:

* value space: ``(field, row_val, col_val, day)`` straight from the logs;
* id space: the fact table ``(field, row_id, col_id, day)`` plus the two
  dictionaries; answers are decoded back to values.

A :class:`Bitmap` is a lazily built one-column, distinct DataFrame of
columns.  Nothing is collected: every answer is a DataFrame, so nesting and
batches are one Catalyst plan each.  The only driver read is the ids of the
values that a call names (one read of the row dictionary for all its leaves),
turned into literals so that the fact scan can use parquet statistics on ``row_id``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.codec import decode_distinct, joinable
from ..spec import DEFAULT_INDEX, LogSpec

#: Leaves per word of the masks of a batch.
WORD_BITS = 62


def _day(x) -> _dt.date:
    if isinstance(x, _dt.datetime):
        return x.date()
    if isinstance(x, _dt.date):
        return x
    return _dt.datetime.fromisoformat(str(x).strip()).date()  # the whole text, or ValueError


class Bitmap:
    """A set of columns (distinct, one column).  A leaf (``row``/``range``)
    only remembers ``(field, value, start, end)``: its row id is looked up when
    a call needs it, together with those of the call's other leaves, and set
    operations over leaves of one field can be answered by one fact scan.  A set
    operation remembers its operands (``op``), so that a batch of calls can be
    evaluated together (:meth:`Index.shared`); its frame is built when asked for."""

    def __init__(self, index: "Index", df: DataFrame | None = None, leaf: tuple | None = None,
                 op: tuple | None = None):
        self.index = index
        self._df = df
        self.leaf = leaf
        self.op = op

    @property
    def df(self) -> DataFrame:
        if self._df is None:
            if self.leaf is not None:
                self._df = self.index._leaf_columns(self.leaf)
            else:
                self._df = self.index._combine(*self.op)
        return self._df

    def leaves(self) -> list[tuple] | None:
        """The leaves of the expression; nothing if a frame is among its operands."""
        if self.leaf is not None:
            return [self.leaf]
        if self.op is None:
            return None
        parts = [b.leaves() for b in self.op[1]]
        return None if None in parts else [lf for p in parts for lf in p]

    def __or__(self, other: "Bitmap") -> "Bitmap":
        return self.index.union(self, other)

    def __and__(self, other: "Bitmap") -> "Bitmap":
        return self.index.intersect(self, other)

    def __sub__(self, other: "Bitmap") -> "Bitmap":
        return self.index.difference(self, other)

    def count(self) -> DataFrame:
        return self.index.count(self)

    def columns(self, strict: bool = True) -> DataFrame:
        return self.index.columns(self, strict)


class Index:
    def __init__(self, facts: DataFrame, spec: LogSpec = LogSpec(), row_dict: DataFrame | None = None,
                 col_dict: DataFrame | None = None, name: str = DEFAULT_INDEX):
        self.spec = spec
        self.name = name
        self.id_space = "row_id" in facts.columns
        self.rcol = "row_id" if self.id_space else "row_val"
        self.ccol = "col_id" if self.id_space else "col_val"
        self.facts = facts.select("field", self.rcol, self.ccol, "day")
        self._ids: dict = {}
        if self.id_space:
            if row_dict is None or col_dict is None:
                raise ValueError("an id-space index needs both dictionaries")
            self.row_dict = row_dict.where(F.col("index") == F.lit(name))
            self.col_dict = col_dict.where(F.col("index") == F.lit(name))

    # ---- leaves -----------------------------------------------------------

    def _resolve(self, leaves) -> dict:
        """Row key of every ``(field, value)`` of ``leaves``: the value itself,
        or its row id; values that were never seen have none.  One read of the
        row dictionary for all that are not known yet."""
        pairs = {(lf[0], lf[1]) for lf in leaves}
        if not self.id_space:
            return {p: p[1] for p in pairs}
        new = pairs - self._ids.keys()
        if new:
            fields, values = sorted({f for f, _ in new}), sorted({v for _, v in new})
            hits = (self.row_dict.where(F.col("field").isin(*fields) & F.col("row_val").isin(*values))
                    .select("field", "row_val", "row_id").collect())
            got = {(r["field"], r["row_val"]): int(r["row_id"]) for r in hits}
            self._ids |= {p: got.get(p) for p in new}
        return {p: self._ids[p] for p in pairs if self._ids[p] is not None}

    def _empty(self) -> DataFrame:
        return self.facts.where(F.lit(False)).select(self.ccol)

    def _leaf_bits(self, field: str, keys: list, start=None, end=None) -> DataFrame:
        f = self.facts.where((F.col("field") == F.lit(field)) & F.col(self.rcol).isin(*keys))
        if start is not None:
            f = f.where((F.col("day") >= F.lit(start)) & (F.col("day") < F.lit(end)))
        return f

    def _leaf_columns(self, leaf: tuple) -> DataFrame:
        field, value, start, end = leaf
        keys = list(self._resolve([leaf]).values())
        if not keys:
            return self._empty()  # unseen: empty answer, nothing is created
        return self._leaf_bits(field, keys, start, end).select(self.ccol).distinct()

    def _leaf(self, field: str, value: str, start=None, end=None) -> Bitmap:
        self.spec.check_field(field)
        if not isinstance(value, str):
            raise TypeError(f"row value must be a string, got {type(value).__name__}")
        return Bitmap(self, leaf=(field, value, start, end))

    def _resolve_all(self, bms) -> None:
        leaves = [lf for b in bms for lf in b.leaves() or ()]
        if leaves:
            self._resolve(leaves)

    def row(self, field: str, value: str) -> Bitmap:
        """G1: columns with ``field = value`` on any day (or no day)."""
        return self._leaf(field, value)

    def range(self, field: str, value: str, start, end) -> Bitmap:
        """As ``row`` with ``start <= day < end`` (bounds floored to the
        day); bits without a day never match."""
        return self._leaf(field, value, _day(start), _day(end))

    # ---- set algebra ------------------------------------------------------

    def union(self, *bms: Bitmap) -> Bitmap:
        """Columns in any operand (one distinct over the union).  Leaves
        of one field and time window share one scan (``row IN (...)``)."""
        return Bitmap(self, op=("or", bms))

    def intersect(self, *bms: Bitmap) -> Bitmap:
        """Columns in every operand.  Leaves of one field and time window
        are fused into one scan: keep columns seen with all k keys; otherwise
        a left-semi chain."""
        return Bitmap(self, op=("and", bms))

    def difference(self, first: Bitmap, *others: Bitmap) -> Bitmap:
        """First operand minus all others: one anti join against their
        union; leaves of one field and time window are one scan, keeping
        columns seen with the first key and none of the others."""
        return Bitmap(self, op=("minus", (first, *others))) if others else first

    def _combine(self, op: str, bms: tuple[Bitmap, ...]) -> DataFrame:
        if not bms:
            return self._empty()
        self._resolve_all(bms)
        return {"or": self._union, "and": self._intersect, "minus": self._difference}[op](bms)

    def _union(self, bms: tuple[Bitmap, ...]) -> DataFrame:
        groups: dict = {}
        parts = []
        for b in bms:
            if b.leaf is None:
                parts.append(b.df)
            else:
                for key in self._resolve([b.leaf]).values():
                    groups.setdefault((b.leaf[0], b.leaf[2], b.leaf[3]), set()).add(key)
        for (field, start, end), keys in groups.items():
            parts.append(self._leaf_bits(field, sorted(keys), start, end).select(self.ccol))
        return reduce(lambda a, b: a.unionByName(b), parts).distinct() if parts else self._empty()

    def _intersect(self, bms: tuple[Bitmap, ...]) -> DataFrame:
        leaves = [b.leaf for b in bms]
        if len(bms) > 1 and all(lf is not None for lf in leaves) and \
                len({(lf[0], lf[2], lf[3]) for lf in leaves}) == 1:
            field, _, start, end = leaves[0]
            known = self._resolve(leaves)
            if len(known) < len({lf[1] for lf in leaves}):
                return self._empty()
            keys = sorted(known.values())
            pairs = self._leaf_bits(field, keys, start, end).select(self.rcol, self.ccol).distinct()
            return (pairs.groupBy(self.ccol).agg(F.count(F.lit(1)).alias("_k"))
                    .where(F.col("_k") == F.lit(len(keys))).select(self.ccol))
        # Every Bitmap frame is distinct and its column never NULL, so a plain
        # left-semi chain stays distinct: no extra distinct aggregate (and
        # shuffle) per operand as with DataFrame.intersect.
        return reduce(lambda a, b: a.join(b, self.ccol, "left_semi"), [b.df for b in bms])

    def _difference(self, bms: tuple[Bitmap, ...]) -> DataFrame:
        first, others = bms[0], bms[1:]
        leaves = [b.leaf for b in bms]
        if all(lf is not None for lf in leaves) and len({(lf[0], lf[2], lf[3]) for lf in leaves}) == 1:
            field, value, start, end = first.leaf
            known = self._resolve(leaves)
            key = known.get((field, value))
            rest = sorted({known[lf[:2]] for lf in leaves[1:] if lf[:2] in known})
            if key is None or key in rest:
                return self._empty()
            is_first = F.col(self.rcol) == F.lit(key)
            return (self._leaf_bits(field, [key] + rest, start, end)
                    .groupBy(self.ccol)
                    .agg(F.max(is_first.cast("int")).alias("_a"), F.min(is_first.cast("int")).alias("_b"))
                    .where((F.col("_a") == 1) & (F.col("_b") == 1))
                    .select(self.ccol))
        rest = reduce(lambda a, b: a.unionByName(b), [b.df for b in others])
        return first.df.join(rest, self.ccol, "left_anti")

    # ---- many answers from one scan -----------------------------------------

    def shared(self, bms: list[Bitmap]) -> tuple[DataFrame, list[Column]]:
        """One pass over the facts for any number of expressions: ``(masks,
        tests)``.  Every distinct leaf of all of them is a bit; ``masks`` has a row
        for each column in any leaf, with its bits OR-ed into words, and
        ``tests[i]`` says from them whether the column is in ``bms[i]``.

        The leaves are joined to the facts as a broadcast table (its size is that
        of the request), so the work per bit does not grow with the number of
        calls; one aggregate by column, partial in each task, gives the masks.  A
        column outside all leaves is in no answer: differences start from a set."""
        leaves = list(dict.fromkeys(lf for b in bms for lf in b.leaves()))
        known = self._resolve(leaves) if leaves else {}
        live = [lf for lf in leaves if lf[:2] in known]
        bit = {lf: i for i, lf in enumerate(live)}
        words = [f"_w{k}" for k in range(-(-len(live) // WORD_BITS))]

        def test(b: Bitmap) -> Column:
            if b.leaf is not None:
                i = bit.get(b.leaf)
                return F.lit(False) if i is None else \
                    F.col(words[i // WORD_BITS]).bitwiseAND(F.lit(1 << i % WORD_BITS)) != 0
            op, parts = b.op[0], [test(x) for x in b.op[1]]
            if not parts:
                return F.lit(False)
            if op == "or":
                return reduce(lambda x, y: x | y, parts)
            if op == "and":
                return reduce(lambda x, y: x & y, parts)
            return reduce(lambda x, y: x & ~y, parts)

        tests = [test(b) for b in bms]
        if not live:
            return self._empty(), tests
        table = F.array(*[F.struct(
            F.lit(lf[0]).alias("_field"), F.lit(known[lf[:2]]).alias("_key"), F.lit(lf[2]).cast("date").alias("_start"),
            F.lit(lf[3]).cast("date").alias("_end"),
            *[F.lit(1 << i % WORD_BITS if i // WORD_BITS == k else 0).cast("bigint").alias(w) for k, w in enumerate(words)])
            for i, lf in enumerate(live)])
        table = self.facts.sparkSession.range(1).select(F.inline(table))
        f = self.facts.where(F.col("field").isin(*sorted({lf[0] for lf in live}))
                             & F.col(self.rcol).isin(*sorted({known[lf[:2]] for lf in live})))
        if all(lf[2] is not None for lf in live):
            start, end = min(lf[2] for lf in live), max(lf[3] for lf in live)
            f = f.where((F.col("day") >= F.lit(start)) & (F.col("day") < F.lit(end)))
        in_time = F.col("_start").isNull() | ((F.col("day") >= F.col("_start")) & (F.col("day") < F.col("_end")))
        hit = f.join(F.broadcast(table), (F.col("field") == F.col("_field")) & (F.col(self.rcol) == F.col("_key")) & in_time)
        return hit.groupBy(self.ccol).agg(*[F.bit_or(w).alias(w) for w in words]), tests

    # ---- results ----------------------------------------------------------

    def count(self, bm: Bitmap) -> DataFrame:
        """Exact number of distinct columns, one row ``count``."""
        return bm.df.agg(F.count(F.lit(1)).cast("long").alias("count"))

    def columns(self, bm: Bitmap, strict: bool = True) -> DataFrame:
        """Bitmap answer as values: ``col_val``."""
        if not self.id_space:
            return bm.df.select(F.col("col_val"))
        return decode_distinct(bm.df, self.col_dict, strict=strict).select("col_val")

    def topn(self, field: str, n: int | None = None, filter: Bitmap | None = None) -> DataFrame:
        """Rows of ``field`` by number of distinct columns, ``Count``
        descending then ``Key`` ascending, first ``n`` (all when None).
        With ``filter`` only columns of that bitmap count.

        Distinct (row, col) pairs are counted with a partial aggregate per
        row, so one very popular row does not end up in one task.
        """
        self.spec.check_field(field)
        f = self.facts.where(F.col("field") == F.lit(field)).select(self.rcol, self.ccol)
        if filter is not None:
            f = f.join(filter.df, self.ccol, "left_semi")
        counts = f.distinct().groupBy(self.rcol).agg(F.count(F.lit(1)).cast("long").alias("Count"))
        if self.id_space:
            d = self.row_dict.where(F.col("field") == F.lit(field)).select("row_id", "row_val")
            counts = (counts.join(d, "row_id", "left")
                      .select(F.coalesce("row_val", F.lit("")).alias("Key"), "Count"))
        else:
            counts = counts.select(F.col("row_val").alias("Key"), "Count")
        out = counts.orderBy(F.desc("Count"), F.asc("Key"))
        return out.limit(int(n)) if n is not None else out


@dataclass(frozen=True)
class Count:
    """A call of a batch: the number of columns of a bitmap."""
    bitmap: Bitmap


def _batch_shared(index: Index, calls: dict[int, Bitmap | Count]) -> list[DataFrame]:
    """The bitmap and count calls of a batch: one fact scan, one decoding."""
    bms = [c.bitmap if isinstance(c, Count) else c for c in calls.values()]
    masks, tests = index.shared(bms)
    masks = joinable(masks) if index.id_space else masks
    counts = [(i, t) for (i, c), t in zip(calls.items(), tests) if isinstance(c, Count)]
    lists = [(i, t) for (i, c), t in zip(calls.items(), tests) if not isinstance(c, Count)]
    parts = []
    if counts:
        sums = masks.agg(*[F.count_if(t).alias(f"_c{i}") for i, t in counts])
        rows = F.array(*[F.struct(F.lit(i).alias("call_no"), F.col(f"_c{i}").alias("count")) for i, _ in counts])
        parts.append(sums.select(F.inline(rows)).select(
            "call_no", F.lit("count").alias("kind"), F.lit(None).cast("string").alias("key"), "count"))
    if lists:
        mine = F.array_compact(F.array(*[F.when(t, F.lit(i)) for i, t in lists]))
        found = masks.select(index.ccol, mine.alias("_calls")).where(F.size("_calls") > 0)
        if index.id_space:
            found = decode_distinct(found, index.col_dict)
        parts.append(found.select(F.explode("_calls").alias("call_no"), F.lit("bitmap").alias("kind"),
                                  F.col("col_val").alias("key"), F.lit(None).cast("long").alias("count")))
    return parts


def batch_calls(index: Index, results: list) -> DataFrame:
    """Several answers in one long frame ``(call_no, kind, key, count)``:
    bitmap -> one row per column; :class:`Count` or a count frame -> one row;
    topn -> one row per (Key, Count).  Bitmaps and counts, however many and however
    nested, are evaluated together: one scan of the facts and one of the column
    dictionary (:meth:`Index.shared`)."""
    together = {i: r for i, r in enumerate(results)
                if isinstance(r, (Bitmap, Count)) and (r.bitmap if isinstance(r, Count) else r).leaves() is not None}
    parts = _batch_shared(index, together) if together else []
    for i, r in enumerate(results):
        if i in together:
            continue
        if isinstance(r, Count):
            r = index.count(r.bitmap)
        if isinstance(r, Bitmap):
            r = index.columns(r)
        cols = r.columns
        if cols == ["col_val"]:
            p = r.select(F.lit("bitmap").alias("kind"), F.col("col_val").alias("key"),
                         F.lit(None).cast("long").alias("count"))
        elif cols == ["count"]:
            p = r.select(F.lit("count").alias("kind"), F.lit(None).cast("string").alias("key"),
                         F.col("count").cast("long"))
        elif cols == ["Key", "Count"]:
            p = r.select(F.lit("topn").alias("kind"), F.col("Key").alias("key"),
                         F.col("Count").cast("long").alias("count"))
        else:
            raise ValueError(f"not a call result: {cols}")
        parts.append(p.select(F.lit(i).alias("call_no"), "kind", "key", "count"))
    if not parts:
        raise ValueError("a batch has one call or more")
    return reduce(lambda a, b: a.unionByName(b), parts)
