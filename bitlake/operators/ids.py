"""Dictionary encoding: surrogate ids for values.

Row dictionary ``(index, field, row_id, row_val)``: ids are dense per
``(index, field)`` and continue after the current maximum.
Column dictionary ``(index, col_id, shard, col_val)``: ids are spread
round-robin over ``lanes`` open shards of ``shard_width`` ids each, so that a
fresh load never piles onto one shard; a full shard is replaced by a never
used one.  In both, new values of one batch get ids in byte order of the
value, so ids are deterministic and a retried batch gets the same ids.

The rank over all new values is the scalable part: a global ``row_number``
would put every new value into one task.  Instead values are range-partitioned
by Spark, ranked inside each range, and shifted by the sizes of the ranges
before them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, written
from ..spec import IdConfig

ROW_DICT_COLS = ["index", "field", "row_id", "row_val"]
COL_DICT_COLS = ["index", "col_id", "shard", "col_val"]


def dense_rank_at_scale(df: DataFrame, order_col: str, group_cols=(), rows_per_bucket: int = 50_000,
                        rank_col: str = "rank") -> DataFrame:
    """0-based rank of ``order_col`` within ``group_cols`` (byte order).

    ``df`` must be distinct on ``group_cols + [order_col]`` and should be a
    materialised table.  Spark range-partitions the values into
    ``ceil(n / rows_per_bucket)`` buckets (any number of them); the bucket of
    every value is then checkpointed, so a retried task meets the same buckets.
    Values are ranked inside their bucket, and a bucket is shifted by the sizes
    of those before it (one row per bucket and group).
    """
    group_cols = list(group_cols)
    key = group_cols + [order_col]
    buckets = max(1, math.ceil(df.count() / max(1, rows_per_bucket)))
    if buckets == 1:  # one bucket's worth: nothing to shift
        w = Window.partitionBy(*group_cols).orderBy(order_col)
        return df.withColumn(rank_col, (F.row_number().over(w) - 1).cast("long"))
    checkpoint_dir(df.sparkSession)
    b = (df.repartitionByRange(buckets, *key)
         .withColumn("_bucket", F.spark_partition_id()).checkpoint())
    inside = Window.partitionBy("_bucket", *group_cols).orderBy(order_col)
    ranked = b.withColumn("_rn", F.row_number().over(inside) - 1)
    counts = b.groupBy("_bucket", *group_cols).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group_cols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", *group_cols,
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (ranked.join(offsets, ["_bucket", *group_cols])
            .withColumn(rank_col, (F.col("_off") + F.col("_rn")).cast("long"))
            .drop("_bucket", "_rn", "_off"))


# ---- row dictionary (D1, D2, D7) ------------------------------------------

def _of_index(d: DataFrame, index: str) -> DataFrame:
    return d.where(F.col("index") == F.lit(index))


def next_row_id(row_dict: DataFrame, index: str | None = None) -> DataFrame:
    """Next free row id per (index, field): ``max(row_id) + 1``."""
    d = _of_index(row_dict, index) if index is not None else row_dict
    return d.groupBy("index", "field").agg((F.max("row_id") + 1).alias("next_id"))


def new_row_values(values: DataFrame, row_dict: DataFrame, index: str) -> DataFrame:
    """Distinct (field, row_val) of ``values`` that have no id yet."""
    known = _of_index(row_dict, index).select("field", "row_val")
    return values.select("field", "row_val").distinct().join(known, ["field", "row_val"], "left_anti")


def assign_row_ids(values: DataFrame, row_dict: DataFrame, index: str,
                   cfg: IdConfig = IdConfig(), new_values: DataFrame | None = None) -> DataFrame:
    """D1 get-or-create: the *new* dictionary entries for ``values``.

    Existing values keep their ids; new ones get ``next_id + rank`` per field.
    Pass ``new_values`` when the caller already materialised them.
    """
    new = new_values if new_values is not None else written(new_row_values(values, row_dict, index), "new-rows")
    ranked = dense_rank_at_scale(new, "row_val", ["field"], cfg.rows_per_rank_bucket)
    nxt = next_row_id(row_dict, index).select("field", "next_id")
    return (ranked.join(nxt, "field", "left")
            .select(F.lit(index).alias("index"), "field",
                    (F.coalesce("next_id", F.lit(0)) + F.col("rank")).cast("long").alias("row_id"),
                    "row_val"))


def dict_integrity(d: DataFrame, kind: str = "row") -> DataFrame:
    """Violations of both unique keys; every count must be 0."""
    if kind == "row":
        keys = {"unique_id": ["index", "field", "row_id"], "unique_value": ["index", "field", "row_val"]}
    else:
        keys = {"unique_id": ["index", "col_id"], "unique_value": ["index", "col_val"]}
    out = None
    for name, k in keys.items():
        v = (d.groupBy(*k).count().where(F.col("count") > 1)
             .agg(F.count(F.lit(1)).alias("violations"))
             .select(F.lit(name).alias("constraint"), "violations"))
        out = v if out is None else out.unionByName(v)
    return out


def check_row_entries(entries: DataFrame, row_dict: DataFrame, index: str) -> None:
    """D7 before a commit: raise unless the new row entries keep both unique
    keys.  New ids start at the next free id, so they cannot meet old ones."""
    low = (entries.join(next_row_id(row_dict, index).select("field", "next_id"), "field")
           .where(F.col("row_id") < F.col("next_id")).agg(F.count(F.lit(1)).alias("n")))
    _raise_if_any(dict_integrity(entries, "row").agg(F.sum("violations").alias("n")).unionByName(low), "row")


def check_col_entries(entries: DataFrame, state: DataFrame) -> None:
    """D7 before a commit, for column entries and the shard state they started from."""
    low = (entries.join(state.select("shard", "last_id"), "shard")
           .where(F.col("col_id") <= F.col("last_id")).agg(F.count(F.lit(1)).alias("n")))
    _raise_if_any(dict_integrity(entries, "col").agg(F.sum("violations").alias("n")).unionByName(low), "column")


def _raise_if_any(counts: DataFrame, what: str) -> None:
    n = counts.agg(F.sum("n")).first()[0] or 0
    if n:
        raise RuntimeError(f"{n} {what} dictionary entries would break a unique key; nothing was committed")


# ---- column dictionary (D3-D6, D8) ----------------------------------------

def shard_state(col_dict: DataFrame, shard_width: int, index: str | None = None) -> DataFrame:
    """Per shard the last id, ids used, next free offset, full or not.

    Derived from the dictionary itself (``max(col_id)``), so it can never go
    backwards.
    """
    d = _of_index(col_dict, index) if index is not None else col_dict
    w = int(shard_width)
    return (d.groupBy("index", "shard")
            .agg(F.max("col_id").alias("last_id"), F.count(F.lit(1)).alias("ids_used"))
            .withColumn("next_offset", F.pmod(F.col("last_id") + 1, F.lit(w)))
            .withColumn("full", F.col("next_offset") == 0))


def _owned(cfg: IdConfig) -> Column:
    return F.pmod(F.col("shard"), F.lit(cfg.n_owners)) == F.lit(cfg.owner)


def open_shards(state: DataFrame, cfg: IdConfig) -> DataFrame:
    """Unfinished shards of this owner, lowest first, at most ``lanes``;
    lane ``i`` resumes the i-th of them."""
    top = state.where(~F.col("full") & _owned(cfg)).orderBy("shard").limit(cfg.lanes)
    return top.withColumn("lane", (F.row_number().over(Window.orderBy("shard")) - 1).cast("int"))


def shard_base(state: DataFrame, cfg: IdConfig) -> DataFrame:
    """One row: first never-used shard slot of this owner."""
    return (state.where(_owned(cfg))
            .agg(F.coalesce(F.max(F.expr(f"shard div {cfg.n_owners}")) + 1, F.lit(0)).cast("long").alias("base")))


def unused_shards(state: DataFrame, cfg: IdConfig, per_lane: int = 1) -> DataFrame:
    """The next never-used shards this owner would open, per lane and
    overflow step ``j``: ``shard = (base + j*lanes + lane) * n_owners + owner``.
    Owners draw from disjoint residues, so separate jobs never share ids."""
    steps = F.sequence(F.lit(0), F.lit(cfg.lanes * per_lane - 1))
    return (shard_base(state, cfg)
            .select("base", F.explode(steps).alias("slot"))
            .select(F.pmod("slot", F.lit(cfg.lanes)).cast("int").alias("lane"),
                    F.expr(f"slot div {cfg.lanes}").cast("int").alias("step"),
                    ((F.col("base") + F.col("slot")) * cfg.n_owners + cfg.owner).cast("long").alias("shard")))


def shard_status(col_dict: DataFrame, cfg: IdConfig, index: str | None = None) -> DataFrame:
    """Shard state with fill ratio and whether the shard is open for this owner."""
    st = shard_state(col_dict, cfg.shard_width, index)
    return (st.withColumn("fill_ratio", F.col("ids_used") / F.lit(float(cfg.shard_width)))
            .withColumn("owned", _owned(cfg)))


def new_col_values(values: DataFrame, col_dict: DataFrame, index: str) -> DataFrame:
    known = _of_index(col_dict, index).select("col_val")
    return values.select("col_val").distinct().join(known, "col_val", "left_anti")


def _idiv(c: Column, n: int) -> Column:
    """Integer ``c div n``, exact for any bigint."""
    return F.call_function("div", c, F.lit(int(n))).cast("long")


def column_id_expr(rank: Column, lanes_open: list[tuple[int, int]], base: int, cfg: IdConfig):
    """Pure arithmetic from the rank of a new value to (shard, col_id).

    ``lane = r % L``, ``q = r div L``, ``p = q + next_offset(lane)``,
    ``k = p div W``; an open lane keeps its shard while ``k == 0``; otherwise
    the value goes to overflow slot ``j = k - open`` whose shard is
    ``(base + j*L + lane) * N + owner``; the id is ``shard*W + p % W``.
    """
    L, W, N, o = cfg.lanes, cfg.shard_width, cfg.n_owners, cfg.owner
    lane = F.pmod(rank, F.lit(L))
    q = _idiv(rank, L)
    # Lane i is the i-th open shard: one array literal each, whatever the number.
    def of_lane(values):
        return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]).cast("array<bigint>"), lane.cast("int"))

    open_shard = of_lane([s for s, _ in lanes_open])
    next_off = F.coalesce(of_lane([n for _, n in lanes_open]), F.lit(0).cast("long"))
    p = q + next_off
    k = _idiv(p, W)
    is_open = open_shard.isNotNull()
    j = k - F.when(is_open, F.lit(1)).otherwise(F.lit(0))
    fresh = (F.lit(int(base)) + j * F.lit(L) + lane) * F.lit(N) + F.lit(o)
    shard = F.when(is_open & (k == 0), open_shard).otherwise(fresh).cast("long")
    col_id = (shard * F.lit(W) + F.pmod(p, F.lit(W))).cast("long")
    return shard, col_id


def assign_column_ids(values: DataFrame, col_dict: DataFrame, index: str,
                      cfg: IdConfig = IdConfig(), new_values: DataFrame | None = None,
                      state: DataFrame | None = None) -> DataFrame:
    """D3 get-or-create: the *new* column-dictionary entries for ``values``.

    The open-lane table (at most ``lanes`` rows) and the base slot (one
    number) are read to the driver and become literals; everything else is
    per-row arithmetic on the rank.  ``state`` (D4 rows) may come from a
    smaller source than the dictionary, e.g. the store's shard log.
    """
    if state is None:
        state = shard_state(_of_index(col_dict, index), cfg.shard_width)
    # one bounded read: at most `lanes` open shards plus the base slot
    opened = open_shards(state, cfg).select(F.lit(0).alias("_k"), "lane", "shard", "next_offset")
    base_row = shard_base(state, cfg).select(F.lit(1).alias("_k"), F.lit(None).cast("int").alias("lane"),
                                             F.col("base").alias("shard"),
                                             F.lit(None).cast("long").alias("next_offset"))
    got = opened.unionByName(base_row).collect()
    lanes_open = [(r["shard"], r["next_offset"]) for r in sorted((r for r in got if r["_k"] == 0),
                                                                 key=lambda r: r["lane"])]
    base = [r["shard"] for r in got if r["_k"] == 1][0]
    new = new_values if new_values is not None else written(new_col_values(values, col_dict, index), "new-cols")
    ranked = dense_rank_at_scale(new, "col_val", (), cfg.rows_per_rank_bucket)
    shard, col_id = column_id_expr(F.col("rank"), lanes_open, base, cfg)
    return ranked.select(F.lit(index).alias("index"), col_id.alias("col_id"),
                         shard.alias("shard"), "col_val")
