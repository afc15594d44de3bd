"""Value <-> id joins.

All are plain equi joins; Spark picks broadcast or sort-merge from real
sizes (AQE), nothing is forced: the row dictionary is usually small, the
column dictionary can be as large as the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Column ids are stored in groups of 2^26 consecutive ids (a partition
# column of the stored dictionary), so decoding a small answer reads only
# the groups it touches (dynamic partition pruning).
ID_GROUP_BITS = 26


def id_group(col_id) -> "F.Column":
    c = F.col(col_id) if isinstance(col_id, str) else col_id
    return F.shiftright(c, ID_GROUP_BITS)


def _of_index(d: DataFrame, index: str | None) -> DataFrame:
    return d.where(F.col("index") == F.lit(index)) if index is not None else d


def encode_rows(bits: DataFrame, row_dict: DataFrame, index: str | None = None) -> DataFrame:
    """(field, row_val) -> row_id, inner join after the ids exist."""
    d = _of_index(row_dict, index).select("field", "row_val", "row_id")
    return bits.join(d, ["field", "row_val"]).drop("row_val")


def encode_columns(bits: DataFrame, col_dict: DataFrame, index: str | None = None) -> DataFrame:
    """col_val -> (col_id, shard)."""
    d = _of_index(col_dict, index).select("col_val", "col_id", "shard")
    return bits.join(d, "col_val").drop("col_val")


def decode_rows(df: DataFrame, row_dict: DataFrame, index: str | None = None) -> DataFrame:
    """C4: row_id -> row_val; an unknown id decodes to "" (no error)."""
    d = _of_index(row_dict, index).select("field", "row_id", "row_val")
    return (df.join(d, ["field", "row_id"], "left")
            .withColumn("row_val", F.coalesce("row_val", F.lit(""))))


def decode_columns(df: DataFrame, col_dict: DataFrame, index: str | None = None,
                   strict: bool = True) -> DataFrame:
    """col_id -> col_val.  ``strict``: an unknown id fails the job;
    otherwise the id itself is returned as text.

    Hits are an inner join, so that a small answer prunes the dictionary's id
    groups while the query runs (an outer join never does); ids without a hit
    are found against the hits, not against the dictionary."""
    d = _of_index(col_dict, index)
    key = ["id_group", "col_id"] if "id_group" in col_dict.columns else ["col_id"]
    d = d.select(*key, "col_val")
    asked = df.withColumn("id_group", id_group("col_id")) if len(key) > 1 else df
    hits = asked.join(d, key)
    missing = asked.join(hits.select("col_id"), "col_id", "left_anti")
    text = F.col("col_id").cast("string")
    if strict:
        text = F.raise_error(F.concat(F.lit("unknown column id "), text)).cast("string")
    out = [*df.columns, "col_val"]
    return hits.select(*out).unionByName(missing.withColumn("col_val", text).select(*out))


def joinable(ids: DataFrame) -> DataFrame:
    """The dictionary join asks for ids (and groups) that are not null, which all
    are.  Asked for beforehand, every use of an answer has the same plan up to the
    answer's exchange, so that Spark reuses it."""
    return ids.where(F.col("col_id").isNotNull() & id_group("col_id").isNotNull())


def decode_distinct(ids: DataFrame, col_dict: DataFrame, strict: bool = True) -> DataFrame:
    """C5 for an answer: ``ids`` has each ``col_id`` once, and any payload.

    As :func:`decode_columns`, with one use of the dictionary: the ids and their
    hits meet in one aggregate by id, where an id without a hit is seen.  Both
    read the same exchange of the answer, so its scans run once."""
    key = ["id_group", "col_id"] if "id_group" in col_dict.columns else ["col_id"]
    ids = joinable(ids)
    asked = ids.withColumn("id_group", id_group("col_id")) if len(key) > 1 else ids
    hits = asked.select(*key).join(col_dict.select(*key, "col_val"), key).select("col_id", "col_val")
    both = ids.withColumn("col_val", F.lit(None).cast("string")).unionByName(hits, allowMissingColumns=True)
    text = F.col("col_id").cast("string")
    if strict:
        text = F.raise_error(F.concat(F.lit("unknown column id "), text)).cast("string")
    payload = [c for c in ids.columns if c != "col_id"]
    out = both.groupBy("col_id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in [*payload, "col_val"]])
    return out.withColumn("col_val", F.coalesce("col_val", text)).select(*ids.columns, "col_val")
