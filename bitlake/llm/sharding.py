"""Sharding by a permutation-filled lookup table (native placement).

Every shard has its own permutation of the slots of a table of prime size:
``(offset + j * skip) mod size``.  Shards take turns, each claiming the next
slot of its permutation that is still free, until the table is full.  Slots are
thus spread evenly (counts differ by one at most) and adding or removing a
shard moves few keys.  The table depends on parameters alone and has a fixed
size, so it is broadcast; placing a row is one hash and one lookup.

Defined cases: a null key is placed like the empty text; equal keys always
land in the same shard; repeated rows stay repeated rows; texts are not read, so
their length does not matter; extra columns, whatever their names, are kept; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitlake.llm.common import free_names, hash52, quoted

#: Prime number of slots; bounds the broadcast table.
SLOTS = 8191
#: Shards of the query.
SHARDS = 32


def _number(*parts: object) -> int:
    return int.from_bytes(hashlib.sha256(":".join(map(str, parts)).encode()).digest()[:8], "big")


@lru_cache(maxsize=8)
def lookup_table(shards: int, slots: int = SLOTS, seed: int = 7) -> tuple[int, ...]:
    """Shard of every slot.  O(slots * log slots) steps, whatever the data."""
    if not 1 <= shards <= slots or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be a prime no smaller than the number of shards")
    at = [_number(seed, "offset", s) % slots for s in range(shards)]
    skip = [_number(seed, "skip", s) % (slots - 1) + 1 for s in range(shards)]
    table, claimed = [-1] * slots, 0
    while True:
        for s in range(shards):
            while table[at[s]] >= 0:
                at[s] = (at[s] + skip[s]) % slots
            table[at[s]] = s
            claimed += 1
            if claimed == slots:
                return tuple(table)


def table_frame(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    csv = ",".join(map(str, lookup_table(shards, slots)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(csv), ",")).alias("slot", "shard")).select(
        F.col("slot").cast("bigint").alias("slot"), F.col("shard").cast("int").alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(hash52(F.coalesce(key.cast("string"), F.lit(""))), F.lit(slots))


def shard(df: DataFrame, key: str = "doc_id", shards: int = SHARDS, slots: int = SLOTS,
          slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with its slot and shard; an input column of either name is replaced."""
    rest = [F.col(quoted(c)) for c in df.columns if c not in (slot_col, shard_col)]
    at, to = free_names(df.columns, "at", "to")
    table = table_frame(df.sparkSession, shards, slots).select(F.col("slot").alias(at), F.col("shard").alias(to))
    placed = df.select(*rest, slot_of(F.col(quoted(key)), slots).alias(at))
    return placed.join(F.broadcast(table), at).select(
        *rest, F.col(at).alias(slot_col), F.col(to).alias(shard_col))


def write_shards(df: DataFrame, path: str, key: str = "doc_id", shards: int = SHARDS, slots: int = SLOTS,
                 rows_per_file: int = 1_000_000) -> DataFrame:
    """Place whole rows: write them below ``path/shard=<n>`` and read them back.

    Rows are range partitioned by shard and, within it, by a hash of the row, in about
    ``rows / rows_per_file`` parts, so a shard with a hot key is several files of
    several tasks and a small one shares its task with others.  Raises ``ValueError`` for an
    input column named ``shard``: the folder's name would hide it."""
    if "shard" in df.columns:
        raise ValueError("rename the input column 'shard'")
    placed = shard(df, key, shards, slots)
    parts = max(1, -(-placed.count() // rows_per_file))
    spread = F.xxhash64(F.concat_ws(chr(0), *[F.col(quoted(c)).cast("string") for c in df.columns]))
    (placed.repartitionByRange(parts, F.col("shard"), spread, F.rand(SHARDS)).write
     .option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path))
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def oracle(shards: int = SHARDS, slots: int = SLOTS) -> str:
    csv = ",".join(map(str, lookup_table(shards, slots)))
    return f"""
WITH t AS (SELECT unnest(range({slots})) AS slot, unnest(string_split('{csv}', ','))::INTEGER AS shard),
d AS (SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT % {slots} AS slot FROM documents)
SELECT doc_id, text, lang, source, n_chars, slot, shard FROM d JOIN t USING (slot)
"""
