"""Scalar expressions for log parsing.

All built-in Spark expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import LogSpec


def _literal_regex(sep: str) -> str:
    # F.split takes a Java regex; quote the separator so it is matched as text.
    return "\\Q" + sep + "\\E"


def split_exact(col, sep: str) -> Column:
    """Split keeping empty and trailing empty elements (limit -1)."""
    return F.split(col, _literal_regex(sep), -1)


def parse_ts(col, fmt: str = LogSpec.ts_format) -> Column:
    """B2: fixed-format UTC time -> timestamp_ntz; NULL (row kept) when the
    text does not parse.  ``try_to_timestamp`` never throws under ANSI."""
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def day_of(ts) -> Column:
    """Day bucket of a time (no zone conversion on timestamp_ntz)."""
    return F.to_date(ts)


def month_of(day) -> Column:
    """Month view key, ``yyyyMM``."""
    return F.date_format(day, "yyyyMM")


def shard_of(col_id, width: int) -> Column:
    """Shard of a column id, ``col_id div width`` (exact integer)."""
    w = int(width)
    c = F.col(col_id) if isinstance(col_id, str) else col_id
    if w & (w - 1) == 0:                       # power of two, e.g. the default 2^20
        return F.shiftright(c, w.bit_length() - 1)
    return F.call_function("div", c, F.lit(w)).cast("long")


def offset_in_shard(col_id, width: int) -> Column:
    """Position of a column id inside its shard."""
    return F.pmod(F.col(col_id) if isinstance(col_id, str) else col_id, F.lit(int(width)))


def parse_lines(lines: DataFrame, spec: LogSpec = LogSpec()) -> DataFrame:
    """B1: split every line and take the configured positions.

    Keeps the line's provenance columns; ``n_pos`` tells how many positions
    the line had (lines with fewer than ``spec.min_positions`` are rejects).
    Out-of-range positions are NULL (``get``), later positions are ignored.
    """
    arr = split_exact(F.col("value"), spec.sep)
    cols = [c for c in ("value", "dt", "part", "file_path", "file_size") if c in lines.columns]
    df = lines.select(*cols, arr.alias("_pos"))
    ts_raw = F.get(F.col("_pos"), spec.ts_pos)
    ts = parse_ts(ts_raw, spec.ts_format)
    out = [*cols,
           F.size("_pos").alias("n_pos"),
           ts_raw.alias("ts_raw"),
           ts.alias("ts"),
           day_of(ts).alias("day"),
           F.get(F.col("_pos"), spec.id_pos).alias("idfield")]
    out += [F.get(F.col("_pos"), p).alias(n) for n, p in spec.scalar_fields]
    out += [F.get(F.col("_pos"), p).alias(f"{n}_list") for n, p in spec.list_fields]
    return df.select(*out)


def accepted(parsed: DataFrame, spec: LogSpec = LogSpec()) -> DataFrame:
    return parsed.where(F.col("n_pos") >= F.lit(spec.min_positions))


def reject_lines(parsed: DataFrame, spec: LogSpec = LogSpec()) -> DataFrame:
    """Lines with too few positions; they produce no bits and no ids."""
    cols = [c for c in ("value", "dt", "part", "file_path") if c in parsed.columns]
    return (parsed.where(F.col("n_pos") < F.lit(spec.min_positions))
            .select(*cols[:1],
                    F.concat(F.lit("positions="), F.col("n_pos").cast("string"),
                             F.lit(f" < {spec.min_positions}")).alias("reason"),
                    *cols[1:]))
