"""Lines -> bits (B4-B6) and idempotent set.

A bit is ``(field, row_val, col_val, day)``: entity ``col_val`` had value
``row_val`` for attribute ``field`` on ``day`` (NULL when the time did not
parse).  One pass over the parsed lines: every line explodes into its scalar
bits plus one bit per list element.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import accepted, month_of, split_exact
from ..spec import LogSpec

BIT_COLS = ["field", "row_val", "col_val", "day"]


def list_elements(list_col, sep: str = ","):
    """B4 + B5: elements of a list field; an empty list gives none, empty
    elements between separators (``a,,b``) are kept as ``""``."""
    c = F.col(list_col) if isinstance(list_col, str) else list_col
    return F.when(c != F.lit(""), split_exact(c, sep)).otherwise(F.array().cast("array<string>"))


def unpivot_bits(parsed: DataFrame, spec: LogSpec = LogSpec(), keep=()) -> DataFrame:
    """Each accepted line -> its scalar bits and one bit per list element.

    ``keep`` names extra provenance columns to carry (e.g. ``file_path``).
    """
    def bit(name, val):
        return F.struct(F.lit(name).alias("field"), val.alias("row_val"))

    def element_bit(name):
        return lambda x: bit(name, x)  # one-argument lambda: transform passes the element only

    parts = [F.array(*[bit(n, F.col(n)) for n, _ in spec.scalar_fields])]
    for n, _ in spec.list_fields:
        parts.append(F.transform(list_elements(f"{n}_list", spec.list_sep), element_bit(n)))
    all_bits = F.concat(*parts) if len(parts) > 1 else parts[0]
    return (accepted(parsed, spec)
            .select(*keep, F.col("idfield").alias("col_val"), "day",
                    F.explode(all_bits).alias("_b"))
            .select("_b.field", "_b.row_val", "col_val", "day", *keep))


def load_rows(parsed: DataFrame, spec: LogSpec = LogSpec()) -> DataFrame:
    """What a load needs of the lines, from one pass over the files: the bits
    (E1: once each), the rejected lines and per file the number of lines by kind.

    ``(field, row_val, col_val, day, part, n_pos, n)``; the field of a rejected
    line is ``#reject`` (file, line, day of the folder) and of a line count
    ``#line`` (file, kind, day of the folder), names no attribute can have."""
    def col(name, kind):
        return F.col(name) if name in parsed.columns else F.lit(None).cast(kind)

    def row(field, row_val, col_val, day, part=None, n_pos=None):
        return F.struct(field.alias("field"), row_val.alias("row_val"), col_val.alias("col_val"), day.alias("day"),
                        (F.lit(None) if part is None else part).cast("int").alias("part"),
                        (F.lit(None) if n_pos is None else n_pos).cast("int").alias("n_pos"))

    file, dt, part = col("file_path", "string"), col("dt", "date"), col("part", "int")
    short = F.col("n_pos") < F.lit(spec.min_positions)
    kind = F.when(short, "reject").when(F.col("ts").isNull(), "bad_time").otherwise("ok")
    parts = [F.array(*[row(F.lit(n), F.col(n), F.col("idfield"), F.col("day")) for n, _ in spec.scalar_fields])]
    for n, _ in spec.list_fields:
        parts.append(F.transform(list_elements(f"{n}_list", spec.list_sep), _element_row(n, row)))
    bits = F.concat(*parts)
    rejects = F.array(row(F.lit("#reject"), file, F.col("value"), dt, part, F.col("n_pos")))
    lines = F.array(row(F.lit("#line"), file, kind, dt, part))
    out = parsed.select(F.explode(F.concat(lines, F.when(short, rejects).otherwise(bits))).alias("_r")).select("_r.*")
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n"))


def _element_row(field, row):
    return lambda x: row(F.lit(field), x, F.col("idfield"), F.col("day"))


def set_bits(bits: DataFrame) -> DataFrame:
    """Repeated bits collapse (NULL days compare equal here).

    Planned as partial + final hash aggregate: duplicates are removed on the
    map side before the shuffle.
    """
    return bits.select(*BIT_COLS).distinct()


def time_views(bits: DataFrame) -> DataFrame:
    """Day and month view keys of every bit."""
    return bits.withColumn("month", month_of(F.col("day")))


def bits_from_lines(lines: DataFrame, spec: LogSpec = LogSpec()) -> DataFrame:
    """parse -> unpivot -> set, the whole value-space path."""
    from ..functions.parse import parse_lines
    return set_bits(unpivot_bits(parse_lines(lines, spec), spec))
