"""Embedding whitening by polarisation covariance.

A row's vector becomes whole numbers, ``x = floor(256 * c)``; the *fit list* is
each distinct ``x`` once (``n`` vectors, sums ``S`` per dimension).  With
``y = n * x - S``, which is exact and centred, tasks add up two kinds of squares:

* ``Q[i]    = sum of y[i] ** 2`` for every dimension,
* ``Q[i, j] = sum of (y[i] + y[j]) ** 2`` for every pair of dimensions.

``(Q[i, j] - Q[i] - Q[j]) / 2`` is then ``n ** 3`` times the covariance of ``i``
and ``j``: differences of variances give all of them, and no product of two
dimensions is ever formed.  All of it is in whole numbers of any size: a task
splits ``y`` into limbs of :data:`LIMB` bits, so that sums of products fit 64
bits, and hands on base 2^40 digits, which Spark adds up by pair.  The driver
takes ``d * (d + 1) / 2`` rows (a number of the dimensions, not of the input) for
``eigh``.  The largest eigenvalues come first.

Vectors are spread by the shuffle that finds the distinct ones, after a partial
aggregate in each task, so one very common vector is no hot group.

Defined cases: rows whose vector is null or holds null or non-finite entries are
dropped; so are rows of another length than the commonest among the distinct
vectors (ties: the longer one); a null id is an id like any other; repeated rows
are rows of the result, once in the fit list; ``deviation`` is null where a bigint
cannot hold it; a component without variance (fewer distinct vectors than
dimensions, constant ones) has ``explained`` 0 and a null ``whitened``;
``explained`` is null without any variance; an empty table, or one without a
usable row, gives no rows.  A vector is held whole, so a very long one costs its own length
in a task, and ``d ** 2`` sums.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from bitlake.llm.common import stage

SCALE = 256
COMPONENTS = 4
LIMB = 24
#: A task adds up so many vectors before it carries into Python integers.
ROWS = 8192
DIGIT, DIGITS = 40, 6
_SUMS = "i int, j int, " + ", ".join(f"q{k} bigint" for k in range(DIGITS))


@dataclass
class Model:
    n: int
    sums: list[int]
    vectors: np.ndarray  #: unit eigenvectors, one a column
    values: np.ndarray  #: their eigenvalues, falling
    trace: float
    top: int  #: the largest absolute entry of a vector


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, x array<bigint>)`` of the rows whose vector is whole and finite."""
    c = F.col(vector_col)
    finite = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    x = F.transform(c, lambda e: F.floor(e.cast("double") * SCALE).cast("bigint"))
    return df.filter(c.isNotNull() & finite).select(F.col(id_col).alias("id"), x.alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


def _digits(v: int) -> list[int]:
    """``v`` in base 2^40, all digits with the sign of ``v``."""
    sign, v = (-1, -v) if v < 0 else (1, v)
    return [sign * (v >> DIGIT * k & (1 << DIGIT) - 1) for k in range(DIGITS)]


def _sums_frame(i: list[int], j: list[int], totals: list[int]) -> pa.RecordBatch:
    digits = np.array([_digits(t) for t in totals], np.int64).reshape(len(totals), DIGITS)
    return pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(digits[:, k]) for k in range(DIGITS))],
        ["i", "j", *(f"q{k}" for k in range(DIGITS))])


def _add_up(rows: DataFrame) -> dict[tuple[int, int], int]:
    """Totals by ``(i, j)`` of what the tasks handed on."""
    out = rows.groupBy("i", "j").agg(*[F.sum(f"q{k}").alias(f"q{k}") for k in range(DIGITS)]).collect()
    return {(r.i, r.j): sum(int(r[f"q{k}"]) << DIGIT * k for k in range(DIGITS)) for r in out}


def _first_sums(d: int):
    """Sums by dimension, and under ``(-1, -1)`` the number of vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, n = [0] * d, 0
        for b in batches:
            x = _matrix(b.column(0), d)
            n += len(x)
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            totals = [t + (int(h) << 32) + int(lo) for t, h, lo in zip(totals, high, low)]
        yield _sums_frame([-1, *range(d)], [-1] * (d + 1), [n, *totals])
    return run


def centred(x: np.ndarray, n: int, sums: list[int], top: int) -> np.ndarray:
    """``n * x - S``, in 64 bits if they hold it."""
    if 2 * n * max(top, 1) < 1 << 61:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def square_sums(v: np.ndarray, bound: int) -> list[int]:
    """Exact sum of squares of every column of ``v``, entries below ``bound``."""
    if v.dtype == object:
        return [int(t) for t in (v * v).sum(axis=0)]
    limbs, rest = [], v
    for _ in range((bound.bit_length() - 1) // LIMB):
        limbs.append(rest & (1 << LIMB) - 1)
        rest = rest >> LIMB
    limbs.append(rest)
    totals = [0] * v.shape[1]
    for a, x in enumerate(limbs):
        for b in range(a + 1):
            part = np.einsum("ij,ij->j", x, limbs[b])
            shift = LIMB * (a + b) + (a != b)
            totals = [t + (int(p) << shift) for t, p in zip(totals, part)]
    return totals


def _squares(d: int, n: int, sums: list[int], top: int):
    """``Q`` of every dimension and of every pair of them over a task's vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = [[0] * (d - i) for i in range(d)]
        bound = 4 * n * max(top, 1) + 1
        for b in batches:
            everything = _matrix(b.column(0), d)
            for at in range(0, len(everything), ROWS):
                y = centred(everything[at:at + ROWS], n, sums, top)
                for i in range(d):
                    pairs = y[:, i:] + y[:, i:i + 1]
                    pairs[:, 0] = y[:, i]
                    q[i] = [t + s for t, s in zip(q[i], square_sums(pairs, bound))]
        for i in range(d):
            yield _sums_frame([i] * (d - i), list(range(i, d)), q[i])
    return run


def covariances(q: dict[tuple[int, int], int], d: int, n: int) -> np.ndarray:
    """Covariances from the sums of squares; each is rounded once."""
    v = np.zeros((d, d))
    for (i, j), t in q.items():
        v[i, j] = v[j, i] = (t if i == j else (t - q[i, i] - q[j, j]) // 2) / n ** 3
    return v


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Model | None, DataFrame | None]:
    """The model and the fit list ``(x)`` of :func:`whole_vectors`; nothing if empty."""
    distinct = stage(vectors.select("x").distinct(), "whitening-fit")
    lengths = (distinct.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), F.desc("d")).first())
    if lengths is None:
        return None, None
    d = int(lengths.d)
    if d == 0:
        return None, None
    distinct = distinct.filter(F.size("x") == d)
    first = _add_up(distinct.mapInArrow(_first_sums(d), _SUMS))
    n, sums = first[-1, -1], [first[i, -1] for i in range(d)]
    ends = distinct.agg(F.min(F.array_min("x")).alias("lo"), F.max(F.array_max("x")).alias("hi")).first()
    top = max(abs(int(ends.lo)), abs(int(ends.hi)))
    v = covariances(_add_up(distinct.mapInArrow(_squares(d, n, sums, top), _SUMS)), d, n)
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e, kind="stable")[:components]
    return Model(n, sums, u[:, order], e[order], float(np.trace(v)), top), distinct


def _scales(model: Model) -> np.ndarray:
    """``1 / sqrt(e)``; NaN for a component whose variance is rounding only."""
    floor = max(model.values[0], 0) * len(model.sums) * np.finfo(float).eps
    ok = model.values > floor
    return np.where(ok, 1 / np.sqrt(np.where(ok, model.values, 1)), np.nan)


def project(x: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """``(y, whitened)`` of a matrix of whole vectors."""
    y = centred(x, model.n, model.sums, model.top)
    return y, (y.astype(np.float64) / model.n) @ model.vectors * _scales(model)


def _deviations(y: np.ndarray, bound: int) -> pa.Array:
    if y.shape[1] * bound * bound < 1 << 63:
        return pa.array(np.einsum("ij,ij->i", y, y))
    totals = [int(t) for t in (y.astype(object) ** 2).sum(axis=1)]
    return pa.array([t if t < 1 << 63 else None for t in totals], pa.int64())


def _whitened_fit(model: Model):
    k, d = len(model.values), len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, w = project(_matrix(b.column(0), d), model)
            yield pa.RecordBatch.from_arrays([pa.array(w[:, c]) for c in range(k)], [f"w{c}" for c in range(k)])
    return run


def identity_error(model: Model, fit_list: DataFrame) -> float | None:
    """Largest absolute entry of the fit list's whitened covariance less the
    identity, over the components that have variance."""
    use = [c for c, s in enumerate(_scales(model)) if np.isfinite(s)]
    if not use:
        return None
    w = fit_list.mapInArrow(_whitened_fit(model), ", ".join(f"w{c} double" for c in range(len(model.values))))
    r = w.agg(*[F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a in use for b in use if a <= b]).first()
    return max(abs(r[f"c{a}_{b}"] - (a == b)) for a in use for b in use if a <= b)


def _rows(model: Model, error: float | None, id_type: pa.DataType):
    k, d = len(model.values), len(model.sums)
    explained = [max(float(e), 0.0) / model.trace if model.trace > 0 else None for e in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            y, w = project(_matrix(b.column(1), d), model)
            deviation = _deviations(y, 2 * model.n * max(model.top, 1))
            each = pa.array(np.repeat(np.arange(m), k))
            flat = np.ascontiguousarray(w).ravel()
            yield pa.RecordBatch.from_arrays([
                b.column(0).cast(id_type).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n, np.int64)), deviation.take(each),
                pa.array(flat, mask=np.isnan(flat)), pa.array(explained * m, pa.float64()),
                pa.array([error] * (m * k), pa.float64())],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``id_col, component, n, deviation,
    whitened, explained, identity_error``."""
    vectors = whole_vectors(df, id_col, vector_col)
    id_type = vectors.schema["id"].dataType
    schema = (f"id {id_type.simpleString()}, component int, n bigint, deviation bigint, whitened double, "
              "explained double, identity_error double")
    model, fit_list = fit(vectors, components)
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    error = identity_error(model, fit_list)
    return (vectors.filter(F.size("x") == len(model.sums)).mapInArrow(_rows(model, error, to_arrow_type(id_type)), schema)
            .withColumnRenamed("id", id_col))
