"""Quality classifier: Naive Bayes support vectors.

A text's features are indicators of n-grams: word 1- and 2-grams, and 1-, 2- and
3-grams of word shapes (letters by case, digits, each punctuation mark; runs
count once; a word equal to the one before has a shape of its own).  They are
hashed into ``2**BITS`` slots.  Each indicator is scaled by its class log-count
ratio, counted over *all* labelled training rows, and the vector to unit length.
A linear hinge-loss model is fit by dual coordinate descent to a sample of at
most :data:`SAMPLE` training rows a class, drawn from the labelled rows that have
a document.  Sampled rows are weighted so that the classes have the ratio that
they have among all labelled rows, in the fit and in the curve.  Margins of rows that a model has not seen (three folds) set a
logistic curve that turns margins into scores.

Labels, language, source and ids are never inputs of a score.

Defined cases: a null text counts as empty; an empty text gets the score of the
model's constant; rows that repeat an id and its text train as often as they
are there; rows without label, with a null label or with labels that
differ train nothing; a null id is not held out and trains nothing; if only one
class is labelled every score is 1 for class 1 and 0 for class 0, and 1 if
nothing is; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitlake.llm.common import stage, text_or_empty
from bitlake.llm.hashing import BYTE, Prefix, chunks, mix, word_tokens

BITS = 18
#: Training rows a class that the linear model is fit to, at most.
SAMPLE = 6000
#: Labels that are broadcast, at most (about 30 MB).  Beyond, labelled texts are shuffled.
BROADCAST = 1 << 20
THRESHOLD = 0.7
EPOCHS = 20
COST = 1.0
CHUNK = 1 << 20
_U = np.uint64

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a"):ord("z") + 1] = ord("a")
_SHAPE[ord("A"):ord("Z") + 1] = ord("A")
_SHAPE[ord("0"):ord("9") + 1] = ord("0")
_SHAPE[128:] = ord("a")


def _grams(tokens: np.ndarray, doc: np.ndarray, n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the n-grams and their documents."""
    if len(tokens) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:len(doc) - n + 1] == doc[n - 1:])
    h = np.full(len(at), salt, _U)
    for i in range(n):
        h = mix(h * _U(0x9E3779B97F4A7C15) + tokens[at + i])
    return (h >> _U(64 - BITS)).astype(np.int64), doc[at]


def features(buf: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(document, slot)`` of the distinct features of each document, sorted."""
    words, s, e, at = word_tokens(buf, docs)
    doc = np.repeat(np.arange(len(docs) - 1), np.diff(at))
    # Shapes: bytes whose class differs from the one before, or that start a word.
    cls = _SHAPE[buf]
    first = np.ones(len(buf), bool)
    first[1:] = cls[1:] != cls[:-1]
    first[s] = True
    kept = np.flatnonzero(first)
    shapes = Prefix(BYTE[cls[kept]]).slices(np.searchsorted(kept, s), np.searchsorted(kept, e)) if len(s) else words
    if len(s) > 1:
        again = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
        shapes[1:][again] = _U(1)
    parts = [_grams(words, doc, 1, 1), _grams(words, doc, 2, 2),
             _grams(shapes, doc, 1, 3), _grams(shapes, doc, 2, 4), _grams(shapes, doc, 3, 5)]
    key = np.unique(np.concatenate([d << BITS | slot for slot, d in parts]))
    return key >> BITS, key & ((1 << BITS) - 1)


def log_count_ratios(counts: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """From ``counts[class, slot]``; slots that were never seen get 0."""
    p = counts + alpha
    r = np.log(p[1] / p[1].sum()) - np.log(p[0] / p[0].sum())
    return np.where(counts.sum(0) > 0, r, 0.0)


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int,
                            cost: float = COST, epochs: int = EPOCHS, times: np.ndarray | None = None) -> np.ndarray:
    """Weights of the L2-regularised hinge loss; the last one is the constant.
    One dual variable at a time is moved to the minimum within ``[0, cost]``.
    ``rows`` are (slots, values), ``times`` how often each counts (once);
    ``y`` is -1 or 1."""
    most = cost * (np.ones(len(rows)) if times is None else times)
    w = np.zeros(size + 1)
    alpha = np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            slots, v = rows[i]
            g = y[i] * (w[slots] @ v + w[size]) - 1.0
            new = min(max(alpha[i] - g / norm[i], 0.0), most[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                w[slots] += step * v
                w[size] += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def logistic(margin: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset of ``1 / (1 + exp(-(slope * margin + offset)))``, by
    Newton steps on smoothed targets; ``times`` is how often each row counts."""
    times = np.ones(len(y)) if times is None else times
    n1, n0 = times[y > 0].sum(), times[y < 0].sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones(len(margin))], 1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (times * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (times * (t - p)) - 1e-6 * b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, t, h)``: ``h`` tells rows apart by id and text."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("t"))
    return d.select("doc_id", F.encode("t", "UTF-8").alias("t"), F.xxhash64("doc_id", "t").alias("h"))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(t, y, h)``: texts of all rows that may be learned from, and their labels.
    Texts are not shuffled unless there are very many labels."""
    one = stage(labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("y"))
                .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out())
                .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).filter("y = z")
                .select("doc_id", "y"), "labels")
    d = _texts(docs).filter(F.col("doc_id").isNotNull() & ~held_out())
    return d.join(F.broadcast(one) if one.count() <= BROADCAST else one, "doc_id").select("t", "y", "h")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and slot: rows of each class that have its feature.  Also one row
    (``slot`` -1) a training row, with its ``h``."""
    names = ["slot", "h", "n0", "n1"]
    counts = np.zeros((2, 1 << BITS), np.int64)
    for b in batches:
        y = b.column(1).to_numpy(zero_copy_only=False)
        for i, _, buf, offs in chunks(b.column(0), CHUNK):
            doc, slot = features(buf, offs)
            own = y[i + doc]
            for k in (0, 1):
                counts[k] += np.bincount(slot[own == k], minlength=1 << BITS)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(y), -1, np.int32)), b.column(2), pa.array((y == 0).astype(np.int64)),
            pa.array((y == 1).astype(np.int64))], names)
    seen = np.flatnonzero(counts.any(0))
    yield pa.RecordBatch.from_arrays([
        pa.array(seen.astype(np.int32)), pa.array(np.zeros(len(seen), np.int64)), pa.array(counts[0][seen]),
        pa.array(counts[1][seen])], names)


def _sample(rows: DataFrame, n: np.ndarray, sample: int) -> dict[int, tuple[int, int]]:
    """``h -> (class, times)`` of a sample of the training rows ``(h, n0, n1)``, of
    at most ``sample`` rows a class in all.  A row that is there ``c`` times is
    taken ``c`` times the share of its class, rounded up or down by its hash."""
    u = F.pmod(F.xxhash64("h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    out: dict[int, tuple[int, int]] = {}
    for k in (0, 1):
        times = F.floor(F.col(f"n{k}") * F.lit(min(1.0, sample / int(n[k]))) + u)
        left = sample
        for r in (rows.filter(F.col(f"n{k}") > 0).select("h", times.alias("m")).filter("m > 0")
                  .orderBy(F.desc("m"), "h").limit(sample).collect()):
            if left:
                out[r.h] = k, min(r.m, left)
                left -= out[r.h][1]
    return out


class QualityModel:
    """Scaled weights of the slots, and the curve from margins to scores."""

    def __init__(self, ratios: np.ndarray, weights: np.ndarray, slope: float, offset: float):
        self.ratios = ratios.astype(np.float32)
        self.weights = (weights[:-1] * ratios).astype(np.float32)
        self.constant, self.slope, self.offset = float(weights[-1]), slope, offset

    def score(self, column: pa.Array) -> np.ndarray:
        out = []
        for i, j, buf, offs in chunks(column, CHUNK):
            doc, slot = features(buf, offs)
            r = self.ratios[slot].astype(float)
            norm = np.sqrt(np.bincount(doc, r * r, j - i))
            dot = np.bincount(doc, self.weights[slot], j - i)
            margin = dot / np.where(norm > 0, norm, 1.0) + self.constant
            out.append(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel | float:
    """A model, or the score of every text if there is only one class."""
    got = stage(training_rows(docs, labels).mapInArrow(_counts, "slot int, h bigint, n0 bigint, n1 bigint")
                .groupBy("slot", "h").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "training-counts")
    rows = got.filter("slot < 0")
    n = np.array([x or 0 for x in rows.agg(F.sum("n0"), F.sum("n1")).first()], np.int64)
    if not n.all():
        return 0.0 if n[0] else 1.0
    seen = got.filter("slot >= 0").select("slot", "n0", "n1").toArrow()  # 2**BITS rows at most
    counts = np.zeros((2, 1 << BITS))
    for k in (0, 1):
        counts[k, seen["slot"].to_numpy()] = seen[f"n{k}"].to_numpy()
    ratios = log_count_ratios(counts)
    chosen = _sample(rows, n, sample)
    picked = spark.createDataFrame([(h,) for h in chosen], "h bigint")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for b in batches:
            new = [i for i, h in enumerate(b.column(1).to_pylist()) if not (h in met or met.add(h))]
            b = b.take(pa.array(new, pa.int32()))
            for i, j, buf, offs in chunks(b.column(0), CHUNK):
                doc, slot = features(buf, offs)
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(slot.astype(np.int32))),
                    b.column(1).slice(i, j - i)], ["slots", "h"])

    data = (_texts(docs).join(F.broadcast(picked), "h").select("t", "h")
            .mapInArrow(vectors, "slots array<int>, h bigint").dropDuplicates(["h"]).toArrow())
    h = data["h"].to_numpy()
    order = np.argsort(h)
    lists = data["slots"].combine_chunks()
    flat, cut = lists.values.to_numpy(), lists.offsets.to_numpy()
    y, times = (np.array([chosen[i][k] for i in h[order].tolist()], float) for k in (0, 1))
    # The classes in the ratio of all rows, with the weight of the sample in all.
    drawn = np.array([times[y == k].sum() for k in (0, 1)])
    times *= (n / drawn * (drawn.sum() / n.sum()))[y.astype(int)]
    y = 2 * y - 1
    x = []
    for i in order:
        slots = flat[cut[i]:cut[i + 1]]
        v = ratios[slots]
        norm = np.sqrt(v @ v)
        x.append((slots, v / norm if norm else v))
    margin, fold = np.zeros(len(x)), np.arange(len(x)) % 3
    for k in range(3):
        w = dual_coordinate_descent([x[i] for i in np.flatnonzero(fold != k)], y[fold != k], 1 << BITS,
                                    times=times[fold != k])
        for i in np.flatnonzero(fold == k):
            margin[i] = w[x[i][0]] @ x[i][1] + w[-1]
    slope, offset = logistic(margin, y, times)
    return QualityModel(ratios, dual_coordinate_descent(x, y, 1 << BITS, times=times), slope, offset)


def scored(spark: SparkSession, model: QualityModel | float, text: Column) -> Column:
    """The score of a text column.  The model has a fixed size (2 MB)."""
    if isinstance(model, float):
        return F.lit(model)
    shared = spark.sparkContext.broadcast(vars(model))

    @F.arrow_udf("double")
    def score(t: pa.Array) -> pa.Array:
        own = QualityModel.__new__(QualityModel)
        vars(own).update(shared.value)
        return pa.array(own.score(t), pa.float64())

    return score(F.encode(text, "UTF-8"))


def quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    model = fit(spark, docs, labels)
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"),
                        scored(spark, model, text_or_empty()).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
