"""A quality classifier: regularised quadratic discriminant over statistics of whole texts.

Each text becomes a vector of transformed statistics (logarithms of sizes, square roots of shares).
Sums and products of the labelled rows give each class a mean and a covariance, shrunk towards the
pooled one and its diagonal; its Cholesky factor is kept, so that a score costs two triangular
products. The score is the difference of the log densities, from Mahalanobis distances, put on a
scale from 0 to 1 by a logistic curve fitted to a bounded sample of the training rows.

Labels, language, source and doc_id are never inputs. Null and empty texts have the statistics of
no words and are scored like others; repeated rows get repeated scores. A doc_id with several
labels counts once, with the least. With labels of one class only, every score is that class."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, runs, slices, table
from .tokens import SPACED, _byte_class, grams, words

THRESHOLD = 0.3
#: Shares of the pooled covariance, and then of its diagonal, in a class's covariance.
POOLED, DIAGONAL, RIDGE = 0.05, 0.05, 1e-3
#: Training rows that the curve is fitted to, at most.
CURVE_ROWS = 20_000

LINES = _byte_class((0x0A, 0x0A), (0x0D, 0x0D))


def _only(text: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(text.encode(), np.uint8)] = True
    return out


_SETS = [
    _only("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    _only("0123456789"),
    _only(" \t\n\r"),
    _only(".,;:"),
    _only("!?"),
    _only("#$%&*+=~^@_\\<>{}[]/"),
    _only("|"),
    _only("\"'()-"),
    np.arange(256) >= 0xC0,  # first bytes of characters beyond ASCII
]
STATISTICS = len(_SETS) + 10


def statistics(column: pa.Array) -> np.ndarray:
    """A row of STATISTICS numbers for each text."""
    w = words(column, SPACED)
    n = len(w.counts)
    closed = np.append(w.offsets[:-1], len(w.data))
    size = np.diff(w.offsets)
    per_text = lambda values, first, some: np.add.reduceat(np.append(values, 0), first)[:n] * some if n else np.zeros(0)
    share = lambda a, b: np.sqrt(a / np.maximum(b, 1))
    out = [share(per_text(s[w.data].astype(np.int32), closed, size > 0), size) for s in _SETS]
    count, some = w.counts, w.counts > 0
    length = w.end - w.start
    at = lambda values: per_text(values.astype(np.float64), np.append(w.first[:-1], len(values)), some)
    mean = at(length) / np.maximum(count, 1)
    upper, letter = _SETS[0], _SETS[0] | _only("abcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 0x80)
    capitals = upper[w.data[w.start]] & upper[w.data[w.end - 1]] if len(w.start) else np.zeros(0, bool)
    marked = ~letter[w.data[w.end - 1]] if len(w.start) else np.zeros(0, bool)
    alone = np.zeros(len(length), bool)
    if len(length):
        alone = ~letter[w.data[w.start]] & (length <= 3)
    lines = words(column, LINES)
    pairs, first = grams(w, 2)
    out += [
        np.log1p(count),
        mean**0.5,
        np.sqrt(np.maximum(at(length.astype(float) ** 2) / np.maximum(count, 1) - mean**2, 0)) ** 0.5,
        share(at(capitals), count),
        share(at(marked), count),
        share(at(alone), count),
        share(_distinct_count(w.hash, w.text, n), count),
        share(_distinct_count(pairs, w.text[first], n), count),
        share(lines.counts - _distinct_count(lines.hash, lines.text, n), lines.counts),
        np.log1p(count / np.maximum(lines.counts, 1)),
    ]
    return np.stack(out, 1)


def _distinct_count(hashes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """How many different hashes each text has."""
    if not len(hashes):
        return np.zeros(texts)
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return np.bincount(t[new], minlength=texts).astype(float)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            x = statistics(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, STATISTICS), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *batch.columns[2:], lists], names=["doc_id", *batch.schema.names[2:], "x"])


def vectors(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, further columns and the statistics of each text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), *more)
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_vectors, ", ".join(["doc_id long", *(f"{c} {kinds[c]}" for c in more), "x array<double>"]))


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


@dataclass
class Model:
    """Of each class 0 and 1: the mean, the inverse Cholesky factor of the covariance, and the
    logarithm of its determinant; then slope and offset of the curve."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    determinants: list[float]
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None

    def difference(self, x: np.ndarray) -> np.ndarray:
        density = [-0.5 * (((x - m) @ f.T) ** 2).sum(1) - 0.5 * d for m, f, d in zip(self.means, self.factors, self.determinants, strict=True)]
        return np.sign(d := density[1] - density[0]) * np.log1p(np.abs(d))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.offset, -40, 40)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, STATISTICS + 1, STATISTICS + 1))
    for batch in batches:
        x = np.array(batch.column("x").to_pylist(), float).reshape(-1, STATISTICS)
        x = np.concatenate([np.ones((len(x), 1)), x], 1)
        y = batch.column("quality").to_numpy()
        for k in (0, 1):
            total[k] += x[y == k].T @ x[y == k]
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def _added(key: tuple, rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b.as_buffer(), float) for b in rows.column("sums"))
    return pa.table({"k": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})


def training(labels: DataFrame) -> DataFrame:
    """doc_id, quality of the labelled documents to learn from."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    return rows.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))


def _differences(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, STATISTICS)
            yield pa.RecordBatch.from_arrays([pa.array(model.value.difference(x)), batch.column("quality")], names=["d", "quality"])

    return run


def fit(marked: DataFrame) -> Model:
    """marked: doc_id, x (see vectors()) and quality of the rows to learn from."""
    rows = cut(marked.select("doc_id", "x", "quality"), "labelled")
    partial = rows.select("x", "quality").mapInArrow(_sums, "sums binary").withColumn("k", F.spark_partition_id())
    for width in (1024, 32):  # sums of sums, so that no group grows with the number of tasks
        partial = partial.withColumn("k", F.pmod("k", F.lit(width)).cast("int")).groupBy("k").applyInArrow(_added, "k int, sums binary")
    total = sum((np.frombuffer(r["sums"], float).reshape(2, STATISTICS + 1, -1) for r in partial.collect()), np.zeros((2, STATISTICS + 1, STATISTICS + 1)))  # 32 rows at most
    n = total[:, 0, 0]
    if n.min() < 2:
        return Model([], [], [], constant=float(n[1] >= n[0]))
    means = [total[k, 0, 1:] / n[k] for k in (0, 1)]
    scatter = [total[k, 1:, 1:] / n[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (n[0] * scatter[0] + n[1] * scatter[1]) / n.sum()
    factors, determinants = [], []
    for k in (0, 1):
        own = POOLED + (1 - POOLED) * min(1.0, STATISTICS / n[k])
        s = (1 - own) * scatter[k] + own * pooled
        s = (1 - DIAGONAL) * s + DIAGONAL * np.diag(np.diag(s)) + RIDGE * np.eye(STATISTICS)
        c = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(c))
        determinants.append(float(2 * np.log(np.diag(c)).sum()))
    model = Model(means, factors, determinants)
    some = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(CURVE_ROWS).mapInArrow(_differences(rows.sparkSession.sparkContext.broadcast(model)), "d double, quality int").collect()
    d = np.array([r["d"] for r in some])
    y = np.array([r["quality"] for r in some], float)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton's method for the curve, with a weak prior on the slope
        p = 1 / (1 + np.exp(-np.clip(a * d + b, -40, 40)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([((y - p) * d).sum() - 0.01 * a, (y - p).sum() - 0.01 * b])
        hessian = np.array([[(w * d * d).sum() + 0.01, (w * d).sum()], [(w * d).sum(), w.sum() + 0.01]])
        step = np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        a, b = a + step[0], b + step[1]
    model.slope, model.offset = max(a, 1e-3), b
    return model


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, STATISTICS)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.score(x))], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    xs = cut(vectors(docs), "vectors")
    model = docs.sparkSession.sparkContext.broadcast(fit(xs.join(training(labels), "doc_id")))
    scored = xs.mapInArrow(_scored(model), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """documents without those that the classifier rejects. Of texts only those to learn from are
    shuffled; the others are scored where they are, and rows stay outside of Python."""
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(training(labels), "doc_id")
    model = docs.sparkSession.sparkContext.broadcast(fit(vectors(marked, "quality")))

    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        parts = [model.value.score(statistics(text.slice(first, n))) for first, n in runs(text)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return docs.filter(scored("text") >= THRESHOLD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
