"""Whitening of embeddings by the leading components of their covariance.

Components become integers first, so that equal vectors are equal and sums are exact. Spark makes the list of distinct vectors,
their exact sums, and the covariance: each task adds up the outer products of its centred vectors, and the tasks' matrices are added row by
row. The covariance is as large as the dimension squared, whatever the number of vectors; it is all that the driver gets.
There it is brought to tridiagonal form by Householder reflections, the leading eigenvalues come from bisection on Sturm
counts, their vectors from inverse iteration, made orthogonal again within clusters of close eigenvalues. The projection,
dimension times components, is broadcast, and vectors are projected where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import Query, stored, table

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
#: Components with less than this share of the largest eigenvalue hold nothing but rounding.
LEAST_SHARE = 1e-10
#: Eigenvalues nearer than this share of the matrix norm form a cluster.
CLUSTER = 1e-3
#: Entries from here on don't fit a long, with room for centring.
LARGEST = float(2**61)


# --- Leading eigenvectors of a symmetric matrix -------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the unit vectors of the reflections that lead there, in order."""
    a, reflections = np.array(matrix, np.float64), []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        # Scaled, so that squares of tiny entries don't vanish.
        largest = np.abs(v).max()
        if largest == 0 or not np.any(v[1:]):
            reflections.append(np.zeros(len(v)))
            continue
        v /= largest
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        v /= np.sqrt(v @ v)
        reflections.append(v)
        # A - 2 v w' - 2 w v' with w = A v - (v'A v) v, on the rest of the matrix.
        rest = a[k + 1 :, k + 1 :]
        w = rest @ v
        w -= (v @ w) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        column = a[k + 1 :, k] - 2 * (v @ a[k + 1 :, k]) * v
        a[k + 1 :, k] = a[k, k + 1 :] = column
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray, tiny: float) -> np.ndarray:
    """Number of eigenvalues below each value of `at`: negative terms of the Sturm sequence."""
    square = np.concatenate([[0.0], off * off])
    term, below = np.ones(len(at)), np.zeros(len(at), np.int64)
    for i, d in enumerate(diagonal):
        term = d - at - square[i] / term
        term = np.where(np.abs(term) < tiny, -tiny, term)
        below += term < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each halved in until no number lies between its bounds."""
    edge = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low, high = (diagonal - edge).min(), (diagonal + edge).max()
    norm = max(abs(low), abs(high))
    tiny = max(np.finfo(float).tiny, np.finfo(float).eps ** 2 * norm)
    wanted = len(diagonal) - 1 - np.arange(k)
    lows, highs = np.full(k, low - norm * 1e-12 - tiny), np.full(k, high + norm * 1e-12 + tiny)
    while True:
        middle = lows + (highs - lows) / 2
        if np.all((middle <= lows) | (middle >= highs)):
            return middle
        above = sturm_counts(diagonal, off, middle, tiny) > wanted
        highs, lows = np.where(above, middle, highs), np.where(above, lows, middle)


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges; pivots of zero become `tiny`."""
    n = len(diagonal)
    main, upper, second, x = diagonal - shift, np.append(off, 0.0), np.zeros(n), right.copy()
    for i in range(n - 1):
        below, own = off[i], main[i]
        if abs(below) > abs(own):  # rows i and i + 1 change places
            factor = own / below
            main[i], kept, second[i] = below, upper[i], upper[i + 1]
            upper[i], main[i + 1], upper[i + 1] = main[i + 1], kept - factor * main[i + 1], -factor * second[i]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            main[i] = own if abs(own) > tiny else tiny
            factor = below / main[i]
            main[i + 1] -= factor * upper[i]
            x[i + 1] -= factor * x[i]
    for i in range(n - 1, -1, -1):
        pivot = main[i] if abs(main[i]) > tiny else tiny
        ahead = (upper[i] * x[i + 1] if i + 1 < n else 0.0) + (second[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = (x[i] - ahead) / pivot
    return x


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix as columns; those of close eigenvalues are kept orthogonal."""
    norm = max(np.abs(diagonal).max(initial=0.0) + 2 * np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    eps = np.finfo(float).eps
    random, found, first = np.random.default_rng(12), np.zeros((len(diagonal), len(values))), 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        # Shifts of a cluster differ, so that equal eigenvalues get different solutions.
        shift = value - (j - first) * 2 * eps * norm
        x = random.standard_normal(len(diagonal))
        for _ in range(4):
            x = solve_shifted(diagonal, off, shift, x / np.abs(x).max(), eps * norm)
            for _ in range(2):
                x = x / np.sqrt(((x / np.abs(x).max()) ** 2).sum()) / np.abs(x).max()
                x -= found[:, first:j] @ (found[:, first:j].T @ x)
        found[:, j] = x / np.sqrt(x @ x)
    return found


def leading_eigen(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    diagonal, off, reflections = tridiagonal(matrix)
    k = min(k, len(diagonal))
    vectors = leading_vectors(diagonal, off, leading_values(diagonal, off, k))
    for at in range(len(reflections) - 1, -1, -1):
        v = reflections[at]
        vectors[at + 1 :] -= 2 * np.outer(v, v @ vectors[at + 1 :])
    vectors /= np.sqrt((vectors**2).sum(0))
    values = ((matrix @ vectors) * vectors).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# --- Over a table --------------------------------------------------------------------------------------------


def integers(rows: DataFrame, vector: str, out: str) -> DataFrame:
    """Rows with a whole vector, and the column `out`: floor(SCALE * entry) + OFFSET of each entry as long."""
    whole = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double") * SCALE) < LARGEST, F.lit(False)))
    kept = rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & whole)
    return kept.withColumn(out, F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET))


def matrix_of(lists: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def exact_sums(fit: DataFrame, dims: int) -> list[int]:
    """Sum of each dimension: whole numbers from each task, as halves that don't overflow, then decimals over the tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, object)
        for batch in batches:
            x = matrix_of(batch.column(0), dims)
            total += ((x >> 31).sum(0).astype(object) << 31) + (x & (2**31 - 1)).sum(0).astype(object)
        values = pa.array([[Decimal(int(t)) for t in total]], pa.list_(pa.decimal128(28, 0)))
        yield pa.RecordBatch.from_arrays([values], names=["values"])

    parts = fit.mapInArrow(add, "values array<decimal(28,0)>")
    return [int(s) for s in parts.agg(*[F.sum(F.get("values", F.lit(j))) for j in range(dims)]).first()]


def summed(parts: DataFrame, dims: int) -> np.ndarray:
    """Rows (i, values) of all tasks' matrices added up, as one matrix: `dims` rows come to the driver."""
    sums = parts.groupBy("i").agg(*[F.sum(F.get("values", F.lit(j))).alias(f"s{j}") for j in range(dims)])
    out = np.zeros((dims, dims))
    for row in sums.collect():
        out[row["i"]] = row[1:]
    return out


@dataclass(frozen=True)
class Whitening:
    """`n` distinct vectors with sum n * floor + rest in each dimension, leading eigenvalues, vectors as columns, and the trace."""

    n: int
    floor: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part in integers, so nothing is lost far from zero."""
        return (x - self.floor).astype(np.float64) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sums of (n x - S)^2 as decimals; null beyond 38 digits."""
        away = x - self.floor
        bound = (int(np.abs(away).max(initial=0)) + 1) * self.n
        if bound * bound * x.shape[1] < 2**63:
            return pa.array(((away * self.n - self.rest) ** 2).sum(1)).cast(pa.decimal128(38, 0))
        exact = ((away.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(1)
        return pa.array([Decimal(int(v)) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))


def outer_sums(fit: DataFrame, of) -> DataFrame:
    """(i, values): the rows of the sum of outer products of `of(x)`, one matrix a task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = of(batch.column(0))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            values = pa.array(list(total), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), values], names=["i", "values"])

    return fit.mapInArrow(add, "i int, values array<double>")


def fit_whitening(rows: DataFrame, vector: str, components: int = COMPONENTS) -> tuple[Whitening, float] | None:
    """The whitening of the distinct vectors of `rows`, and the largest entry by which their whitened covariance differs from the identity.

    None where no vector is whole. Vectors that have not the usual length, that of most distinct vectors (ties: the longer), take no part.
    """
    fit = stored(integers(rows.select(vector), vector, "x").groupBy("x").agg(F.lit(1).alias("one")).select("x"), "distinct-vectors")
    size = fit.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if size is None:
        return None
    dims, n = size["dims"], size["count"]
    fit = fit.filter(F.size("x") == dims)
    sums = exact_sums(fit, dims)
    floor, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    start = Whitening(n, floor, rest, np.zeros(0), np.zeros((dims, 0)), 0.0)
    covariance = summed(outer_sums(fit, lambda x: start.centred(matrix_of(x, dims))), dims) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_eigen(covariance, components)
    let = (values > 0) & (values > values[0] * LEAST_SHARE)
    model = Whitening(n, floor, rest, values[let], vectors[:, let], float(np.trace(covariance)))
    k = len(model.values)
    error = 0.0
    if k:
        error = float(np.abs(summed(outer_sums(fit, lambda x: model.whitened(matrix_of(x, dims))), k) / n - np.eye(k)).max())
    return model, error


def whiten(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable row of `rows` and component: id, component, n, deviation decimal(38,0), whitened, explained, identity_error.

    Rows take no part whose vector is null, empty, holds null or non-finite entries, entries whose 64-fold needs more than 61 bits, or has another
    length than most distinct vectors have. The fit counts each distinct vector once; repeated rows each give their rows, null ids too.
    Components with no more than `LEAST_SHARE` of the largest eigenvalue are left out: one distinct vector alone, or an empty table, gives no rows.
    `deviation` is null beyond 38 digits. Other columns are not read.
    """
    narrow = rows.select(F.col(id).alias("_id"), F.col(vector).alias("_vector"))
    kind = dict(narrow.dtypes)["_id"]
    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    found = fit_whitening(narrow, "_vector", components)
    spark = rows.sparkSession
    if found is None or not len(found[0].values):
        return spark.createDataFrame([], schema).withColumnRenamed("id", id)
    model, error = found
    dims, k = model.vectors.shape
    shared = spark.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            x, rows = matrix_of(batch.column(1), dims), batch.num_rows
            each = pa.array(np.repeat(np.arange(rows), k))
            columns = [
                batch.column(0).take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n, np.int64)),
                model.deviations(x).take(each),
                pa.array(model.whitened(x).ravel()),
                pa.array(np.tile(model.values / model.trace, rows)),
                pa.array(np.full(rows * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    usable = integers(narrow, "_vector", "_x").filter(F.size("_x") == dims).select("_id", "_x")
    return usable.mapInArrow(project, schema).withColumnRenamed("id", id)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"))
    # A deviation beyond a long has none: null.
    return found.withColumn("deviation", F.expr("try_cast(deviation as long)"))


QUERIES: dict[str, tuple[Query, str | None]] = {"op12_whitening": (op12, None)}
