"""Whitening of vectors: principal components with unit variance.

Three small distributed passes and one projection. Entries become whole numbers first, so that counts, sums and the
covariance are exact and do not depend on how rows are dealt out:

1. The number of rows and the sum of each dimension.
2. Every entry is centred by the whole part of its dimension's mean, then products are summed per pair of dimensions:
   matrix products of blocks inside a task, one row per pair and task into the shuffle. What is left of the mean, a
   fraction below one, is taken off exactly.
3. The leading eigenvectors of the covariance (see ``eigen``), divided by the roots of their eigenvalues, are broadcast
   and project every row. The covariance of what comes out is summed the same way and held against the identity.

On the driver are matrices of dimensions squared; no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.eigen import EPS, leading
from scholarmill.llm.rows import arrow_type, column, fields, prepare

#: Fixed values of the contract: an entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32

#: Entries from here on do not fit a long after scaling.
TOO_LARGE = float(1 << 56)

#: Sums of whole numbers are exact below these in doubles and in longs.
IN_DOUBLE, IN_LONG = 1 << 53, 1 << 62

WHOLE = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitening:
    """``mean = shift + rest / n`` per dimension, eigenvalues, and projection rows ``eigenvector / sqrt(eigenvalue)``."""

    n: int
    shift: tuple[int, ...]
    rest: tuple[int, ...]
    values: np.ndarray
    rows: np.ndarray
    trace: float

    def centred(self, whole: np.ndarray) -> np.ndarray:
        return (whole - np.array(self.shift)) - np.array(self.rest, dtype=float) / self.n

    def project(self, whole: np.ndarray) -> np.ndarray:
        return self.centred(whole) @ self.rows.T

    def deviations(self, whole: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S) squared, exact."""
        own, rest = whole - np.array(self.shift), np.array(self.rest)
        largest = int(np.abs(own).max(initial=0)) * self.n + self.n
        if largest * largest * max(1, own.shape[1]) < IN_LONG:
            off = self.n * own - rest
            return (off * off).sum(axis=1).tolist()
        return [sum((self.n * int(y) - int(t)) ** 2 for y, t in zip(row, self.rest)) for row in own]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``(vec_id, vector array<double>)`` of rows that can be whitened, and their length."""
    prepare(vectors.sparkSession)
    rows = vectors.select(column(id_col).alias("vec_id"), column(vector_col).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < TOO_LARGE)))
    # the length that most vectors have, the greater one of a tie
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = sizes[0]["size"] if sizes else 0
    return rows.filter(F.size("vector") == size), size


def whole(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The whole numbers of a batch's vectors, a row each."""
    flat = batch.column(batch.schema.get_field_index("vector")).flatten().to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * flat) + 0.0).astype(np.int64).reshape(-1, size) + OFFSET


class Total:
    """A sum of arrays of whole numbers that never overflows."""

    def __init__(self, shape):
        self.held, self.bound, self.large = np.zeros(shape, dtype=np.int64), 0, np.zeros(shape, dtype=object)

    def add(self, part: np.ndarray, bound: int) -> None:
        if bound >= IN_LONG:
            self.large = self.large + part
            return
        if self.bound + bound >= IN_LONG:
            self.large, self.held, self.bound = self.large + self.held, np.zeros_like(self.held), 0
        self.held += part.astype(np.int64)
        self.bound += bound

    def all(self) -> np.ndarray:
        return self.large + self.held


def sums(rows: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of rows and the sum of each dimension."""
    schema = pa.schema([("i", pa.int32()), ("total", WHOLE)])

    def run(batches):
        total, n = Total(size), 0
        for batch in batches:
            own = whole(batch, size)
            bound = int(np.abs(own).max(initial=0)) * len(own)
            total.add(own.sum(axis=0) if bound < IN_LONG else own.astype(object).sum(axis=0), bound)
            n += len(own)
        yield decimals(schema, [range(-1, size)], [n, *total.all()])

    found = {r.i: int(r.total) for r in rows.select("vector").mapInArrow(run, "i int, total decimal(38,0)").groupBy("i").agg(
        F.sum("total").alias("total")).collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(size)]


def decimals(schema: pa.Schema, keys: list, totals: list) -> pa.RecordBatch:
    import decimal

    return pa.RecordBatch.from_arrays([*(pa.array(k, pa.int32()) for k in keys),
                                       pa.array([decimal.Decimal(int(t)) for t in totals], WHOLE)], schema=schema)


def products(own: np.ndarray) -> tuple[np.ndarray, int]:
    """The sum of each row's products of dimensions, exact, and a bound of its entries."""
    largest = int(np.abs(own).max(initial=0))
    bound = largest * largest * len(own)
    if bound < IN_DOUBLE:
        flat = own.astype(float)
        return flat.T @ flat, bound
    if bound < IN_LONG:
        return own.T @ own, bound
    large = own.astype(object)
    return large.T @ large, bound


def covariance(rows: DataFrame, size: int, n: int, shift: list[int], rest: list[int]) -> np.ndarray:
    """Covariance with divisor ``n``, each entry rounded once."""
    upper = np.triu_indices(size)
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("total", WHOLE)])

    def run(batches):
        total, centre = Total((size, size)), np.array(shift)
        for batch in batches:
            total.add(*products(whole(batch, size) - centre))
        yield decimals(schema, list(upper), total.all()[upper])

    found = rows.select("vector").mapInArrow(run, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total"))
    out = np.zeros((size, size))
    for r in found.toLocalIterator():
        out[r.i, r.j] = out[r.j, r.i] = (n * int(r.total) - rest[r.i] * rest[r.j]) / (n * n)
    return out


def fit(rows: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of all of ``rows(vector)``; components without variance are left out."""
    n, total = sums(rows, size)
    shift, rest = [s // n if n else 0 for s in total], [s % n if n else 0 for s in total]
    if n == 0 or size == 0:
        return Whitening(n, tuple(shift), tuple(rest), np.zeros(0), np.zeros((0, size)), 0.0)
    spread = covariance(rows, size, n, shift, rest)
    values, axes = leading(spread, components)
    has = values > size * EPS * max(values[0], 0.0)
    return Whitening(n, tuple(shift), tuple(rest), values[has], axes[has] / np.sqrt(values[has])[:, None], float(np.trace(spread)))


def identity_error(rows: DataFrame, size: int, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened rows, less the identity."""
    k = len(model.values)
    if k == 0:
        return 0.0
    sent = rows.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("total", pa.float64())])
    at = np.indices((k, k + 1)).reshape(2, -1)

    def run(batches):
        total = np.zeros((k, k + 1))
        for batch in batches:
            out = sent.value.project(whole(batch, size))
            total[:, :k] += out.T @ out
            total[:, k] += out.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(total.ravel())], schema=schema)

    found = np.zeros((k, k + 1))
    for r in rows.select("vector").mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        found[r.i, r.j] = r.total / model.n
    return float(np.abs(found[:, :k] - np.outer(found[:, k], found[:, k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation decimal, whitened, explained, identity_error)``, a row per vector and component.

    Vectors that are null, hold null or non-finite entries or such that do not fit a long after scaling, and vectors of
    another length than most (the greater length of a tie) are left out; so are components without variance, at whose
    scale nothing can be. Repeated rows count and come out as often as they occur, null ids stay. Equal eigenvalues may
    have any basis of their space. No usable vectors give no rows.
    """
    rows, size = usable(vectors, id_col, vector_col)
    model = fit(rows, size, components)
    error = identity_error(rows, size, model)
    sent = vectors.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("vec_id", arrow_type(rows, "vec_id")), ("component", pa.int32()), ("n", pa.int64()), ("deviation", WHOLE),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def run(batches):
        import decimal

        own, k = sent.value, len(sent.value.values)
        share = own.values / own.trace if k else own.values
        for batch in batches:
            if k == 0 or batch.num_rows == 0:
                continue
            numbers = whole(batch, size)
            each = np.repeat(np.arange(len(numbers)), k)
            deviation = pa.array([decimal.Decimal(d) for d in own.deviations(numbers)], WHOLE)
            rows_ = len(each)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(numbers))),
                 pa.array(np.full(rows_, own.n)), deviation.take(pa.array(each)), pa.array(own.project(numbers).ravel()),
                 pa.array(np.tile(share, len(numbers))), pa.array(np.full(rows_, error))], schema=schema)

    return rows.mapInArrow(run, f"vec_id {fields(rows, 'vec_id')}, component int, n bigint, deviation decimal(38,0), whitened double, "
                                "explained double, identity_error double")


def digests(found: DataFrame) -> DataFrame:
    """``deviation`` as a long; null where it does not fit one, which takes about a billion vectors."""
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
