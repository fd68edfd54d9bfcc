"""Penalty search for linear models from the moments of each fold.

A penalised least-squares fit needs only counts, means and covariances, and so does its error on a
held-out fold.  One distributed pass yields these for all folds; every penalty of every fold is then
solved on a matrix whose side is the number of features, instead of fifty passes over each fold.

In the pass, vectors become blocks of rows; a block's products are one matrix product.  A task keeps a sum per
fold, centred near the mean of its first block, and what tasks found is merged in two steps, one matrix at a time,
by a root of the shuffle's tasks first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.session import settings, ship

#: Features at most whose covariance matrix the search holds; beyond, ``wide`` searches by fits on the data.
MAX_FEATURES = 4096

#: Numbers in a block of rows.
BLOCK_NUMBERS = 2_000_000

#: What Arrow hands over at once, by size: one row of sums is a matrix, and thousands of vectors are no more than that.
FEW_AT_ONCE = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


@dataclass(frozen=True)
class Moments:
    """Row count, means and population covariance of features and label (the last column)."""

    n: int
    mean: np.ndarray
    cov: np.ndarray

    def drop(self, column: int) -> Moments:
        return Moments(self.n, np.delete(self.mean, column),
                       np.delete(np.delete(self.cov, column, 0), column, 1))

    def scaled(self, deviation: np.ndarray) -> Moments:
        return Moments(self.n, self.mean / deviation, self.cov / np.outer(deviation, deviation))


def dense_blocks(batches, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(fold, rows)`` of ``(fold, vector struct, label)``; a row is a vector, sparse or dense, and its label."""
    step = max(1, BLOCK_NUMBERS // (width + 1))
    for whole in batches:
        for begin in range(0, whole.num_rows, step):
            batch = whole.slice(begin, step)
            vectors = batch.column(1)
            out = np.zeros((batch.num_rows, width + 1))
            out[:, -1] = batch.column(2).to_numpy(zero_copy_only=False)
            values, indices = pc.struct_field(vectors, "values"), pc.struct_field(vectors, "indices")
            length = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
            dense = pc.equal(pc.struct_field(vectors, "type"), 1).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), length)
            column = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
            column[~dense[row]] = indices.flatten().to_numpy(zero_copy_only=False)
            out[row, column] = values.flatten().to_numpy(zero_copy_only=False)
            yield batch.column(0).to_numpy(zero_copy_only=False), out


class Sums:
    """Count, mean and sum of products about the mean, of rows that come in blocks."""

    def __init__(self, n: int = 0, mean: np.ndarray | None = None, products: np.ndarray | None = None):
        self.n, self.mean, self.products = n, mean, products

    def add(self, n: int, mean: np.ndarray, products: np.ndarray) -> None:
        if not self.n:
            self.n, self.mean, self.products = n, mean, products
            return
        off, total = mean - self.mean, self.n + n
        self.products += products
        self.products += np.outer(off, off) * (self.n * n / total)
        self.mean = self.mean + off * (n / total)
        self.n = total

    def add_rows(self, rows: np.ndarray) -> None:
        mean = rows.mean(axis=0)
        rows = rows - mean
        self.add(len(rows), mean, rows.T @ rows)

    def row(self) -> dict:
        return {"n": self.n, "mean": self.mean.tobytes(), "products": self.products[np.triu_indices(len(self.mean))].tobytes()}

    @classmethod
    def of(cls, n: int, mean: bytes, products: bytes) -> Sums:
        mean = np.frombuffer(mean).copy()
        full = np.zeros((len(mean), len(mean)))
        full[np.triu_indices(len(mean))] = np.frombuffer(products)
        return cls(n, mean, full + np.triu(full, 1).T)


PART = "fold int, n bigint, mean binary, products binary"
PART_ARROW = pa.schema([("fold", pa.int32()), ("n", pa.int64()), ("mean", pa.binary()), ("products", pa.binary())])


def width_of(rows: DataFrame, features: str = "raw") -> int:
    first = rows.select(features).first()
    return len(first[0]) if first else 0


def fold_moments(rows: DataFrame, folds: int = 5, features: str = "raw", label: str = "y", max_features: int = MAX_FEATURES) -> list[Moments]:
    """The moments of each fold, from one pass over ``rows(fold, features, label)``."""
    spark = ship(rows.sparkSession)
    width = width_of(rows, features)
    if width > max_features:
        raise ValueError(f"{width} features; a matrix of at most {max_features} is held")

    def of_rows(batches):
        held: dict[int, Sums] = {}
        for fold, block in dense_blocks(batches, width):
            for k in np.unique(fold).tolist():
                held.setdefault(k, Sums()).add_rows(block[fold == k])
        yield from parts(held)

    def merged(batches):
        held: dict[int, Sums] = {}
        for batch in batches:
            for r in batch.to_pylist():
                one = Sums.of(r["n"], r["mean"], r["products"])
                held.setdefault(r["fold"], Sums()).add(one.n, one.mean, one.products)
        yield from parts(held)

    def parts(held):
        for k, sums in held.items():
            yield pa.RecordBatch.from_pylist([{"fold": k, **sums.row()}], schema=PART_ARROW)

    sent = rows.select(F.col("fold").cast("int").alias("fold"), F.unwrap_udt(features).alias("v"), F.col(label).cast("double").alias("y"))
    groups = max(1, int(int(spark.conf.get("spark.sql.shuffle.partitions")) ** 0.5))
    found = sent.mapInArrow(of_rows, PART).withColumn("group", F.spark_partition_id() % groups)
    # the first step spreads the tasks' sums, the second brings each fold's together
    some = found.repartition(groups, "group").drop("group").mapInArrow(merged, PART)
    with settings(spark, FEW_AT_ONCE):
        last = {r["fold"]: Sums.of(r["n"], r["mean"], r["products"]) for r in some.repartition(folds, "fold").mapInArrow(merged, PART).toLocalIterator()}
    nothing = Moments(0, np.zeros(width + 1), np.zeros((width + 1, width + 1)))
    return [Moments(last[k].n, last[k].mean, last[k].products / last[k].n) if k in last else nothing for k in range(folds)]


def merge(parts: Sequence[Moments]) -> Moments:
    parts = [p for p in parts if p.n] or list(parts)[:1]
    n = sum(p.n for p in parts)
    if not n:
        return parts[0]
    mean = sum(p.n * p.mean for p in parts) / n
    cov = sum(p.n * (p.cov + np.outer(p.mean - mean, p.mean - mean)) for p in parts) / n
    return Moments(n, mean, cov)


def held_out_error(m: Moments, intercept: float, beta: np.ndarray) -> float:
    """Mean squared error of a linear model on the rows the moments describe."""
    gap = m.mean[-1] - intercept - m.mean[:-1] @ beta
    return float(m.cov[-1, -1] - 2 * beta @ m.cov[:-1, -1] + beta @ m.cov[:-1, :-1] @ beta + gap * gap)


def _gaps(cov: np.ndarray, target: np.ndarray, l1: np.ndarray, l2: np.ndarray, beta: np.ndarray, variance: float) -> np.ndarray:
    """How far each column's objective can lie above its minimum: primal less a feasible dual value."""
    moved = cov @ beta + l2 * beta
    fit = target @ beta
    square = np.maximum(variance - 2 * fit + (beta * moved).sum(axis=0), 0.0)
    slope = np.abs(target[:, None] - moved).max(axis=0, initial=0.0)
    scale = np.where(slope > l1, l1 / np.maximum(slope, 1e-300), 1.0)
    return square / 2 + l1 * np.abs(beta).sum(axis=0) - scale * (variance - fit) + scale * scale * square / 2


def _one(cov: np.ndarray, target: np.ndarray, l1: float, l2: float, beta: np.ndarray, steps: int) -> np.ndarray:
    """Minimises b'Cb/2 - t'b + l1|b| + l2 b'b/2 from ``beta`` on, by solving for the present signs.

    The coefficient that violates its condition most joins with the sign that helps.  If the solution for these
    signs crosses zero, the best crossing on the way to it is taken and what is zero there leaves.  Every step
    lowers the objective, so no set of signs comes back.
    """
    beta = beta.copy()
    signs = np.sign(beta)
    for _ in range(steps):
        used = np.flatnonzero(signs)
        if len(used):
            inner = cov[np.ix_(used, used)]
            inner.flat[::len(used) + 1] += l2 + 1e-11 * np.trace(inner) / len(used)
            goal = np.linalg.solve(inner, target[used] - l1 * signs[used])
            now = beta[used]
            if (goal * signs[used] < 0).any():
                way = goal - now
                with np.errstate(divide="ignore", invalid="ignore"):
                    share = np.where(now * goal < 0, now / -way, np.inf)
                stops = np.unique(np.append(share[(share > 0) & (share < 1)], 1.0))
                points = now[:, None] + way[:, None] * stops
                points[np.abs(points) < 1e-14 * np.abs(now).max(initial=1e-300)] = 0.0
                worth = (points * (inner @ points)).sum(axis=0) / 2 - target[used] @ points + l1 * np.abs(points).sum(axis=0)
                beta[used] = points[:, worth.argmin()]
                new = np.sign(beta)
                if (new != signs).any():
                    signs = new
                    continue
            else:
                beta[used] = goal
        slope = target - cov @ beta - l2 * beta
        over = np.where(signs == 0, np.abs(slope), 0.0)
        worst = int(over.argmax())
        if over[worst] <= l1 * (1 + 1e-9) + 1e-13:
            return beta
        signs[worst] = np.sign(slope[worst])
    return beta


def descend(cov: np.ndarray, target: np.ndarray, l1: np.ndarray, l2: np.ndarray, variance: float,
            tolerance: float = 1e-7, steps: int = 20_000) -> np.ndarray:
    """Minimises b'Cb/2 - t'b + l1|b| + l2 b'b/2 for each penalty, one column each.

    Penalties of one kind follow one another from the greatest on, each from the solution before.  A column whose
    duality gap is not below ``tolerance`` times the label's variance is an error.
    """
    out = np.zeros((len(target), len(l1)))
    beta = np.zeros(len(target))
    order = np.lexsort((-l1, np.round(np.log(np.maximum(l2, 1e-300) / np.maximum(l1, 1e-300)), 6)))
    for k, i in enumerate(order):
        if k and l1[i] > l1[order[k - 1]]:
            beta = np.zeros(len(target))
        out[:, i] = beta = _one(cov, target, l1[i], l2[i], beta, steps)
    left = int((_gaps(cov, target, l1, l2, out, variance) > tolerance * max(variance, 1e-12)).sum())
    if left:
        raise ArithmeticError(f"{left} penalties did not reach a duality gap of {tolerance} in {steps} steps")
    return out


def geometric_path(m: Moments, points: int = 50, ratio: float = 1e-3) -> np.ndarray:
    """From the least penalty that zeroes every coefficient down to a thousandth of it."""
    top = np.abs(m.cov[:-1, -1]).max()
    return np.geomspace(top, top * ratio, points) if top > 0 else np.full(points, 1e-12)


def solved(train: Moments, alphas: np.ndarray, shares: np.ndarray, ridge: bool) -> np.ndarray:
    """Coefficients for each penalty, a column each.

    A ridge penalty weighs the sum of squared errors, the others its mean, as their usual definitions do.
    """
    cov, target = train.cov[:-1, :-1], train.cov[:-1, -1]
    if not ridge:
        return descend(cov, target, alphas * shares, alphas * (1 - shares), float(train.cov[-1, -1]))
    values, vectors = np.linalg.eigh(cov)
    return vectors @ ((vectors.T @ target)[:, None] / (np.maximum(values, 0.0)[:, None] + alphas / max(1, train.n)))


def search(parts: Sequence[Moments], penalties: Sequence[tuple[float, float]], ridge: bool = False) -> tuple[float, float]:
    """The (penalty, l1 share) with the least mean held-out error over the folds.

    ``parts`` are the scaled moments of each fold.
    """
    errors = np.zeros(len(penalties))
    alphas, shares = (np.array(c, dtype=float) for c in zip(*penalties))
    for k, held in enumerate(parts):
        train = merge([p for i, p in enumerate(parts) if i != k])
        for i, beta in enumerate(solved(train, alphas, shares, ridge).T):
            errors[i] += held_out_error(held, train.mean[-1] - train.mean[:-1] @ beta, beta)
    return penalties[int(np.argmin(errors))]
