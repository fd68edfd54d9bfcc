"""Penalty search where features are too many for a matrix of their products.

Every penalty is fitted on the data, fold by fold, and all penalties of a fold are judged in one pass over it.  Scales
and the greatest penalty come from one pass that keeps a few numbers per feature.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.session import settings, ship, write_once

#: Fits that run at the same time.
AT_ONCE = 8

KEYS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def column_sums(rows: DataFrame, features: str = "raw", label: str = "y") -> tuple[int, float, np.ndarray, np.ndarray, np.ndarray]:
    """``(n, mean label, means, population deviations, covariances with the label)`` per feature, from one pass.

    Only cells that are not zero are looked at; they leave a task as one row per feature.
    """
    spark = ship(rows.sparkSession)
    middle = rows.agg(F.avg(label).alias("y"), F.count(label).alias("n")).first()
    n, mean_y = middle["n"], middle["y"] or 0.0
    width = 0 if not n else len(rows.select(features).first()[0])
    schema = pa.schema([("i", pa.int32()), ("x", pa.float64()), ("xx", pa.float64()), ("xy", pa.float64())])

    def run(batches):
        sums = np.zeros((3, width))
        for batch in batches:
            vectors, y = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False) - mean_y
            values, indices = pc.struct_field(vectors, "values"), pc.struct_field(vectors, "indices")
            length = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(length)), length)
            column = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
            sparse = pc.equal(pc.struct_field(vectors, "type"), 0).to_numpy(zero_copy_only=False)
            column[sparse[row]] = indices.flatten().to_numpy(zero_copy_only=False)
            x = values.flatten().to_numpy(zero_copy_only=False)
            for at, weight in enumerate((x, x * x, x * y[row])):
                sums[at] += np.bincount(column, weights=weight, minlength=width)
        used = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(s[used]) for s in sums)], schema=schema)

    sums = np.zeros((3, width))
    with settings(spark, KEYS):
        found = rows.select(F.unwrap_udt(features).alias("v"), F.col(label).cast("double")).mapInArrow(
            run, "i int, x double, xx double, xy double").groupBy("i").agg(F.sum("x"), F.sum("xx"), F.sum("xy"))
        for i, *own in found.toLocalIterator():
            sums[:, i] = own
    mean = sums[0] / max(1, n)
    spread = np.sqrt(np.maximum(sums[1] / max(1, n) - mean * mean, 0.0))
    spread = np.where(spread > 1e-9 * np.maximum(1.0, np.abs(mean)), spread, 1.0)
    return n, mean_y, mean, spread, sums[2] / max(1, n)


def greatest_penalty(spread: np.ndarray, with_label: np.ndarray) -> float:
    """The least penalty that zeroes every coefficient of the scaled features."""
    return max(float(np.abs(with_label / spread).max(initial=0.0)), 1e-12)


def scaled_rows(train: DataFrame, scaler: ElementwiseProduct) -> DataFrame:
    """Scaled once and written by fold: every fit reads the folds it needs."""
    return write_once(scaler.transform(train).select("fold", "scaled", "y"), "scaled", by="fold")


def fold_errors(rows: DataFrame, fold: int, estimators: Callable[[int, float], Sequence[LinearRegression]]) -> np.ndarray:
    """Mean squared error on one fold of a fit of each estimator on the others.

    ``estimators`` gets the number of training rows and their label's deviation.
    """
    train, held = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
    seen = train.agg(F.count("y").alias("n"), F.stddev_pop("y").alias("sd")).first()
    regressions = estimators(seen["n"], seen["sd"] or 1.0)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        models: list[LinearRegressionModel] = list(pool.map(lambda r: r.fit(train), regressions))
    judged = held
    for i, model in enumerate(models):
        judged = model.setPredictionCol(f"_pred{i}").transform(judged)
    error = judged.agg(*(F.avg((F.col("y") - F.col(f"_pred{i}")) ** 2).alias(f"e{i}") for i in range(len(models)))).first()
    return np.array([e if e is not None else 0.0 for e in error], dtype=float)


def search(rows: DataFrame, penalties: Sequence[tuple[float, float]], estimator: Callable[[float, float, int, float], LinearRegression],
           folds: int = 5) -> tuple[float, float]:
    """The (penalty, l1 share) with the least mean error over the folds of ``rows(fold, scaled, y)``."""
    total = np.zeros(len(penalties))
    for k in range(folds):
        total += fold_errors(rows, k, lambda n, sd: [estimator(a, s, n, sd) for a, s in penalties])
    return penalties[int(np.argmin(total))]
