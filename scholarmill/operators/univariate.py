"""Least squares on one feature: the smallest model, fitted inside the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _line() -> Column:
    return F.struct(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"))


def score_line(rows: DataFrame) -> DataFrame:
    """Adds ``pred`` from a line through the training rows (``x``, ``y``, ``split``)."""
    line = rows.where(F.col("split") == "train").agg(_line().alias("l")).scalar()
    return (rows.withColumn("_l", line)
            .withColumn("pred", F.col("_l.intercept") + F.col("_l.slope") * F.col("x")).drop("_l"))


def score_mean(rows: DataFrame) -> DataFrame:
    """Adds ``pred``, the mean of the training rows."""
    mean = rows.where(F.col("split") == "train").agg(F.avg("y")).scalar()
    return rows.withColumn("pred", mean)


def score_out_of_fold(rows: DataFrame, folds: int = 5) -> DataFrame:
    """Adds ``pred`` from a line through the rows of all other folds.

    One pass feeds each row to the folds it trains, and the ``folds`` fitted lines come back as one
    array, so no row is shuffled.
    """
    others = F.filter(F.array(*(F.lit(k) for k in range(folds))), lambda k: k != F.col("fold"))
    lines = (rows.select("x", "y", F.explode(others).alias("k")).groupBy("k").agg(_line().alias("l"))
             .agg(F.map_from_entries(F.collect_list(F.struct("k", "l"))).alias("m")).scalar())
    return (rows.withColumn("_m", lines)
            .withColumn("_l", F.col("_m")[F.col("fold")])
            .withColumn("pred", F.col("_l.intercept") + F.col("_l.slope") * F.col("x")).drop("_m", "_l"))
