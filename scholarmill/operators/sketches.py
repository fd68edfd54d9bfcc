"""Percentiles from mergeable quantile sketches that are kept per group and day.

A day's rows become one sketch per group, of bounded size; a percentile over any days merges their sketches and reads no
rows. A further day adds its own sketches and looks at nothing else. Up to about ``k`` values a sketch holds them all
and is exact; beyond, its rank error is about 2.3 / k ** 0.9.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of a sketch.
K = 4096


def rank_error(k: int = K) -> float:
    """Share of all values by which the rank of an estimate may be off, with a probability of 99 %."""
    return 2.296 / k ** 0.9021


def day_sketches(rows: DataFrame, value: str, group: str, k: int = K) -> DataFrame:
    """``(group, n, sketch)`` of the values that are not null."""
    measured = rows.where(F.col(value).isNotNull())
    return measured.groupBy(F.col(group).alias("group")).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def add_day(rows: DataFrame, day: str, value: str, group: str, path: str, k: int = K) -> None:
    """Stores the sketches of one day under ``path``; a day that is stored again replaces itself."""
    day_sketches(rows, value, group, k).write.mode("overwrite").parquet(f"{path}/day={day}")


def sketched_percentiles(spark: SparkSession, path: str, points: Sequence[float], first: str | None = None, last: str | None = None) -> DataFrame:
    """``(group, n, points)``: for each share the least stored value that so many values do not exceed.

    ``first`` and ``last`` are days, both inclusive; other days' files are not opened.
    """
    kept = spark.read.schema("group string, n bigint, sketch binary, day date").parquet(path)
    if first is not None:
        kept = kept.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        kept = kept.where(F.col("day") <= F.lit(last).cast("date"))
    whole = kept.groupBy("group").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return whole.select("group", "n", F.array(*(F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in points)).alias("points"))
