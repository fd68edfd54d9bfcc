"""Ranks of scores among measured values, however many distinct ones there are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholarmill.session import write_once


def percentile_of_score(scores: DataFrame, score: str, observed: DataFrame, value: str) -> DataFrame:
    """Adds ``percentile``: the mean of the strict and the weak rank of each score, in percent; null for null, or without observations.

    Values and scores are first counted by value, so one that a third of all rows share is one row. The distinct values
    are sorted into ranges, a file each; a prefix sum over the ranges' sizes and a running sum inside each range give
    the number of observations up to every value. Scores fetch theirs by equality, so they are written first: computed
    again, a score that rests on a fit may differ in its last bit and would find nothing.
    """
    scores = write_once(scores, "scores")
    counted = observed.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    asked = scores.where(F.col(score).isNotNull()).select(F.col(score).cast("double").alias("_v")).distinct()
    points = counted.unionByName(asked.withColumn("_n", F.lit(0).cast("long"))).groupBy("_v").agg(F.sum("_n").alias("_n"))
    # written with the number of its range, so that the number stays whatever is computed again
    ranges = write_once(points.repartitionByRange("_v").withColumn("_range", F.spark_partition_id()), "value-ranges")
    sizes = ranges.groupBy("_range").agg(F.sum("_n").alias("_held"))
    # a row per range, as many as the shuffle has partitions
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"))
    upto = Window.partitionBy("_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranges.withColumn("_upto", F.sum("_n").over(upto)).join(before, "_range").select(
        "_v", (F.col("_before") + F.col("_upto")).alias("_weak"), "_n")
    below = F.col("_weak") - F.col("_n")
    total = sizes.agg(F.sum("_held")).scalar()
    rank = F.try_divide((below + F.col("_weak") + F.when(F.col("_n") > 0, 1).otherwise(0)) * F.lit(50.0), total)
    return (scores.join(ranked, scores[score].cast("double") == ranked["_v"], "left")
            .withColumn("percentile", F.when(F.col(score).isNotNull(), rank)).drop("_v", "_weak", "_n"))
