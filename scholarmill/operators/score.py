"""From predictions to what a reader of them gets: counts, intervals, percentiles, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmill.functions.numbers import interval, normal_percentile, raw_count
from scholarmill.operators.quantiles import measured_percentiles
from scholarmill.operators.ranks import percentile_of_score

# 95 % half-width in deviations, half-width on the log scale, reference mean and deviation.
Z95 = 1.96
LOG_HALF_WIDTH = 0.5
LOG_MEAN = 3.28
LOG_STD = 0.99

# The row given where scoring fails.
DEFAULT_ROW = {"predicted_log": 3.28, "predicted_raw": 26.0, "percentile": 50.0,
               "ci_lower": 2.78, "ci_upper": 3.78}

TOP_QUARTILE = 75


def residual_std(scored: DataFrame) -> Column:
    """Population deviation of the residuals, once, as a scalar subquery."""
    return scored.agg(F.stddev_pop(F.col("y") - F.col("pred"))).scalar()


def with_interval(predictions: DataFrame, half_width: Column) -> DataFrame:
    """Bounds on the log scale and as counts; ``half_width`` is any expression."""
    low, high = interval(F.col("pred"), half_width)
    return predictions.withColumns({"ci_lower": low, "ci_upper": high,
                                    "raw_lower": F.expm1(low), "raw_upper": F.expm1(high)})


def score_log(predictions: DataFrame, mean: Column | None = None, std: Column | None = None) -> DataFrame:
    """Log and raw score, fixed log-scale interval and normal percentile.

    Rows without a score get the default row and are marked.
    """
    mean = F.lit(LOG_MEAN) if mean is None else mean
    std = F.lit(LOG_STD) if std is None else std
    low, high = interval(F.col("pred"), F.lit(LOG_HALF_WIDTH))
    made = {"predicted_log": F.col("pred"), "predicted_raw": raw_count(F.col("pred")),
            "percentile": normal_percentile(F.col("pred"), mean, std), "ci_lower": low, "ci_upper": high}
    failed = F.col("pred").isNull() | F.isnan("pred")
    return (predictions.withColumn("is_default", failed)
            .withColumns({n: F.when(F.col("is_default"), F.lit(DEFAULT_ROW[n])).otherwise(c)
                          for n, c in made.items()}))


def score_observed(predictions: DataFrame, scored: DataFrame, observed: DataFrame) -> DataFrame:
    """Raw score, interval from the residuals, and rank among the observed counts."""
    raw = predictions.withColumn("predicted_citations", F.expm1("pred"))
    ranked = percentile_of_score(raw, "predicted_citations", observed, "citations_24mo")
    low, high = interval(F.col("pred"), Z95 * F.col("_sigma"))
    return (ranked.withColumn("_sigma", residual_std(scored))
            .withColumns({"ci_lower": F.expm1(low), "ci_upper": F.expm1(high)}).drop("_sigma"))


def batch_summary(results: DataFrame) -> DataFrame:
    """Mean prediction, median percentile and how many rank in the top quartile."""
    median = measured_percentiles(results, "percentile", [0.5]).select(F.col("points")[0]).scalar()
    return (results.agg(F.avg("predicted_citations").alias("mean_prediction"),
                        F.count_if(F.col("percentile") >= TOP_QUARTILE).alias("n_top_quartile"))
            .withColumn("median_percentile", median))
