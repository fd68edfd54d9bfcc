"""Error metrics, strata, calibration and residual checks over one scored table.

A scored table has ``paper_id``, ``y``, ``pred`` (both on the log scale) and, where needed,
``category``, ``author_count``, ``citations_24mo``, ``split`` and ``fold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmill.functions.labels import fit_gap
from scholarmill.operators.quantiles import count_percentiles, measured_percentiles
from scholarmill.session import write_once

# Nominal coverage and the normal half-width that should reach it.
NOMINAL_Z = ((0.68, 1.0), (0.90, 1.645), (0.95, 1.96), (0.99, 2.576))
CALIBRATION_TOLERANCE = 0.05

# Limits of the residual checks.
MIN_SPREAD = 0.01
MAX_SPREAD_CORRELATION = 0.7
FAR_SIGMAS = 4
FAR_SHARE = 0.02
FAR_COUNT = 2
RANGE_SIGMAS = 2
MAX_FOLD_VARIATION = 0.5
BIAS_LIMIT = 0.2
MIN_AUTHOR_GROUP = 5


def residual() -> Column:
    return F.col("y") - F.col("pred")


def _r2(squared_error: Column) -> Column:
    """One less error over spread.  A constant y gives 1 if it is met exactly, else 0; fewer than two rows, null.

    The spread is the merged population variance, so one pass is enough and large means do not cancel.  Merged parts of
    a constant may differ in their last bit, so the least and the greatest y say whether it is one.
    """
    n, spread = F.count("y"), F.var_pop("y") * F.count("y")
    return F.when(n >= 2, F.when(F.min("y") == F.max("y"), F.when(squared_error == 0, 1.0).otherwise(0.0))
                  .otherwise(1.0 - squared_error / spread))


def regression_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """R2, MAE, RMSE and mean bias, per group if asked; combined on the map side."""
    r = residual()
    return (scored.where(F.col("y").isNotNull() & F.col("pred").isNotNull()).groupBy(*by)
            .agg(F.count("y").alias("n"), _r2(F.sum(r * r)).alias("r2"), F.avg(F.abs(r)).alias("mae"),
                 F.sqrt(F.avg(r * r)).alias("rmse"), F.avg(-r).alias("bias")))


def metrics_by_category(scored: DataFrame) -> DataFrame:
    return regression_metrics(scored, ["category"])


def metrics_by_citation_level(scored: DataFrame) -> DataFrame:
    cuts = count_percentiles(scored, "citations_24mo", [0.25, 0.5, 0.75]).select("points").scalar()
    c, q = F.col("citations_24mo"), F.col("_q")
    level = (F.when(c <= q[0], "low").when(c <= q[1], "medium_low")
             .when(c <= q[2], "medium_high").otherwise("high"))
    r = residual()
    return (scored.withColumn("_q", cuts).withColumn("level", level).groupBy("level")
            .agg(F.count("y").alias("n"), _r2(F.sum(r * r)).alias("r2"), F.avg(F.abs(r)).alias("mae"),
                 F.avg("citations_24mo").alias("mean_citations")))


def metrics_by_author_count(scored: DataFrame, least: int = MIN_AUTHOR_GROUP) -> DataFrame:
    return (regression_metrics(scored, ["author_count"]).where(F.col("n") >= least)
            .select("author_count", "n", "r2", "mae"))


def metrics_by_uncertainty(scored: DataFrame) -> DataFrame:
    # written once: the cuts are values of rows, which must not differ in their last bit when they are compared
    sized = write_once(scored.select("y", "pred", F.abs(residual()).alias("abs_residual")), "sized")
    cuts = measured_percentiles(sized, "abs_residual", [0.33, 0.67]).select("points").scalar()
    a, q = F.col("abs_residual"), F.col("_q")
    band = F.when(a <= q[0], "easy").when(a <= q[1], "medium").otherwise("hard")
    return (regression_metrics(sized.withColumn("_q", cuts).withColumn("band", band), ["band"])
            .select("band", "n", "r2", "mae"))


def worst_strata(scored: DataFrame) -> DataFrame:
    """The stratum with the least R2 per kind, and how far it lies below the whole."""
    kinds = (metrics_by_category(scored).select(F.lit("category").alias("kind"),
                                                F.col("category").alias("stratum"), "r2")
             .unionByName(metrics_by_citation_level(scored).select(
                 F.lit("citation_level").alias("kind"), F.col("level").alias("stratum"), "r2")))
    overall = regression_metrics(scored).select("r2").scalar()
    return (kinds.where(F.col("r2").isNotNull()).groupBy("kind")
            .agg(F.min_by("stratum", F.struct("r2", "stratum")).alias("worst"), F.min("r2").alias("worst_r2"))
            .withColumn("overall_r2", overall)
            .withColumn("gap", F.col("overall_r2") - F.col("worst_r2")))


def bias_flags(scored: DataFrame, limit: float = BIAS_LIMIT) -> DataFrame:
    """Bias per category, what it means in percent of citations, and the greatest of all."""
    per = metrics_by_category(scored).select("category", "bias")
    greatest = per.agg(F.max(F.abs("bias"))).scalar()
    return (per.withColumn("implied_pct", F.expm1(F.abs("bias")) * 100.0)
            .withColumn("is_biased", F.abs("bias") > limit)
            .withColumn("max_abs_bias", greatest))


def calibration(scored: DataFrame, levels: Sequence[tuple[float, float]] = NOMINAL_Z) -> DataFrame:
    """Share of residuals inside z population deviations, per nominal level.

    An empirical share above the nominal one means the intervals are too wide.
    """
    r = residual()
    rows = scored.where(F.col("y").isNotNull() & F.col("pred").isNotNull())
    sigma = rows.agg(F.stddev_pop(r)).scalar()
    inside = (rows.withColumn("_sigma", sigma).groupBy()
              .agg(F.first("_sigma").alias("residual_std"),
                   *(F.avg((F.abs(r) <= z * F.col("_sigma")).cast("int")).alias(str(i))
                     for i, (_, z) in enumerate(levels))))
    rows = F.array(*(F.struct(F.lit(nominal).alias("nominal"), F.lit(z).alias("z"),
                              F.col(str(i)).alias("empirical")) for i, (nominal, z) in enumerate(levels)))
    gap = F.col("x.empirical") - F.col("x.nominal")
    return (inside.select("residual_std", F.explode(rows).alias("x"))
            .select("x.nominal", "x.z", "residual_std", "x.empirical",
                    (F.abs(gap) < CALIBRATION_TOLERANCE).alias("is_calibrated"),
                    F.when(F.abs(gap) < CALIBRATION_TOLERANCE, "ok").when(gap > 0, "too_wide")
                    .otherwise("too_narrow").alias("verdict")))


def residual_diagnostics(scored: DataFrame) -> DataFrame:
    """One row of residual measures and the checks on them."""
    r = residual()
    sigma = scored.agg(F.stddev_pop(r)).scalar()
    m = scored.withColumn("_sigma", sigma).agg(
        F.count("y").alias("n"), F.first("_sigma").alias("residual_std"),
        F.count_if(r > 0).alias("n_positive"), F.count_if(r < 0).alias("n_negative"),
        F.corr(F.abs(r), F.abs("pred")).alias("spread_corr"),
        F.count_if(F.abs(r) > FAR_SIGMAS * F.col("_sigma")).alias("n_far"),
        F.min("y").alias("y_min"), F.max("y").alias("y_max"), F.stddev_pop("y").alias("y_std"),
        F.min("pred").alias("pred_min"), F.max("pred").alias("pred_max"), _r2(F.sum(r * r)).alias("r2"))
    reach = RANGE_SIGMAS * F.col("y_std")
    return m.withColumns({
        "varies": F.col("residual_std") > MIN_SPREAD,
        "two_sided": (F.col("n_positive") > 0) & (F.col("n_negative") > 0),
        "even_spread": F.coalesce(F.col("spread_corr") < MAX_SPREAD_CORRELATION, F.lit(True)),
        "few_far": F.col("n_far") <= F.greatest(F.lit(FAR_COUNT), F.floor(F.col("n") * FAR_SHARE)),
        "in_range": ((F.col("pred_min") >= F.col("y_min") - reach)
                     & (F.col("pred_max") <= F.col("y_max") + reach)),
        "beats_mean": F.col("r2") > 0.0})


def fold_stability(scored: DataFrame) -> DataFrame:
    """Mean, population deviation and range of R2 over folds."""
    per = regression_metrics(scored, ["fold"])
    return (per.agg(F.count("*").alias("n_folds"), F.avg("r2").alias("mean_r2"),
                    F.stddev_pop("r2").alias("std_r2"), (F.max("r2") - F.min("r2")).alias("range_r2"))
            .withColumn("is_unstable", (F.col("mean_r2") > 0) & F.coalesce(
                F.try_divide(F.col("std_r2"), F.abs("mean_r2")) >= MAX_FOLD_VARIATION, F.lit(False))))


def model_comparison(scored: DataFrame) -> DataFrame:
    """One row per model with its train and test metrics and the gap between them.

    ``scored`` holds the rows of all models with ``model`` and ``split``.
    """
    per = regression_metrics(scored, ["model", "split"])

    def of(split: str, name: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(name)))

    wide = per.groupBy("model").agg(*(of(s, m).alias(f"{s}_{m}") for s in ("train", "test")
                                      for m in ("r2", "mae", "rmse")))
    return wide.withColumn("gap", F.col("train_r2") - F.col("test_r2")) \
        .withColumn("verdict", fit_gap(F.col("train_r2"), F.col("test_r2")))


def best_model(comparison: DataFrame) -> DataFrame:
    """The model with the greatest test R2; by name among equals."""
    return comparison.agg(F.max_by("model", F.struct("test_r2", "model")).alias("best"),
                          F.max("test_r2").alias("best_r2"))


def actual_vs_predicted(scored: DataFrame) -> DataFrame:
    """Pairs on the raw scale with the common axis maximum."""
    pairs = scored.select("paper_id", F.col("citations_24mo").cast("double").alias("actual"),
                          F.expm1("pred").alias("predicted"))
    return pairs.withColumn("axis_max", pairs.agg(F.max(F.greatest("actual", "predicted"))).scalar())


def actual_vs_predicted_bins(scored: DataFrame, bins: int = 50) -> DataFrame:
    """The same pairs as counts on a grid, for sets too large to draw point by point."""
    pairs = actual_vs_predicted(scored)
    width = F.when(F.col("axis_max") > 0, F.col("axis_max") / bins).otherwise(1.0)

    def cell(c: str) -> Column:
        return F.greatest(F.lit(0), F.least(F.floor(F.col(c) / width), F.lit(bins - 1))).cast("int")

    return (pairs.groupBy(cell("actual").alias("actual_bin"), cell("predicted").alias("predicted_bin"))
            .agg(F.count("*").alias("n_papers")))


def residual_box(scored: DataFrame) -> DataFrame:
    """Five-number summary of raw residuals per category, with fences at 1.5 quartile ranges."""
    raw = scored.select("category", (F.col("citations_24mo") - F.expm1("pred")).alias("raw_residual"))
    p = F.col("points")
    spread = p[3] - p[1]
    return measured_percentiles(raw, "raw_residual", [0.0, 0.25, 0.5, 0.75, 1.0], ["category"]).select(
        "category", p[0].alias("lowest"), p[1].alias("q1"), p[2].alias("median"), p[3].alias("q3"),
        p[4].alias("highest"), (p[1] - 1.5 * spread).alias("lower_fence"),
        (p[3] + 1.5 * spread).alias("upper_fence"))
