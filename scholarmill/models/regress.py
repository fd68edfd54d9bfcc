"""Fitting, comparing and explaining the regressors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.linalg import SparseVector
from pyspark.ml.regression import GBTRegressor, LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmill.functions.labels import ablation_verdict, feature_group
from scholarmill.models import wide
from scholarmill.models.assemble import population_scaler, scaler_of
from scholarmill.models.moments import MAX_FEATURES, Moments, fold_moments, geometric_path, merge, search, solved, width_of
from scholarmill.operators.evaluate import regression_metrics

# The penalties tried, the penalty of the out-of-fold model, and the trees' settings.
RIDGE_PATH = (-4.0, 4.0, 50)
RIDGE_PATH_ANALYSIS = (-2.0, 3.0, 50)
NET_SHARES_ANALYSIS = (0.1, 0.5, 0.9)
NET_PATH = (-4.0, 0.0, 50)
NET_SHARES = (0.5,)
OUT_OF_FOLD_ALPHA = 0.086
FOREST = {"numTrees": 200, "maxDepth": 8, "featureSubsetStrategy": "sqrt", "seed": 42}
BOOSTED = {"maxIter": 200, "maxDepth": 4, "stepSize": 0.1, "seed": 42}
BOOSTED_ANALYSIS = 100


@dataclass(frozen=True)
class Fitted:
    """A model from the raw vector to ``pred``, with what the search chose."""

    name: str
    model: PipelineModel
    alpha: float | None = None
    l1_share: float | None = None

    def score(self, rows: DataFrame) -> DataFrame:
        return self.model.transform(rows).drop("sliced", "scaled")

    @property
    def coefficients(self) -> np.ndarray:
        """On the scaled features."""
        return self.model.stages[-1].coefficients.toArray()


def train_rows(table: DataFrame) -> DataFrame:
    return table.where(F.col("split") == "train")


def deviations(whole: Moments) -> np.ndarray:
    """Population deviation per feature, one for a constant feature; the last, for the label, is one."""
    spread = np.sqrt(np.maximum(np.diag(whole.cov), 0.0))
    spread[-1] = 1.0
    return np.where(spread > 1e-12 * np.maximum(1.0, np.abs(whole.mean)), spread, 1.0)


def scaled(parts: list[Moments]) -> list[Moments]:
    """Moments per fold with every feature over its deviation on all rows."""
    spread = deviations(merge(parts))
    return [p.scaled(spread) for p in parts]


def scaled_moments(train: DataFrame) -> list[Moments]:
    return scaled(fold_moments(train))


def linear(alpha: float, l1_share: float, label_deviation: float, features: str = "scaled", normal: bool = True) -> LinearRegression:
    """The regression whose objective is mean squared error / 2 + alpha (l1 |b| + (1 - l1) b'b / 2).

    The library divides the label by its deviation first, which leaves an absolute penalty as it is
    and shrinks a squared one, so the squared part is multiplied back.  Without an absolute part the ``normal`` equations
    give the exact solution, as long as features are few enough for them.
    """
    squared = label_deviation * alpha * (1 - l1_share)
    total = alpha * l1_share + squared
    return LinearRegression(featuresCol=features, labelCol="y", predictionCol="pred", standardization=False,
                            regParam=total, elasticNetParam=alpha * l1_share / total if total > 0 else 0.0,
                            maxIter=500, tol=1e-9, solver="auto" if alpha * l1_share > 0 else "normal" if normal else "l-bfgs")


def plane(spark: SparkSession, intercept: float, beta: np.ndarray, features: str = "scaled") -> LinearRegressionModel:
    """The library's model with these numbers: the fit through the points that determine its plane, one per feature."""
    width = len(beta)
    points = [(SparseVector(width, {}), float(intercept)), *((SparseVector(width, {j: 1.0}), float(intercept + b)) for j, b in enumerate(beta))]
    rows = spark.createDataFrame(points, [features, "y"]).coalesce(1)
    return LinearRegression(featuresCol=features, labelCol="y", predictionCol="pred", standardization=False, regParam=0.0, solver="normal").fit(rows)


def fit_linear(name: str, train: DataFrame, alpha: float, l1_share: float, drop: int | None = None,
               ridge: bool = False, whole: Moments | None = None) -> Fitted:
    """Scales and fits on ``train``; ``drop`` leaves one feature out.

    With ``whole``, the moments of ``train`` without the dropped feature, the solver of the search gives the
    coefficients and no row is read.
    """
    stages, source = [], "raw"
    if drop is not None:
        width = width_of(train)
        stages.append(VectorSlicer(inputCol="raw", outputCol="sliced", indices=[i for i in range(width) if i != drop]))
        source = "sliced"
    if whole is not None:
        scaler, even = scaler_of(1.0 / deviations(whole)[:-1], source), whole.scaled(deviations(whole))
        beta = solved(even, np.array([alpha]), np.array([l1_share]), ridge)[:, 0]
        model = plane(train.sparkSession, even.mean[-1] - even.mean[:-1] @ beta, beta)
        return Fitted(name, PipelineModel([*stages, scaler, model]), alpha, l1_share)
    sliced = PipelineModel(stages).transform(train) if stages else train
    scaler = population_scaler(sliced, source)
    seen = train.agg(F.count("y").alias("n"), F.stddev_pop("y").alias("sd")).first()
    model = linear(alpha / seen["n"] if ridge else alpha, l1_share, seen["sd"] or 1.0, normal=width_of(train) <= MAX_FEATURES).fit(
        scaler.transform(sliced))
    return Fitted(name, PipelineModel([*stages, scaler, model]), alpha, l1_share)


def fit_searched(name: str, table: DataFrame, parts: list[Moments] | None, grid, ridge: bool = False, max_features: int = MAX_FEATURES) -> Fitted:
    """The fit on the training rows with the best penalty of ``grid``, a function of the greatest one that matters.

    Up to ``max_features`` the search solves on the moments of folds, beyond it fits on the data.
    """
    train = train_rows(table)
    if parts is not None or width_of(train) <= max_features:
        parts = parts or fold_moments(train)
        even = scaled(parts)
        alpha, share = search(even, grid(float(geometric_path(merge(even))[0])), ridge=ridge)
        return fit_linear(name, train, alpha, share, ridge=ridge, whole=merge(parts))
    _, _, _, spread, with_label = wide.column_sums(train)
    scaler = scaler_of(1.0 / spread)
    rows = wide.scaled_rows(train, scaler)

    def estimator(alpha, share, n, sd):
        return linear(alpha / n if ridge else alpha, share, sd, normal=False)

    alpha, share = wide.search(rows, grid(wide.greatest_penalty(spread, with_label)), estimator)
    seen = rows.agg(F.count("y").alias("n"), F.stddev_pop("y").alias("sd")).first()
    return Fitted(name, PipelineModel([scaler, estimator(alpha, share, seen["n"], seen["sd"] or 1.0).fit(rows)]), alpha, share)


def fit_lasso(table: DataFrame, parts: list[Moments] | None = None, points: int = 50, max_features: int = MAX_FEATURES) -> Fitted:
    """``parts``, here and below: the moments of the training rows per fold, taken if not given."""
    return fit_searched("lasso", table, parts, lambda top: [(a, 1.0) for a in np.geomspace(top, top * 1e-3, points)], max_features=max_features)


def fit_ridge(table: DataFrame, parts: list[Moments] | None = None,
              path: tuple[float, float, int] = RIDGE_PATH, max_features: int = MAX_FEATURES) -> Fitted:
    """``path``: exponents of the least and the greatest penalty, and their number."""
    low, high, points = path
    return fit_searched("ridge", table, parts, lambda _: [(a, 0.0) for a in np.logspace(high, low, points)], ridge=True, max_features=max_features)


def fit_net(table: DataFrame, parts: list[Moments] | None = None, path: tuple[float, float, int] = NET_PATH,
            shares: Sequence[float] = NET_SHARES, max_features: int = MAX_FEATURES) -> Fitted:
    low, high, points = path
    return fit_searched("elastic_net", table, parts, lambda _: [(a, s) for s in shares for a in np.logspace(high, low, points)],
                        max_features=max_features)


def fit_forest(table: DataFrame, **settings) -> Fitted:
    """Trees split on the raw features."""
    forest = RandomForestRegressor(featuresCol="raw", labelCol="y", predictionCol="pred", **{**FOREST, **settings})
    return Fitted("random_forest", PipelineModel([forest.fit(train_rows(table))]))


def fit_boosted(table: DataFrame, **settings) -> Fitted:
    trees = GBTRegressor(featuresCol="raw", labelCol="y", predictionCol="pred", **{**BOOSTED, **settings})
    return Fitted("boosted_trees", PipelineModel([trees.fit(train_rows(table))]))


def scored_by(models: list[Fitted], table: DataFrame) -> DataFrame:
    """The rows of all models under each other, with ``model``."""
    return reduce(DataFrame.unionByName,
                  [m.score(table).drop("raw").withColumn("model", F.lit(m.name)) for m in models])


def split_metrics(fitted: Fitted, table: DataFrame) -> DataFrame:
    """Metrics per split with the penalty the search chose."""
    return (regression_metrics(fitted.score(table), ["split"])
            .select(F.lit(fitted.name).alias("model"), "split", "n", "r2", "mae", "rmse",
                    F.lit(fitted.alpha).cast("double").alias("alpha"),
                    F.lit(fitted.l1_share).cast("double").alias("l1_share")))


def coefficient_table(fitted: Fitted, names: list[str], table: DataFrame) -> DataFrame:
    """Feature, group and coefficient; one row per feature."""
    rows = [(n, float(c)) for n, c in zip(names, fitted.coefficients, strict=True)]
    return (table.sparkSession.createDataFrame(rows, "feature string, coef double")
            .withColumn("feature_group", feature_group(F.col("feature"))))


def ablation(table: DataFrame, names: list[str], feature: str = "author_count") -> DataFrame:
    """Test R2 with and without one feature.

    The search without it uses the same moments less one row and column; only the refit reads data.
    """
    schema = ("feature string, status string, r2_full double, r2_without double")
    if feature not in names:
        row = [(feature, "skipped", None, None)]
    else:
        at = names.index(feature)
        parts = fold_moments(train_rows(table))
        full = fit_lasso(table, parts)
        fewer = [p.drop(at) for p in parts]
        alpha, share = search(scaled(fewer), [(a, 1.0) for a in geometric_path(merge(scaled(fewer)))])
        without = fit_linear("lasso_without", train_rows(table), alpha, share, drop=at, whole=merge(fewer))
        tests = table.where(F.col("split") == "test")
        r2 = [regression_metrics(m.score(tests)).first()["r2"] for m in (full, without)]
        row = [(feature, "completed", *r2)]
    delta = F.col("r2_full") - F.col("r2_without")
    change = F.when(F.col("r2_full") == 0, 0.0).otherwise(delta / F.abs("r2_full") * 100.0)
    return (table.sparkSession.createDataFrame(row, schema)
            .withColumn("delta_r2", delta).withColumn("pct_change", change)
            .withColumn("verdict", ablation_verdict(F.col("pct_change"))))


def out_of_fold(table: DataFrame, alpha: float = OUT_OF_FOLD_ALPHA, folds: int = 5) -> DataFrame:
    """Predictions for every row from a model that did not see its fold; scaled inside the fold."""
    scored, parts = [], fold_moments(table, folds)
    for k in range(folds):
        whole = merge([p for i, p in enumerate(parts) if i != k])
        fitted = fit_linear("lasso", table.where(F.col("fold") != k), alpha, 1.0, whole=whole)
        scored.append(fitted.score(table.where(F.col("fold") == k)))
    return reduce(DataFrame.unionByName, scored).drop("raw")
