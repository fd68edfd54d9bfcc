"""The regressors on one feature, where the whole penalty search has a closed form that SQL can say."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.models import regress as R
from scholarmill.operators.evaluate import regression_metrics
from scholarmill.plans.registry import query
from scholarmill.plans.scored import ROWS_SQL, model_rows
from scholarmill.plans.shape import r6, rounded
from scholarmill.session import write_once


def one_feature_table(spark, folder) -> DataFrame:
    rows = VectorAssembler(inputCols=["x"], outputCol="raw").transform(model_rows(spark, folder))
    return write_once(rows.select("paper_id", "y", "split", "fold", "raw"), "one-feature", by="fold")


def _search_sql(path: str, shrink: str) -> str:
    """``path`` gives (i, alpha, share) from s(top); ``shrink`` the coefficient from c, v, alpha, share and n."""
    def beta(source: str) -> str:
        return shrink.replace("@c", f"{source}.c").replace("@v", f"{source}.v").replace("@n", f"{source}.n")

    return f"""{ROWS_SQL}, train AS (SELECT fold, x / (SELECT stddev_pop(x) FROM model_rows WHERE split = 'train') AS x, y
    FROM model_rows WHERE split = 'train'),
  whole AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(y, x) AS c, var_pop(x) AS v FROM train),
  path AS ({path}),
  seen AS (SELECT f.fold, count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(y, x) AS c, var_pop(x) AS v
    FROM (SELECT DISTINCT fold FROM train) f JOIN train t ON t.fold <> f.fold GROUP BY f.fold),
  held AS (SELECT fold, avg(x) AS mx, avg(y) AS my, covar_pop(y, x) AS c, var_pop(x) AS v, var_pop(y) AS vy FROM train GROUP BY fold),
  fits AS (SELECT path.i, path.alpha, path.share, seen.fold, seen.mx, seen.my, {beta('seen')} AS b FROM seen, path),
  errors AS (SELECT i, any_value(alpha) AS alpha, any_value(share) AS share,
      sum(h.vy - 2 * b * h.c + b * b * h.v + pow(h.my - (f.my - f.mx * b) - h.mx * b, 2)) AS e
    FROM fits f JOIN held h USING (fold) GROUP BY i),
  best AS (SELECT alpha, share FROM errors ORDER BY e, i LIMIT 1),
  model AS (SELECT alpha, share, {beta('whole')} AS b, whole.mx, whole.my FROM best, whole),
  scored AS (SELECT split, y, my + b * (x / (SELECT stddev_pop(x) FROM model_rows WHERE split = 'train') - mx) AS pred, b, alpha, share
    FROM model_rows, model)
  SELECT split, count(*) AS n, {r6('1 - sum(pow(y - pred, 2)) / (var_pop(y) * count(*))')} AS r2, {r6('avg(abs(y - pred))')} AS mae,
    {r6('any_value(alpha)')} AS alpha, {r6('any_value(share)')} AS l1_share, {r6('any_value(b)')} AS coef FROM scored GROUP BY split"""


_SOFT = ("sign(@c) * greatest(abs(@c) - path_.alpha * path_.share, 0) / (@v + path_.alpha * (1 - path_.share))")
_LASSO_PATH = "SELECT i, abs(c) * pow(1e-3, i / 49.0) AS alpha, 1.0 AS share FROM whole, range(50) r(i)"
_NET_PATH = """SELECT k * 50 + i AS i, pow(10.0, -4.0 * i / 49.0) AS alpha, s AS share
    FROM range(50) r(i), (VALUES (0, 0.1::DOUBLE), (1, 0.5), (2, 0.9)) z(k, s)"""
_RIDGE_PATH = "SELECT i, pow(10.0, 3.0 - 5.0 * i / 49.0) AS alpha, 0.0 AS share FROM range(50) r(i)"


def _fit_sql(path: str, shrink: str) -> str:
    """The refit reads the chosen penalty from ``best``, the folds read theirs from ``path``."""
    sql = _search_sql(path, shrink)
    head, tail = sql.split("model AS (", 1)
    return head.replace("path_.", "path.") + "model AS (" + tail.replace("path_.", "best.")


def _run(fit):
    def run(spark, folder) -> DataFrame:
        table = one_feature_table(spark, folder)
        fitted = fit(table)
        return rounded(regression_metrics(fitted.score(table), ["split"]).select(
            "split", "n", "r2", "mae", F.lit(float(fitted.alpha)).alias("alpha"), F.lit(float(fitted.l1_share)).alias("l1_share"),
            F.lit(float(fitted.coefficients[0])).alias("coef")))
    return run


query("lasso_one_feature", _fit_sql(_LASSO_PATH, _SOFT))(_run(R.fit_lasso))
query("net_one_feature", _fit_sql(_NET_PATH, _SOFT))(_run(lambda t: R.fit_net(t, shares=R.NET_SHARES_ANALYSIS)))
query("ridge_one_feature", _fit_sql(_RIDGE_PATH, "@c / (@v + path_.alpha / @n)"))(
    _run(lambda t: R.fit_ridge(t, path=R.RIDGE_PATH_ANALYSIS)))


@query("ablation_one_feature", f"""SELECT 'x' AS feature, 'completed' AS status, r2 AS r2_full, r2_without,
    CASE WHEN abs((r2 - r2_without) / abs(r2) * 100) < 5 THEN 'none' WHEN (r2 - r2_without) / abs(r2) * 100 > 15 THEN 'substantial'
      ELSE 'moderate' END AS verdict
  FROM ({_fit_sql(_LASSO_PATH, _SOFT)}) f, ({ROWS_SQL} SELECT {r6('1 - sum(pow(y - m, 2)) / (var_pop(y) * count(*))')} AS r2_without
    FROM model_rows, (SELECT avg(y) AS m FROM model_rows WHERE split = 'train') t WHERE split = 'test') w WHERE f.split = 'test'""")
def ablation_one_feature(spark, folder) -> DataFrame:
    """What the one feature adds beside a constant: without it the mean is left."""
    rows = VectorAssembler(inputCols=["x", "one"], outputCol="raw").transform(model_rows(spark, folder).withColumn("one", F.lit(1.0)))
    table = write_once(rows.select("paper_id", "y", "split", "fold", "raw"), "one-feature-and-constant", by="fold")
    return rounded(R.ablation(table, ["x", "one"], "x").select("feature", "status", "r2_full", "r2_without", "verdict"))
