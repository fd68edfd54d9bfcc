"""Queries over a scored table, on a one-feature model that SQL can fit too.

The same operators take the tables scored by the fitted models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.functions.labels import ablation_verdict
from scholarmill.functions.numbers import normal_percentile
from scholarmill.operators import evaluate as E
from scholarmill.operators import explain as W
from scholarmill.operators import score as S
from scholarmill.operators.ranks import percentile_of_score
from scholarmill.operators.split import with_fold, with_split
from scholarmill.operators.univariate import score_line, score_mean, score_out_of_fold
from scholarmill.operators.tfidf import vocabulary_table
from scholarmill.plans.features import TERMS_SQL, fitted_vocabulary
from scholarmill.plans.registry import query
from scholarmill.plans.shape import big, r6, rounded
from scholarmill.session import write_once
from scholarmill.sources.stand_ins import DATED_SQL, dated_counts, papers_text


def model_rows(spark, folder) -> DataFrame:
    """log1p of the 24-month count against log1p of the 12-month count.

    Written once: the fit, the score and every cut point read this narrow table, not the events.
    """
    rows = dated_counts(spark, folder).select(
        "paper_id", "category", "author_count", "citations_24mo", F.log1p("citations_12mo").alias("x"),
        F.log1p("citations_24mo").alias("y"))
    return write_once(with_fold(with_split(rows)), "model-rows")


def line_scored(spark, folder) -> DataFrame:
    return score_line(model_rows(spark, folder))


def oof_scored(spark, folder) -> DataFrame:
    return score_out_of_fold(model_rows(spark, folder))


_BUCKET = "CAST(concat('0x', substr(md5({0}CAST(paper_id AS VARCHAR)), 1, 8)) AS BIGINT) % 5"
ROWS_SQL = f"""{DATED_SQL}, model_rows AS (SELECT paper_id, category, author_count, citations_24mo,
    ln(1 + citations_12mo) AS x, ln(1 + citations_24mo) AS y,
    CASE WHEN {_BUCKET.format('')} = 0 THEN 'test' ELSE 'train' END AS split,
    {_BUCKET.format("'fold-' || ")} AS fold FROM horizon)"""
SCORED_SQL = f"""{ROWS_SQL}, line AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM model_rows WHERE split = 'train'),
  scored AS (SELECT *, a + b * x AS pred FROM model_rows, line)"""
OOF_SQL = f"""{ROWS_SQL}, lines AS (SELECT f.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
    FROM (SELECT DISTINCT fold FROM model_rows) f JOIN model_rows r ON r.fold <> f.fold GROUP BY f.fold),
  scored AS (SELECT r.*, a + b * x AS pred FROM model_rows r JOIN lines USING (fold))"""


def _metrics_sql(key: str, keep: str = "n, r2, mae, rmse, bias", source: str = "scored") -> str:
    """Metrics with a two-pass spread, unlike the one-pass form the query uses."""
    parts = {"n": "count(*) AS n",
             "r2": f"{r6('1 - sum((y - pred) * (y - pred)) / sum((y - mu) * (y - mu))')} AS r2",
             "mae": f"{r6('avg(abs(y - pred))')} AS mae",
             "rmse": f"{r6('sqrt(avg((y - pred) * (y - pred)))')} AS rmse",
             "bias": f"{r6('avg(pred - y)')} AS bias",
             "mean_citations": f"{r6('avg(citations_24mo)')} AS mean_citations"}
    cols = ", ".join(parts[k.strip()] for k in keep.split(","))
    over = f"PARTITION BY {key}" if key else ""
    head, tail = (f"{key}, ", f"GROUP BY {key}") if key else ("", "")
    return f"SELECT {head}{cols} FROM (SELECT *, avg(y) OVER ({over}) AS mu FROM {source}) {tail}"


@query("regression_metrics", f"{SCORED_SQL} {_metrics_sql('')}")
def regression_metrics(spark, folder) -> DataFrame:
    return rounded(E.regression_metrics(line_scored(spark, folder)))


@query("metrics_by_category", f"{SCORED_SQL} {_metrics_sql('category')}")
def metrics_by_category(spark, folder) -> DataFrame:
    return rounded(E.metrics_by_category(line_scored(spark, folder)))


LEVELS_SQL = f"""{SCORED_SQL}, q AS (SELECT quantile_cont(citations_24mo::DOUBLE, [0.25, 0.5, 0.75]) AS q FROM scored),
  levels AS (SELECT scored.*, CASE WHEN citations_24mo <= q.q[1] THEN 'low' WHEN citations_24mo <= q.q[2] THEN 'medium_low'
    WHEN citations_24mo <= q.q[3] THEN 'medium_high' ELSE 'high' END AS level FROM scored, q)"""


@query("metrics_by_citation_level", f"{LEVELS_SQL} {_metrics_sql('level', 'n, r2, mae, mean_citations', 'levels')}")
def metrics_by_citation_level(spark, folder) -> DataFrame:
    return rounded(E.metrics_by_citation_level(line_scored(spark, folder)))


@query("metrics_by_author_count", f"""{SCORED_SQL} SELECT {big('author_count')} AS author_count, n, r2, mae
  FROM ({_metrics_sql('author_count')}) WHERE n >= 5""")
def metrics_by_author_count(spark, folder) -> DataFrame:
    return rounded(E.metrics_by_author_count(line_scored(spark, folder)))


@query("metrics_by_uncertainty", f"""{SCORED_SQL}, q AS (SELECT quantile_cont(abs(y - pred), 0.33) AS lo,
    quantile_cont(abs(y - pred), 0.67) AS hi FROM scored),
  bands AS (SELECT scored.*, CASE WHEN abs(y - pred) <= lo THEN 'easy' WHEN abs(y - pred) <= hi THEN 'medium'
    ELSE 'hard' END AS band FROM scored, q) {_metrics_sql('band', 'n, r2, mae', 'bands')}""")
def metrics_by_uncertainty(spark, folder) -> DataFrame:
    return rounded(E.metrics_by_uncertainty(line_scored(spark, folder)))


@query("worst_strata", f"""{LEVELS_SQL}, kinds AS (
    SELECT 'category' AS kind, category AS stratum, r2 FROM ({_metrics_sql('category')})
    UNION ALL SELECT 'citation_level', level, r2 FROM ({_metrics_sql('level', 'n, r2', 'levels')})),
  total AS ({_metrics_sql('')})
  SELECT kind, arg_min(stratum, k.r2) AS worst, min(k.r2) AS worst_r2, any_value(t.r2) AS overall_r2,
    {r6('any_value(t.r2) - min(k.r2)')} AS gap FROM kinds k, total t GROUP BY kind""")
def worst_strata(spark, folder) -> DataFrame:
    rows = rounded(E.worst_strata(write_once(line_scored(spark, folder), "scored")))
    return rounded(rows.withColumn("gap", F.col("overall_r2") - F.col("worst_r2")))


@query("bias_flags", f"""{SCORED_SQL}, b AS (SELECT category, avg(pred - y) AS bias FROM scored GROUP BY category)
  SELECT category, {r6('bias')} AS bias, {r6('100 * (exp(abs(bias)) - 1)')} AS implied_pct, abs(bias) > 0.2 AS is_biased,
    {r6('(SELECT max(abs(bias)) FROM b)')} AS max_abs_bias FROM b""")
def bias_flags(spark, folder) -> DataFrame:
    return rounded(E.bias_flags(line_scored(spark, folder)))


@query("calibration", f"""{OOF_SQL}, s AS (SELECT stddev_pop(y - pred) AS sd FROM scored),
  z(nominal, z) AS (VALUES (0.68::DOUBLE, 1.0::DOUBLE), (0.9, 1.645), (0.95, 1.96), (0.99, 2.576)),
  c AS (SELECT nominal, z, any_value(sd) AS sd, avg(CASE WHEN abs(y - pred) <= z * sd THEN 1.0 ELSE 0.0 END) AS emp
    FROM scored, s, z GROUP BY nominal, z)
  SELECT nominal, z, {r6('sd')} AS residual_std, {r6('emp')} AS empirical, abs(emp - nominal) < 0.05 AS is_calibrated,
    CASE WHEN abs(emp - nominal) < 0.05 THEN 'ok' WHEN emp > nominal THEN 'too_wide' ELSE 'too_narrow' END AS verdict FROM c""")
def calibration(spark, folder) -> DataFrame:
    return rounded(E.calibration(oof_scored(spark, folder)))


@query("oof_predictions", f"{OOF_SQL} SELECT paper_id, {big('fold')} AS fold, {r6('y')} AS y, {r6('pred')} AS pred FROM scored")
def oof_predictions(spark, folder) -> DataFrame:
    return rounded(oof_scored(spark, folder).select("paper_id", "fold", "y", "pred"))


@query("residual_diagnostics", f"""{SCORED_SQL}, s AS (SELECT stddev_pop(y - pred) AS sd, avg(y) AS mu FROM scored),
  m AS (SELECT count(*) AS n, any_value(sd) AS residual_std, count(*) FILTER (WHERE y > pred) AS n_positive,
    count(*) FILTER (WHERE y < pred) AS n_negative, corr(abs(y - pred), abs(pred)) AS spread_corr,
    count(*) FILTER (WHERE abs(y - pred) > 4 * sd) AS n_far, min(y) AS y_min, max(y) AS y_max, stddev_pop(y) AS y_std,
    min(pred) AS pred_min, max(pred) AS pred_max, 1 - sum((y - pred) * (y - pred)) / sum((y - mu) * (y - mu)) AS r2 FROM scored, s)
  SELECT n, {', '.join(f'{r6(c)} AS {c}' for c in ('residual_std', 'spread_corr', 'y_min', 'y_max', 'y_std', 'pred_min',
                                                   'pred_max', 'r2'))}, n_positive, n_negative, n_far,
    residual_std > 0.01 AS varies, n_positive > 0 AND n_negative > 0 AS two_sided, spread_corr < 0.7 AS even_spread,
    n_far <= greatest(2, floor(n * 0.02)) AS few_far,
    pred_min >= y_min - 2 * y_std AND pred_max <= y_max + 2 * y_std AS in_range, r2 > 0 AS beats_mean FROM m""")
def residual_diagnostics(spark, folder) -> DataFrame:
    return rounded(E.residual_diagnostics(line_scored(spark, folder)))


@query("fold_stability", f"""{OOF_SQL}, per AS ({_metrics_sql('fold', 'n, r2')})
  SELECT count(*) AS n_folds, {r6('avg(r2)')} AS mean_r2, {r6('stddev_pop(r2)')} AS std_r2, {r6('max(r2) - min(r2)')} AS range_r2,
    avg(r2) > 0 AND stddev_pop(r2) / abs(avg(r2)) >= 0.5 AS is_unstable FROM per""")
def fold_stability(spark, folder) -> DataFrame:
    return rounded(E.fold_stability(oof_scored(spark, folder)))


def two_models(spark, folder) -> DataFrame:
    rows = model_rows(spark, folder)
    return (score_mean(rows).withColumn("model", F.lit("mean"))
            .unionByName(score_line(rows).withColumn("model", F.lit("line"))))


_WIDE = ", ".join(f"max({m}) FILTER (WHERE split = '{s}') AS {s}_{m}" for s in ("train", "test") for m in ("r2", "mae", "rmse"))
COMPARE_SQL = f"""{SCORED_SQL}, means AS (SELECT avg(y) AS m FROM model_rows WHERE split = 'train'),
  paired AS (SELECT 'line' AS model, split, y, pred FROM scored
    UNION ALL SELECT 'mean', split, y, m FROM model_rows, means),
  per AS (SELECT model, split, 1 - sum((y - pred) * (y - pred)) / sum((y - mu) * (y - mu)) AS r2, avg(abs(y - pred)) AS mae,
      sqrt(avg((y - pred) * (y - pred))) AS rmse
    FROM (SELECT *, avg(y) OVER (PARTITION BY model, split) AS mu FROM paired) GROUP BY model, split),
  wide AS (SELECT model, {_WIDE} FROM per GROUP BY model)"""


@query("model_comparison", f"""{COMPARE_SQL} SELECT model, {', '.join(f'{r6(f"{s}_{m}")} AS {s}_{m}' for s in ('train', 'test')
                           for m in ('r2', 'mae', 'rmse'))}, {r6('train_r2 - test_r2')} AS gap,
  CASE WHEN train_r2 - test_r2 < 0.05 THEN 'good' WHEN train_r2 - test_r2 > 0.15 THEN 'overfit' ELSE 'moderate' END AS verdict
  FROM wide""")
def model_comparison(spark, folder) -> DataFrame:
    return rounded(E.model_comparison(two_models(spark, folder)))


@query("best_model", f"{COMPARE_SQL} SELECT arg_max(model, test_r2) AS best, {r6('max(test_r2)')} AS best_r2 FROM wide")
def best_model(spark, folder) -> DataFrame:
    return rounded(E.best_model(E.model_comparison(two_models(spark, folder))))


@query("baseline_model", f"""{ROWS_SQL}, m AS (SELECT avg(y) AS pred FROM model_rows WHERE split = 'train')
  {_metrics_sql('split', 'n, r2, mae, rmse, bias', '(SELECT r.*, m.pred FROM model_rows r, m)')}""")
def baseline_model(spark, folder) -> DataFrame:
    return rounded(E.regression_metrics(score_mean(model_rows(spark, folder)), ["split"]))


@query("actual_vs_predicted", f"""{SCORED_SQL}, p AS (SELECT paper_id, citations_24mo::DOUBLE AS actual, exp(pred) - 1 AS predicted FROM scored)
  SELECT paper_id, {r6('actual')} AS actual, {r6('predicted')} AS predicted,
    {r6('(SELECT max(greatest(actual, predicted)) FROM p)')} AS axis_max FROM p""")
def actual_vs_predicted(spark, folder) -> DataFrame:
    return rounded(E.actual_vs_predicted(line_scored(spark, folder)))


@query("actual_vs_predicted_bins", f"""{SCORED_SQL}, p AS (SELECT citations_24mo::DOUBLE AS actual, exp(pred) - 1 AS predicted FROM scored),
  w AS (SELECT max(greatest(actual, predicted)) / 50 AS w FROM p)
  SELECT {big('greatest(0, least(floor(actual / w), 49))')} AS actual_bin,
    {big('greatest(0, least(floor(predicted / w), 49))')} AS predicted_bin, count(*) AS n_papers FROM p, w GROUP BY 1, 2""")
def actual_vs_predicted_bins(spark, folder) -> DataFrame:
    return rounded(E.actual_vs_predicted_bins(line_scored(spark, folder)))


@query("residual_box", f"""{SCORED_SQL}, r AS (SELECT category, citations_24mo - (exp(pred) - 1) AS r FROM scored),
  q AS (SELECT category, min(r) AS lowest, quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.5) AS median,
    quantile_cont(r, 0.75) AS q3, max(r) AS highest FROM r GROUP BY category)
  SELECT category, {', '.join(f'{r6(c)} AS {c}' for c in ('lowest', 'q1', 'median', 'q3', 'highest'))},
    {r6('q1 - 1.5 * (q3 - q1)')} AS lower_fence, {r6('q3 + 1.5 * (q3 - q1)')} AS upper_fence FROM q""")
def residual_box(spark, folder) -> DataFrame:
    return rounded(E.residual_box(line_scored(spark, folder)))


@query("prediction_interval", f"""{SCORED_SQL}, s AS (SELECT stddev_pop(y - pred) AS sd FROM scored)
  SELECT paper_id, {r6('pred - 1.96 * sd')} AS ci_lower, {r6('pred + 1.96 * sd')} AS ci_upper,
    {r6('exp(pred - 1.96 * sd) - 1')} AS raw_lower, {r6('exp(pred + 1.96 * sd) - 1')} AS raw_upper FROM scored, s""")
def prediction_interval(spark, folder) -> DataFrame:
    scored = line_scored(spark, folder)
    return rounded(S.with_interval(scored, S.Z95 * S.residual_std(scored))
                   .select("paper_id", "ci_lower", "ci_upper", "raw_lower", "raw_upper"))


# the same formula, written out over t and the absolute z
_CDF_SQL = """CASE WHEN z >= 0 THEN 1 - tail ELSE tail END"""
_NORMAL_SQL = """zs AS (SELECT *, (pred - mean) / std AS z, 1 / (1 + 0.3275911 * abs((pred - mean) / std) / sqrt(2)) AS t FROM {0}),
  tails AS (SELECT *, 0.5 * exp(-z * z / 2) * (0.254829592 * t - 0.284496736 * power(t, 2) + 1.421413741 * power(t, 3)
    - 1.453152027 * power(t, 4) + 1.061405429 * power(t, 5)) AS tail FROM zs)"""


@query("normal_percentile", f"""{SCORED_SQL}, held AS (SELECT paper_id, pred, (SELECT avg(y) FROM scored) AS mean,
    (SELECT stddev_pop(y) FROM scored) AS std FROM scored), {_NORMAL_SQL.format('held')}
  SELECT paper_id, {r6(f'greatest(0, least(100, 100 * ({_CDF_SQL})))')} AS percentile FROM tails""")
def normal_percentiles(spark, folder) -> DataFrame:
    """Mean and deviation come from the observed log counts."""
    scored = line_scored(spark, folder)
    m = scored.agg(F.struct(F.avg("y").alias("mean"), F.stddev_pop("y").alias("std"))).scalar()
    return rounded(scored.select("paper_id", normal_percentile(F.col("pred"), m["mean"], m["std"]).alias("percentile")))


@query("score_with_default", f"""{SCORED_SQL}, held AS (SELECT paper_id, CASE WHEN paper_id % 9 <> 0 THEN pred END AS pred,
    3.28::DOUBLE AS mean, 0.99::DOUBLE AS std FROM scored), {_NORMAL_SQL.format('held')}
  SELECT paper_id, pred IS NULL AS is_default, {r6('coalesce(pred, 3.28)')} AS predicted_log,
    {r6('CASE WHEN pred IS NULL THEN 26.0 ELSE greatest(0, exp(pred) - 1) END')} AS predicted_raw,
    {r6(f'CASE WHEN pred IS NULL THEN 50.0 ELSE 100 * ({_CDF_SQL}) END')} AS percentile,
    {r6('coalesce(pred - 0.5, 2.78)')} AS ci_lower, {r6('coalesce(pred + 0.5, 3.78)')} AS ci_upper FROM tails""")
def score_with_default(spark, folder) -> DataFrame:
    """Every ninth paper has no score and gets the default row."""
    held = line_scored(spark, folder).select(
        "paper_id", F.when(F.col("paper_id") % 9 != 0, F.col("pred")).alias("pred"))
    return rounded(S.score_log(held).drop("pred"))


RANK_SQL = f"""{SCORED_SQL}, s AS (SELECT paper_id, pred, exp(pred) - 1 AS predicted_citations FROM scored),
  ranked AS (SELECT s.paper_id, s.pred, s.predicted_citations,
      count(*) FILTER (WHERE o.citations_24mo < s.predicted_citations) AS l,
      count(*) FILTER (WHERE o.citations_24mo <= s.predicted_citations) AS r, count(*) AS n
    FROM s, horizon o GROUP BY ALL),
  results AS (SELECT *, (l + r + CASE WHEN l < r THEN 1 ELSE 0 END) * 50.0 / n AS percentile FROM ranked)"""


@query("percentile_of_score", f"""{SCORED_SQL}, s AS (SELECT paper_id, round(exp(pred) - 1, 0) AS predicted_citations FROM scored),
  d AS (SELECT predicted_citations AS v,
      (SELECT count(*) FROM horizon WHERE citations_24mo < predicted_citations) AS l,
      (SELECT count(*) FROM horizon WHERE citations_24mo <= predicted_citations) AS r
    FROM (SELECT DISTINCT predicted_citations FROM s))
  SELECT paper_id, {r6('predicted_citations')} AS predicted_citations,
    {r6('(l + r + CASE WHEN l < r THEN 1 ELSE 0 END) * 50.0 / (SELECT count(*) FROM horizon)')} AS percentile
  FROM s JOIN d ON s.predicted_citations = d.v""")
def percentile_of_scores(spark, folder) -> DataFrame:
    """Rounded scores, so that many of them tie with observed counts."""
    scored = line_scored(spark, folder)
    scores = scored.select("paper_id", F.round(F.expm1("pred"), 0).alias("predicted_citations"))
    return rounded(percentile_of_score(scores, "predicted_citations", scored, "citations_24mo"))


@query("percentile_of_measure", f"""{SCORED_SQL}, s AS (SELECT paper_id, author_count, round(abs(y - pred), 2) AS v FROM scored),
  d AS (SELECT v, (SELECT count(*) FROM s o WHERE o.author_count > 4 AND o.v < u.v) AS l,
      (SELECT count(*) FROM s o WHERE o.author_count > 4 AND o.v <= u.v) AS r FROM (SELECT DISTINCT v FROM s) u)
  SELECT paper_id, {r6('v')} AS residual, {r6('(l + r + CASE WHEN l < r THEN 1 ELSE 0 END) * 50.0 / (SELECT count(*) FROM s WHERE author_count > 4)')}
    AS percentile FROM s JOIN d USING (v)""")
def percentile_of_measure(spark, folder) -> DataFrame:
    """Measured values with ties: each paper's residual among those of papers with many authors."""
    sized = line_scored(spark, folder).select("paper_id", "author_count", F.round(F.abs(F.col("y") - F.col("pred")), 2).alias("residual"))
    many = sized.where("author_count > 4")
    return rounded(percentile_of_score(sized.drop("author_count"), "residual", many, "residual"))


def observed_results(spark, folder) -> DataFrame:
    scored = line_scored(spark, folder)
    return S.score_observed(scored, scored, scored)


@query("batch_score", f"""{RANK_SQL}, s2 AS (SELECT stddev_pop(y - pred) AS sd FROM scored)
  SELECT paper_id, {r6('predicted_citations')} AS predicted_citations, {r6('percentile')} AS percentile,
    {r6('exp(pred - 1.96 * sd) - 1')} AS ci_lower, {r6('exp(pred + 1.96 * sd) - 1')} AS ci_upper FROM results, s2""")
def batch_score(spark, folder) -> DataFrame:
    return rounded(observed_results(spark, folder).select("paper_id", "predicted_citations", "percentile", "ci_lower",
                                                          "ci_upper"))


@query("batch_summary", f"""{RANK_SQL} SELECT {r6('avg(predicted_citations)')} AS mean_prediction,
  {r6('quantile_cont(percentile, 0.5)')} AS median_percentile, count(*) FILTER (WHERE percentile >= 75) AS n_top_quartile FROM results""")
def batch_summary(spark, folder) -> DataFrame:
    return rounded(S.batch_summary(write_once(observed_results(spark, folder), "results")))


def literal_coefficients(spark, folder) -> DataFrame:
    """A weight, drawn from its hash, for each term of the fitted vocabulary."""
    terms = vocabulary_table(papers_text(spark, folder), fitted_vocabulary(spark, folder))
    return terms.select(F.concat(F.lit("tfidf_"), "term").alias("feature"),
                        (F.conv(F.substring(F.md5("term"), 3, 4), 16, 10).cast("double") / 1000 - 32).alias("coef"))


HITS_SQL = f"""{TERMS_SQL}, coefficients AS (SELECT term,
    CAST(concat('0x', substr(md5(term), 3, 4)) AS BIGINT)::DOUBLE / 1000 - 32 AS coef FROM vocabulary),
  hits AS (SELECT paper_id, term, coef FROM papers_text JOIN coefficients ON coef <> 0
    AND contains(lower(title || ' ' || abstract), term))"""


@query("word_contributions", f"{HITS_SQL} SELECT paper_id, term, {r6('coef')} AS coef FROM hits")
def word_contributions(spark, folder) -> DataFrame:
    """The terms also match inside longer words, as they should."""
    return rounded(W.word_contributions(papers_text(spark, folder), literal_coefficients(spark, folder)))


@query("literal_importance", f"""{HITS_SQL}, weights AS (SELECT 'tfidf_' || term AS feature, coef FROM coefficients),
  tails AS (SELECT * FROM (SELECT * FROM weights WHERE coef < 0 ORDER BY coef, feature LIMIT 20)
    UNION ALL SELECT * FROM (SELECT * FROM weights WHERE coef > 0 ORDER BY coef DESC, feature LIMIT 20))
  SELECT feature, {r6('coef')} AS coef, replace(replace(replace(feature, 'tfidf_', ''), 'has_', 'has:'), 'cat_', 'cat:') AS label
  FROM tails""")
def literal_importance(spark, folder) -> DataFrame:
    """The twenty weights furthest below and above zero."""
    return rounded(W.feature_importance(literal_coefficients(spark, folder)))


@query("ablation_verdicts", """SELECT doc_id AS paper_id, CASE WHEN abs(doc_id % 61 - 30) < 5 THEN 'none' WHEN doc_id % 61 - 30 > 15 THEN 'substantial'
  ELSE 'moderate' END AS verdict FROM documents""")
def ablation_verdicts(spark, folder) -> DataFrame:
    change = (F.col("paper_id") % 61 - 30).cast("double")
    return papers_text(spark, folder).select("paper_id", ablation_verdict(change).alias("verdict"))


@query("top_words_per_paper", f"""{HITS_SQL} SELECT paper_id, rank, term, {r6('coef')} AS coef,
  CASE WHEN coef > 0 THEN 'increases' ELSE 'decreases' END AS direction
  FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY abs(coef) DESC, term) AS rank FROM hits) WHERE rank <= 10""")
def top_words_per_paper(spark, folder) -> DataFrame:
    return rounded(W.top_words(papers_text(spark, folder), literal_coefficients(spark, folder), 10))
