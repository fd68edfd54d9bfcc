"""Queries that fit models on the given texts and labels.

The trained table and the lasso scoring model are kept as long as the session and the tables' files stay the same and
nothing is released, as a job that trains once and scores often would.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.functions.labels import feature_group
from scholarmill.models import regress as R
from scholarmill.models.assemble import FittedFeatures, fit_categories, fit_features, training_table
from scholarmill.models.bundle import ScoringModel, bundle
from scholarmill.models.moments import Moments
from scholarmill.operators import evaluate as E
from scholarmill.operators import explain as W
from scholarmill.operators import score as S
from scholarmill.operators.cohort import cohort
from scholarmill.operators.features import feature_columns
from scholarmill.operators.ranks import percentile_of_score
from scholarmill.operators.split import with_split
from scholarmill.operators.univariate import score_mean
from scholarmill.plans.features import KEYWORDS, STOP_WORDS, TERMS_SQL
from scholarmill.plans.registry import query
from scholarmill.plans.shape import rounded
from scholarmill.session import fresh_path, releases, write_once
from scholarmill.sources.stand_ins import TEXT_SQL, citations_text, papers_text
from scholarmill.sources.tables import read_upload, write_csv

_KEPT: dict[str, tuple[object, object]] = {}


def _files(spark, folder) -> tuple:
    """What the trained things depend on: the session and the files of the tables, with their sizes and times."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    listed = []
    for name in ("documents", "labels"):
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        store = path.getFileSystem(conf)
        found = store.listStatus(path) if store.exists(path) else []
        listed += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found]
    return (spark.sparkContext.applicationId, releases(spark), *sorted(listed))


def _once(spark, folder, what, make):
    """One kept value per name: another session, folder or other files replace it."""
    key = _files(spark, folder)
    if what not in _KEPT or _KEPT[what][0] != key:
        _KEPT[what] = key, make()
    return _KEPT[what][1]


def training_papers(spark, folder) -> DataFrame:
    joined = papers_text(spark, folder).join(citations_text(spark, folder), "paper_id")
    return cohort(joined, date(2022, 12, 31))


def trained(spark, folder) -> tuple[FittedFeatures, DataFrame]:
    def make():
        papers = training_papers(spark, folder)
        train = with_split(papers).where("split = 'train'")
        features = fit_features(train, fit_categories(train), KEYWORDS, STOP_WORDS)
        return features, training_table(papers, features, keep=("paper_id", "category"))
    return _once(spark, folder, "table", make)


def fold_parts(spark, folder) -> list[Moments]:
    """The moments of the training rows per fold, which every linear model is fitted on."""
    return _once(spark, folder, "moments", lambda: R.fold_moments(R.train_rows(trained(spark, folder)[1])))


def lasso(spark, folder) -> R.Fitted:
    return _once(spark, folder, "lasso", lambda: R.fit_lasso(trained(spark, folder)[1], fold_parts(spark, folder)))


def scoring_model(spark, folder) -> ScoringModel:
    def make():
        features, table = trained(spark, folder)
        return bundle(lasso(spark, folder), features, training_papers(spark, folder), table)
    return _once(spark, folder, "scoring", make)


def _metrics_of(fit):
    def run(spark, folder) -> DataFrame:
        table = trained(spark, folder)[1]
        return rounded(R.split_metrics(fit(spark, folder, table), table))
    return run


for _name, _fit in (("model_lasso", lambda s, f, t: lasso(s, f)), ("model_ridge", lambda s, f, t: R.fit_ridge(t, fold_parts(s, f))),
                    ("model_elasticnet", lambda s, f, t: R.fit_net(t, fold_parts(s, f))),
                    ("model_rf", lambda s, f, t: R.fit_forest(t)), ("model_gbt", lambda s, f, t: R.fit_boosted(t))):
    query(_name)(_metrics_of(_fit))


@query("linear_model_comparison")
def linear_model_comparison(spark, folder) -> DataFrame:
    """The linear models on one set of fold moments, next to each other."""
    table, parts = trained(spark, folder)[1], fold_parts(spark, folder)
    models = [lasso(spark, folder), R.fit_ridge(table, parts), R.fit_net(table, parts)]
    return rounded(E.model_comparison(R.scored_by(models, table)))


@query("coefficients")
def coefficients(spark, folder) -> DataFrame:
    features, table = trained(spark, folder)
    return rounded(R.coefficient_table(lasso(spark, folder), features.names, table))


@query("feature_importance")
def feature_importance(spark, folder) -> DataFrame:
    return rounded(W.feature_importance(coefficients(spark, folder)))


@query("lasso_card")
def lasso_card(spark, folder) -> DataFrame:
    return W.model_card(coefficients(spark, folder))


@query("lasso_top_words")
def lasso_top_words(spark, folder) -> DataFrame:
    return rounded(W.top_words(papers_text(spark, folder), coefficients(spark, folder)))


@query("ablation")
def ablation(spark, folder) -> DataFrame:
    features, table = trained(spark, folder)
    return rounded(R.ablation(table, features.names))


def lasso_out_of_fold(spark, folder) -> DataFrame:
    return _once(spark, folder, "oof", lambda: write_once(R.out_of_fold(trained(spark, folder)[1]), "out-of-fold"))


@query("lasso_out_of_fold")
def out_of_fold(spark, folder) -> DataFrame:
    return rounded(lasso_out_of_fold(spark, folder).select("paper_id", "fold", "y", "pred"))


@query("lasso_calibration")
def lasso_calibration(spark, folder) -> DataFrame:
    return rounded(E.calibration(lasso_out_of_fold(spark, folder)))


@query("lasso_metrics_by_category")
def lasso_metrics_by_category(spark, folder) -> DataFrame:
    return rounded(E.metrics_by_category(lasso(spark, folder).score(trained(spark, folder)[1])))


def same_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Per key whether both sides hold equal values; a key that one side lacks is not the same."""
    def whole(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key), F.struct(*sorted(c for c in df.columns if c != key)).alias(name))

    return whole(left, "a").join(whole(right, "b"), key, "full").select(
        key, F.coalesce(F.col("a").eqNullSafe(F.col("b")) & F.col("a").isNotNull(), F.lit(False)).alias("same"))


@query("model_roundtrip", "SELECT doc_id AS paper_id, true AS same FROM documents")
def model_roundtrip(spark, folder) -> DataFrame:
    """Predictions of the saved and reloaded model for all papers against those of the model in memory."""
    path = fresh_path(spark, "model")
    model, papers = scoring_model(spark, folder), papers_text(spark, folder)
    model.save(path, spark)
    scores = [rounded(m.with_bounds(m.predict(papers, ["paper_id"]))) for m in (ScoringModel.load(path, spark), model)]
    return same_rows(*scores, "paper_id")


@query("lasso_api_scores")
def lasso_api_scores(spark, folder) -> DataFrame:
    """The reply to a scoring request per paper: log score with half a unit either way and its normal percentile.

    Every ninth paper has no score and gets the default row.
    """
    model = scoring_model(spark, folder)
    pred = model.predict(papers_text(spark, folder), ["paper_id"])
    held = pred.select("paper_id", F.when(F.col("paper_id") % 9 != 0, F.col("pred")).alias("pred"))
    return rounded(S.score_log(held, F.lit(model.y_mean), F.lit(model.y_std)))


@query("comparison_table")
def comparison_table(spark, folder) -> DataFrame:
    return rounded(compared_models(spark, folder))


TRAIN_TERMS_SQL = TEXT_SQL + """, train_papers AS (SELECT p.* FROM papers_text p JOIN citations_text c USING (paper_id)
    WHERE submitted <= DATE '2022-12-31' AND citations_24mo IS NOT NULL AND length(abstract) > 10 AND length(title) > 3
      AND CAST(concat('0x', substr(md5(CAST(paper_id AS VARCHAR)), 1, 8)) AS BIGINT) % 5 <> 0)""" + TERMS_SQL.removeprefix(
    TEXT_SQL).replace("FROM papers_text", "FROM train_papers")


@query("coefficient_names", f"""{TRAIN_TERMS_SQL}, names AS (SELECT unnest([{", ".join(f"'{c}'" for c in feature_columns([], KEYWORDS))}]) AS feature
    UNION ALL SELECT DISTINCT 'cat_' || category FROM train_papers WHERE category IS NOT NULL UNION ALL SELECT 'tfidf_' || term FROM vocabulary)
  SELECT feature, CASE WHEN starts_with(feature, 'tfidf_') THEN 'tfidf' WHEN starts_with(feature, 'cat_') THEN 'cat'
    WHEN starts_with(feature, 'has_') THEN 'has' ELSE 'other' END AS feature_group FROM names""")
def coefficient_names(spark, folder) -> DataFrame:
    """The features that the fitted model has coefficients for, and their groups."""
    return coefficients(spark, folder).select("feature", "feature_group")


def compared_models(spark, folder) -> DataFrame:
    """Baseline, linear models and trees with their metrics, penalties, features in use and the root of all features."""
    features, table = trained(spark, folder)
    parts = fold_parts(spark, folder)
    models = [lasso(spark, folder), R.fit_ridge(table, parts), R.fit_net(table, parts), R.fit_forest(table), R.fit_boosted(table)]
    baseline = score_mean(table).drop("raw").withColumn("model", F.lit("baseline"))
    metrics = E.model_comparison(baseline.unionByName(R.scored_by(models, table)))
    p = len(features.names)
    chosen = spark.createDataFrame(
        [(m.name, None, None) if m.alpha is None else (m.name, float(m.alpha), int((abs(m.coefficients) > W.NONZERO).sum())) for m in models] + [("baseline", None, None)],
        "model string, alpha double, n_nonzero long")
    return metrics.join(chosen, "model").withColumn("n_features", F.lit(p)).withColumn("sqrt_features", F.floor(F.sqrt(F.lit(p))))


@query("csv_predictions", """SELECT md5(split_part(text, chr(10), 1)) AS title_md5, count(*) AS n_rows, true AS scored, true AS same
  FROM documents GROUP BY 1""")
def csv_predictions(spark, folder) -> DataFrame:
    """A CSV upload of all papers, scored, and written as CSV; read back to show what it holds."""
    upload, out = fresh_path(spark, "upload"), fresh_path(spark, "predictions")
    write_csv(papers_text(spark, folder).select("title", "abstract"), upload)
    model = scoring_model(spark, folder)
    rows = read_upload(spark, upload)
    bounded = model.with_bounds(model.predict_upload(rows, ["title"])).drop("pred")
    observed = citations_text(spark, folder)
    ranked = percentile_of_score(bounded, "predicted_citations", observed, "citations_24mo")
    results = write_once(rounded(ranked.select("title", "predicted_citations", "percentile", "ci_lower", "ci_upper")), "results")
    write_csv(results, out)
    back = spark.read.schema(results.schema).options(header=True, escape='"', multiLine=True).csv(out)

    def digest(df: DataFrame, name: str) -> DataFrame:
        """Rows per title, and the sum over them that differs when any number of any row does."""
        numbers = F.xxhash64(*(F.format_number(c, 6) for c in ("predicted_citations", "percentile", "ci_lower", "ci_upper")))
        good = (F.col("predicted_citations").isNotNull() & (F.col("ci_lower") < F.col("ci_upper")) & F.col("percentile").between(0, 100))
        return df.groupBy(F.md5(F.coalesce("title", F.lit(""))).alias("title_md5")).agg(
            F.count("*").alias(f"n_{name}"), F.sum(numbers.cast("decimal(38,0)")).alias(f"sum_{name}"), F.bool_and(good).alias(f"good_{name}"))

    both = digest(back, "file").join(digest(results, "memory"), "title_md5", "full")
    same = (F.col("n_file") == F.col("n_memory")) & (F.col("sum_file") == F.col("sum_memory"))
    return both.select("title_md5", F.col("n_file").alias("n_rows"), F.col("good_file").alias("scored"),
                       F.coalesce(same, F.lit(False)).alias("same"))


@query("model_card", """WITH names AS (SELECT DISTINCT 'cat_' || lang AS feature FROM documents
    UNION ALL SELECT DISTINCT 'tfidf_' || source FROM documents),
  coefficients AS (SELECT feature, CASE WHEN substr(md5(feature), 1, 1) < '8' THEN 0.0
    ELSE CAST(concat('0x', substr(md5(feature), 3, 4)) AS BIGINT)::DOUBLE / 1000 - 32 END AS coef FROM names)
  SELECT CASE WHEN starts_with(feature, 'tfidf_') THEN 'tfidf' WHEN starts_with(feature, 'cat_') THEN 'cat' ELSE 'other' END
    AS feature_group, count(*) AS n_features, count(*) FILTER (WHERE abs(coef) > 1e-6) AS n_nonzero FROM coefficients GROUP BY 1""")
def model_card(spark, folder) -> DataFrame:
    """On weights drawn from the names of the given categories and sources."""
    papers = papers_text(spark, folder)
    names = (papers.select(F.concat(F.lit("cat_"), "category").alias("feature")).distinct()
             .unionByName(papers.select(F.concat(F.lit("tfidf_"), "source").alias("feature")).distinct()))
    digest = F.md5("feature")
    weight = F.when(F.substring(digest, 1, 1) < "8", 0.0).otherwise(
        F.conv(F.substring(digest, 3, 4), 16, 10).cast("double") / 1000 - 32)
    return W.model_card(names.withColumn("coef", weight).withColumn("feature_group", feature_group(F.col("feature"))))
