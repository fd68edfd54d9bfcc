"""Queries for horizons, targets, trends and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.operators import features as X
from scholarmill.operators import trends as T
from scholarmill.plans.features import CATEGORIES, KEYWORDS
from scholarmill.plans.registry import query
from scholarmill.plans.shape import big, r6, rounded
from scholarmill.sources.stand_ins import (DATED_SQL, TEXT_SQL, citations_text, dated_counts, papers_text,
                                           stored_counts)


@query("citation_horizon", f"{DATED_SQL} SELECT paper_id, category, submitted, citations_12mo, citations_24mo FROM horizon")
def horizon(spark, folder) -> DataFrame:
    return dated_counts(spark, folder).select("paper_id", "category", "submitted", "citations_12mo", "citations_24mo")


@query("targets", f"""{DATED_SQL} SELECT paper_id, {r6('citations_24mo')} AS citations_24mo,
  {r6('ln(1 + citations_24mo)')} AS citations_24mo_log,
  {big("CASE WHEN citations_24mo > (SELECT quantile_cont(citations_24mo::DOUBLE, 0.75) FROM horizon) THEN 1 ELSE 0 END")}
    AS top_quartile FROM horizon""")
def targets(spark, folder) -> DataFrame:
    return rounded(X.targets(stored_counts(spark, folder)))


@query("log_targets", f"""{DATED_SQL} SELECT paper_id, {r6('ln(1 + citations_24mo)')} AS as_log,
  {r6('exp(ln(1 + citations_24mo)) - 1')} AS back FROM horizon""")
def log_targets(spark, folder) -> DataFrame:
    logs = dated_counts(spark, folder).select("paper_id", F.log1p("citations_24mo").alias("as_log"))
    return rounded(logs.withColumn("back", F.expm1("as_log")))


_C = "citations_24mo::DOUBLE"


@query("target_summary", f"""{DATED_SQL}, cut AS (SELECT quantile_cont({_C}, 0.75) AS p75 FROM horizon)
  SELECT count(*) AS n, {r6('avg(citations_24mo)')} AS mean, {r6(f'quantile_cont({_C}, 0.5)')} AS median,
    {r6('stddev_samp(citations_24mo)')} AS std, {r6('any_value(p75)')} AS p75, {r6(f'quantile_cont({_C}, 0.9)')} AS p90,
    {r6(f'quantile_cont({_C}, 0.99)')} AS p99, count(*) FILTER (WHERE citations_24mo > p75) AS positives,
    {r6('100.0 * count(*) FILTER (WHERE citations_24mo > p75) / count(*)')} AS share_pct FROM horizon, cut""")
def target_summary(spark, folder) -> DataFrame:
    return rounded(X.target_summary(stored_counts(spark, folder)))


@query("y_stats", f"""{DATED_SQL}, v AS (SELECT ln(1 + citations_24mo) AS y FROM horizon),
  m AS (SELECT avg(y) AS mu, stddev_pop(y) AS sd FROM v)
  SELECT count(*) AS n, {r6('avg(y)')} AS mean, {r6('stddev_pop(y)')} AS std, {r6('quantile_cont(y, 0.5)')} AS median,
    {r6('min(y)')} AS min, {r6('max(y)')} AS max, {r6('quantile_cont(y, 0.25)')} AS p25, {r6('quantile_cont(y, 0.75)')} AS p75,
    {r6('quantile_cont(y, 0.9)')} AS p90, {r6('quantile_cont(y, 0.99)')} AS p99,
    {r6('avg(power((y - mu) / sd, 3))')} AS skewness, {r6('avg(power((y - mu) / sd, 4)) - 3')} AS kurtosis FROM v, m""")
def y_stats(spark, folder) -> DataFrame:
    return rounded(X.y_stats(stored_counts(spark, folder)))


@query("citation_velocity", f"""{DATED_SQL}, held AS (SELECT paper_id, citations_24mo::DOUBLE AS c24,
    CASE WHEN paper_id % 10 = 0 THEN citations_24mo * 0.6 ELSE citations_12mo END::DOUBLE AS c12 FROM horizon),
  cut AS (SELECT quantile_cont(c12, 0.75) AS p12, quantile_cont(c24, 0.75) AS p24 FROM held)
  SELECT count(*) AS n, {r6('avg(c12)')} AS first_mean, {r6('avg(c24 - c12)')} AS second_mean,
    {r6('any_value(p12)')} AS p75_12mo, {r6('any_value(p24)')} AS p75_24mo,
    count(*) FILTER (WHERE c12 > p12) AS fast_starters, count(*) FILTER (WHERE paper_id % 10 = 0) AS n_estimated,
    {r6('avg(c24 - c12) / (avg(c12) + 1)')} AS velocity_ratio FROM held, cut""")
def citation_velocity(spark, folder) -> DataFrame:
    """Every tenth paper lacks its 12-month count, so the estimate is used next to real counts."""
    papers = stored_counts(spark, folder).withColumn(
        "citations_12mo", F.when(F.col("paper_id") % 10 != 0, F.col("citations_12mo")))
    return rounded(T.citation_velocity(papers))


@query("author_trend", f"""{DATED_SQL} SELECT {big('author_count')} AS author_count, count(*) AS n,
  {r6(f'quantile_cont({_C}, 0.5)')} AS median, {r6('avg(citations_24mo)')} AS mean FROM horizon GROUP BY 1""")
def author_trend(spark, folder) -> DataFrame:
    return rounded(T.author_trend(dated_counts(spark, folder)))


FLAGS = [f"has_{k}" for k in KEYWORDS]
_KEYWORD_SQL = f"""{TEXT_SQL}, flags AS (SELECT k.keyword, citations_24mo FROM papers_text JOIN citations_text USING (paper_id)
    JOIN (SELECT unnest([{', '.join(repr(k) for k in KEYWORDS)}]) AS keyword) k
      ON contains(lower(title || ' ' || abstract), k.keyword)),
  trend AS (SELECT keyword, count(*) AS n, {r6(f'quantile_cont({_C}, 0.5)')} AS median,
    {r6('avg(citations_24mo)')} AS mean FROM flags GROUP BY keyword)"""


def keyword_rows(spark, folder) -> DataFrame:
    papers = papers_text(spark, folder).join(citations_text(spark, folder), "paper_id")
    return T.keyword_trend(X.feature_table(papers, CATEGORIES, KEYWORDS, keep=("paper_id", "citations_24mo")), FLAGS)


@query("keyword_trend", f"{_KEYWORD_SQL} SELECT * FROM trend")
def keyword_trend(spark, folder) -> DataFrame:
    return rounded(keyword_rows(spark, folder))


@query("top_keywords", f"{_KEYWORD_SQL} SELECT * FROM trend ORDER BY mean DESC, keyword LIMIT 10")
def top_keywords(spark, folder) -> DataFrame:
    return T.top_keywords(rounded(keyword_rows(spark, folder)))


@query("category_percentiles", f"""{DATED_SQL} SELECT category, """ + ", ".join(
    f"round(quantile_cont({_C}, {p}), 1) AS {n}" for n, p in
    (("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p99", 0.99))) + " FROM horizon GROUP BY category")
def category_percentiles(spark, folder) -> DataFrame:
    return T.category_percentiles(dated_counts(spark, folder))


def _histogram_sql(v: str) -> str:
    return f"""{DATED_SQL}, v AS (SELECT category, CAST({v} AS DOUBLE) AS v FROM horizon),
      e AS (SELECT min(v) AS lo, (max(v) - min(v)) / 30 AS w FROM v)
      SELECT category, {big('CASE WHEN w > 0 THEN least(floor((v - lo) / w), 29) ELSE 0 END')} AS bin, count(*) AS n_papers
      FROM v, e GROUP BY 1, 2"""


@query("histogram_by_category", _histogram_sql("citations_24mo"))
def histogram_by_category(spark, folder) -> DataFrame:
    return rounded(T.histogram_by_category(stored_counts(spark, folder), "citations_24mo"))


@query("histogram_log_by_category", _histogram_sql("round(ln(1 + citations_24mo), 6)"))
def histogram_log_by_category(spark, folder) -> DataFrame:
    logs = stored_counts(spark, folder).withColumn("log_count", F.round(F.log1p("citations_24mo"), 6))
    return rounded(T.histogram_by_category(logs, "log_count"))
