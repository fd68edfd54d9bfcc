"""Features and targets on one keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmill.functions.labels import feature_group, one_hot
from scholarmill.functions.text import (KEYWORDS, author_count, bracket_refs, dollar_count, flag_name,
                                        keyword_flags, reading_ease, word_count)
from scholarmill.operators.quantiles import count_percentiles

# Names of the feature columns.
TEXT_FEATURES = ("abstract_length", "title_length", "flesch_reading_ease", "equation_count",
                 "citation_count")
DATED_FEATURES = ("author_count", "submission_month", "submission_year")


def text_features() -> dict[str, Column]:
    title, abstract = F.col("title"), F.col("abstract")
    return {"abstract_length": word_count(abstract), "title_length": word_count(title),
            "flesch_reading_ease": reading_ease(abstract), "equation_count": dollar_count(abstract),
            "citation_count": bracket_refs(abstract)}


def metadata_features(categories: Sequence[str], keywords: Sequence[str] = KEYWORDS) -> dict[str, Column]:
    return {"author_count": author_count(F.col("authors")),
            "submission_month": F.month("submitted"), "submission_year": F.year("submitted"),
            **one_hot(F.col("category"), list(categories)),
            **keyword_flags(F.col("title"), F.col("abstract"), keywords)}


def feature_columns(categories: Sequence[str], keywords: Sequence[str] = KEYWORDS) -> list[str]:
    return [*TEXT_FEATURES, *DATED_FEATURES, *(f"cat_{c}" for c in sorted(categories)),
            *(flag_name(k) for k in keywords)]


def feature_table(papers: DataFrame, categories: Sequence[str],
                  keywords: Sequence[str] = KEYWORDS, keep: Sequence[str] = ("paper_id",)) -> DataFrame:
    """One narrow projection: no join, no shuffle, no alignment by position.

    ``categories`` is a fitted list, so the schema does not depend on the rows scored.
    """
    return papers.select(*keep, *(c.alias(n) for n, c in text_features().items()),
                         *(c.alias(n) for n, c in metadata_features(categories, keywords).items()))


def impute_zero(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    return features.withColumns(
        {c: F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for c in columns})


def top_quartile_cut(papers: DataFrame, count: str = "citations_24mo") -> Column:
    """The 75th percentile over the whole set, as a scalar subquery."""
    return count_percentiles(papers, count, [0.75]).select(F.col("points")[0]).scalar()


def targets(papers: DataFrame, count: str = "citations_24mo",
            keep: Sequence[str] = ("paper_id",)) -> DataFrame:
    """The count, its log1p, and whether it lies strictly above the 75th percentile."""
    c = F.col(count).cast("double")
    return papers.select(*keep, c.alias("citations_24mo"), F.log1p(c).alias("citations_24mo_log"),
                         (c > top_quartile_cut(papers, count)).cast("int").alias("top_quartile"))


def target_summary(papers: DataFrame, count: str = "citations_24mo") -> DataFrame:
    points = count_percentiles(papers, count, [0.5, 0.75, 0.9, 0.99])
    return (papers.where(F.col(count).isNotNull())
            .withColumn("_cut", top_quartile_cut(papers, count))
            .agg(F.count("*").alias("n"), F.avg(count).alias("mean"), F.stddev_samp(count).alias("std"),
                 F.count_if(F.col(count) > F.col("_cut")).alias("positives"))
            .withColumn("share_pct", F.try_divide(F.col("positives") * 100.0, F.col("n")))
            .withColumn("_p", points.select("points").scalar())
            .select("n", "mean", F.col("_p")[0].alias("median"), "std", F.col("_p")[1].alias("p75"),
                    F.col("_p")[2].alias("p90"), F.col("_p")[3].alias("p99"), "positives", "share_pct"))


def y_stats(papers: DataFrame, count: str = "citations_24mo") -> DataFrame:
    """Statistics of log1p of a count; deviation, skewness and excess kurtosis of the population.

    Percentiles come from the frequencies of the log values, which are as few as the counts.
    """
    logs = papers.where(F.col(count).isNotNull()).select(F.log1p(F.col(count).cast("double")).alias("y"))
    points = count_percentiles(logs, "y", [0.5, 0.25, 0.75, 0.9, 0.99]).select("points").scalar()
    return (logs.agg(F.count("*").alias("n"), F.avg("y").alias("mean"), F.stddev_pop("y").alias("std"),
                     F.min("y").alias("min"), F.max("y").alias("max"),
                     F.skewness("y").alias("skewness"), F.kurtosis("y").alias("kurtosis"))
            .withColumn("_p", points)
            .select("n", "mean", "std", F.col("_p")[0].alias("median"), "min", "max",
                    *(F.col("_p")[i + 1].alias(name) for i, name in enumerate(("p25", "p75", "p90", "p99"))),
                    "skewness", "kurtosis"))


def column_moments(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, mean, population variance, least and greatest value per column: one scan, one row per column."""
    per = {c: F.struct(F.count(F.col(f"`{c}`")).alias("n"), F.avg(F.col(f"`{c}`")).alias("mean"),
                       F.var_pop(F.col(f"`{c}`")).alias("var"),
                       F.min(F.col(f"`{c}`")).cast("double").alias("lo"),
                       F.max(F.col(f"`{c}`")).cast("double").alias("hi")) for c in columns}
    wide = features.agg(*(s.alias(c) for c, s in per.items()))
    return (wide.unpivot([], [F.col(f"`{c}`") for c in columns], "feature", "m")
            .select("feature", "m.*"))


def feature_ranges(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    return column_moments(features, columns).select("feature", F.col("lo").alias("min_value"),
                                                    F.col("hi").alias("max_value"))


def x_stats_by_group(moments: DataFrame) -> DataFrame:
    """Statistics over all cells of a feature group, merged from the moments of its columns.

    The rows are never unpivoted: only one row per column is.
    """
    grouped = moments.withColumn("feature_group", feature_group(F.col("feature")))
    pooled = grouped.groupBy("feature_group").agg(
        F.count("*").alias("n_columns"), F.sum("n").alias("cells"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        F.sum(F.col("n") * (F.col("var") + F.col("mean") * F.col("mean"))).alias("squares"),
        F.min("lo").alias("min_value"), F.max("hi").alias("max_value"))
    spread = F.greatest(F.lit(0.0), F.col("squares") / F.col("cells") - F.col("mean") * F.col("mean"))
    return pooled.select("feature_group", "n_columns", "mean", F.sqrt(spread).alias("std"),
                         "min_value", "max_value")


def scaled_moments(moments: DataFrame) -> DataFrame:
    """The moments of each column less its mean, over its population deviation; a constant column becomes 0."""
    sd = F.sqrt(F.greatest(F.lit(0.0), F.col("var")))
    varies = sd > 0

    def scaled(bound: str) -> Column:
        return F.when(varies, (F.col(bound) - F.col("mean")) / sd).otherwise(0.0).alias(bound)

    return moments.select("feature", "n", F.lit(0.0).alias("mean"), F.when(varies, 1.0).otherwise(0.0).alias("var"), scaled("lo"), scaled("hi"))


def sparse_moments(weights: DataFrame, terms: DataFrame, n_rows: Column) -> DataFrame:
    """Moments per term of a long (paper, term, weight) table whose absent cells are zeros."""
    held = weights.groupBy("term").agg(
        F.count("*").alias("nnz"), F.sum("weight").alias("s"),
        F.sum(F.col("weight") * F.col("weight")).alias("ss"),
        F.min("weight").alias("lo"), F.max("weight").alias("hi"))
    full = terms.select("term").join(held, "term", "left").fillna(0, ["nnz", "s", "ss"])
    n = n_rows.cast("double")
    has_zero = F.col("nnz") < n
    return (full.withColumn("n", n_rows)
            .withColumn("mean", F.col("s") / n)
            .select(F.concat(F.lit("tfidf_"), "term").alias("feature"), "n", "mean",
                    (F.col("ss") / n - F.col("mean") * F.col("mean")).alias("var"),
                    F.when(has_zero, F.least(F.lit(0.0), F.col("lo"))).otherwise(F.col("lo")).alias("lo"),
                    F.when(has_zero, F.greatest(F.lit(0.0), F.col("hi"))).otherwise(F.col("hi")).alias("hi")))


def standardize(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column less its mean, over its population deviation; a constant column becomes 0."""
    stats = features.agg(F.struct(*(F.struct(F.avg(F.col(f"`{c}`")).alias("m"),
                                             F.stddev_pop(F.col(f"`{c}`")).alias("s")).alias(c)
                                    for c in columns)).alias("all")).scalar()
    placed = features.withColumn("_s", stats)
    out = {}
    for c in columns:
        m, s = F.col("_s")[c]["m"], F.col("_s")[c]["s"]
        out[c] = (F.col(f"`{c}`") - m) / F.when(s > 0, s).otherwise(1.0)
    return placed.withColumns(out).drop("_s")


def feature_group_counts(names: DataFrame) -> DataFrame:
    return (names.groupBy(feature_group(F.col("feature")).alias("feature_group"))
            .agg(F.count("*").alias("n_columns")))


def median_fill(rows: DataFrame, medians: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls become the training median, given as one row with a column per feature."""
    m = medians.select(F.struct(*(F.col(f"`{c}`") for c in columns))).scalar()
    return (rows.withColumn("_m", m)
            .withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.col("_m")[c]) for c in columns})
            .drop("_m"))
