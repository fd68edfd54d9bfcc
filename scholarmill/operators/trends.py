"""Velocity, trends and distributions of citation counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.operators.quantiles import count_percentiles

# The early share assumed where 12-month counts are missing, and the histogram's bins.
EARLY_SHARE = 0.6
HISTOGRAM_BINS = 30


def citation_velocity(papers: DataFrame, early_share: float = EARLY_SHARE) -> DataFrame:
    """First-year and second-year means, their ratio, quartile cuts and fast starters.

    A missing 12-month count is estimated from the 24-month one; ``n_estimated`` says how often.
    """
    c24 = F.col("citations_24mo").cast("double")
    rows = papers.where(F.col("citations_24mo").isNotNull()).select(
        c24.alias("c24"), F.coalesce(F.col("citations_12mo").cast("double"), c24 * early_share).alias("c12"),
        F.col("citations_12mo").isNull().alias("is_estimate"))
    cut12 = count_percentiles(rows, "c12", [0.75]).select(F.col("points")[0]).scalar()
    cut24 = count_percentiles(rows, "c24", [0.75]).select(F.col("points")[0]).scalar()
    return (rows.withColumn("_p12", cut12)
            .agg(F.count("*").alias("n"), F.avg("c12").alias("first_mean"),
                 F.avg(F.col("c24") - F.col("c12")).alias("second_mean"),
                 F.first("_p12").alias("p75_12mo"),
                 F.count_if(F.col("c12") > F.col("_p12")).alias("fast_starters"),
                 F.count_if("is_estimate").alias("n_estimated"))
            .withColumn("p75_24mo", cut24)
            .withColumn("velocity_ratio", F.col("second_mean") / (F.col("first_mean") + 1)))


def author_trend(papers: DataFrame) -> DataFrame:
    return count_percentiles(papers, "citations_24mo", [0.5], ["author_count"]).select(
        "author_count", "n", F.col("points")[0].alias("median"), "mean")


def keyword_trend(papers: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Count, median and mean per keyword; a paper counts for each keyword it has.

    Each row expands only to the flags it holds, and a keyword without papers gives no row.
    """
    held = F.filter(F.array(*(F.when(F.col(f"`{f}`") == 1, f[len("has_"):]) for f in flags)),
                    lambda k: k.isNotNull())
    rows = papers.select(F.explode(held).alias("keyword"), "citations_24mo")
    return count_percentiles(rows, "citations_24mo", [0.5], ["keyword"]).select(
        "keyword", "n", F.col("points")[0].alias("median"), "mean")


def top_keywords(trend: DataFrame, n: int = 10) -> DataFrame:
    return trend.orderBy(F.desc("mean"), "keyword").limit(n)


def category_percentiles(papers: DataFrame) -> DataFrame:
    points = ("p25", "p50", "p75", "p90", "p99")
    rows = count_percentiles(papers, "citations_24mo", [0.25, 0.5, 0.75, 0.9, 0.99], ["category"])
    return rows.select("category", *(F.round(F.col("points")[i], 1).alias(p) for i, p in enumerate(points)))


def histogram_by_category(papers: DataFrame, value: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal bins over the range of the whole set; the greatest value falls in the last bin."""
    rows = papers.where(F.col(value).isNotNull()).select("category", F.col(value).cast("double").alias("v"))
    edge = rows.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    width = (F.col("_e.hi") - F.col("_e.lo")) / bins
    number = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("_e.lo")) / width), F.lit(bins - 1))) \
        .otherwise(0).cast("int")
    return (rows.withColumn("_e", edge).groupBy("category", number.alias("bin"))
            .agg(F.count("*").alias("n_papers")))
