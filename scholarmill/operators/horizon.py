"""Citations that fall within so many months of a paper's submission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAYS_PER_MONTH = 30
MONTHS = (12, 24)


def cited_within(cited_by: Column, published: Column, submitted: Column, months: int) -> Column:
    """The whole count when the work came out in time, else 0.

    ``published`` is a text; without a readable date the submission day stands in.
    """
    day = F.coalesce(F.try_to_date(F.substring(published, 1, 10), "yyyy-MM-dd"), submitted)
    limit = F.date_add(submitted, DAYS_PER_MONTH * months)
    return F.when(day > limit, 0).otherwise(F.coalesce(cited_by, F.lit(0)))


def horizon_counts(submitted: Column, day: Column, weight: Column,
                   months: tuple[int, ...] = MONTHS) -> dict[str, Column]:
    """Per horizon, the sum of ``weight`` over the days inside it."""
    return {
        f"citations_{m}mo": F.sum(F.when((day >= submitted)
                                         & (day <= F.date_add(submitted, DAYS_PER_MONTH * m)),
                                         weight).otherwise(F.lit(0).cast("long")))
        for m in months}


def citation_horizon(papers: DataFrame, events: DataFrame,
                     months: tuple[int, ...] = MONTHS) -> DataFrame:
    """Joins papers to citing events and counts those inside each horizon.

    Events are counted per paper and day before they meet the papers: a paper that draws a third
    of all events then brings one row per day to the join, not one per event.  Papers without any
    event keep zero counts.  Wide columns of ``papers`` stay out of the first join and the sums.
    """
    daily = events.groupBy("paper_id", "cited_on").agg(F.count("*").alias("n_events"))
    return horizon_of_daily(papers, daily, months)


def horizon_of_daily(papers: DataFrame, daily: DataFrame, months: tuple[int, ...] = MONTHS) -> DataFrame:
    """The same from events counted per paper and day (``n_events``)."""
    counts = horizon_counts(F.col("submitted"), F.col("cited_on"), F.col("n_events"), months)
    cited = (daily.join(papers.select("paper_id", "submitted"), "paper_id").groupBy("paper_id")
             .agg(*(c.alias(n) for n, c in counts.items())))
    return papers.join(cited, "paper_id", "left").fillna(0, list(counts))


def first_event_horizon(papers: DataFrame, events: DataFrame, months: tuple[int, ...] = MONTHS) -> DataFrame:
    """The same where the day of a paper's first event is its submission day, in ``submitted``.

    The first day comes from the counts per paper and day, so events are scanned once; a paper brings a row per day to
    the task that finds it.  Papers without events are left out.
    """
    daily = events.groupBy("paper_id", "cited_on").agg(F.count("*").alias("n_events"))
    dated = daily.withColumn("submitted", F.min("cited_on").over(Window.partitionBy("paper_id")))
    counts = horizon_counts(F.col("submitted"), F.col("cited_on"), F.col("n_events"), months)
    cited = dated.groupBy("paper_id").agg(F.min("submitted").alias("submitted"), *(c.alias(n) for n, c in counts.items()))
    return papers.join(cited, "paper_id")
