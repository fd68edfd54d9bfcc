"""Which papers enter the model, and why the others do not."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts at or below these lengths are invalid.
ABSTRACT_OVER = 10
TITLE_OVER = 3

# The filter stages, in the order they apply.
# Fixed value: days a paper needs to gather its counts.
WAIT_DAYS = 730

STAGES = ("time_cutoff", "null_citations", "invalid_text")


def parse_dates(papers: DataFrame, text: str = "submitted_date", lenient: bool = False) -> DataFrame:
    """Adds ``submitted``.  A bad date fails the job, or is null when ``lenient``."""
    read = F.try_to_date if lenient else F.to_date
    return papers.withColumn("submitted", read(F.col(text), "yyyy-MM-dd"))


def valid_text() -> Column:
    return F.coalesce((F.length("abstract") > ABSTRACT_OVER) & (F.length("title") > TITLE_OVER),
                      F.lit(False))


def default_cutoff(run_date: date) -> date:
    """Papers need two years for their counts: the run's day less ``WAIT_DAYS``."""
    return run_date - timedelta(days=WAIT_DAYS)


def failing_stage(cutoff: date) -> Column:
    """The first stage a joined row fails, or null for a kept row.  A zero count is kept."""
    return (F.when(~F.coalesce(F.col("submitted") <= F.lit(cutoff), F.lit(False)), STAGES[0])
            .when(F.col("citations_24mo").isNull(), STAGES[1])
            .when(~valid_text(), STAGES[2]))


def cohort(joined: DataFrame, cutoff: date) -> DataFrame:
    return joined.where((F.col("submitted") <= F.lit(cutoff))
                        & F.col("citations_24mo").isNotNull() & valid_text())


def filter_audit(joined: DataFrame, cutoff: date) -> DataFrame:
    """Rows removed per stage and kept, each with its share of the initial rows, in one pass."""
    stage = failing_stage(cutoff)
    totals = (joined.select(stage.alias("stage"))
              .agg(F.count("*").alias("initial_rows"),
                   *(F.count_if(F.col("stage") == s).alias(s) for s in STAGES),
                   F.count_if(F.col("stage").isNull()).alias("kept")))
    return (totals.unpivot(["initial_rows"], [*STAGES, "kept"], "stage", "n_rows")
            .withColumn("pct_of_initial",
                        F.coalesce(F.try_divide(F.col("n_rows") * 100.0, F.col("initial_rows")), F.lit(0.0))))
