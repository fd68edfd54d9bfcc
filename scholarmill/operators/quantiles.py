"""Exact linear-interpolated percentiles and percentile ranks that no single task has to hold.

Spark's ``percentile`` keeps every distinct value of a group in one task.  That is right for counts,
which have few distinct values once grouped; measured values need the bracketed form below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarmill.session import write_once

#: Ranks the sketch tells apart, and the ranks a bracket spans on either side; a miss widens it by the factor.
SKETCH_ACCURACY, MARGIN, WIDER = 20_000, 4.0, 16.0


def count_percentiles(df: DataFrame, value: str, points: Sequence[float],
                      by: Sequence[str] = ()) -> DataFrame:
    """Percentiles of a count, with ``n`` and ``mean``, from its frequency table.

    Rows are reduced to (group, count) frequencies on the map side, so a group that holds a third
    of all rows reaches its reducer as one row per distinct count.
    """
    freq = (df.where(F.col(value).isNotNull()).groupBy(*by, value)
            .agg(F.count("*").alias("freq")))
    return freq.groupBy(*by).agg(
        F.sum("freq").alias("n"),
        (F.sum(F.col(value).cast("double") * F.col("freq")) / F.sum("freq")).alias("mean"),
        F.percentile(value, [float(p) for p in points], F.col("freq")).alias("points"))


def measured_percentiles(df: DataFrame, value: str, points: Sequence[float],
                         by: Sequence[str] = ()) -> DataFrame:
    """Percentiles of a measured value: bracket each rank with a sketch, then select exactly.

    The sketch's rank error is bounded, so each wanted rank lies between two sketched values that
    enclose a few ten-thousandths of the rows, whatever their number.  One pass counts the rows
    below each bracket and keeps the distinct values inside it; a running count over those finds
    the two neighbours of the rank.  Should a bracket miss its rank, all are widened and the pass is
    repeated, in the end from the least to the greatest value, which cannot miss.
    """
    margin = MARGIN / SKETCH_ACCURACY
    while True:
        chosen = write_once(_bracketed(df, value, [float(p) for p in points], by, margin), "percentiles")
        if chosen.where("missed").isEmpty():
            break
        margin *= WIDER
    value_at = F.col("left") + F.col("frac") * (F.col("right") - F.col("left"))
    return (chosen.select(*by, "n", "i", value_at.alias("v")).groupBy(*by, "n")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("points")))


def _bracketed(df: DataFrame, value: str, points: Sequence[float], by: Sequence[str], margin: float) -> DataFrame:
    """Per group and point the two values beside its rank, and whether the bracket missed them."""
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("v"))
    wanted = [max(0.0, p - margin) for p in points] + [min(1.0, p + margin) for p in points]
    sketch = rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.percentile_approx("v", wanted, SKETCH_ACCURACY).alias("s"))

    def ranked(i: int) -> Column:
        at = F.lit(points[i]) * (F.col("n") - 1)
        return F.struct(
            F.lit(i).alias("i"), F.floor(at).alias("rank"), (at - F.floor(at)).alias("frac"),
            (F.col("lo") if points[i] <= margin else F.col("s")[i]).alias("from"),
            (F.col("hi") if points[i] >= 1.0 - margin else F.col("s")[i + len(points)]).alias("to"))

    brackets = F.array(*(ranked(i) for i in range(len(points))))
    if by:
        # one row per group on this side; left to the planner, which knows the size at run time
        placed = rows.join(sketch.select(*by, "n", brackets.alias("b")), list(by))
    else:
        placed = rows.withColumn("g", sketch.select(F.struct("n", brackets.alias("b"))).scalar())
        placed = placed.select("v", F.col("g.n").alias("n"), F.col("g.b").alias("b"))
    hits = placed.select(*by, "n", "v", F.explode("b").alias("b")).where(F.col("v") <= F.col("b.to"))
    cells = (hits.groupBy(*by, "n", "b", F.when(F.col("v") >= F.col("b.from"), F.col("v")).alias("v"))
             .agg(F.count("*").alias("freq")))
    inside = Window.partitionBy(*by, "b.i").orderBy(F.col("v").asc_nulls_first())
    running = cells.withColumn("upto", F.sum("freq").over(inside))
    after = F.least(F.col("b.rank") + 1, F.col("n") - 1)
    chosen = running.groupBy(*by, "n", "b").agg(
        F.count_if(F.col("v").isNull() & (F.col("upto") > F.col("b.rank"))).alias("missed"),
        F.min(F.when(F.col("upto") > F.col("b.rank"), F.col("v"))).alias("left"),
        F.min(F.when(F.col("upto") > after, F.col("v"))).alias("right"))
    missed = (F.col("missed") > 0) | F.col("left").isNull() | F.col("right").isNull()
    return chosen.select(*by, "n", F.col("b.i").alias("i"), F.col("b.frac").alias("frac"), "left", "right", missed.alias("missed"))
