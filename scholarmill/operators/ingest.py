"""Selecting, de-duplicating and storing incoming records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.session import write_once


def in_category_and_dates(papers: DataFrame, categories: Sequence[str], first: date,
                          last: date) -> DataFrame:
    """Both bounds belong to the range; the predicate reaches the Parquet scan."""
    return papers.where(F.col("category").isin(list(categories))
                        & F.col("submitted").between(F.lit(first), F.lit(last)))


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """Columns are matched by name."""
    return reduce(DataFrame.unionByName, sources)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with signs added until no column of ``df`` has it."""
    while name in df.columns:
        name += "_"
    return name


def first_per_key(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The row with the least ``seq`` per key; a null ``seq`` comes last, ties go to the least hash of the whole row.

    Rows are written once with a number each; key, order, hash and number alone are aggregated, partially and by
    hashing, and the numbers that win fetch their rows.  So wide rows are dealt out once at most, wholly repeated rows
    need no further step, and a key that holds a third of all rows does not meet in one task.
    """
    number, mark = fresh_name(rows, "_number"), fresh_name(rows, "_hash")
    marked = write_once(rows.withColumns({number: F.monotonically_increasing_id(), mark: F.xxhash64(*rows.columns)}), "numbered")
    narrow = marked.select(F.col(key).alias("key"), F.col(seq).alias("seq"), F.col(mark).alias("hash"), F.col(number).alias("number"))
    first = narrow.groupBy(F.col("key").alias("of")).agg(F.min("seq").alias("least"))
    near = narrow.join(first, F.col("key").eqNullSafe(F.col("of")) & F.col("seq").eqNullSafe(F.col("least")))
    won = near.groupBy("key").agg(F.min_by("number", "hash").alias("won")).select("won")
    return marked.join(won, F.col(number) == F.col("won"), "left_semi").select(*rows.columns)


def not_stored(incoming: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key the store lacks."""
    return incoming.join(stored.select(key), key, "left_anti")


def new_rows(incoming: DataFrame, stored: DataFrame, key: str, seq: str) -> DataFrame:
    """Insert-if-absent: one row per new key, the first one; stored rows never change.

    Copies collapse before the join, so a key with many copies meets the store as one row.
    """
    return not_stored(first_per_key(incoming, key, seq), stored, key)


def pending_citations(papers: DataFrame, citations: DataFrame, key: str = "paper_id") -> DataFrame:
    """Papers that have no citation row yet."""
    return not_stored(papers, citations, key)


def capped_ingest(candidates: DataFrame, stored: DataFrame, priority: Sequence[str],
                  cap: int) -> DataFrame:
    """The first ``cap`` new papers by category priority, then date, then id.

    The cap counts over all categories, so an early category can use all of it.
    """
    rank = F.array_position(F.array(*(F.lit(c) for c in priority)), F.col("category"))
    fresh = not_stored(candidates.where(F.col("category").isin(list(priority))), stored, "paper_id")
    return (fresh.withColumn("priority", rank.cast("int"))
            .orderBy("priority", "submitted", "paper_id").limit(cap))
