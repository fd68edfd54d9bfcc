"""The given tables read as papers, citations and citing events.

``documents`` and ``labels`` stand for paper texts and their counts; ``part`` and ``lineitem`` stand
for papers and the dated events that cite them.  The ``*_SQL`` texts say the same for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmill.operators.horizon import first_event_horizon
from scholarmill.session import write_once
from scholarmill.sources.tables import read_table

PAPERS_TEXT_SQL = """papers_text AS (
  SELECT doc_id AS paper_id, split_part(text, chr(10), 1) AS title, text AS abstract,
         split_part(text, chr(10), 1) AS authors, lang AS category, source,
         CAST(DATE '2019-01-01' + CAST(doc_id % 1461 AS INTEGER) AS DATE) AS submitted
  FROM documents)"""

CITATIONS_TEXT_SQL = """citations_text AS (
  SELECT doc_id AS paper_id, toxic AS citations_12mo, quality AS citations_24mo FROM labels)"""

EVENTS_SQL = """cite_events AS (
  SELECT l_partkey AS paper_id, CAST(l_shipdate AS DATE) AS cited_on FROM lineitem)"""

PAPERS_DATED_SQL = """papers_dated AS (
  SELECT p_partkey AS paper_id, p_name AS title, p_type AS category,
         CAST(p_size % 8 + 1 AS INTEGER) AS author_count, s.submitted
  FROM part JOIN (SELECT paper_id, min(cited_on) AS submitted FROM cite_events GROUP BY paper_id) s
    ON p_partkey = s.paper_id)"""

HORIZON_SQL = """horizon AS (
  SELECT p.paper_id, p.title, p.category, p.author_count, p.submitted,
         CAST(count(*) FILTER (WHERE e.cited_on >= p.submitted AND e.cited_on <= p.submitted + 360) AS BIGINT)
           AS citations_12mo,
         CAST(count(*) FILTER (WHERE e.cited_on >= p.submitted AND e.cited_on <= p.submitted + 720) AS BIGINT)
           AS citations_24mo
  FROM papers_dated p JOIN cite_events e USING (paper_id)
  GROUP BY ALL)"""

TEXT_SQL = f"WITH {PAPERS_TEXT_SQL}, {CITATIONS_TEXT_SQL}"
DATED_SQL = f"WITH {EVENTS_SQL}, {PAPERS_DATED_SQL}, {HORIZON_SQL}"


def papers_text(spark: SparkSession, folder: str) -> DataFrame:
    first_line = F.split_part("text", F.lit("\n"), F.lit(1))
    return read_table(spark, folder, "documents").select(
        F.col("doc_id").alias("paper_id"), first_line.alias("title"), F.col("text").alias("abstract"),
        first_line.alias("authors"), F.col("lang").alias("category"), "source",
        F.date_add(F.lit("2019-01-01").cast("date"), (F.col("doc_id") % 1461).cast("int")).alias("submitted"))


def citations_text(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "labels").select(
        F.col("doc_id").alias("paper_id"), F.col("toxic").alias("citations_12mo"),
        F.col("quality").alias("citations_24mo"))


def cite_events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("paper_id"), F.to_date("l_shipdate").alias("cited_on"))


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """Papers without a submission day."""
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("paper_id"), F.col("p_name").alias("title"),
        F.col("p_type").alias("category"), (F.col("p_size") % 8 + 1).alias("author_count"))


def papers_dated(spark: SparkSession, folder: str) -> DataFrame:
    """Papers whose submission day is the day of their first event."""
    first = (cite_events(spark, folder).groupBy("paper_id")
             .agg(F.min("cited_on").alias("submitted")))
    return parts(spark, folder).join(first, "paper_id")


def dated_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Papers with their citation counts at 12 and 24 months, from one scan of the events."""
    return first_event_horizon(parts(spark, folder), cite_events(spark, folder))


def stored_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The same, written once, for work that reads the counts more than once."""
    return write_once(dated_counts(spark, folder).drop("title"), "counts")
