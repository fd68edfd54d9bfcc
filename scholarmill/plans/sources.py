"""Queries for reading, writing and parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmill.operators.features import feature_columns, feature_table
from scholarmill.operators.horizon import cited_within
from scholarmill.operators.quality import citation_distribution
from scholarmill.plans.features import CATEGORIES, FEATURES_SQL, KEYWORDS
from scholarmill.plans.registry import query
from scholarmill.plans.shape import r6, rounded
from scholarmill.session import fresh_path
from scholarmill.sources import landed
from scholarmill.sources.stand_ins import TEXT_SQL, citations_text, papers_text
from scholarmill.sources.tables import (read_summary, read_table, read_upload, table_counts, write_csv,
                                        write_features, write_summary)


@query("scan_papers", f"{TEXT_SQL} SELECT paper_id, title, abstract, authors, category, submitted FROM papers_text")
def scan_papers(spark, folder) -> DataFrame:
    return papers_text(spark, folder).select("paper_id", "title", "abstract", "authors", "category", "submitted")


@query("scan_citations_pruned",
       f"{TEXT_SQL} SELECT paper_id, CAST(citations_12mo AS BIGINT) AS citations_12mo FROM citations_text")
def scan_citations_pruned(spark, folder) -> DataFrame:
    return rounded(citations_text(spark, folder).select("paper_id", "citations_12mo"))


@query("table_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ("documents", "labels", "part", "lineitem")))
def counts(spark, folder) -> DataFrame:
    return table_counts({t: read_table(spark, folder, t) for t in ("documents", "labels", "part", "lineitem")})


@query("features_roundtrip", FEATURES_SQL)
def features_roundtrip(spark, folder) -> DataFrame:
    """Writes the feature table by category and reads it back with its own schema."""
    table = rounded(feature_table(papers_text(spark, folder), CATEGORIES, KEYWORDS,
                                  keep=("paper_id", "category")))
    path = fresh_path(spark, "features")
    write_features(table, path, partition_by="category")
    return spark.read.schema(table.schema).parquet(path).select(
        "paper_id", *(F.col(f"`{c}`") for c in feature_columns(CATEGORIES, KEYWORDS)))


@query("csv_batch_read", """SELECT split_part(text, chr(10), 1) AS title, md5(text) AS abstract_md5,
  length(text) AS abstract_chars FROM documents""")
def csv_batch_read(spark, folder) -> DataFrame:
    """The papers as an uploaded CSV: quotes and line breaks inside a cell survive."""
    path = fresh_path(spark, "upload")
    write_csv(papers_text(spark, folder).select("title", "abstract"), path)
    return read_upload(spark, path).select("title", F.md5("abstract").alias("abstract_md5"),
                                           F.length("abstract").cast("bigint").alias("abstract_chars"))


@query("summary_json_roundtrip", f"""{TEXT_SQL} SELECT 'citations_24mo' AS horizon, count(*) AS n,
  {r6('avg(citations_24mo)')} AS mean, {r6('quantile_cont(citations_24mo::DOUBLE, 0.5)')} AS median,
  {r6('stddev_samp(citations_24mo)')} AS std, {r6('quantile_cont(citations_24mo::DOUBLE, 0.25)')} AS p25,
  {r6('quantile_cont(citations_24mo::DOUBLE, 0.75)')} AS p75, {r6('quantile_cont(citations_24mo::DOUBLE, 0.9)')} AS p90,
  {r6('quantile_cont(citations_24mo::DOUBLE, 0.99)')} AS p99 FROM citations_text""")
def summary_json_roundtrip(spark, folder) -> DataFrame:
    summary = citation_distribution(citations_text(spark, folder), ["citations_24mo"])
    path = fresh_path(spark, "summary")
    write_summary(summary, path)
    return rounded(read_summary(spark, path, summary.schema))


def landed_feed(spark, folder) -> str:
    """The documents landed as feed files."""
    papers = papers_text(spark, folder)
    path = fresh_path(spark, "feed")
    (papers.select(F.concat(F.lit("http://example.org/abs/"), F.col("paper_id").cast("string"), F.lit("v1")).alias("id"),
                   "title", F.col("abstract").alias("summary"),
                   F.concat(F.col("submitted").cast("string"), F.lit("T09:30:00Z")).alias("published"),
                   F.array(F.struct(F.col("source").alias("name")), F.struct(F.col("category").alias("name")))
                   .alias("author"))
     .write.options(rootTag="feed", rowTag="entry").xml(path))
    return path


@query("parse_feed", f"""{TEXT_SQL} SELECT paper_id || 'v1' AS paper_id, title, md5(abstract) AS abstract_md5,
  source || ', ' || category AS authors, 'feed' AS category, CAST(submitted AS VARCHAR) AS submitted_date
  FROM papers_text""")
def parse_feed(spark, folder) -> DataFrame:
    entries = landed.read_feed(spark, landed_feed(spark, folder))
    papers = landed.papers_from_feed(entries, F.lit("feed"))
    return papers.select("paper_id", "title", F.md5("abstract").alias("abstract_md5"), "authors", "category",
                         "submitted_date")


@query("extract_id", """SELECT page_id, element_at_end AS work_id FROM (
  SELECT page_id, regexp_extract('http://example.org/abs/' || url, '(?s)^.*/abs/(.*)$', 1) AS element_at_end
  FROM pages WHERE url IS NOT NULL)""")
def extract_id(spark, folder) -> DataFrame:
    return (read_table(spark, folder, "pages").where(F.col("url").isNotNull())
            .select("page_id", landed.id_from_url(F.concat(F.lit("http://example.org/abs/"), "url")).alias("work_id")))


@query("date_prefix", "SELECT event_id, coalesce(substr(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 1, 10), '') AS day FROM events")
def date_prefix(spark, folder) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return read_table(spark, folder, "events").select("event_id", landed.date_prefix(stamp).alias("day"))


def landed_works(spark, folder) -> DataFrame:
    """A works document per paper, in which only labelled papers have a result."""
    held = papers_text(spark, folder).select("paper_id", "submitted").join(
        citations_text(spark, folder), "paper_id", "left")
    published = F.date_add("submitted", (F.col("paper_id") % 1000).cast("int")).cast("string")
    work = F.struct((F.col("citations_24mo") + F.col("paper_id") % 7).alias("cited_by_count"),
                    F.when(F.col("paper_id") % 5 != 0, published).alias("publication_date"))
    results = F.when(F.col("citations_24mo").isNotNull(), F.array(work)).otherwise(F.array())
    return held.select("paper_id", "submitted", F.to_json(F.struct(results.alias("results"))).alias("body"))


WORKS_SQL = f"""{TEXT_SQL}, works AS (
  SELECT paper_id, submitted, citations_24mo + paper_id % 7 AS cited_by_count,
         CASE WHEN paper_id % 5 <> 0 THEN CAST(CAST(submitted + CAST(paper_id % 1000 AS INTEGER) AS DATE) AS VARCHAR) END
           AS publication_date
  FROM papers_text JOIN citations_text USING (paper_id))"""


@query("parse_works", f"{WORKS_SQL} SELECT paper_id, cited_by_count, publication_date FROM works")
def parse_works(spark, folder) -> DataFrame:
    return landed.works_from_json(landed_works(spark, folder), "body").drop("submitted")


@query("cited_within_gate", f"""{WORKS_SQL} SELECT paper_id,
  CAST(CASE WHEN coalesce(CAST(publication_date AS DATE), submitted) > submitted + 360 THEN 0 ELSE cited_by_count END AS BIGINT)
    AS citations_12mo,
  CAST(CASE WHEN coalesce(CAST(publication_date AS DATE), submitted) > submitted + 720 THEN 0 ELSE cited_by_count END AS BIGINT)
    AS citations_24mo FROM works""")
def cited_within_gate(spark, folder) -> DataFrame:
    works = landed.works_from_json(landed_works(spark, folder), "body")
    gate = (F.col("cited_by_count"), F.col("publication_date"), F.col("submitted"))
    return works.select("paper_id", *(cited_within(*gate, m).alias(f"citations_{m}mo") for m in (12, 24)))
