"""Paper and citation records from landed feed (XML) and works (JSON) documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmill.sources.schemas import FEED_ENTRY, WORKS


def id_from_url(url: Column) -> Column:
    """The text after the last ``/abs/``; a version suffix stays."""
    return F.element_at(F.split(url, "/abs/"), -1)


def date_prefix(stamp: Column) -> Column:
    """The first ten characters of a timestamp text, or the empty string."""
    return F.coalesce(F.substring(stamp, 1, 10), F.lit(""))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Entries of landed Atom files; a large file is split across tasks where an entry ends.

    What stands before a file's first entry and after its last one is no entry and gives no row.
    """
    end = "</entry>"
    parts = spark.read.text(path, lineSep=end).select(F.regexp_extract("value", r"(?s)<entry[\s>].*", 0).alias("entry"))
    entry = F.from_xml(F.concat("entry", F.lit(end)), FEED_ENTRY.simpleString(), {"ignoreSurroundingSpaces": "false"})
    return parts.where(F.col("entry") != "").select(entry.alias("e")).select("e.*")


def papers_from_feed(entries: DataFrame, category: Column) -> DataFrame:
    """Paper rows; an entry without id is skipped, missing texts become the empty string."""
    names = F.transform("author", lambda a: F.coalesce(a["name"], F.lit("")))
    return (entries.where(F.col("id").isNotNull())
            .select(id_from_url(F.col("id")).alias("paper_id"),
                    F.coalesce("title", F.lit("")).alias("title"),
                    F.coalesce("summary", F.lit("")).alias("abstract"),
                    F.coalesce(F.array_join(names, ", "), F.lit("")).alias("authors"),
                    category.alias("category"),
                    date_prefix(F.col("published")).alias("submitted_date")))


def works_from_json(documents: DataFrame, body: str) -> DataFrame:
    """Adds the first listed work; a document without results gives no row."""
    work = F.try_element_at(F.from_json(body, WORKS)["results"], F.lit(1))
    return (documents.withColumn("work", work).where(F.col("work").isNotNull())
            .withColumns({"cited_by_count": F.col("work.cited_by_count"),
                          "publication_date": F.col("work.publication_date")})
            .drop("work", body))
