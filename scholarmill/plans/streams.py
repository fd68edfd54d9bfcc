"""Queries that run the streaming jobs over the given tables until no file is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmill.plans.models import same_rows, scoring_model
from scholarmill.plans.registry import query
from scholarmill.plans.shape import rounded
from scholarmill.session import fresh_path, write_once
from scholarmill.sources.keyed_store import KeyedStore
from scholarmill.sources.stand_ins import DATED_SQL, papers_dated, papers_text
from scholarmill.sources.tables import read_table, stream_table
from scholarmill.streaming.horizon import daily_counts, running_horizon, start_counts
from scholarmill.streaming.ingest import start_ingest
from scholarmill.streaming.keyed_horizon import paper_counts, start_paper_counts, stored_horizon
from scholarmill.streaming.score import start_scoring

# the given lines carry no id of their own; these columns tell them apart
EVENT_KEY = ("l_orderkey", "l_linenumber", "paper_id", "l_suppkey", "l_extendedprice", "cited_at")


# how late an event may come
LATENESS = "30 days"
SLICES = 4


def _stream(spark, folder, name) -> DataFrame:
    return stream_table(spark, folder, name, read_table(spark, folder, name).schema)


def each_slice(spark, folder, run) -> None:
    """Lets slices of time land one after the other and calls ``run`` with the stream of all that have landed.

    A slice takes its events from every split of the table as they lie. A run takes all files of a slice in one
    micro-batch, however many tasks they make.
    """
    events = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("paper_id"), "l_suppkey", "l_extendedprice",
        F.col("l_shipdate").cast("timestamp").alias("cited_at"))
    span = events.agg(F.min("cited_at").alias("a"), F.max("cited_at").alias("b")).first()
    at = F.unix_seconds("cited_at")
    first, last = (F.unix_seconds(F.lit(span[c])) for c in "ab")
    part = F.least(F.floor((at - first) * SLICES / F.greatest(last - first, F.lit(1))), F.lit(SLICES - 1))
    path = fresh_path(spark, "landed-events")
    for number in range(SLICES):
        events.where(part == number).write.mode("append").parquet(path)
        run(spark.readStream.schema(events.schema).parquet(path))


def landed_documents(spark, folder, run=lambda stream: None):
    """Lets slices of the documents land one after the other, calls ``run`` after each, and gives the stream of them all.

    A slice takes its rows from every split of the table as they lie, so no task holds more than a split of the texts.
    A run takes all files that are new in one micro-batch.
    """
    path = fresh_path(spark, "landed-documents")
    rows = read_table(spark, folder, "documents").select("doc_id", "text")
    stream = spark.readStream.schema(rows.schema).parquet
    for number in range(SLICES):
        rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)) == number).write.mode("append").parquet(path)
        run(stream(path))
    return stream(path)


@query("stream_ingest", "SELECT DISTINCT md5(text) AS text_key, length(text) AS n_chars FROM documents")
def stream_ingest(spark, folder) -> DataFrame:
    """Streams the documents into a store keyed by content, twice: the second run adds nothing."""
    def rows(landed):
        return landed.select(F.md5("text").alias("text_key"), F.length("text").cast("bigint").alias("n_chars"), F.col("doc_id").alias("seq"))

    store = KeyedStore(spark, fresh_path(spark, "store"), "text_key", T.StructType.fromDDL("text_key string, n_chars bigint"), buckets=SLICES)
    first, again = fresh_path(spark, "ingest-first"), fresh_path(spark, "ingest-again")
    # a slice at a time, then all of them in one micro-batch
    landed = landed_documents(spark, folder, lambda stream: start_ingest(rows(stream), store, first, "seq").awaitTermination())
    start_ingest(rows(landed), store, again, "seq").awaitTermination()
    return store.rows()


@query("stream_horizon", f"{DATED_SQL} SELECT paper_id, category, submitted, citations_12mo, citations_24mo FROM horizon")
def stream_horizon(spark, folder) -> DataFrame:
    """Events land in slices of time, one per micro-batch, so a lateness of days lets days that are over go."""
    papers = papers_dated(spark, folder).select("paper_id", "category", "submitted")
    path, checkpoint = fresh_path(spark, "counts"), fresh_path(spark, "counts-checkpoint")
    each_slice(spark, folder, lambda events: start_counts(daily_counts(events, EVENT_KEY, LATENESS), path, checkpoint).awaitTermination())
    return running_horizon(papers, path)


@query("stream_horizon_keyed", f"{DATED_SQL} SELECT paper_id, category, submitted, citations_12mo, citations_24mo FROM horizon")
def stream_horizon_keyed(spark, folder) -> DataFrame:
    """The same with an entry per paper that a timer ends when its two years are over."""
    papers = papers_dated(spark, folder).select("paper_id", "category", "submitted")
    dated = write_once(papers, "dated-papers")
    path, checkpoint = fresh_path(spark, "paper-counts"), fresh_path(spark, "paper-counts-checkpoint")
    each_slice(spark, folder, lambda events: start_paper_counts(
        paper_counts(events, dated, EVENT_KEY, LATENESS, salts=SLICES), path, checkpoint).awaitTermination())
    return stored_horizon(dated, path).drop("final")


@query("stream_score", "SELECT doc_id AS paper_id, true AS same FROM documents")
def stream_score(spark, folder) -> DataFrame:
    """Scores the documents as an upload stream of title and abstract; each score against that of a batch."""
    papers = _stream(spark, folder, "documents").select(
        F.col("doc_id").alias("paper_id"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("abstract"))
    path = fresh_path(spark, "scores")
    start_scoring(scoring_model(spark, folder), papers, ["paper_id"], path,
                  fresh_path(spark, "scores-checkpoint")).awaitTermination()
    scored = rounded(spark.read.parquet(path))
    model = scoring_model(spark, folder)
    batch = rounded(model.with_bounds(model.predict_upload(papers_text(spark, folder).select("paper_id", "title", "abstract"), ["paper_id"])))
    return same_rows(scored, batch, "paper_id")
