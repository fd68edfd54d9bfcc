"""Running citation counts from a stream of citing events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from scholarmill.operators.horizon import MONTHS, horizon_of_daily

COMPACTED = "paper_id bigint, started timestamp, cited_on date, n_events bigint"
STORED = f"{COMPACTED}, batch int"


def daily_counts(events: DataFrame, event_key: Sequence[str], delay: str) -> DataFrame:
    """Events per paper and day so far.  ``events`` has ``paper_id``, ``cited_at`` (timestamp) and its key.

    A horizon is relative to each paper's own date, which no event-time window fits; days do.  So the
    stream counts days and needs no papers: a paper with many events spreads over its days, and
    the watermark evicts both the repeats it guards against and the days that are over.  An event
    later than ``delay`` is dropped, so choose the lateness to accept and reconcile with the batch
    count.

    Repeats under a key that holds paper and time meet on their day, so the day's own entry tells them apart and
    the state has an entry per paper and day; under another key it also has one per event.
    """
    late = events.withWatermark("cited_at", delay)
    if {"paper_id", "cited_at"} <= set(event_key):
        fresh, count = late, F.size(F.collect_set(F.struct(*(c for c in event_key if c != "paper_id")))).cast("long")
    else:
        fresh, count = late.dropDuplicatesWithinWatermark(list(event_key)), F.count("*")
    return (fresh.groupBy("paper_id", F.window("cited_at", "1 day").alias("w"),
                          F.to_date("cited_at").alias("cited_on"))
            .agg(count.alias("n_events"))
            .select("paper_id", F.col("w.start").alias("started"), "cited_on", "n_events"))


def start_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the changed counts of each micro-batch under its own number.

    A replay overwrites its own folder only.
    """
    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (counts.writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the finished folders ``prefix=number``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(root):
        return []
    found = (f.getPath() for f in store.listStatus(root))
    return sorted(int(p.getName().split("=")[1]) for p in found
                  if p.getName().startswith(f"{prefix}=") and store.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def compact_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(paper_id, cited_on, n_events)``: the latest count of each paper and day.

    What was compacted before is kept beside ``path`` under the number of the last micro-batch in it, so a call reads
    that table and the micro-batches since, and writes the next one.  Run between runs of the stream.
    """
    batches, kept = _numbers(spark, path, "batch"), _numbers(spark, f"{path}-compacted", "upto")
    last = kept[-1] if kept else -1
    newer = [b for b in batches if b > last]
    if newer or not kept:
        stored = spark.read.schema(STORED).parquet(path).where(F.col("batch") > last)
        if kept:
            base = spark.read.schema(COMPACTED).parquet(f"{path}-compacted/upto={last}")
            stored = stored.unionByName(base.withColumn("batch", F.lit(last)))
        latest = stored.groupBy("paper_id", "started", "cited_on").agg(F.max_by("n_events", "batch").alias("n_events"))
        last = newer[-1] if newer else last
        latest.write.mode("overwrite").parquet(f"{path}-compacted/upto={last}")
    table = spark.read.schema(COMPACTED).parquet(f"{path}-compacted/upto={last}")
    return table.groupBy("paper_id", "cited_on").agg(F.sum("n_events").alias("n_events"))


def running_horizon(papers: DataFrame, path: str, months: tuple[int, ...] = MONTHS) -> DataFrame:
    """Horizon counts from the latest stored count of each paper and day."""
    return horizon_of_daily(papers, compact_counts(papers.sparkSession, path), months)
