"""Exact copies of texts, as a stream whose keyed state on disk never expires.

Two chained streams read every file of a table once, also those that come later:

1. *Arrivals.* Each row becomes its digest (SHA-256 of the text without white space), its id, its length and a content
   locator: the file and the row in it where the text lies. No text goes further than the task that reads it.
2. *State.* RocksDB keeps one entry per digest without a watermark or a time to live: how many rows have had it, and
   length, id and locator of the row that stays. Rows are combined per task before they are dealt out by digest, so a
   text that a third of all rows share costs its state task one row per map task and micro-batch.

Decisions join arrivals with the state. A digest that more than one row has had is a hit: the text of each such row is
fetched by its locator and compared byte by byte with the text at the locator of the row that stays. Members of a large
group are dealt over several tasks, each with its own copy of that one text. Digests under which texts differ are
grouped anew by their bytes, so the outcome does not rest on the digest.

Both streams recover from their checkpoints under the shared folder: a lost executor or a second run continues where
the last committed micro-batch ended, and files that were read are not read again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmill.llm.rows import column
from scholarmill.session import fresh_path, settings, write_once

#: What does not count when texts are compared (fixed values of the contract).
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"

#: Bytes of the digest that are the key of the state, files of one micro-batch, rows that are compared in one task.
KEY_BYTES, FILES_PER_BATCH, MEMBERS_TOGETHER = 32, 4096, 4096

#: State on disk; changes are checkpointed, not whole copies, and many small stores do not reserve room beforehand.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """The text without white space; a null text is empty."""
    out = F.coalesce(text, F.lit(""))
    for sign in WHITE:
        out = F.replace(out, F.lit(sign), F.lit(""))
    return out


def locator() -> Column:
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def preference() -> Column:
    """The least of these stays: the longest text, then the smallest id (rows without an id last), then the first place."""
    return F.struct((-F.col("points")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "at")


def globbed(path: str) -> str:
    """``path`` as a pattern that only it matches: a stream takes a folder or a pattern, but no single file."""
    return re.sub(r"([A-Za-z0-9_])/*$", r"[\1]", path)


@dataclass(frozen=True)
class Intake:
    """One table's streams: where it lies, and the folder of its arrivals, state and checkpoints."""

    spark: SparkSession
    path: str
    home: str
    id_col: str = "doc_id"
    text_col: str = "text"
    key_bytes: int = KEY_BYTES

    def schema(self) -> T.StructType:
        """Id and text alone are read, so further columns, whatever their names, cannot clash."""
        found = self.spark.read.parquet(self.path).schema
        return T.StructType([found[self.id_col], found[self.text_col]])

    def arrivals(self) -> DataFrame:
        """``(key, sha, doc_id, points, at)`` of every row that has been read."""
        return self.spark.read.schema(self._arrival_schema()).parquet(f"{self.home}/arrivals")

    def _arrival_schema(self) -> T.StructType:
        at = T.StructType([T.StructField("file", T.StringType()), T.StructField("row", T.LongType())])
        return T.StructType([T.StructField("key", T.BinaryType()), T.StructField("sha", T.BinaryType()),
                             T.StructField("doc_id", self.schema()[self.id_col].dataType),
                             T.StructField("points", T.IntegerType()), T.StructField("at", at)])

    def read_on(self, files_per_batch: int = FILES_PER_BATCH) -> Intake:
        """Reads all files that have not been read, in micro-batches, and stops."""
        source = self.spark.readStream.schema(self.schema()).option("maxFilesPerTrigger", files_per_batch).parquet(globbed(self.path))
        sha = F.unhex(F.sha2(normalised(column(self.text_col)), 256))
        rows = source.select(
            sha.alias("sha"), column(self.id_col).alias("doc_id"),
            F.coalesce(F.length(column(self.text_col)), F.lit(0)).alias("points"), locator().alias("at"))
        rows = rows.select(F.substring("sha", 1, self.key_bytes).alias("key"), "sha", "doc_id", "points", "at")
        with settings(self.spark, STATE_STORE):
            rows.writeStream.format("parquet").option("path", f"{self.home}/arrivals").option(
                "checkpointLocation", f"{self.home}/arrivals-checkpoint").trigger(availableNow=True).start().awaitTermination()
            come = self.spark.readStream.schema(self._arrival_schema()).option("maxFilesPerTrigger", files_per_batch).parquet(f"{self.home}/arrivals")
            held = come.groupBy("key").agg(F.min(preference()).alias("stays"), F.count("*").alias("n"))
            held.writeStream.format("noop").outputMode("update").option(
                "checkpointLocation", f"{self.home}/state-checkpoint").trigger(availableNow=True).start().awaitTermination()
        return self

    def state(self) -> DataFrame:
        """``(key, stays, n)``: the state after the last committed micro-batch."""
        commits = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.home}/state-checkpoint/commits")
        files = commits.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not (files.exists(commits) and files.listStatus(commits)):
            # nothing has come yet
            return self.arrivals().groupBy("key").agg(F.min(preference()).alias("stays"), F.count("*").alias("n"))
        kept = self.spark.read.format("statestore").load(f"{self.home}/state-checkpoint")
        stays, n = kept.schema["value"].dataType.names
        return kept.select("key.key", F.col(f"value.{column_name(stays)}").alias("stays"), F.col(f"value.{column_name(n)}").alias("n"))

    def texts_of(self, wanted: DataFrame) -> DataFrame:
        """``wanted(at, ...)`` with ``body``, the normalised text that lies at the locator."""
        rows = self.spark.read.schema(self.schema()).parquet(self.path).select(
            locator().alias("at"), normalised(column(self.text_col)).alias("body"))
        return wanted.join(rows, "at")


def column_name(name: str) -> str:
    return f"`{name}`"


def intake(spark: SparkSession, path: str, home: str | None = None, **columns) -> Intake:
    """The streams of the Parquet table at ``path``; give ``home`` to go on from an earlier run."""
    return Intake(spark, path, home or fresh_path(spark, "exact-copies"), **columns)


def confirmed(own: Intake, hits: DataFrame, together: int) -> DataFrame:
    """``(at, stays, n)`` for each of ``hits(key, at, doc_id, points, stays, n)``, by the bytes of the texts."""
    held = write_once(own.texts_of(hits), "texts-of-hits")
    parts = F.ceil(F.col("n") / together).cast("int")
    firsts = held.filter("at = stays.at").select("key", F.col("body").alias("kept_body"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    dealt = held.withColumn("part", F.pmod(F.xxhash64("at"), parts).cast("int"))
    compared = dealt.join(firsts, ["key", "part"]).select("key", "at", "stays", "n", (F.col("body") == F.col("kept_body")).alias("same"))
    compared = write_once(compared, "compared-hits")
    # no rows as long as the digest tells texts apart: written, so that the planner knows and deals nothing out by it
    differ = write_once(compared.filter("NOT same").select("key").distinct(), "digests-that-differ")
    # texts that differ under one digest: each set of equal bytes is a group
    apart = held.join(differ, "key", "left_semi")
    groups = apart.groupBy("key", "body").agg(F.min(preference()).alias("stays"), F.count("*").alias("n"))
    apart = apart.select("key", "body", "at").join(groups, ["key", "body"]).select("at", "stays", "n")
    return compared.join(differ, "key", "left_anti").select("at", "stays", "n").union(apart)


def decide(own: Intake, together: int = MEMBERS_TOGETHER) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, sha)``, one row per row that has been read.

    Texts are equal when they are identical without white space; null and empty texts are equal to those of white space
    alone. Of equal texts the longest stays (code points of the original), then the smallest id, a row without an id
    last; of rows that agree in all that, the first by file and place, so that exactly one row of a group stays, also of
    wholly repeated rows. ``keep_id`` is null if the row that stays has no id. An empty table gives no rows.
    """
    arrivals = own.arrivals()
    # written first: a join of two plain shuffles lets the planner split a digest that very many rows have
    with settings(own.spark, STATE_STORE):
        several = write_once(own.state().filter("n > 1"), "digests-of-several")
    hits = arrivals.select("key", "doc_id", "points", "at").join(several, "key")
    sure = write_once(confirmed(own, hits, together), "confirmed-hits")
    joined = arrivals.select("doc_id", "sha", "at").join(sure, "at", "left")
    alone = F.col("n").isNull()
    return joined.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
                         F.when(alone, F.lit(1)).otherwise(F.col("n")).cast("long").alias("group_size"),
                         (alone | (F.col("at") == F.col("stays.at"))).alias("kept"), "sha")


def digests(decided: DataFrame) -> DataFrame:
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
