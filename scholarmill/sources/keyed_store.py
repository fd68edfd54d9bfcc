"""A Parquet store with one row per key, whose inserts read little of it.

Rows lie in a folder per bucket of the key's hash. Beside them every bucket has a Bloom filter: for each key some bits,
kept as rows ``(word, bits)`` that add up by "or". A batch of new rows first asks the filters. Keys that lack a bit are
new, without a look at the rows; only buckets in which some key has all its bits are opened, and only their keys are
read. So what a micro-batch reads follows the batch and not the store.

Filters are written before rows: an insert that fails in between leaves bits without rows, which costs a look later and
never a row. One writer at a time; a repeated batch finds its rows and adds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmill.operators.ingest import first_per_key
from scholarmill.session import write_once

#: Buckets of a store, bits of a bucket's filter, bits of a key. At ten bits a key, one new key in 120 is looked up.
BUCKETS, BITS, PROBES = 32, 1 << 23, 7

WORD_BITS = 64


@dataclass(frozen=True)
class KeyedStore:
    """The numbers are part of the store: open it with those it was made with."""

    spark: SparkSession
    path: str
    key: str
    schema: T.StructType
    buckets: int = BUCKETS
    bits: int = BITS
    probes: int = PROBES

    FILTER = "word int, bits bigint"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{self.key}`")), F.lit(self.buckets)).cast("int")

    def _read(self, part: str, schema, buckets: list[int] | None = None) -> DataFrame:
        """Rows or filter words of the given buckets; only their folders are listed."""
        root = f"{self.path}/{part}"
        jvm = self.spark.sparkContext._jvm
        store = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        folders = [f"{root}/_bucket={b}" for b in (range(self.buckets) if buckets is None else buckets)]
        held = [f for f in folders if store.exists(jvm.org.apache.hadoop.fs.Path(f))]
        if not held:
            return self.spark.createDataFrame([], schema).withColumn("_bucket", F.lit(None).cast("int"))
        both = T.StructType([*(T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields, T.StructField("_bucket", T.IntegerType())])
        return self.spark.read.schema(both).option("basePath", root).parquet(*held)

    def rows(self) -> DataFrame:
        return self._read("rows", self.schema).drop("_bucket")

    def _places(self, rows: DataFrame) -> DataFrame:
        """``(key, _bucket, probe, word, mask)``: the bits of each key."""
        key = F.col(f"`{self.key}`")
        at = F.array(*(F.pmod(F.xxhash64(key, F.lit(i)), F.lit(self.bits)).cast("int") for i in range(self.probes)))
        placed = rows.select(key.alias("key"), "_bucket", F.posexplode(at).alias("probe", "at"))
        return placed.select("key", "_bucket", "probe", F.floor(F.col("at") / WORD_BITS).cast("int").alias("word"),
                             F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % WORD_BITS).alias("mask"))

    def suspects(self, batch: DataFrame) -> DataFrame:
        """``(key, _bucket)`` of the rows of ``batch(key, _bucket)`` whose bits are all set."""
        buckets = [r["_bucket"] for r in batch.select("_bucket").distinct().collect()]
        words = self._read("filters", self.FILTER, buckets)
        asked = self._places(batch)
        hit = asked.join(words, ["_bucket", "word"]).filter(F.col("mask").bitwiseAND(F.col("bits")) != 0)
        return hit.groupBy("key", "_bucket").agg(F.count_distinct("probe").alias("n")).filter(F.col("n") == self.probes).drop("n")

    def keys_of(self, buckets: list[int]) -> DataFrame:
        """The stored keys of some buckets."""
        return self._read("rows", self.schema, buckets).select(F.col(f"`{self.key}`").alias("stored_key"))

    def new_rows(self, incoming: DataFrame, seq: str) -> DataFrame:
        """The first row of each key that the store lacks, with its bucket; a null key is a key."""
        batch = write_once(first_per_key(incoming, self.key, seq).withColumn("_bucket", self.bucket()), "incoming")
        suspects = write_once(self.suspects(batch.select(F.col(f"`{self.key}`"), "_bucket")), "suspects")
        buckets = [r["_bucket"] for r in suspects.select("_bucket").distinct().collect()]
        if not buckets:
            return batch
        stored = self.keys_of(buckets)
        known = write_once(suspects.join(stored, F.col("key").eqNullSafe(F.col("stored_key")), "left_semi").select("key"), "known")
        return batch.join(known, F.col(f"`{self.key}`").eqNullSafe(known["key"]), "left_anti")

    def insert(self, incoming: DataFrame, seq: str) -> None:
        """Adds the rows of new keys; ``seq`` says which of a key's rows is the first and is not stored."""
        fresh = self.new_rows(incoming, seq)
        # dealt out by bucket once, for the sums and for the files
        placed = self._places(fresh.select(F.col(f"`{self.key}`"), "_bucket")).repartition("_bucket")
        words = placed.groupBy("_bucket", "word").agg(F.bit_or("mask").alias("bits"))
        words.select("word", "bits", "_bucket").write.partitionBy("_bucket").mode("append").parquet(f"{self.path}/filters")
        columns = [f"`{f.name}`" for f in self.schema]
        fresh.select(*columns, "_bucket").hint("rebalance", "_bucket").write.partitionBy("_bucket").mode("append").parquet(f"{self.path}/rows")
