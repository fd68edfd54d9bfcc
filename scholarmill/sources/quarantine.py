"""Valid and rejected rows of one input, both kept: nothing is dropped without a word."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

Check = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Quarantine:
    """Rows by round and outcome under ``path``.

    ``check`` adds ``violated``, the names of the rules a row breaks. A round is written in one pass: rows that break none
    go to one folder, the others with their reasons to another. A replay takes the rejected rows of all rounds so far,
    mends what its caller knows to mend, and checks them again as a round of its own.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    check: Check

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("violated", T.ArrayType(T.StringType()))])

    def admit(self, rows: DataFrame, number: int) -> None:
        """Writes round ``number``; a round that is written again replaces itself."""
        checked = self.check(rows).withColumn("accepted", F.size("violated") == 0)
        names = [f"`{f.name}`" for f in self.stored]
        checked.select(*names, "accepted").write.mode("overwrite").partitionBy("accepted").parquet(f"{self.path}/round={number}")

    def _rounds(self) -> DataFrame:
        both = T.StructType([*self.stored.fields, T.StructField("round", T.IntegerType()), T.StructField("accepted", T.BooleanType())])
        return self.spark.read.schema(both).parquet(self.path)

    def valid(self) -> DataFrame:
        return self._rounds().where("accepted").drop("violated", "accepted")

    def rejected(self) -> DataFrame:
        """Rows that wait, with their reasons: those of rounds that no replay has taken."""
        return self._rounds().where(~F.col("accepted") & (F.col("round") > self._replayed())).drop("accepted")

    def _store(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm.org.apache.hadoop.fs.Path, root, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _replayed(self) -> int:
        """The last round whose rejected rows were taken; -1 before the first replay."""
        path, root, store = self._store()
        marks = store.listStatus(path(root, "_replayed")) if store.exists(path(root, "_replayed")) else []
        return max((int(m.getPath().getName()) for m in marks), default=-1)

    def replay(self, mend: Check) -> int:
        """Checks the mended rejected rows as the next round and returns its number.

        The mark that they were taken follows their round, so a replay that breaks off leaves the rows where they are; run
        again, it replaces its round.
        """
        path, root, store = self._store()
        last = self._rounds().agg(F.max("round").alias("n")).first()["n"]
        last = -1 if last is None else last
        taken = self.rejected().where(F.col("round") <= last).drop("violated", "round")
        self.admit(mend(taken), last + 1)
        store.mkdirs(path(root, f"_replayed/{last}"))
        return last + 1


def start_admitting(stream: DataFrame, quarantine: Quarantine, checkpoint: str) -> StreamingQuery:
    """A round per micro-batch; a batch that is replayed after a failure replaces its own round."""
    return (stream.writeStream.foreachBatch(lambda batch, number: quarantine.admit(batch, number))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
