"""CSV files with quoted line breaks, read by many tasks.

Where a record ends depends on how many quotes come before, so a file is usually read by one task from its start. Here
every split of a file is scanned for its lines and its number of quotes. The parity of the quotes before a split, a
prefix sum over the splits of a file, says whether it begins inside a quoted cell. Knowing that, each split is cut into
records by itself; what it begins and ends with may be part of a record that crosses its bounds, and those pieces are put
together afterwards.

Files are read as RFC 4180 has them: a cell with a quote, a separator or a line break stands in quotes, and a quote in it
is doubled. A record is a line for the text reader only as long as quotes are even, so a single quote inside an unquoted
cell, which that form does not allow, would shift all that follows in its file.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmill.session import settings, ship, write_once

#: Bytes of a split.
SPLIT_BYTES = 64 << 20

#: Records, and characters of them, that leave a task together, and what Arrow hands over at once: long lines are fewer.
RECORDS_TOGETHER, CHARACTERS_TOGETHER = 4096, 1 << 20
FEW_AT_ONCE = {"spark.sql.execution.arrow.maxBytesPerBatch": "1m"}

#: What a task finds: a whole record, or the end, the beginning, or the middle of one that crosses splits.
WHOLE, END, BEGIN, MIDDLE = 0, 1, 2, 3

PIECES = "split bigint, kind int, first boolean, record string"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``(file, begin, split, line)``: lines in the order of their file within each split."""
    rows = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), F.col("value").alias("line"))
    return rows.select("file", "begin", F.xxhash64("file", "begin").alias("split"), "line")


def records(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(record)`` of every file's records but its first, the header; empty lines are no records."""
    ship(spark)
    # splits depend on these alone, so both scans cut the files alike, whatever executors there are
    fixed = {"spark.sql.files.maxPartitionBytes": str(split_bytes), "spark.sql.files.openCostInBytes": str(split_bytes),
             "spark.sql.files.minPartitionNum": "1", **FEW_AT_ONCE}
    with settings(spark, fixed):
        lines = lines_of(spark, path)
        quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
        splits = write_once(lines.groupBy("file", "begin", "split").agg((F.sum(quotes) % 2).alias("odd")), "csv-splits")
        before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
        placed = write_once(splits.withColumn("inside", F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)) == 1), "csv-places")
        if placed.count() != placed.select("split").distinct().count():
            raise ValueError("two splits share a hash")  # a chance of one in 2 ** 64 for each pair
        # a number for each split that begins inside a cell
        inside = frozenset(r["split"] for r in placed.filter("inside").select("split").toLocalIterator())
        starts = frozenset(r["split"] for r in placed.filter("begin = 0").select("split").toLocalIterator())
        pieces = write_once(lines.select("split", "line").mapInArrow(cutter(inside, starts), PIECES), "csv-pieces")
    whole = pieces.filter(F.col("kind") == WHOLE).select("first", "record")
    # pieces of one record follow one another: each begins with a BEGIN
    parts = pieces.filter(F.col("kind") != WHOLE).join(placed.select("file", "begin", "split"), "split")
    order = Window.partitionBy("file").orderBy("begin", (F.col("kind") != END).cast("int"))
    numbered = parts.withColumn("at", F.row_number().over(order)).withColumn(
        "number", F.sum((F.col("kind") == BEGIN).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy("file", "number").agg(
        F.max("first").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "record"))), lambda x: x["record"]), "\n").alias("record"))
    every = whole.unionByName(joined.select("first", "record"))
    return every.filter(~F.col("first")).select(F.regexp_replace("record", "\r$", "").alias("record")).filter("record <> ''").select(
        F.replace("record", F.lit("\r\n"), F.lit("\n")).alias("record"))


def cutter(inside: frozenset[int], starts: frozenset[int]):
    """The task that cuts lines into pieces; lines of a split come together and in order."""
    schema = pa.schema([("split", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("record", pa.string())])

    def run(batches):
        split, held, open_, crossed, n = None, [], False, False, 0
        out: list[tuple] = []
        size = 0

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

        def end_of_split():
            # what is open goes on in the next split
            if held:
                out.append((split, MIDDLE if crossed else BEGIN, split in starts and n == 0, "\n".join(held)))

        for batch in batches:
            odd = pc.bit_wise_and(pc.count_substring(batch.column(1), '"'), 1).to_pylist()
            for own, line, quotes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), odd):
                if own != split:
                    end_of_split()
                    split, held, n = own, [], 0
                    open_ = crossed = own in inside
                held.append(line)
                open_ ^= bool(quotes)
                if not open_:
                    first = own in starts and n == 0 and not crossed
                    out.append((own, END if crossed else WHOLE, first, "\n".join(held)))
                    size += len(out[-1][-1])
                    held, crossed, n = [], False, n + 1
                    if len(out) >= RECORDS_TOGETHER or size >= CHARACTERS_TOGETHER:
                        yield sent()
                        out.clear()
                        size = 0
        end_of_split()
        if out:
            yield sent()

    return run


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The rows of CSV files with a header each; columns are taken by place, missing cells are null."""
    parsed = F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"escape": '"', "mode": "PERMISSIVE"})
    return records(spark, path, split_bytes).select(parsed.alias("r")).select("r.*")
