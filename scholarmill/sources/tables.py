"""Readers and writers for tables in files and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmill.sources.schemas import UPLOAD
from scholarmill.sources.split_csv import read_split_csv


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int,
              partitions: int, **options: str) -> DataFrame:
    """A database table read by ranges of a numeric ``key``, one connection per range."""
    return (spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key,
                                              lowerBound=lower, upperBound=upper,
                                              numPartitions=partitions, **options).load())


def stream_table(spark: SparkSession, folder: str, name: str, schema: T.StructType,
                 files_per_batch: int | None = None) -> DataFrame:
    """The same table as a file stream.

    The bracket makes the path a pattern, so a single file and a folder of part files both match.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/{name}.parque[t]")


def write_features(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """One keyed table holds id, features and targets; rows never rely on their position.

    With ``partition_by`` rows are dealt out by it first, so a folder has as many files as its size needs, not one per
    task; a value with very many rows is split.
    """
    writer = df.hint("rebalance", partition_by).write.partitionBy(partition_by) if partition_by else df.write
    writer.mode("overwrite").parquet(path)


def read_upload(spark: SparkSession, path: str) -> DataFrame:
    """A CSV batch of title and abstract; a missing cell becomes the empty string."""
    rows = read_split_csv(spark, path, UPLOAD)
    return rows.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in UPLOAD.fieldNames()))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_summary(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table, as one union of single-row aggregates."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out
