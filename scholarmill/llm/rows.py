"""Rows in and out of the Arrow operators, shared by this subpackage.

Every operator takes the id and text columns it is told and reads no other, so further columns, also ones named like
its outputs, cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmill.session import ship

#: Rows of one Arrow batch at most, so that a batch of long texts stays small; the default of 10,000 suits numbers.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds Arrow batches, lets shuffle files go early, and sends this package to executors that do not have it on their path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    # operators write their steps as tables; a step's shuffle files are of no use after it
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return ship(spark)


def column(name: str) -> Column:
    return F.col(f"`{name}`")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` and nothing else; a null text is empty."""
    prepare(docs.sparkSession)
    return docs.select(column(id_col).alias("doc_id"), F.coalesce(column(text_col), F.lit("")).alias("text"))


def blocks(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of about ``size`` characters together; one longer text is a block of its own."""
    ids: list = []
    held: list[str] = []
    n = 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(key)
            held.append(text)
            n += len(text) + 50
            if n >= size:
                yield ids, held
                ids, held, n = [], [], 0
    if ids:
        yield ids, held


def words_between(raw: np.ndarray, gap: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of ``raw`` bytes and where each starts; ``gap`` says of each byte whether it lies between words."""
    inside = np.concatenate([[False], ~gap[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    offsets = np.append(0, np.cumsum(end - start)).astype(np.int32)
    data = raw[inside[1:-1]].tobytes()
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]), start


def fields(df: DataFrame, name: str) -> str:
    """The DDL type of a column, for output schemas that keep an id of any type."""
    return df.schema[name].dataType.simpleString()


def arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)
