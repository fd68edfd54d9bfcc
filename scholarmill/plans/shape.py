"""Output shaping shared by the queries, so that Spark and SQL results carry equal types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 6


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six digits, whole numbers as bigint."""
    def shaped(name: str, kind: str):
        c = F.col(f"`{name}`")
        if kind == "double":
            return F.round(c, DIGITS).alias(name)
        if kind in ("int", "tinyint", "smallint"):
            return c.cast("bigint").alias(name)
        return c

    return df.select(*(shaped(n, k) for n, k in df.dtypes))


def r6(sql: str) -> str:
    """The same rounding in SQL; adding 0.0 turns a negative zero into zero."""
    return f"(round(CAST({sql} AS DOUBLE), {DIGITS}) + 0.0)"


def big(sql: str) -> str:
    return f"CAST({sql} AS BIGINT)"
