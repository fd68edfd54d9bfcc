"""Train, test and fold assignment on the key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.functions.keys import fold_number, split_label


def with_split(df: DataFrame, key: str = "paper_id") -> DataFrame:
    return df.withColumn("split", split_label(F.col(key)))


def with_fold(df: DataFrame, key: str = "paper_id", folds: int = 5) -> DataFrame:
    return df.withColumn("fold", fold_number(F.col(key), folds))
