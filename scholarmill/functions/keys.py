"""Row assignment by a hash of the key, which does not depend on partitions or run order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEST_BUCKETS = 5


def hash_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    digest = F.md5(F.concat(F.lit(salt), key.cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets).cast("int")


def split_label(key: Column) -> Column:
    """About one row in five goes to ``test``."""
    return F.when(hash_bucket(key, TEST_BUCKETS) == 0, "test").otherwise("train")


def fold_number(key: Column, folds: int = 5) -> Column:
    return hash_bucket(key, folds, salt="fold-")
