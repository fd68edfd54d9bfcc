"""Session settings, the shared working folder, and tables that cut lineage."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# masters whose executors live in the driver's process, not those of a local cluster
ONE_PROCESS = re.compile(r"local(\[[^\]]*\])?")

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keyed streaming state grows with the number of papers, so keep it off-heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "scholarmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; pass dotted settings through ``**{"spark.x": "y"}``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, held: dict[str, str]) -> Iterator[None]:
    """Session settings that hold for the jobs run inside, whatever comes of them."""
    before = {key: spark.conf.get(key, None) for key in held}
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to executors that do not have it on their path; operators that run Python in tasks need it."""
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        package = Path(__file__).resolve().parent
        handle, target = tempfile.mkstemp(prefix="scholarmill-", suffix=".zip")
        with os.fdopen(handle, "wb") as out, zipfile.ZipFile(out, "w") as archive:
            for path in sorted(package.rglob("*.py")):
                archive.write(path, path.relative_to(package.parent))
        spark.sparkContext.addPyFile(target)
        atexit.register(lambda: os.path.exists(target) and os.unlink(target))
        _SHIPPED.add(application)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder, which only tests rely on.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured
    if not ONE_PROCESS.fullmatch(spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    made = tempfile.mkdtemp(prefix="scholarmill-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set(CHECKPOINT_KEY, made)
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_dir(spark: SparkSession) -> str:
    """This application's own folder under the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/scholarmill-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the application's folder that no earlier call gave."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


_RELEASES: dict[str, int] = {}


def releases(spark: SparkSession) -> int:
    """How often this application's tables were deleted; what is kept across calls holds for one such time."""
    return _RELEASES.get(spark.sparkContext.applicationId, 0)


def release(spark: SparkSession) -> None:
    """Deletes what ``write_once`` and the queries have written for this application.

    DataFrames that read such tables are of no use afterwards, so a long job calls this when it has stored its results.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    _RELEASES[spark.sparkContext.applicationId] = releases(spark) + 1
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_once(df: DataFrame, label: str, by: str | None = None, row_group: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Later plans start from the files, so a lost executor re-reads them instead of recomputing.  ``by`` names a column
    of few values that gets a folder per value: a plan for one value reads its files only.  ``row_group`` is the size in
    bytes that later scans can split, for rows that are costly to work on.
    """
    path = fresh_path(df.sparkSession, label)
    writer = df.hint("rebalance", by).write.partitionBy(by) if by else df.write
    (writer.option("parquet.block.size", row_group) if row_group else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
