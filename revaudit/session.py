"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every revaudit job relies on.  AQE re-plans joins from real shuffle sizes,
# splits skewed join partitions and coalesces small shuffle partitions.  Broadcasts
# come only from explicit hints behind a check of measured bytes or from AQE's runtime
# conversion, which measures the materialised side; the plan-time estimate (a
# fraction of the Parquet file size) is not trusted: it let a 600k-row distinct
# side through as "small".
SESSION_DEFAULTS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app_name: str = "revaudit",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Rows of a shuffle partition of wide rows: few enough that a task sorts them in memory, also when three sorts hold them at once.
PARTITION_ROWS = 250_000


def partitions_of(spark: SparkSession, rows: int = 0) -> int:
    """The session's shuffle partitions, or more where they would hold more than ``PARTITION_ROWS`` of ``rows`` rows each."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PARTITION_ROWS))


#: Tables of more rows are built in steps: what a step leaves is stored, and its shuffle files go before the next one begins.
STEP_ROWS = 2_000_000
#: Keys that a range exchange samples for its bounds, about; up to three times as many come to the driver.
SAMPLED_KEYS = 30_000


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside only."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_removed(spark: SparkSession):
    """The shuffle files of each write inside go as soon as it is done, not when the driver happens to collect its garbage.

    For writes only: what they leave is read back from the files.
    """
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def bounded_sample(spark: SparkSession, partitions: int):
    """Range exchanges into ``partitions`` that run inside sample about ``SAMPLED_KEYS`` keys at most (10 of each partition at least)."""
    name = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    most = int(spark.conf.get(name, "100"))
    return settings(spark, {name: str(min(most, max(10, SAMPLED_KEYS // partitions)))})


def stored_step(table: DataFrame, kind: str) -> tuple[DataFrame, str]:
    """``table`` written below the shared folder and read back, and the folder; the shuffle files of the step are gone."""
    spark = table.sparkSession
    path = work_path(spark, kind, uuid.uuid4().hex[:12])
    with shuffles_removed(spark):
        table.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(table.schema).parquet(path), path


def _is_local(spark: SparkSession) -> bool:
    """One JVM, one set of folders: ``local`` or ``local[..]``, not ``local-cluster[..]``."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and written intermediate tables.

    Taken from ``spark.checkpoint.dir``.  Only a local session (tests) without that
    setting gets a folder of its own; a cluster session without it is an error,
    because a machine-local folder is not visible to the executors.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="revaudit-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    if _is_local(spark) and "://" not in folder:
        os.makedirs(folder, exist_ok=True)
    return folder.rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared folder, e.g. ``work_path(spark, 'snapshots', 'v=3')``."""
    return "/".join([shared_dir(spark), "revaudit", *parts])
