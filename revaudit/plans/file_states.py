"""Fingerprint of a folder of files from stored states: only files without a state are read.

    <root>/file_states     states of the files read so far (append-only Parquet)

A file counts as known by its path, size and time of change; states of files that are gone or were replaced are
left out by the join with the current listing.  Two runs at once may both add a file's states: states of one file are alike, so one of each is taken.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.content import STATE_COLUMNS, merged_fingerprint, movement_states
from .publish import path_exists

_FILE = ("path", "size", "changed")


@dataclass
class FolderFingerprint:
    fingerprint: DataFrame
    #: Files of the folder that had to be read by this run.
    read: list[str]


def _plain(path: Column) -> Column:
    """One spelling of ``scheme:/path`` and ``scheme:///path``."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, size, changed of the Parquet files of the folders or files, without reading them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths)
    return files.select(F.col("path").alias("given"), _plain(F.col("path")).alias("path"), F.col("length").alias("size"),
                        F.col("modificationTime").alias("changed"))


def _known(spark: SparkSession, folder: str) -> DataFrame | None:
    return spark.read.parquet(folder) if path_exists(spark, folder) else None


def folder_fingerprint(spark: SparkSession, paths: list[str], root: str) -> FolderFingerprint:
    """Fingerprint of the movements in ``paths``; states below ``root``.

    Only the paths of new files come to the driver.
    """
    folder = f"{root}/file_states"
    files, known = listing(spark, paths), _known(spark, folder)
    new = files if known is None else files.join(known.select(*_FILE).distinct(), list(_FILE), "left_anti")
    read = sorted(r["given"] for r in new.select("given").collect())
    if read:
        source = spark.read.parquet(*read)
        keyed = source.select("*", _plain(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("size"),
                              F.col("_metadata.file_modification_time").alias("changed"))
        states = movement_states(keyed, *_FILE)
        empty = new.select(*_FILE, *[F.lit(None).alias(c) for c in ("railway", "station")], F.lit(0).cast("long").alias("n"))
        # A file without rows is known by a state of no rows.
        states.unionByName(empty, allowMissingColumns=True).write.mode("append").parquet(folder)
        known = _known(spark, folder)
    if known is None:
        known = spark.createDataFrame([], "path string, size bigint, changed timestamp, railway string, station string, n bigint, "
                                          "lo timestamp_ntz, hi timestamp_ntz, content decimal(38,0)")
    # One state for each file and names, whichever run wrote it; files without rows bring none.
    current = (known.where("n > 0").join(files.select(*_FILE), list(_FILE), "left_semi")
               .dropDuplicates([*_FILE, "railway", "station"]).select(*STATE_COLUMNS))
    return FolderFingerprint(merged_fingerprint(current), read)
