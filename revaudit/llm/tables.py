"""Written intermediate tables and input helpers of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back.

    Cuts the lineage with one job: a lost executor costs the tasks that read the
    files, not the steps before them.  The folder belongs to the caller's
    ``spark.checkpoint.dir`` and is removed with it.
    """
    spark = df.sparkSession
    path = work_path(spark, "llm", f"{tag}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(columns: list[str], name: str) -> str:
    """``name``, with as many underscores behind it as it takes to differ from all ``columns`` (whatever their case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column over all rows."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0])


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once for a session), so that tasks can import it anywhere."""
    import os
    import tempfile
    import zipfile

    name = "revaudit_tasks.zip"
    if any(f.endswith(name) for f in spark.sparkContext.listFiles):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="revaudit-"), name)
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    packed.write(full, os.path.join("revaudit", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
