"""The shared folder for tables that outlive a job."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the cluster's checkpoint folder: the one that
    spark.checkpoint.dir names, or else that was set on the context.

    Without either only a single-machine session can do with a local folder; on
    a cluster the executors would not share it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="covshare-")
    return f"{folder.rstrip('/')}/covshare-{label}-{uuid.uuid4().hex}"


def stored(table: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read back.

    Cuts the lineage for good: a lost executor re-reads files. The folder stays
    until `discard`.
    """
    spark = table.sparkSession
    path = scratch_path(spark, label)
    table.write.parquet(path)
    back = spark.read.schema(table.schema).parquet(path)
    back.stored_at = path
    return back


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path, in whatever file system it is; nothing happens if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables: DataFrame | None) -> None:
    """Delete the folders of stored tables. Only for those that no result still
    to be computed reads: what was made from them must be stored itself."""
    for table in tables:
        if table is not None:
            remove(table.sparkSession, table.stored_at)


@contextlib.contextmanager
def passing(spark: SparkSession, label: str) -> Iterator[str]:
    """A path for tables that are of no use afterwards; removed also after an error."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        remove(spark, path)
