"""What Python workers are given: this package, and batches that fit in memory."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let the workers of a local session import the package from where the driver
    did, whatever the working directory. A cluster gets it with --py-files."""
    context = spark.sparkContext
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if context.master.startswith("local") and _ROOT not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join(p for p in (_ROOT, *paths) if p)


_kept: dict[Callable, tuple] = {}


def kept(make: Callable, path: str):
    """`make(path)`, once in a worker for all its tasks that ask for the same file one
    after another: what is read from the file and learnt from texts stays."""
    stat = os.stat(path)
    key = (path, stat.st_mtime_ns, stat.st_size)
    if make not in _kept or _kept[make][0] != key:
        _kept.pop(make, None)
        _kept[make] = (key, make(path))
    return _kept[make][1]


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_MOST_ROWS = 1000


def short_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch, if it has more: whole texts make
    batches of the usual 10,000 rows so large that several copies of one, in the
    executor and its workers, take a good part of a small executor."""
    if int(spark.conf.get(_BATCH_ROWS)) > _MOST_ROWS:
        spark.conf.set(_BATCH_ROWS, _MOST_ROWS)
