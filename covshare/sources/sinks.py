"""CSV and Parquet writers, and publishing all tables of a run at once."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covshare.sources import schemas
from covshare.sources.scratch import remove

_MANIFEST = "manifest.json"


def write_csv(
    table: DataFrame, path: str, encoding: str = schemas.UNICODE, delimiter: str = ","
) -> None:
    """Replaces what the path held."""
    table.write.mode("overwrite").csv(
        path, header=True, encoding=encoding, sep=delimiter
    )


def write_parquet(table: DataFrame, path: str, *partition_by: str) -> None:
    """Replaces what the path held.

    Rows are brought together by the partition columns first, or else every task
    would write a file for every value. A value with many rows is split, so the
    number of files follows the size of the table and not that of the cluster.
    """
    if partition_by:
        table = table.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    table.write.mode("overwrite").parquet(path, partitionBy=list(partition_by) or None)


def write_report(report: DataFrame, path: str) -> None:
    """The county report under its published column names."""
    write_csv(report.withColumnsRenamed(schemas.REPORT_NAMES), path)


class Publication:
    """The tables of one run, which become the published ones all at once.

    A run writes into a folder of its own below ``out``. Only ``commit`` makes it
    the published one, by replacing the manifest in one step; a run that fails
    before leaves the tables of the last one as they are. The run before stays for
    those still reading it. One run at a time may publish to a folder.
    """

    def __init__(self, spark: SparkSession, out: str):
        self._spark = spark
        self._out = out.rstrip("/")
        self._run = uuid.uuid4().hex
        self._tables: dict[str, str] = {}

    def path(self, name: str, kind: str = "csv") -> str:
        """Where this run writes a table of a format that Spark reads."""
        self._tables[name] = kind
        return f"{self._out}/runs/{self._run}/{name}"

    def commit(self) -> None:
        before = _manifest(self._spark, self._out)
        tables = {
            name: {"path": f"runs/{self._run}/{name}", "format": kind}
            for name, kind in self._tables.items()
        }
        content = json.dumps({"run": self._run, "before": before and before["run"], "tables": tables}, indent=1)
        _replace(self._spark, f"{self._out}/{_MANIFEST}", f"{self._out}/.{self._run}", content)
        self._remove_other_runs({self._run, before and before["run"]})

    def abandon(self) -> None:
        """Remove what this run has written so far."""
        remove(self._spark, f"{self._out}/runs/{self._run}")

    def _remove_other_runs(self, kept: set[str | None]) -> None:
        place, files = _file_system(self._spark, f"{self._out}/runs")
        for found in files.listStatus(place):
            if found.getPath().getName() not in kept:
                files.delete(found.getPath(), True)


def read_published(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A table of the last run that was published."""
    manifest = _manifest(spark, out.rstrip("/"))
    if manifest is None or name not in manifest["tables"]:
        raise ValueError(f"{out} has no published table {name}")
    table = manifest["tables"][name]
    return spark.read.load(f"{out.rstrip('/')}/{table['path']}", format=table["format"], header=True)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest(spark: SparkSession, out: str) -> dict | None:
    place, files = _file_system(spark, f"{out}/{_MANIFEST}")
    if not files.exists(place):
        return None
    return json.loads(spark.read.text(f"{out}/{_MANIFEST}", wholetext=True).first()["value"])


def _replace(spark: SparkSession, path: str, aside: str, content: str) -> None:
    """Write a file aside and rename it over the one at ``path``."""
    place, files = _file_system(spark, aside)
    stream = files.create(place, True)
    stream.write(bytearray(content.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(place, hadoop.Path(path), options)
