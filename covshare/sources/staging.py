"""Filings staged once for all that reads them, clustered by block.

The raw files are scanned once, for a plain Parquet copy of the columns in use.
From that copy two tables are made: ordinary blocks in a table bucketed by block,
which aggregations and joins by block read without a shuffle, and the heavy blocks
in a plain one, because a bucket is read by one task and a block with a large part
of all filings would make it as large. A heavy block holds more than a share of the
filings that is a fixed part of a bucket, so there is a bounded number of them,
whatever the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.operators.joins import split_join
from covshare.sources.scratch import discard, remove, scratch_path, stored

#: A block is heavy from this part of a bucket's average filings on.
HEAVY_PART = 4

Join = Callable[[DataFrame, DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Part:
    """Filings, and how they join a table that has one row per block."""

    filings: DataFrame
    join: Join


@dataclass(frozen=True)
class StagedFilings:
    """Filings in parts that have no block in common."""

    parts: tuple[Part, ...]
    table: str | None = None
    place: str | None = None
    heavy: tuple[DataFrame, ...] = ()

    def by_part(self, operator: Callable[[Part], DataFrame]) -> DataFrame:
        """What an operator that works block by block makes of all filings."""
        return reduce(DataFrame.unionByName, [operator(part) for part in self.parts])

    def whole(self) -> DataFrame:
        return self.by_part(lambda part: part.filings)

    def close(self) -> None:
        """Remove the staged tables; nothing made from them can be computed afterwards."""
        if self.table is not None:
            spark = self.parts[0].filings.sparkSession
            spark.sql(f"DROP TABLE IF EXISTS {self.table}")
            remove(spark, self.place)
            discard(*self.heavy)


def unstaged(filings: DataFrame) -> StagedFilings:
    """Filings as they come, computed anew by whatever reads them."""
    return StagedFilings((Part(filings, split_join),))


def stage(filings: DataFrame, buckets: int | None = None, heavy_part: int = HEAVY_PART) -> StagedFilings:
    """Filings with a `block_code`, written out by block.

    `buckets` is the number of shuffle partitions if not given: joins with tables
    that are shuffled into as many find both sides in place. A null block is no
    ordinary one. Rows keep all columns and may repeat.
    """
    spark = filings.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    landed = stored(filings, "landed-filings")
    counted = landed.groupBy("block_code").agg(F.count(F.lit(1)).alias("n"))
    total = landed.count()
    heavy = stored(
        # Fewer than buckets * heavy_part blocks can be above that, and the null one.
        counted.where((F.col("n") * (buckets * heavy_part) > total) | F.col("block_code").isNull()).select("block_code"),
        "heavy-blocks",
    )
    few = F.broadcast(heavy.where("block_code is not null"))
    heavy_filings = stored(
        landed.join(few, "block_code", "left_semi").unionByName(landed.where("block_code is null")), "heavy-filings"
    )
    name, place = f"covshare_filings_{uuid.uuid4().hex}", scratch_path(spark, "filings")
    (
        landed.where("block_code is not null")
        .join(few, "block_code", "left_anti")
        .repartition(buckets, "block_code")  # a file per bucket, not one per task and bucket
        .write.bucketBy(buckets, "block_code")
        .sortBy("block_code")
        .option("path", place)
        .format("parquet")
        .saveAsTable(name)
    )
    discard(landed)

    def beside_heavy(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
        """Only rows of heavy blocks are asked of the other side, so it can be sent whole."""
        return left.join(F.broadcast(right.join(few, "block_code", "left_semi")), key)

    return StagedFilings(
        (
            Part(spark.table(name), lambda left, right, key: left.join(right, key)),
            Part(heavy_filings, beside_heavy),
        ),
        name,
        place,
        (heavy, heavy_filings),
    )
