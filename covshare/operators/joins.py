"""Joins of a table that may hold one key in a large part of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` so that adaptive execution can split a key of ``left``.

    A side that is an aggregate by the key would be joined as it is partitioned,
    without an exchange below the join, and then nothing can be split. With a hash
    of the key in the join condition both sides get an exchange of their own.
    """
    spread = F.xxhash64(key)
    return left.withColumn("_spread", spread).join(
        right.withColumn("_spread", spread), ["_spread", key], how
    ).drop("_spread")
