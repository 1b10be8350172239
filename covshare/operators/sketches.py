"""Distinct providers as sketches, for counts that are kept up between runs.

A sketch of a block's providers has a bounded size however many filings it has seen.
Sketches unite: those of blocks to counties, states and the nation, and those
of an earlier run with those of new filings, so old filings need not be read again.
With 2 ** BITS registers a count has a relative standard error of
1.04 / sqrt(2 ** BITS), 1.6 percent; few providers are counted almost exactly.
The exact counts of :mod:`covshare.operators.providers` remain the published ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.functions.keys import county_of_block, state_of_block
from covshare.layout import CLASSES, LEVELS, Level
from covshare.operators.filings import BUSINESS, CONSUMER, EITHER

BITS = 12
_TESTS = {"c": CONSUMER, "b": BUSINESS, "a": EITHER}


def _sketch(code: str) -> str:
    return f"providers_{code}"


def block_sketches(filings: DataFrame, bits: int = BITS) -> DataFrame:
    """block_code and a sketch of its providers for each class.

    Tasks hand on one row per block, so a block with a large part of the filings
    is as many rows as there are tasks.
    """
    return filings.groupBy("block_code").agg(
        *[
            F.expr(f"hll_sketch_agg(CASE WHEN {_TESTS[k.code]} THEN bigint(hoco_num) END, {bits})").alias(_sketch(k.code))
            for k in CLASSES
        ]
    )


def _united() -> list:
    return [F.hll_union_agg(_sketch(k.code)).alias(_sketch(k.code)) for k in CLASSES]


def add_filings(sketches: DataFrame, filings: DataFrame, bits: int = BITS) -> DataFrame:
    """Block sketches of an earlier run with more filings, repeated ones included."""
    return sketches.unionByName(block_sketches(filings, bits)).groupBy("block_code").agg(*_united())


def sketches_at(sketches: DataFrame, level: Level) -> DataFrame:
    """Block sketches united at one level.

    Counties first: what a state and the nation unite is a row per county.
    """
    block = F.col("block_code")
    place = {"county_fips": county_of_block(block), "state_fips": state_of_block(block)}
    counties = sketches.withColumns(place).groupBy(*place).agg(*_united())
    return counties.groupBy(*([level.key] if level.key else [])).agg(*_united())


def provider_estimates(sketches: DataFrame) -> DataFrame:
    """level, geo_id (0 for the nation), class, providers: the estimates in long form."""
    levels = []
    for level in LEVELS:
        rows = F.array(
            *[
                F.struct(F.lit(k.code).alias("class"), F.hll_sketch_estimate(_sketch(k.code)).alias("providers"))
                for k in CLASSES
            ]
        )
        place = F.col(level.key) if level.key else F.lit(0)
        levels.append(
            sketches_at(sketches, level).select(
                F.lit(level.name).alias("level"), place.alias("geo_id"), F.inline(rows)
            )
        )
    return reduce(DataFrame.union, levels)
