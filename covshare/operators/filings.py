"""Provider filings and the conditions that select among them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.functions.keys import county_of_block, left, state_of_block
from covshare.functions.numbers import percent
from covshare.layout import BROADBAND_DOWN, BROADBAND_UP, LEVELS
from covshare.operators.joins import split_join

CONSUMER = "consumer = 1"
BUSINESS = "business = 1"
EITHER = "business = 1 OR consumer = 1"
FAST_DOWN = f"max_down >= {BROADBAND_DOWN}"
FAST_UP = f"max_up >= {BROADBAND_UP}"
ACCESS = f"{FAST_UP} AND {FAST_DOWN}"
# The zero branch: at or below both thresholds, so not quite the complement.
LACK = f"max_up <= {BROADBAND_UP} AND max_down <= {BROADBAND_DOWN}"
POPULATED = "gl_pop <> 0"


def prepare_filings(deployment: DataFrame, truncate_speeds: bool = False) -> DataFrame:
    """Filings with geographic keys; a speed not filed is 0.

    ``truncate_speeds`` drops fractions, as a reader typing speeds as whole
    numbers would.
    """
    speed = "double(bigint({0}))" if truncate_speeds else "double({0})"
    block = F.col("block_code")
    return deployment.select(
        "block_code",
        county_of_block(block).alias("county_fips"),
        state_of_block(block).alias("state_fips"),
        "hoco_num",
        left(F.col("dba_name")).alias("dba_name"),
        "consumer",
        "business",
        *[
            F.expr(f"coalesce({speed.format(s)}, 0D) AS {s}")
            for s in ("max_down", "max_up")
        ],
    )


def populations(block_pop: DataFrame) -> DataFrame:
    """Population per block; a block filed with two populations is an error.

    Repeated rows collapse before the shuffle, and the result is partitioned by
    block, as joins with block tables need it; filings are joined by split_join.
    """
    lowest, highest = F.col("lowest"), F.col("highest")
    fault = F.concat(F.lit("block with two populations: "), F.col("block_code"))
    return (
        block_pop.groupBy("block_code")
        .agg(F.min("gl_pop").alias("lowest"), F.max("gl_pop").alias("highest"))
        .select(
            "block_code",
            F.when(lowest.eqNullSafe(highest), highest)
            .otherwise(F.raise_error(fault))
            .alias("gl_pop"),
        )
    )


def with_provenance(
    left_table: DataFrame, right_table: DataFrame, key: str, marker: str = "provenance"
) -> DataFrame:
    """Full outer join that says which side each row came from.

    Written as a left join and the right rows it missed: a key holding a large
    part of the left rows can then be split, which a full outer join forbids.
    """
    matched = F.col("_in_right").isNotNull()
    from_left = (
        left_table.join(right_table.withColumn("_in_right", F.lit(1)), key, "left")
        .withColumn(marker, F.when(matched, "both").otherwise("left_only"))
        .drop("_in_right")
    )
    only_right = right_table.join(
        left_table.select(key).distinct(), key, "left_anti"
    ).withColumn(marker, F.lit("right_only"))
    return from_left.unionByName(only_right, allowMissingColumns=True)


def filings_with_population(filings: DataFrame, block_pop: DataFrame) -> DataFrame:
    """Every filing and every population row, joined where the block is in both.

    Missing populations and speeds are 0, missing keys and classes stay null.
    """
    joined = with_provenance(filings, block_pop, "block_code")
    return joined.fillna(0, subset=["gl_pop", "max_down", "max_up"])


def shares_of_block() -> list[str]:
    """The block's population in percent of its county, state and nation."""
    return [f"{percent('gl_pop', v.divisor)} AS pct_of_{v.name}" for v in LEVELS]


def filings_with_denominators(
    filings: DataFrame, block_pop: DataFrame, denominators: DataFrame
) -> DataFrame:
    """Filings in a known county with block, county, state and national population."""
    joined = split_join(filings.drop("state_fips"), populations(block_pop), "block_code", "left")
    return split_join(joined.fillna(0, subset=["gl_pop"]), denominators, "county_fips")


def enrich(
    filings: DataFrame, block_pop: DataFrame, denominators: DataFrame, join=split_join
) -> DataFrame:
    """Filings of populated blocks in known counties, with the block's shares.

    ``join`` says how filings meet the table of blocks.
    """
    people = populations(block_pop.where(POPULATED)).withColumn(
        "county_fips", county_of_block(F.col("block_code"))
    )
    known = people.join(denominators, "county_fips").drop("county_fips")
    return join(filings.drop("state_fips"), known, "block_code").selectExpr(
        "*", *shares_of_block()
    )
