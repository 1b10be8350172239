"""County, state and national populations and the tables keyed by county."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covshare.functions.keys import (
    county_number,
    county_of_block,
    key_prefix,
    state_of_block,
    zero_pad,
)
from covshare.functions.numbers import divisor
from covshare.layout import (
    COUNTY_DIGITS,
    INTENDED,
    LEVELS,
    NATIONAL,
    STATE_DIGITS,
)
from covshare.operators.filings import populations


def counties(county_pop: DataFrame) -> DataFrame:
    """County populations, one row per key; a repeated key is an error."""
    county = F.col("county_fips")
    valid = F.col("n") == 1
    fault = F.concat(F.lit("not a unique county key: "), county)
    return (
        county_pop.groupBy("county_fips")
        .agg(F.count("*").alias("n"), F.sum("county_pop").alias("county_pop"))
        .select(
            F.when(valid, county).otherwise(F.raise_error(fault)).cast("int").alias(
                "county_fips"
            ),
            "county_pop",
        )
        .withColumn(
            "state_fips",
            key_prefix(zero_pad(F.col("county_fips"), COUNTY_DIGITS), STATE_DIGITS),
        )
    )


def state_populations(county_pop: DataFrame) -> DataFrame:
    return (
        counties(county_pop)
        .groupBy("state_fips")
        .agg(F.sum("county_pop").alias("state_pop"))
    )


def national_population(county_pop: DataFrame) -> DataFrame:
    return counties(county_pop).agg(F.sum("county_pop").alias("national_pop"))


def denominators(county_pop: DataFrame) -> DataFrame:
    """County, state and national population on every county row.

    A window adds the state's total in place: a state has at most a thousand
    counties. The nation's is a scalar subquery.
    """
    state = Window.partitionBy("state_fips")
    with_state = counties(county_pop).select(
        "county_fips",
        "state_fips",
        "county_pop",
        F.sum("county_pop").over(state).alias("state_pop"),
    )
    with_totals = with_state.withColumn(
        "national_pop", national_population(county_pop).scalar()
    )
    return with_totals.selectExpr(
        "*", *[f"{divisor(level.population)} AS {level.divisor}" for level in LEVELS]
    )


def county_data(county_names: DataFrame, county_housing: DataFrame) -> DataFrame:
    """Names joined to housing on the county key; other name columns carry through."""
    carried = [c for c in county_names.columns if c not in ("state_fp", "county_fp")]
    names = county_names.select(
        county_number(F.col("state_fp"), F.col("county_fp")).alias("county_fips"),
        F.col("state_fp").alias("state_fips"),
        *[F.col(f"`{c}`") for c in carried],
    )
    housing = county_housing.select(
        F.col("county_fips").cast("int").alias("county_fips"),
        "population",
        "housing_units",
    )
    return names.join(housing, "county_fips").distinct()


def block_population(block_pop: DataFrame) -> DataFrame:
    """Distinct blocks with population and the county and state in their code."""
    block = F.col("block_code")
    return populations(block_pop).select(
        "block_code",
        county_of_block(block).alias("county_fips"),
        state_of_block(block).alias("state_fips"),
        "gl_pop",
    )


def county_pop_from_blocks(
    filings: DataFrame, block_pop: DataFrame, mode: str
) -> DataFrame:
    """County population added up from the filed blocks.

    As written a block counts once per filing; as intended, once.
    """
    per_block = filings.groupBy("block_code").agg(F.count("*").alias("n_filings"))
    weight = F.lit(1) if mode == INTENDED else F.col("n_filings")
    summed = (
        per_block.join(populations(block_pop), "block_code", "left")
        .fillna(0, subset=["gl_pop"])
        .withColumn("county_fips", county_of_block(F.col("block_code")))
        .groupBy("county_fips")
        .agg(F.sum(F.col("gl_pop") * weight).cast("bigint").alias("gl_pop"))
    )
    return summed


def with_merge_level(table: DataFrame) -> DataFrame:
    return table.withColumn("merge_level", F.lit(NATIONAL))

