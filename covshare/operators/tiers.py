"""Population by speed tier: shares, the most common tier, sums of tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.functions.numbers import percent, total
from covshare.layout import (
    AS_WRITTEN,
    DIRECTIONS,
    LEVELS,
    NATION,
    SPEED_TIERS,
    STATE,
    TIERS,
    Direction,
    Level,
    tier_column,
)
from covshare.operators.blocks import populated_blocks, speed_tier, top_speed
from covshare.operators.shares import population_share, population_shares


def tier_sum(direction: Direction, tier: int) -> str:
    return f"{direction.code}_{tier}"


def tier_tests(direction: Direction) -> dict[str, str]:
    """One condition per tier on blocks with their tier."""
    return {tier_sum(direction, i): f"{direction.tier} = {i}" for i in TIERS}


def tiered_blocks(
    filings: DataFrame, block_pop: DataFrame, direction: Direction
) -> DataFrame:
    """Populated blocks with a consumer filing, their best speed and its tier."""
    best = top_speed(filings, direction.speed, direction.top_speed)
    return with_tiers(populated_blocks(best, block_pop), [direction])


def with_tiers(
    blocks: DataFrame, directions: Sequence[Direction] = DIRECTIONS
) -> DataFrame:
    return blocks.withColumns(
        {d.tier: speed_tier(F.col(d.top_speed)) for d in directions}
    )


def tier_share(
    filings: DataFrame,
    block_pop: DataFrame,
    denominators: DataFrame,
    direction: Direction,
    level: Level,
) -> DataFrame:
    """Percent of a level's population by the best tier of its block."""
    shares = population_share(
        tiered_blocks(filings, block_pop, direction),
        tier_tests(direction),
        denominators,
        level,
    )
    return shares.withColumnsRenamed(
        {tier_sum(direction, i): tier_column(direction, i, level) for i in TIERS}
    )


def speed_tier_share(
    filings: DataFrame,
    block_pop: DataFrame,
    denominators: DataFrame,
    direction: Direction,
    edges: Sequence[tuple[str, float]] = SPEED_TIERS,
    levels: Sequence[Level] = LEVELS,
) -> DataFrame:
    """Percent of population by the best tier of its block, for any tiers: level,
    geo_id, tier (position), name, share.

    ``edges`` are tiers as :func:`~covshare.operators.blocks.speed_tier` takes
    them; a block below the first is in none, but counts in the denominators.
    """
    best = top_speed(filings, direction.speed, direction.top_speed)
    blocks = populated_blocks(best, block_pop).withColumn(
        direction.tier, speed_tier(F.col(direction.top_speed), edges)
    )
    sums = {
        tier_sum(direction, i): f"{direction.tier} <=> {i}" for i in range(len(edges))
    }
    shares = population_shares(blocks, sums, denominators)
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("tier"), F.lit(name).alias("name"), F.col(tier_sum(direction, i)).alias("share"))
            for i, (name, _) in enumerate(edges)
        ]
    )
    wanted = [level.name for level in levels]
    return shares.where(F.col("level").isin(wanted)).select("level", "geo_id", F.inline(rows))


def tier_shares_of(direction: Direction, level: Level, sums: str = "{}") -> list[str]:
    """Tier shares from the tier sums of a report row."""
    return [
        f"{percent(sums.format(tier_sum(direction, i)), level.divisor)} "
        f"AS {tier_column(direction, i, level)}"
        for i in TIERS
    ]


def first_largest(columns: Sequence[str]) -> tuple[str, str]:
    """The largest of some columns and the name of the first that holds it."""
    values = f"array({', '.join(columns)})"
    labels = ", ".join(f"'{c}'" for c in columns)
    position = f"int(array_position({values}, array_max({values})))"
    return f"array_max({values})", f"element_at(array({labels}), {position})"


def most_common_tier(direction: Direction, level: Level, mode: str) -> list[str]:
    """Share and column name of the tier most people live in.

    As written, the national label compares the state's second tier with the
    nation's other ones.
    """
    columns = [tier_column(direction, i, level) for i in TIERS]
    largest, label = first_largest(columns)
    if mode == AS_WRITTEN and level is NATION:
        columns[1] = tier_column(direction, 1, STATE)
        _, label = first_largest(columns)
    stem = f"mc{direction.letter.lower()}s"
    return [
        f"{largest} AS {stem}_prop_{level.tier_suffix}",
        f"{label} AS {stem}_tier_{level.tier_suffix}",
    ]


def share_of_tiers(
    direction: Direction, level: Level, first_tier: int, sums: str = "{}"
) -> str:
    """Percent of population in a tier or a faster one."""
    people = [
        sums.format(tier_sum(direction, i)) for i in TIERS if i >= first_tier
    ]
    return percent(total(people), level.divisor)
