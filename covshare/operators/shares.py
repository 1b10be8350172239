"""Population shares of blocks by geography.

Populations are whole numbers: they are added up per county, the counties are
added up to states and the nation, and each sum is divided once. The large
shuffle therefore carries one row per county and task, and results do not
depend on the order of summation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.functions.numbers import any_true, percent, sum_where
from covshare.layout import AS_WRITTEN, COUNTY, LEVELS, NATION, STATE, Level
from covshare.operators.blocks import block_speeds, populated_blocks


def county_sums(
    blocks: DataFrame,
    sums: Mapping[str, str],
    denominators: DataFrame,
    flags: Mapping[str, str] | None = None,
) -> DataFrame:
    """Population of the blocks meeting each condition, per known county.

    ``flags`` tell whether any block of the county meets a condition.
    """
    per_county = blocks.groupBy("county_fips").agg(
        *[F.expr(sum_where(test, "gl_pop")).alias(n) for n, test in sums.items()],
        *[F.expr(any_true(test)).alias(n) for n, test in (flags or {}).items()],
    )
    return per_county.join(denominators, "county_fips")


def roll_up(per_county: DataFrame, sums: Iterable[str], level: Level) -> DataFrame:
    """County sums added up to one level, with that level's divisor."""
    if level is COUNTY:
        return per_county
    added = [F.sum(name).alias(name) for name in sums]
    whole = F.max(level.divisor).alias(level.divisor)
    if level is STATE:
        return per_county.groupBy("state_fips").agg(whole, *added)
    return per_county.agg(whole, *added)


def roll_up_all(per_county: DataFrame, sums: Iterable[str]) -> DataFrame:
    """County, state and national sums as one grouping-sets aggregation.

    Rows carry ``level``, ``geo_id`` (0 for the nation) and ``divisor``.
    """
    sums = list(sums)
    grouped = per_county.groupingSets(
        [["state_fips", "county_fips"], ["state_fips"], []], "state_fips", "county_fips"
    ).agg(
        F.grouping_id().alias("gid"),
        *[F.max(level.divisor).alias(level.divisor) for level in LEVELS],
        *[F.sum(name).alias(name) for name in sums],
    )

    def by_level(county: str, state: str, nation: str) -> str:
        return f"CASE gid WHEN 0 THEN {county} WHEN 1 THEN {state} ELSE {nation} END"

    return grouped.selectExpr(
        f"{by_level(*[repr(level.name) for level in LEVELS])} AS level",
        f"{by_level('county_fips', 'state_fips', '0')} AS geo_id",
        f"{by_level(*[level.divisor for level in LEVELS])} AS divisor",
        *sums,
    )


def population_share(
    blocks: DataFrame,
    shares: Mapping[str, str],
    denominators: DataFrame,
    level: Level,
) -> DataFrame:
    """Percent of a level's population living in blocks that meet each condition.

    ``blocks`` decides which geographies appear; those where no block meets a
    condition show 0.
    """
    rolled = roll_up(county_sums(blocks, shares, denominators), shares, level)
    key = [level.key] if level.key else []
    return rolled.selectExpr(
        *key, *[f"{percent(name, level.divisor)} AS {name}" for name in shares]
    )


def population_shares(
    blocks: DataFrame, shares: Mapping[str, str], denominators: DataFrame
) -> DataFrame:
    """The same at all three levels, in long form."""
    rolled = roll_up_all(county_sums(blocks, shares, denominators), shares)
    return rolled.selectExpr(
        "level", "geo_id", *[f"{percent(n, 'divisor')} AS {n}" for n in shares]
    )


def surveyed(blocks: DataFrame, mode: str) -> DataFrame:
    """Blocks that make their geography appear among the access shares.

    As written those in the access or the zero branch; as intended all.
    """
    return blocks.where("any_access OR any_lack") if mode == AS_WRITTEN else blocks


def access_share(
    filings: DataFrame,
    block_pop: DataFrame,
    denominators: DataFrame,
    level: Level,
    mode: str = AS_WRITTEN,
) -> DataFrame:
    """Percent of population in blocks with a broadband filing."""
    blocks = populated_blocks(block_speeds(filings), block_pop)
    return population_share(
        surveyed(blocks, mode), {"pct_with_access": "any_access"}, denominators, level
    )


def speed_share(
    filings: DataFrame,
    block_pop: DataFrame,
    denominators: DataFrame,
    flag: str,
    mode: str = AS_WRITTEN,
) -> DataFrame:
    """Percent of population in blocks fast enough in one direction, all levels.

    As written the test is lost below the nation, where every filed block
    counts, and the nation repeats the access share.
    """
    blocks = populated_blocks(block_speeds(filings), block_pop)
    if mode != AS_WRITTEN:
        return population_shares(blocks, {"pct": flag}, denominators)
    both = population_shares(
        blocks, {"covered": "true", "access": "any_access"}, denominators
    )
    return both.selectExpr(
        "level",
        "geo_id",
        f"CASE level WHEN '{NATION.name}' THEN access ELSE covered END AS pct",
    )


def all_shares(
    filings: DataFrame, block_pop: DataFrame, denominators: DataFrame
) -> DataFrame:
    """Access, download and upload shares at all levels in one pass, as intended."""
    blocks = populated_blocks(block_speeds(filings), block_pop)
    return population_shares(
        blocks, {"access": "any_access", "down": "any_down", "up": "any_up"}, denominators
    )
