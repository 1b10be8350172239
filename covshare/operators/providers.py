"""Distinct providers and population by number of providers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.functions.numbers import any_true, percent, total
from covshare.layout import (
    AS_WRITTEN,
    BUCKETS,
    CLASSES,
    COUNTY,
    LEVELS,
    MEDIAN_LEVEL,
    STATE,
    Level,
    ProviderClass,
    bucket_column,
    cumulative_column,
    provider_count_column,
)
from covshare.operators.blocks import block_profile, populated_blocks, provider_bucket
from covshare.operators.filings import BUSINESS, CONSUMER, EITHER
from covshare.operators.shares import county_sums, roll_up, roll_up_all


def county_providers(filings: DataFrame) -> DataFrame:
    """Distinct (county, provider) with the classes it serves there.

    The only pass over the filings that the three levels of counts need; a
    county holding a large part of them collapses to its providers per task.
    """
    return (
        filings.where(EITHER)
        .groupBy("county_fips", "state_fips", "hoco_num")
        .agg(
            F.expr(any_true(CONSUMER)).alias("serves_c"),
            F.expr(any_true(BUSINESS)).alias("serves_b"),
        )
    )


def _providers_at(providers: DataFrame, level: Level) -> DataFrame:
    """Distinct (place, provider) at a level, each level from the one below."""
    if level is COUNTY:
        return providers
    lower = providers if level is STATE else _providers_at(providers, STATE)
    keys = [level.key] if level.key else []
    return lower.groupBy(*keys, "hoco_num").agg(
        *[F.expr(any_true(flag)).alias(flag) for flag in ("serves_c", "serves_b")]
    )


def provider_counts(providers: DataFrame, level: Level) -> DataFrame:
    """Distinct providers of each class at a level, from :func:`county_providers`.

    A place needs filings of both classes to appear, as the counts of the
    classes are joined to each other.
    """
    keys = [level.key] if level.key else []
    counts = {
        "c": "count(CASE WHEN serves_c THEN hoco_num END)",
        "b": "count(CASE WHEN serves_b THEN hoco_num END)",
        "a": "count(hoco_num)",
    }
    counted = _providers_at(providers, level).groupBy(*keys).agg(
        *[
            F.expr(counts[k.code]).alias(provider_count_column(level, k))
            for k in CLASSES
        ],
        F.expr("bool_or(serves_c) AND bool_or(serves_b)").alias("both"),
    )
    return (counted.where("both") if keys else counted).drop("both")


def provider_counts_all(providers: DataFrame) -> DataFrame:
    """:func:`provider_counts` of all levels as one table.

    Rows carry ``level`` and ``geo_id``, 0 for the nation. The levels share the
    shuffle of the distinct providers, which Spark runs once.
    """
    levels = []
    for level in LEVELS:
        place = F.col(level.key) if level.key else F.lit(0)
        levels.append(
            provider_counts(providers, level).select(
                F.lit(level.name).alias("level"),
                place.alias("geo_id"),
                *[
                    F.col(provider_count_column(level, k)).alias(k.code)
                    for k in CLASSES
                ],
            )
        )
    return reduce(DataFrame.union, levels)


def counts_at(counts: DataFrame, level: Level) -> DataFrame:
    """One level of :func:`provider_counts_all` under its column names."""
    key = [F.col("geo_id").alias(level.key)] if level.key else []
    return counts.where(F.col("level") == level.name).select(
        *key, *[F.col(k.code).alias(provider_count_column(level, k)) for k in CLASSES]
    )


def bucket_sum(klass: ProviderClass, bucket: int) -> str:
    return f"prov_{klass.code}_{bucket}"


def bucket_tests() -> dict[str, str]:
    """One condition per class and bucket on blocks with their buckets."""
    return {bucket_sum(k, b): f"{k.bucket} = {b}" for k in CLASSES for b in BUCKETS}


def counted_blocks(filings: DataFrame, block_pop: DataFrame) -> DataFrame:
    """Populated blocks with a consumer filing, their provider counts and buckets."""
    served = block_profile(filings).where("serves_c")
    return with_buckets(populated_blocks(served, block_pop))


def with_buckets(blocks: DataFrame) -> DataFrame:
    return blocks.withColumns(
        {k.bucket: provider_bucket(F.col(k.column)) for k in CLASSES}
    )


def county_bucket_sums(
    filings: DataFrame, block_pop: DataFrame, denominators: DataFrame
) -> DataFrame:
    return county_sums(counted_blocks(filings, block_pop), bucket_tests(), denominators)


def bucket_share(per_county: DataFrame, level: Level) -> DataFrame:
    """Percent of a level's population by the provider count of its block.

    Counties carry their population, states that of their counties in the table.
    """
    sums, kept = list(bucket_tests()), []
    if level is COUNTY:
        kept = ["county_fips", "state_fips", "county_pop"]
    if level is STATE:
        per_county = per_county.withColumn("state_pop_covered", F.col("county_pop"))
        sums.append("state_pop_covered")
        kept = ["state_fips", "state_pop_covered"]
    return roll_up(per_county, sums, level).selectExpr(*kept, *bucket_shares_of(level))


def bucket_shares_of(level: Level, sums: str = "{}") -> list[str]:
    """Bucket shares from the bucket sums of a row."""
    return [
        f"{percent(sums.format(bucket_sum(k, b)), level.divisor)} "
        f"AS {bucket_column(level, k, b)}"
        for k in CLASSES
        for b in BUCKETS
    ]


def cumulative_share(
    klass: ProviderClass, bucket: int, whole: str, sums: str = "{}"
) -> str:
    """Percent of population with at most ``bucket`` providers.

    The last bucket adds the open one, so it is the total.
    """
    people = [sums.format(bucket_sum(klass, b)) for b in range(bucket + 1)]
    return percent(total(people), whole)


def bracket_below(
    cumulative: str, mode: str = AS_WRITTEN, level: float = MEDIAN_LEVEL
) -> str:
    """The step of a cumulative distribution at which ``level`` is read.

    Intended, it is the step that crosses the level. As written, it is the
    last one that stays at or below it on both ends.
    """
    low, high = f"{cumulative}[k]", f"{cumulative}[k + 1]"
    reached = f"{high} <= {level}" if mode == AS_WRITTEN else f"{high} >= {level}"
    steps = f"sequence(0, size({cumulative}) - 2)"
    return f"array_max(filter({steps}, k -> {low} < {level} AND {reached}))"


def interpolated(cumulative: str, bracket: str, level: float | str = MEDIAN_LEVEL) -> str:
    """Where the line through a step reaches ``level``; a flat step never does."""
    low, high = f"{cumulative}[{bracket}]", f"{cumulative}[{bracket} + 1]"
    return (
        f"{bracket} + CASE WHEN {high} = {low} THEN double('inf') "
        f"ELSE ({level} - {low}) / ({high} - {low}) END"
    )


def first_reaching(cumulative: str, size: int, level: float) -> str:
    """Place of the first entry of an ascending array at or above ``level``, the
    array's size if there is none; searched by halves."""

    def within(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return (
            f"CASE WHEN {cumulative}[{middle}] >= {level} THEN {within(low, middle)} "
            f"ELSE {within(middle + 1, high)} END"
        )

    return within(0, size)


def quantile_rows(
    per_county: DataFrame, levels: Sequence[float], mode: str = AS_WRITTEN
) -> DataFrame:
    """Interpolated quantiles of the provider count, in long form: level, geo_id,
    class, quantile, value, bracket.

    All are read off one cumulative array. Like :func:`median_rows` for each level.
    """
    size = len(BUCKETS)
    read = ", ".join(
        f"struct(double({q}) AS quantile, {first_reaching('cumulative', size, q)} AS first)"
        for q in levels
    )
    found = class_rows(per_county).selectExpr(
        "level", "geo_id", "class", "cumulative", f"inline(array({read}))"
    )
    # As intended, the step that ends there, if there is such a place. As written,
    # the last step that ends at or below the level.
    back = f"CASE WHEN first < {size} THEN 1 END"
    if mode == AS_WRITTEN:
        reached = f"first < {size} AND cumulative[least(first, {size - 1})] = quantile"
        back = f"CASE WHEN {reached} THEN 1 ELSE 2 END"
    bracketed = found.selectExpr("*", f"nullif(greatest(first - ({back}), -1), -1) AS bracket")
    return bracketed.selectExpr(
        "level",
        "geo_id",
        "class",
        "quantile",
        f"{interpolated('cumulative', 'bracket', 'quantile')} AS value",
        "bracket",
    )


def class_rows(per_county: DataFrame) -> DataFrame:
    """Cumulative and bucket shares in long form, as arrays over the buckets.

    One row per level, geography and class.
    """
    rolled = roll_up_all(per_county, bucket_tests())
    structs = []
    for k in CLASSES:
        shares = ", ".join(percent(bucket_sum(k, b), "divisor") for b in BUCKETS)
        running = ", ".join(cumulative_share(k, b, "divisor") for b in BUCKETS)
        structs.append(f"struct('{k.code}', array({shares}), array({running}))")
    return rolled.selectExpr(
        "level",
        "geo_id",
        f"inline(array({', '.join(structs)})) AS (class, shares, cumulative)",
    )


def bucket_share_rows(per_county: DataFrame) -> DataFrame:
    """Bucket shares of all levels and classes in long form."""
    return class_rows(per_county).selectExpr(
        "level", "geo_id", "class", *[f"shares[{b}] AS share_{b}" for b in BUCKETS]
    )


def median_rows(per_county: DataFrame, mode: str = AS_WRITTEN) -> DataFrame:
    """Interpolated median of the provider count, in long form."""
    found = class_rows(per_county).selectExpr(
        "level",
        "geo_id",
        "class",
        "cumulative",
        f"{bracket_below('cumulative', mode)} AS bracket",
    )
    return found.selectExpr(
        "level",
        "geo_id",
        "class",
        f"{interpolated('cumulative', 'bracket')} AS value",
        "bracket",
    )


def last_lower_bound(brackets: dict[tuple[Level, ProviderClass], str]) -> str:
    """The one lower-bound label all levels and classes write to in turn.

    Written county first and nation last, consumer before business before
    either, so the last combination that has a bracket keeps it.
    """
    labels = []
    for level in LEVELS:
        for klass in CLASSES:
            stem = cumulative_column(level, klass, 0)[:-1]
            labels.append(f"'{stem}' || string({brackets[level, klass]})")
    return f"coalesce({', '.join(reversed(labels))})"
