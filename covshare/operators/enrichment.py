"""Joining payload tables, keyed by county, state or nation, onto a report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.functions.numbers import any_true
from covshare.layout import AS_WRITTEN


def attach_single_row(table: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """A one-row table on every row, as the fields of one column.

    A scalar subquery: no join, and it fails if there is more than one row.
    """
    return table.withColumn(name, one_row.select(F.struct("*")).scalar())


def join_all(tables: list[DataFrame], key: str, how: str = "inner") -> DataFrame:
    """Fold a list of tables into one on a common key."""
    return reduce(lambda left, right: left.join(right, key, how), tables)


def outer_join(left: DataFrame, right: DataFrame, key: str, mode: str) -> DataFrame:
    """Full outer join on one key; as written, missing keys match each other."""
    if mode != AS_WRITTEN:
        return left.join(right, key, "full")
    own = right.withColumnRenamed(key, "_right_key")
    joined = left.join(own, F.col(key).eqNullSafe(F.col("_right_key")), "full")
    return joined.withColumn(key, F.coalesce(key, "_right_key")).drop("_right_key")


LEVEL_KEYS = ("county_fips", "state_fips", "merge_level")


def _suffixed(left: list[str], right: list[str]) -> tuple[list[str], list[str]]:
    """Names of two tables side by side: those that both have end in _x and _y."""
    shared = set(left) & set(right)
    return (
        [f"{c}_x" if c in shared else c for c in left],
        [f"{c}_y" if c in shared else c for c in right],
    )


def _join_levels(report: DataFrame, tables: tuple[DataFrame, ...], join) -> DataFrame:
    """Payload tables of the three levels joined one after another.

    The report's hundreds of measures travel through the joins as one column, and
    payload columns under numbers: their names may hold anything, and may be in
    several tables, where they get suffixes as tables are joined.
    """
    measures = [c for c in report.columns if c not in LEVEL_KEYS]
    columns = [F.col("_measures").getField(c) for c in measures]
    names = measures
    joined = report.select(
        *LEVEL_KEYS, F.struct(*[F.col(f"`{c}`") for c in measures]).alias("_measures")
    )
    for key, table in zip(LEVEL_KEYS, tables):
        payload = [c for c in table.columns if c != key]
        numbers = {c: f"_{key}_{i}" for i, c in enumerate(payload)}
        own = table.select(key, *[F.col(f"`{c}`").alias(n) for c, n in numbers.items()])
        joined = join(joined, own, key)
        names, added = _suffixed(names, payload)
        names = names + added
        columns = columns + [F.col(n) for n in numbers.values()]
    return joined.select(*LEVEL_KEYS, *[c.alias(n) for c, n in zip(columns, names)])


def with_rural_tables(
    report: DataFrame, county: DataFrame, state: DataFrame, nation: DataFrame, mode: str
) -> DataFrame:
    """Full outer joins with payload tables of the three levels."""
    county = county.withColumn("county_fips", F.col("county_fips").cast("int"))
    state = state.withColumn("state_fips", F.col("state_fips").cast("int"))
    return _join_levels(
        report, (county, state, nation), lambda left, right, key: outer_join(left, right, key, mode)
    )


def left_enrich(
    report: DataFrame, county: DataFrame, state: DataFrame, nation: DataFrame
) -> DataFrame:
    """Left joins with payload tables of the three levels."""
    return _join_levels(
        report, (county, state, nation), lambda left, right, key: left.join(right, key, "left")
    )


def with_income(
    report: DataFrame, county: DataFrame, state: DataFrame, nation: DataFrame
) -> DataFrame:
    """Income tables joined from their own side: every county, then every state
    that has income, then only rows that reach a national row."""
    joined = county.join(report, "county_fips", "left")
    joined = state.join(joined, "state_fips", "left")
    return nation.join(joined, "merge_level")


def flag_any_negative(table: DataFrame, column: str, flag: str) -> DataFrame:
    """1 on every row if any row of the table is below zero in a column, else 0."""
    found = table.agg(F.expr(f"int({any_true(f'{column} < 0')}) AS {flag}"))
    return attach_single_row(table, found, "_found").selectExpr("*", f"_found.{flag}").drop("_found")
