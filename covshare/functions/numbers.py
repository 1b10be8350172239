"""Arithmetic shared by every measure.

Report rows are hundreds of columns wide, so measures are written as SQL text:
one expression crosses from Python to the JVM per column, not one per operator.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructField

# The smallest double above zero.
SMALLEST = "4.9E-324D"


def divisor(population: str) -> str:
    """A population to divide by, as a double.

    An empty population becomes the smallest double, so that anybody divided
    by it is infinite and nobody is 0; an unknown one becomes infinity, so
    that everything divided by it is 0, the value of an empty sum.
    """
    return (
        f"CASE WHEN {population} = 0 THEN {SMALLEST} "
        f"ELSE coalesce(double({population}), double('inf')) END"
    )


def percent(part: str, whole: str) -> str:
    """``part`` in percent of ``whole``, a :func:`divisor`."""
    return f"100 * (double({part}) / {whole})"


def sum_where(condition: str, value: str) -> str:
    """Sum of ``value`` over the rows meeting ``condition``; 0 if there are none."""
    return f"coalesce(sum(CASE WHEN {condition} THEN {value} END), 0L)"


def any_true(condition: str) -> str:
    return f"coalesce(bool_or({condition}), false)"


def total(names: list[str]) -> str:
    return f"({' + '.join(names)})"


def fill_missing(table: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """0 for every null of the columns, all if none are named; "0" where they hold text."""
    wanted = set(table.columns if columns is None else columns)

    def filled(field: StructField) -> Column:
        own = F.col(f"`{field.name}`")
        if field.name in wanted and isinstance(field.dataType, (NumericType, StringType)):
            own = F.coalesce(own, F.lit(0).cast(field.dataType))
        return own.alias(field.name)

    return table.select(*[filled(field) for field in table.schema])
