"""Geographic keys: fifteen digits of block, of which five are the county."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covshare.layout import (
    BLOCK_DIGITS,
    COUNTY_DIGITS,
    COUNTY_PART_DIGITS,
    NAME_CHARS,
    STATE_DIGITS,
)


def zero_pad(key: Column, width: int) -> Column:
    """Left-pad with zeros; a longer key stays whole (``lpad`` would cut it)."""
    text = key.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def left(text: Column, n: int = NAME_CHARS) -> Column:
    return F.substring(text, 1, n)


def key_prefix(text: Column, digits: int) -> Column:
    """The leading digits of a padded key, as a number."""
    return left(text, digits).cast("int")


def _leading(block_code: Column, digits: int) -> Column:
    # Arithmetic keeps the hot path free of strings; only a code too long for
    # the padded width needs its text.
    unit = F.lit(10 ** (BLOCK_DIGITS - digits)).cast("bigint")
    too_long = block_code >= F.lit(10**BLOCK_DIGITS).cast("bigint")
    return F.when(too_long, key_prefix(block_code.cast("string"), digits)).otherwise(
        F.call_function("div", block_code, unit).cast("int")
    )


def county_of_block(block_code: Column) -> Column:
    return _leading(block_code, COUNTY_DIGITS)


def state_of_block(block_code: Column) -> Column:
    return _leading(block_code, STATE_DIGITS)


def compose_county(state: Column, county_part: Column) -> Column:
    """State number followed by the three-digit county, padded to five."""
    return zero_pad(
        F.concat(state.cast("string"), zero_pad(county_part, COUNTY_PART_DIGITS)),
        COUNTY_DIGITS,
    )


def county_number(state: Column, county_part: Column) -> Column:
    """:func:`compose_county` as a number; text only for an over-long part."""
    unit = 10**COUNTY_PART_DIGITS
    return F.when(county_part < unit, state * unit + county_part).otherwise(
        compose_county(state, county_part).cast("int")
    )


def block_text(block_code: Column) -> Column:
    return zero_pad(block_code, BLOCK_DIGITS)
