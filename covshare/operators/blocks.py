"""One row per block: everything the population shares need to know about it.

Filings are by far the largest input, and one block may hold a large part of
them. Each aggregation here starts on the map side, so such a block reaches the
shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covshare.functions.keys import county_of_block, state_of_block
from covshare.layout import CLASSES, DIRECTIONS, SPEED_TIERS, TOP_BUCKET
from covshare.operators.filings import (
    ACCESS,
    BUSINESS,
    CONSUMER,
    FAST_DOWN,
    FAST_UP,
    LACK,
    POPULATED,
    populations,
)
from covshare.operators.joins import split_join

# What a block is flagged with if any of its filings meets the condition. The
# flags travel through the shuffles as bits of one number per group; they are
# two groups so that a query about one scans no columns for the other.
_SPEED_FLAGS = {
    "any_access": ACCESS,
    "any_lack": LACK,
    "any_down": FAST_DOWN,
    "any_up": FAST_UP,
}
_CLASS_FLAGS = {"serves_c": CONSUMER, "serves_b": BUSINESS}


def _mask(flags: dict[str, str]) -> str:
    bits = [
        f"CASE WHEN {test} THEN {1 << bit} ELSE 0 END"
        for bit, test in enumerate(flags.values())
    ]
    return f"bit_or({' + '.join(bits)})"


def _unmasked(mask: str, flags: dict[str, str]) -> dict[str, str]:
    return {name: f"({mask} & {1 << bit}) <> 0" for bit, name in enumerate(flags)}


def _facts() -> list[Column]:
    return [
        F.expr(_mask(_SPEED_FLAGS)).alias("speed_flags"),
        F.expr(_mask(_CLASS_FLAGS)).alias("class_flags"),
        *[
            F.expr(f"max(CASE WHEN {CONSUMER} THEN {d.speed} END)").alias(d.top_speed)
            for d in DIRECTIONS
        ],
    ]


def _merged_facts() -> list[Column]:
    flags = [F.expr(f"bit_or({m})").alias(m) for m in ("speed_flags", "class_flags")]
    return flags + [F.max(d.top_speed).alias(d.top_speed) for d in DIRECTIONS]


def _provider_counts() -> list[Column]:
    # Rows are distinct (block, provider) here, so counting rows counts
    # providers. A block without filings of a class has no count.
    serves = _class_tests()
    return [
        F.expr(
            f"CASE WHEN max({serves[k.code]}) "
            f"THEN count(CASE WHEN {serves[k.code]} THEN hoco_num END) END"
        ).alias(k.column)
        for k in CLASSES
    ]


def _class_tests() -> dict[str, str]:
    served = _unmasked("class_flags", _CLASS_FLAGS)
    return {"c": served["serves_c"], "b": served["serves_b"], "a": "class_flags <> 0"}


def _described(blocks: DataFrame) -> DataFrame:
    """Blocks with their flags and the geography in their code."""
    flags = {
        **_unmasked("speed_flags", _SPEED_FLAGS),
        **{f"serves_{code}": test for code, test in _class_tests().items()},
    }
    kept = [c for c in blocks.columns if not c.endswith("_flags")]
    return _with_geography(
        blocks.selectExpr(*kept, *[f"{text} AS {name}" for name, text in flags.items()])
    )


def block_speeds(filings: DataFrame) -> DataFrame:
    """Access flags and the best consumer speeds of each filed block."""
    return _described(filings.groupBy("block_code").agg(*_facts()))


def block_profile(filings: DataFrame) -> DataFrame:
    """:func:`block_speeds` plus the distinct providers of each class.

    Grouping by block and provider first makes the distinct counts plain
    counts and spreads a large block over its providers.
    """
    per_provider = filings.groupBy("block_code", "hoco_num").agg(*_facts())
    return _described(
        per_provider.groupBy("block_code").agg(*_merged_facts(), *_provider_counts())
    )


def block_providers(filings: DataFrame) -> DataFrame:
    """Distinct providers per block and class, for blocks serving either class."""
    return (
        block_profile(filings)
        .where("serves_a")
        .select("block_code", *[k.column for k in CLASSES])
    )


def _with_geography(blocks: DataFrame) -> DataFrame:
    block = F.col("block_code")
    return blocks.withColumns(
        {"county_fips": county_of_block(block), "state_fips": state_of_block(block)}
    )


def populated_blocks(blocks: DataFrame, block_pop: DataFrame) -> DataFrame:
    """Filed blocks where somebody lives, with their population."""
    return blocks.join(populations(block_pop.where(POPULATED)), "block_code")


def top_speed(filings: DataFrame, speed: str, top: str) -> DataFrame:
    """Each block's highest value of a speed among its consumer filings.

    Keeping the rows tied at the maximum and making them distinct leaves one
    row per block, so an aggregation does what a window over rows would.
    """
    best = filings.where(CONSUMER).groupBy("block_code").agg(F.max(speed).alias(top))
    return _with_geography(best)


def filings_at_top(filings: DataFrame, speed: str) -> DataFrame:
    """The consumer filings that reach their block's highest speed, all tied ones.

    The maximum is one row per block, found in two steps, and the filings meet it
    in a join that can split a block; a window would bring a block into one task.
    Filings without a block are left out.
    """
    served = filings.where(CONSUMER)
    best = served.groupBy("block_code").agg(F.max(speed).alias("_top"))
    return split_join(served, best, "block_code").where(F.col(speed) == F.col("_top")).drop("_top")


def checked_edges(edges: Sequence[tuple[str, float]]) -> tuple[tuple[str, float], ...]:
    """Tiers as (name, floor) if they make sense: floors ascend, no three are equal,
    names are distinct."""
    floors, names = [floor for _, floor in edges], [name for name, _ in edges]
    rising = all(a <= b for a, b in zip(floors, floors[1:])) and all(
        a < b for a, b in zip(floors, floors[2:])
    )
    if not floors or not rising or len(set(names)) < len(names):
        raise ValueError(f"tiers need rising floors and distinct names: {edges}")
    return tuple(edges)


def speed_tier(speed: Column, tiers: Sequence[tuple[str, float]] = SPEED_TIERS) -> Column:
    """Position of the tier a speed falls into; null below the first.

    A tier starts at its floor and ends before the next one. Of two tiers with
    one floor the first is exactly that speed and the second starts above it.
    The edges are searched by halves, so a speed meets as many of them as their
    number has bits.
    """
    floors = [floor for _, floor in checked_edges(tiers)]

    def reaches(position: int) -> Column:
        exact_before = position > 0 and floors[position - 1] == floors[position]
        return speed > floors[position] if exact_before else speed >= floors[position]

    def within(low: int, high: int) -> Column:
        """The position if it is one of low to high - 1; -1 stands for below all."""
        if high - low == 1:
            return F.lit(low if low >= 0 else None).cast("int")
        middle = (low + high) // 2
        return F.when(reaches(middle), within(middle, high)).otherwise(within(low, middle))

    return within(-1, len(floors))


def provider_bucket(count: Column, top: int = TOP_BUCKET) -> Column:
    """Number of providers with everything from ``top`` up in one bucket."""
    return F.least(F.coalesce(count, F.lit(0)), F.lit(top)).cast("int")
