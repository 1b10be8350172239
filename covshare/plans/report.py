"""The county report: one wide row per county.

All measures come from one table of whole-number sums per county. The filings
are read for it once, and once more for the providers per county. Both results
are stored in the shared folder as soon as a step is asked for, so nothing
reads the filings again; everything after that works on one row per county.
Whoever publishes the tables of filings and blocks too has them staged first.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.functions.numbers import fill_missing, percent
from covshare.layout import (
    AS_WRITTEN,
    BUCKETS,
    CLASSES,
    COUNTY,
    DIRECTIONS,
    DOWNLOAD,
    INTENDED,
    LEVELS,
    NATION,
    NATIONAL,
    STATE,
    UPLOAD,
    Direction,
    Level,
    ProviderClass,
    cumulative_column,
    lower_bound_column,
    median_column,
)
from covshare.operators import enrichment, geography, providers, tiers
from covshare.operators.blocks import (
    block_profile,
    block_providers,
    block_speeds,
    populated_blocks,
)
from covshare.operators.filings import (
    CONSUMER,
    enrich,
    prepare_filings,
    shares_of_block,
)
from covshare.operators.shares import county_sums, roll_up
from covshare.sources.scratch import discard, stored
from covshare.sources.staging import stage, unstaged

BLOCK_KEYS = ("block_code", "county_fips", "state_fips")
BLOCK_SHARES = (
    "gl_pop",
    "county_pop",
    "pct_of_county",
    "pct_of_state",
    "pct_of_nation",
)

# How a level's sum of a measure is called on a county row.
_SUMS = {COUNTY: "{}", STATE: "state_{}", NATION: "nation.{}"}


@dataclass(frozen=True)
class LevelTables:
    """Payload tables keyed by county_fips, state_fips and merge_level."""

    county: DataFrame
    state: DataFrame
    nation: DataFrame


@dataclass(frozen=True)
class Sources:
    """The tables a report is made from, under their canonical column names.

    The last ones are optional and only reach the extended report.
    """

    deployment: DataFrame
    block_pop: DataFrame
    county_pop: DataFrame
    county_names: DataFrame
    county_housing: DataFrame
    rural_county: DataFrame
    rural_state: DataFrame
    rural_nation: DataFrame
    adoption: LevelTables | None = None
    progress: LevelTables | None = None
    income: LevelTables | None = None


class CountyReport:
    """The report in the steps it is published in; each step adds columns."""

    def __init__(
        self,
        sources: Sources,
        mode: str = AS_WRITTEN,
        truncate_speeds: bool = False,
        staged: bool = False,
    ):
        if mode not in (AS_WRITTEN, INTENDED):
            raise ValueError(f"mode must be {AS_WRITTEN!r} or {INTENDED!r}: {mode!r}")
        self.sources = sources
        self.mode = mode
        filings = prepare_filings(sources.deployment, truncate_speeds)
        self.filings = stage(filings) if staged else unstaged(filings)
        self.denominators = geography.denominators(sources.county_pop)
        self._stored: dict[object, DataFrame] = {}

    # -- stored tables -------------------------------------------------------

    def close(self) -> None:
        """Remove what the report has stored; its tables can't be computed afterwards."""
        discard(*self._stored.values())
        self._stored.clear()
        self.filings.close()

    def _measures(self, with_tiers: bool, with_providers: bool) -> dict[str, str]:
        """Conditions on blocks whose population each county adds up."""
        served = {}
        if with_tiers:
            for direction in DIRECTIONS:
                served.update(tiers.tier_tests(direction))
        if with_providers:
            served.update(providers.bucket_tests())
        return {
            "covered": "true",
            "access": "any_access",
            "down": "any_down",
            "up": "any_up",
            **{name: f"serves_c AND {test}" for name, test in served.items()},
        }

    def _county_sums(self, with_tiers: bool, with_providers: bool) -> DataFrame:
        """County sums of the measures, stored; the full table serves every step."""
        for known in ((with_tiers, with_providers), (True, True)):
            if known in self._stored:
                return self._stored[known]
        profile = block_profile if with_providers else block_speeds
        blocks = self.filings.by_part(
            lambda part: populated_blocks(profile(part.filings), self.sources.block_pop)
        )
        if with_tiers:
            blocks = tiers.with_tiers(blocks)
        if with_providers:
            blocks = providers.with_buckets(blocks)
        sums = county_sums(
            blocks,
            self._measures(with_tiers, with_providers),
            self.denominators,
            {"surveyed": "any_access OR any_lack", "served": "serves_c"},
        )
        self._stored[with_tiers, with_providers] = stored(sums, "county-sums")
        return self._stored[with_tiers, with_providers]

    def _provider_counts(self) -> DataFrame:
        if "counts" not in self._stored:
            found = providers.county_providers(self.filings.whole())
            self._stored["counts"] = stored(
                providers.provider_counts_all(found), "provider-counts"
            )
        return self._stored["counts"]

    def _store_both(self, with_tiers: bool, with_providers: bool) -> None:
        """Both passes over the filings side by side; neither needs the other."""
        with ThreadPoolExecutor(max_workers=2) as pool:
            passes = [
                pool.submit(self._county_sums, with_tiers, with_providers),
                pool.submit(self._provider_counts),
            ]
            for done in passes:
                done.result()

    # -- the county table ----------------------------------------------------

    def _county_table(self, with_tiers: bool, with_providers: bool) -> DataFrame:
        """County sums with their state and national totals, names and housing."""
        table = self._county_sums(with_tiers, with_providers)
        names = list(self._measures(with_tiers, with_providers))
        nation = table.selectExpr(*[f"sum({n}) AS {n}" for n in names])
        # A window sees the counties of one state, of which there are few.
        table = table.selectExpr(
            "*",
            *[
                f"sum({n}) OVER (PARTITION BY state_fips) AS {_SUMS[STATE].format(n)}"
                for n in names
            ],
            "sum(CASE WHEN served THEN county_pop END) "
            "OVER (PARTITION BY state_fips) AS state_pop_covered",
        )
        table = enrichment.attach_single_row(table, nation, "nation")
        if self.mode == AS_WRITTEN:
            table = table.where("surveyed")
        if with_tiers or with_providers:
            table = table.where("served")
        named = geography.county_data(
            self.sources.county_names, self.sources.county_housing
        ).drop("state_fips")
        return named.join(table, "county_fips")

    def _with_provider_counts(self, table: DataFrame) -> DataFrame:
        counts = self._provider_counts()
        for level in (COUNTY, STATE):
            table = table.join(providers.counts_at(counts, level), level.key)
        nation = providers.counts_at(counts, NATION)
        table = enrichment.attach_single_row(table, nation, "_nation")
        return table.select("*", "_nation.*").drop("_nation")

    # -- column families, as SQL text ----------------------------------------

    def _names(self) -> list[str]:
        return [
            c
            for c in self.sources.county_names.columns
            if c not in ("state_fp", "county_fp")
        ]

    def _identity(self) -> list[str]:
        names = [f"`{c}`" for c in self._names()]
        return ["county_fips", "state_fips", *names, "population", "housing_units"]

    def _filled(self, table: DataFrame) -> DataFrame:
        """No name, housing or population value is missing: 0 stands in, also as text.

        Nothing else in the table can be null.
        """
        return fill_missing(table, [*self._names(), "population", "housing_units"])

    def _access(self) -> list[str]:
        """Access, download and upload shares, and the share without access.

        As written, the speed tests are lost below the nation and the nation
        repeats the access share.
        """
        columns = []
        for level in LEVELS:
            down, up = "down", "up"
            if self.mode == AS_WRITTEN:
                down = up = "access" if level is NATION else "covered"
            shares = {
                short: percent(_SUMS[level].format(measure), level.divisor)
                for short, measure in (("acc", "access"), ("ds", down), ("us", up))
            }
            columns += [
                f"{share} AS pctpopwBB{short}_{level.access_suffix}"
                for short, share in shares.items()
            ]
            columns.append(f"100 - {shares['acc']} AS pctpopwoBBacc_{level.access_suffix}")
        return columns

    def _tiers(self) -> list[str]:
        shares = [
            column
            for direction in DIRECTIONS
            for level in LEVELS
            for column in tiers.tier_shares_of(direction, level, _SUMS[level])
        ]
        totals = [
            f"{tiers.share_of_tiers(d, COUNTY, 0)} AS total{d.letter}SPCT"
            for d in DIRECTIONS
        ]
        return shares + totals

    def _most_common(self) -> list[str]:
        return [
            column
            for direction in DIRECTIONS
            for level in LEVELS
            for column in tiers.most_common_tier(direction, level, self.mode)
        ]

    def _fast_tiers(self) -> list[str]:
        return [
            f"{tiers.share_of_tiers(d, level, d.first_fast_tier, _SUMS[level])} "
            f"AS {stem}_{level.tier_suffix}"
            for d, stem in ((DOWNLOAD, "dsgteq25"), (UPLOAD, "usgteq3"))
            for level in LEVELS
        ]

    def _bucket_shares(self) -> list[str]:
        shares = [
            column
            for level in LEVELS
            for column in providers.bucket_shares_of(level, _SUMS[level])
        ]
        return ["county_pop", "state_pop_covered", *shares]

    def _cumulative(self) -> list[str]:
        """Cumulative shares as one array per level and class."""
        arrays = []
        for level in LEVELS:
            for klass in CLASSES:
                running = ", ".join(
                    providers.cumulative_share(klass, b, level.divisor, _SUMS[level])
                    for b in BUCKETS
                )
                arrays.append(f"array({running}) AS {_cumulative(level, klass)}")
        return arrays

    def _with_medians(self, table: DataFrame) -> DataFrame:
        """Cumulative arrays unpacked into columns, with their medians."""
        places = [(level, klass) for level in LEVELS for klass in CLASSES]
        arrays = [_cumulative(*place) for place in places]
        brackets = {place: lower_bound_column(*place) for place in places}
        found = table.selectExpr(
            "*",
            *[
                f"{providers.bracket_below(array, self.mode)} AS {brackets[place]}"
                for place, array in zip(places, arrays)
            ],
        )
        kept = [f"`{c}`" for c in table.columns if c not in arrays]
        unpacked = [
            f"{_cumulative(*place)}[{b}] AS {cumulative_column(*place, b)}"
            for place in places
            for b in BUCKETS
        ]
        medians = [
            f"{providers.interpolated(array, brackets[place])} AS {median_column(*place)}"
            for place, array in zip(places, arrays)
        ]
        bounds = list(brackets.values())
        if self.mode == AS_WRITTEN:
            bounds = [f"{providers.last_lower_bound(brackets)} AS lb"]
        return found.selectExpr(*kept, *unpacked, *medians, *bounds)

    # -- the published steps -------------------------------------------------

    def access(self) -> DataFrame:
        """Counties with access, download and upload shares."""
        table = self._county_table(with_tiers=False, with_providers=False)
        return table.selectExpr(*self._identity(), *self._access())

    def fast_tiers(self) -> DataFrame:
        """Shares at 25 Mbps down and 3 Mbps up, and the totals of all tiers."""
        table = self._county_table(with_tiers=True, with_providers=False)
        return table.selectExpr("county_fips", *self._tiers()[-2:], *self._fast_tiers())

    def tiers(self) -> DataFrame:
        """Access shares, tier shares, most common tiers and tier totals."""
        table = self._county_table(with_tiers=True, with_providers=False)
        return table.selectExpr(*self._tier_columns()).selectExpr(
            "*", *self._most_common()
        )

    def provider_counts(self) -> DataFrame:
        """The same with distinct providers per county, state and nation."""
        self._store_both(with_tiers=True, with_providers=False)
        table = self._county_table(with_tiers=True, with_providers=False)
        return self._with_provider_counts(
            table.selectExpr(*self._tier_columns())
        ).selectExpr("*", *self._most_common())

    def provider_shares(self) -> DataFrame:
        """The same with population shares by number of providers."""
        self._store_both(with_tiers=True, with_providers=True)
        table = self._county_table(with_tiers=True, with_providers=True)
        return self._with_provider_counts(
            table.selectExpr(*self._tier_columns(), *self._bucket_shares())
        ).selectExpr("*", *self._most_common())

    def county_rows(self) -> DataFrame:
        """Everything but the rural tables."""
        self._store_both(with_tiers=True, with_providers=True)
        table = self._county_table(with_tiers=True, with_providers=True)
        if self.mode == AS_WRITTEN:
            table = self._filled(table)
        counted = self._with_provider_counts(
            table.selectExpr(
                *self._tier_columns(),
                *self._bucket_shares(),
                *self._fast_tiers(),
                *self._cumulative(),
            )
        )
        return self._with_medians(counted.selectExpr("*", *self._most_common()))

    def final(self) -> DataFrame:
        """The whole report, joined in full with the rural tables."""
        s = self.sources
        return enrichment.with_rural_tables(
            self.county_rows(), s.rural_county, s.rural_state, s.rural_nation, self.mode
        )

    def extended(self) -> DataFrame:
        """The whole report with the optional sources there are.

        Adoption and progress join from the report's side; then a flag tells whether
        any county has a negative share without access, and the shares with and
        without are added up; income joins from its own side.
        """
        table, s = self.final(), self.sources
        for payload in (s.adoption, s.progress):
            if payload is not None:
                table = enrichment.left_enrich(table, payload.county, payload.state, payload.nation)
        table = enrichment.flag_any_negative(table, "pctpopwoBBacc_county", "less_than_zero")
        table = table.withColumn(
            "totalpct", F.col("pctpopwoBBacc_county") + F.col("pctpopwBBacc_county")
        )
        if s.income is not None:
            table = enrichment.with_income(table, s.income.county, s.income.state, s.income.nation)
        return table

    def is_extended(self) -> bool:
        s = self.sources
        return any(payload is not None for payload in (s.adoption, s.progress, s.income))

    # -- the tables published beside it --------------------------------------

    def tier_table(self, direction: Direction, level: Level) -> DataFrame:
        """Tier shares of one direction at one level."""
        served = self._county_sums(True, True).where("served")
        rolled = roll_up(served, tiers.tier_tests(direction), level)
        keys = [level.key] if level.key else []
        return rolled.selectExpr(*keys, *tiers.tier_shares_of(direction, level))

    def provider_count_table(self, level: Level) -> DataFrame:
        return providers.counts_at(self._provider_counts(), level)

    def provider_share_table(self, level: Level) -> DataFrame:
        served = self._county_sums(True, True).where("served")
        return providers.bucket_share(served, level)

    def consumer_filings(self) -> DataFrame:
        """Consumer filings of populated blocks with the shares of their block."""
        s = self.sources
        known = self.filings.by_part(
            lambda part: enrich(
                part.filings.where(CONSUMER), s.block_pop, self.denominators, part.join
            )
        )
        return known.select(*BLOCK_KEYS, "max_down", "max_up", *BLOCK_SHARES)

    def all_block_providers(self) -> DataFrame:
        """Provider counts of every block with filings of a class, without regard to
        population."""
        return self.filings.by_part(lambda part: block_providers(part.filings))

    def block_providers(self) -> DataFrame:
        """Provider counts of the blocks with consumer filings, and their shares."""
        counted = self.filings.by_part(
            lambda part: providers.counted_blocks(part.filings, self.sources.block_pop)
        )
        known = counted.drop("state_fips").join(self.denominators, "county_fips")
        counts = [f"coalesce({k.column}, 0) AS {k.column}" for k in CLASSES]
        return known.selectExpr("*", *shares_of_block()).selectExpr(
            *BLOCK_KEYS, *counts, *BLOCK_SHARES
        )

    def _tier_columns(self) -> list[str]:
        return [
            *self._identity(),
            f"'{NATIONAL}' AS merge_level",
            *self._access(),
            *self._tiers(),
        ]


def _cumulative(level: Level, klass: ProviderClass) -> str:
    return f"cumulative_{level.provider_infix}_{klass.code}"
