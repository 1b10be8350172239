"""Names, edges and thresholds that the published tables prescribe."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------
# Widths of the geographic keys, counted in digits.
STATE_DIGITS = 2
COUNTY_PART_DIGITS = 3
COUNTY_DIGITS = 5
BLOCK_DIGITS = 15

# Characters kept of a provider's trading name.
NAME_CHARS = 23

# Service that counts as broadband, in Mbps.
BROADBAND_DOWN = 25
BROADBAND_UP = 3

# Speed tiers: name and lowest speed in Mbps. The first tier is exactly 0,
# the second starts above 0, every other one starts at its floor.
SPEED_TIERS = (
    ("0", 0),
    ("Gt0kAndLt1000k", 0),
    ("Gt1000kAndLt3000k", 1),
    ("Gt3000kAndLt4000k", 3),
    ("Gt4000kAndLt6000k", 4),
    ("Gt6000kAndLt10000k", 6),
    ("Gt10000kAndLt15000k", 10),
    ("Gt15000kAndLt25000k", 15),
    ("Gt25000kAndLt50000k", 25),
    ("Gt50000kAndLt100000k", 50),
    ("Gt100000kAndLt1Gig", 100),
    ("Gt1Gig", 1000),
)

# Provider counts are reported as 0 to 7 and "8 or more".
TOP_BUCKET = 8

# The level at which the middle of a cumulative distribution is read.
MEDIAN_LEVEL = 50

# Key of the single national row.
NATIONAL = "national"
# ----------------------------------------------------------------------------

TIERS = range(len(SPEED_TIERS))
BUCKETS = range(TOP_BUCKET + 1)

AS_WRITTEN = "as_written"
INTENDED = "intended"


@dataclass(frozen=True)
class Level:
    """A geography level and the spellings its columns use."""

    name: str
    key: str | None
    population: str
    tier_suffix: str
    provider_infix: str
    access_suffix: str

    @property
    def divisor(self) -> str:
        """Column that shares at this level are divided by."""
        return f"{self.name}_divisor"


COUNTY = Level("county", "county_fips", "county_pop", "c", "cnty", "county")
STATE = Level("state", "state_fips", "state_pop", "s", "state", "state")
NATION = Level("nation", None, "national_pop", "n", "nat", "nat")
LEVELS = (COUNTY, STATE, NATION)


@dataclass(frozen=True)
class ProviderClass:
    """A class of service and the block column counting its providers."""

    code: str
    column: str

    @property
    def bucket(self) -> str:
        """Column holding the bucket of a block's provider count."""
        return f"bucket_{self.code}"


CONSUMER = ProviderClass("c", "prov_cons")
BUSINESS = ProviderClass("b", "prov_bus")
EITHER = ProviderClass("a", "prov_all")
CLASSES = (CONSUMER, BUSINESS, EITHER)


@dataclass(frozen=True)
class Direction:
    """Download or upload: its letter and the block's best speed in it."""

    letter: str
    speed: str
    top_speed: str
    first_fast_tier: int

    @property
    def code(self) -> str:
        return f"{self.letter.lower()}l"

    @property
    def tier(self) -> str:
        """Column holding the tier of a block's best speed."""
        return f"tier_{self.code}"


def tier_starting_at(mbps: int) -> int:
    """Position of the tier whose floor is ``mbps``."""
    return max(i for i, (_, floor) in enumerate(SPEED_TIERS) if floor == mbps)


DOWNLOAD = Direction("D", "max_down", "top_down", tier_starting_at(BROADBAND_DOWN))
UPLOAD = Direction("U", "max_up", "top_up", tier_starting_at(BROADBAND_UP))
DIRECTIONS = (DOWNLOAD, UPLOAD)


def tier_column(direction: Direction, tier: int, level: Level) -> str:
    return f"pct{direction.letter}S{SPEED_TIERS[tier][0]}_hi_{level.tier_suffix}"


def bucket_column(level: Level, klass: ProviderClass, bucket: int) -> str:
    greq = "greq_" if bucket == TOP_BUCKET else ""
    return f"sum_prov_{level.provider_infix}_{greq}{klass.code}_{bucket}"


def cumulative_column(level: Level, klass: ProviderClass, bucket: int) -> str:
    return f"cumm_prov_{level.provider_infix}_{klass.code}_{bucket}"


def median_column(level: Level, klass: ProviderClass) -> str:
    return f"cumm_prov_{level.provider_infix}_{klass.code}_50th"


def lower_bound_column(level: Level, klass: ProviderClass) -> str:
    return f"lb_{level.provider_infix}_{klass.code}"


def provider_count_column(level: Level, klass: ProviderClass) -> str:
    return f"provcount_{level.provider_infix}_{klass.code}"
