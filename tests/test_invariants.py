"""Relations that hold between results whatever the data."""

import pytest
from conftest import SF_DIR

from covshare.layout import (
    BUCKETS,
    CLASSES,
    COUNTY,
    DIRECTIONS,
    INTENDED,
    LEVELS,
    NATION,
    STATE,
    TIERS,
    bucket_column,
    cumulative_column,
    provider_count_column,
    tier_column,
)
from covshare.plans.catalogue import _report
from covshare.sources.fixtures import Inputs

CLOSE = 1e-9


@pytest.fixture(scope="module")
def rows(spark):
    return _report(Inputs(spark, SF_DIR), INTENDED).county_rows().toPandas()


@pytest.mark.parametrize("level", LEVELS, ids=lambda level: level.name)
def test_with_and_without_access_make_100(rows, level):
    s = level.access_suffix
    total = rows[f"pctpopwBBacc_{s}"] + rows[f"pctpopwoBBacc_{s}"]
    assert (total - 100).abs().max() < CLOSE


@pytest.mark.parametrize("level", LEVELS, ids=lambda level: level.name)
def test_tiers_add_up_to_the_same_share_in_both_directions(rows, level):
    totals = [
        rows[[tier_column(d, i, level) for i in TIERS]].sum(axis=1) for d in DIRECTIONS
    ]
    assert (totals[0] - totals[1]).abs().max() < CLOSE
    assert totals[0].max() <= 100 + CLOSE


def test_tier_totals(rows):
    for d in DIRECTIONS:
        total = rows[[tier_column(d, i, COUNTY) for i in TIERS]].sum(axis=1)
        assert (total - rows[f"total{d.letter}SPCT"]).abs().max() < CLOSE


@pytest.mark.parametrize("level", LEVELS, ids=lambda level: level.name)
def test_cumulative_shares_never_fall_and_end_at_the_total(rows, level):
    for klass in CLASSES:
        steps = [rows[cumulative_column(level, klass, b)] for b in BUCKETS]
        for low, high in zip(steps, steps[1:]):
            assert (high - low).min() >= 0
        total = rows[[bucket_column(level, klass, b) for b in BUCKETS]].sum(axis=1)
        assert (total - steps[-1]).abs().max() < CLOSE


def test_provider_counts_grow_with_the_area(rows):
    for klass in CLASSES:
        county, state, nation = (
            rows[provider_count_column(level, klass)] for level in LEVELS
        )
        assert (county <= state).all() and (state <= nation).all()


@pytest.mark.parametrize("level", LEVELS, ids=lambda level: level.name)
def test_either_class_counts_at_least_each_class(rows, level):
    c, b, a = (rows[provider_count_column(level, k)] for k in CLASSES)
    assert (a >= c).all() and (a >= b).all() and (a <= c + b).all()


def test_nation_is_the_population_weighted_mean_of_counties(spark):
    t = Inputs(spark, SF_DIR)
    from covshare.operators import geography, shares
    from covshare.operators.filings import prepare_filings

    denominators = geography.denominators(t.county_pop_raw)
    result = shares.all_shares(
        prepare_filings(t.deployment_raw), t.block_pop_raw, denominators
    ).toPandas()
    weights = denominators.toPandas().set_index("county_fips")["county_pop"]
    counties = result[result.level == COUNTY.name].set_index("geo_id")
    nation = result[result.level == NATION.name].iloc[0]
    for share in ("access", "down", "up"):
        mean = (counties[share] * weights.reindex(counties.index)).sum() / weights.sum()
        assert mean == pytest.approx(nation[share])
    assert (result[result.level == STATE.name][["access", "down", "up"]] <= 100).all().all()
