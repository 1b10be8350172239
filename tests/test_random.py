"""Random small inputs against a plain recomputation."""

import math
import random
from collections import defaultdict

import pytest
from conftest import block

from covshare.layout import AS_WRITTEN, COUNTY, INTENDED, LEVELS, SPEED_TIERS
from covshare.operators import providers, shares, tiers
from covshare.layout import DOWNLOAD, UPLOAD, bucket_column, tier_column

COUNTIES = (1001, 1003, 2001, 2005)


def draw(seed, hot=False):
    rng = random.Random(seed)
    blocks = [block(rng.choice(COUNTIES + (3001,)), n) for n in range(40)]
    filings = []
    for _ in range(300):
        where = blocks[0] if hot and rng.random() < 0.5 else rng.choice(blocks)
        filings.append(
            (
                where,
                rng.choice([None, *range(12)]),
                rng.choice([0, 1, 1]),
                rng.choice([0, 1]),
                rng.choice([0.0, 0.5, 2.0, 10.0, 25.0, 30.0, 100.0, 2000.0, None]),
                rng.choice([0.0, 0.5, 1.0, 3.0, 5.0, 30.0]),
            )
        )
    people = [(b, rng.choice([0, 5, 17, 40])) for b in blocks if rng.random() < 0.9]
    counties = [(c, rng.randrange(200, 900)) for c in COUNTIES]
    return filings, people, counties


class Plain:
    """The same measures one filing at a time."""

    def __init__(self, filings, people, counties):
        self.county_pop = dict(counties)
        self.people = {b: p for b, p in people if p}
        self.all_filings = [(b, h, c, u, d or 0.0, up) for b, h, c, u, d, up in filings]
        self.filings = [
            f for f in self.all_filings
            if f[0] in self.people and f[0] // 10**10 in self.county_pop
        ]
        self.nation = sum(self.county_pop.values())
        self.states = defaultdict(int)
        for county, pop in self.county_pop.items():
            self.states[county // 1000] += pop

    def places(self, b):
        county = b // 10**10
        return [("county", county), ("state", county // 1000), ("nation", 0)]

    def whole(self, place):
        level, geo = place
        return {"county": self.county_pop, "state": self.states, "nation": {0: self.nation}}[level][geo]

    def share(self, blocks, present=None):
        """Percent of people in some blocks, for the places of ``present`` blocks."""
        sums = {p: 0 for b in (present if present is not None else blocks) for p in self.places(b)}
        for b in blocks:
            for place in self.places(b):
                if place in sums:
                    sums[place] += self.people[b]
        return {p: 100 * s / self.whole(p) for p, s in sums.items()}

    def blocks(self, test=lambda f: True):
        return {f[0] for f in self.filings if test(f)}


def in_access(f):
    return f[5] >= 3 and f[4] >= 25


def in_zero_branch(f):
    return f[5] <= 3 and f[4] <= 25


def tier_of(speed):
    if speed == 0:
        return 0
    return max(i for i, (_, floor) in enumerate(SPEED_TIERS) if i and (speed >= floor))


def close(got, expected):
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert math.isclose(got[key], value, rel_tol=1e-12, abs_tol=1e-12), key


@pytest.fixture(params=[(1, False), (2, False), (3, True)], ids=["a", "b", "hot"])
def case(request, world):
    data = draw(*request.param)
    return world(*data), Plain(*data)


def long_form(frame, value):
    return {(r["level"], r["geo_id"]): r[value] for r in frame.collect()}


def test_access_shares(case):
    w, plain = case
    present = plain.blocks(lambda f: in_access(f) or in_zero_branch(f))
    expected = plain.share(plain.blocks(in_access), present)
    for level in LEVELS:
        frame = shares.access_share(*w.tables(), level, AS_WRITTEN)
        got = {
            (level.name, r[level.key] if level.key else 0): r["pct_with_access"]
            for r in frame.collect()
        }
        close(got, {k: v for k, v in expected.items() if k[0] == level.name})


def test_intended_shares(case):
    w, plain = case
    frame = shares.all_shares(*w.tables())
    covered = plain.blocks()
    close(long_form(frame, "access"), plain.share(plain.blocks(in_access), covered))
    close(long_form(frame, "down"), plain.share(plain.blocks(lambda f: f[4] >= 25), covered))
    close(long_form(frame, "up"), plain.share(plain.blocks(lambda f: f[5] >= 3), covered))


def test_tier_shares(case):
    w, plain = case
    for direction, position in ((DOWNLOAD, 4), (UPLOAD, 5)):
        top = {}
        for f in plain.filings:
            if f[2] == 1:
                top[f[0]] = max(top.get(f[0], 0.0), f[position])
        for level in LEVELS:
            rows = tiers.tier_share(*w.tables(), direction, level).collect()
            for i in range(12):
                expected = plain.share({b for b, s in top.items() if tier_of(s) == i}, set(top))
                got = {
                    (level.name, r[level.key] if level.key else 0): r[tier_column(direction, i, level)]
                    for r in rows
                }
                close(got, {k: v for k, v in expected.items() if k[0] == level.name})


def provider_sets(plain, code):
    found = defaultdict(set)
    for b, hoco, consumer, business, _, _ in plain.all_filings:
        if {"c": consumer, "b": business, "a": consumer or business}[code]:
            found[b].add(hoco)
    return {b: len(s - {None}) for b, s in found.items()}


def test_bucket_shares(case):
    w, plain = case
    served = plain.blocks(lambda f: f[2] == 1)
    row_of = {
        r["county_fips"]: r
        for r in providers.bucket_share(
            providers.county_bucket_sums(*w.tables()), COUNTY
        ).collect()
    }
    from covshare.layout import CLASSES

    for klass in CLASSES:
        counts = provider_sets(plain, klass.code)
        for bucket in range(9):
            blocks = {b for b in served if min(counts.get(b, 0), 8) == bucket}
            expected = {
                k[1]: v for k, v in plain.share(blocks, served).items() if k[0] == "county"
            }
            got = {c: r[bucket_column(COUNTY, klass, bucket)] for c, r in row_of.items()}
            close(got, expected)


def test_provider_counts(case):
    w, plain = case
    counted = providers.provider_counts_all(providers.county_providers(w.filings()))
    got = {(r["level"], r["geo_id"]): (r["c"], r["b"], r["a"]) for r in counted.collect()}
    sets = defaultdict(lambda: {"c": set(), "b": set(), "a": set()})
    for b, hoco, consumer, business, _, _ in plain.all_filings:
        for place in plain.places(b):
            for code, serves in (("c", consumer), ("b", business), ("a", consumer or business)):
                if serves:
                    sets[place][code].add(hoco)
    expected = {
        place: tuple(len(s[code] - {None}) for code in "cba")
        for place, s in sets.items()
        if place[0] == "nation" or (s["c"] and s["b"])
    }
    assert got == expected
    for level in LEVELS:
        one = providers.provider_counts(providers.county_providers(w.filings()), level)
        names = [f"provcount_{level.provider_infix}_{code}" for code in "cba"]
        single = {
            (level.name, r[level.key] if level.key else 0): tuple(r[n] for n in names)
            for r in one.collect()
        }
        assert single == {k: v for k, v in expected.items() if k[0] == level.name}


def test_intended_median_lies_in_its_bracket(case):
    w, _ = case
    rows = providers.median_rows(providers.county_bucket_sums(*w.tables()), INTENDED).collect()
    assert rows
    for r in rows:
        if r["value"] is not None:
            assert r["bracket"] < r["value"] <= r["bracket"] + 1
