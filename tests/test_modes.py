"""As written and as intended differ where they should, and only there."""

import pytest
from conftest import block

from covshare.layout import AS_WRITTEN, INTENDED
from covshare.plans.report import CountyReport

A, B = 1001, 1003


def mixed(world):
    """County A has every kind of block, county B only a fast-down slow-up one."""
    blocks = [block(A, n) for n in range(1, 4)] + [block(B, 1)]
    filings = [
        (blocks[0], 1, 1, 1, 25.0, 3.0),
        (blocks[1], 2, 1, 1, 100.0, 1.0),
        (blocks[2], 3, 1, 1, 10.0, 1.0),
        (blocks[3], 4, 1, 1, 100.0, 1.0),
    ]
    people = list(zip(blocks, [40, 30, 20, 50]))
    rural = ([(A, 1), (9001, 2)], [(1, 3), (9, 4)], [("national", 5)])
    return world(filings, people, [(A, 100), (B, 50)], rural=rural)


def simple(world):
    """Both thresholds met or missed together: no slip applies below the nation."""
    blocks = [block(A, n) for n in range(1, 3)]
    filings = [(b, h, 1, 1, 30.0, 5.0) for b in blocks for h in (1, 2)]
    return world(filings, [(b, 50) for b in blocks], [(A, 100)])


def rows(world_, mode):
    report = CountyReport(world_.sources(), mode).county_rows()
    return {r["county_fips"]: r.asDict() for r in report.collect()}


def test_modes_differ_where_a_slip_applies(world):
    w = mixed(world)
    written, intended = rows(w, AS_WRITTEN), rows(w, INTENDED)
    assert set(written) == {A}
    assert set(intended) == {A, B}
    assert written[A]["pctpopwBBds_county"] == 90.0
    assert intended[A]["pctpopwBBds_county"] == 70.0
    assert written[A]["pctpopwBBus_state"] == pytest.approx(100 * 140 / 150)
    assert intended[A]["pctpopwBBus_state"] == pytest.approx(100 * 40 / 150)
    assert written[A]["pctpopwBBds_nat"] == written[A]["pctpopwBBacc_nat"]
    assert intended[A]["pctpopwBBds_nat"] == pytest.approx(100 * 120 / 150)
    assert "lb" in written[A] and "lb_cnty_c" in intended[A]


def test_modes_agree_where_none_applies(world):
    w = simple(world)
    written, intended = rows(w, AS_WRITTEN)[A], rows(w, INTENDED)[A]
    same = [
        c for c in written if c in intended and not c.endswith("_50th")
    ]
    assert len(same) == len(written) - 9 - 1  # the medians and lb
    assert {c: written[c] for c in same} == {c: intended[c] for c in same}


def test_lower_bound_is_that_of_the_last_combination(world):
    blocks = [block(A, n) for n in range(1, 3)]
    filings = [(b, h, 1, 1, 30.0, 5.0) for b in blocks for h in (1, 2)]
    w = world(filings, [(b, 10) for b in blocks], [(A, 100)])
    got = rows(w, AS_WRITTEN)[A]
    assert got["lb"] == "cumm_prov_nat_a_7"
    assert got["cumm_prov_cnty_c_50th"] == float("inf")


@pytest.mark.parametrize("mode", [AS_WRITTEN, INTENDED])
def test_rural_tables_join_in_full(world, mode):
    final = CountyReport(mixed(world).sources(), mode).final().collect()
    counties = {r["county_fips"] for r in final}
    assert {A, 9001} <= counties
    alone = [r for r in final if r["rural_s"] == 4]
    assert len(alone) == 1 and alone[0]["county_fips"] is None
    matched = next(r for r in final if r["county_fips"] == A)
    assert (matched["rural_c"], matched["rural_s"], matched["rural_n"]) == (1, 3, 5)


def test_unknown_mode_is_refused(world):
    with pytest.raises(ValueError):
        CountyReport(simple(world).sources(), "exact")
