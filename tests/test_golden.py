"""Hand-computed results for the edge rules."""

import dataclasses
import math

import pytest
from conftest import block, by_key
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from covshare.functions import keys
from covshare.functions.numbers import divisor, fill_missing, percent
from covshare.layout import (
    AS_WRITTEN,
    COUNTY,
    DOWNLOAD,
    INTENDED,
    NATION,
    SPEED_TIERS,
    STATE,
    tier_column,
)
from covshare.operators import blocks, enrichment, geography, providers, shares, sketches, tiers
from covshare.operators.filings import populations, with_provenance
from covshare.plans.report import CountyReport

C = 1001


def edges(world):
    """Blocks A to D of one county of 100 people."""
    a, b, c, d = (block(C, n) for n in range(1, 5))
    return world(
        [(a, 1, 1, 0, 25.0, 3.0), (b, 1, 1, 0, 100.0, 1.0), (c, 1, 1, 0, 10.0, 1.0)],
        [(a, 40), (b, 30), (c, 20), (d, 10)],
        [(C, 100)],
    )


def level_values(frame):
    return {(r["level"], r["geo_id"]): r["pct"] for r in frame.collect()}


@pytest.mark.parametrize("mode", [AS_WRITTEN, INTENDED])
def test_access_share_at_the_edge(world, mode):
    w = edges(world)
    share = shares.access_share(*w.tables(), COUNTY, mode)
    assert by_key(share, "county_fips", "pct_with_access") == {C: 40.0}


@pytest.mark.parametrize(
    "flag, mode, expected",
    [
        ("any_down", AS_WRITTEN, 90.0),
        ("any_down", INTENDED, 70.0),
        ("any_up", AS_WRITTEN, 90.0),
        ("any_up", INTENDED, 40.0),
    ],
)
def test_speed_shares(world, flag, mode, expected):
    got = level_values(shares.speed_share(*edges(world).tables(), flag, mode))
    assert got["county", C] == expected
    assert got["state", 1] == expected
    assert got["nation", 0] == (40.0 if mode == AS_WRITTEN else expected)


def test_county_in_neither_branch_is_absent_as_written(world):
    b = block(C, 2)
    w = world([(b, 1, 1, 0, 100.0, 1.0)], [(b, 30)], [(C, 100)])
    written = shares.access_share(*w.tables(), COUNTY, AS_WRITTEN)
    intended = shares.access_share(*w.tables(), COUNTY, INTENDED)
    assert written.count() == 0
    assert by_key(intended, "county_fips", "pct_with_access") == {C: 0.0}


def test_speed_tiers_by_floor(spark):
    speeds = [0.0, 0.5, 1.0, 3.0, 4.0, 6.0, 10.0, 15.0, 25.0, 50.0, 100.0, 1000.0]
    extra = [(0.999, 1), (2.999, 2), (999.9, 10), (5000.0, 11)]
    rows = list(zip(speeds, range(12))) + extra
    frame = spark.createDataFrame(rows, "speed DOUBLE, expected INT")
    got = frame.withColumn("tier", blocks.speed_tier(F.col("speed")))
    assert got.where("tier <> expected OR tier IS NULL").count() == 0
    assert len(SPEED_TIERS) == 12
    negative = spark.createDataFrame([(-1.0,)], "speed DOUBLE")
    assert negative.select(blocks.speed_tier(F.col("speed"))).first()[0] is None


def test_whole_speeds_empty_the_fractional_tier(world):
    a = block(C, 1)
    w = world([(a, 1, 1, 0, 0.768, 0.2)], [(a, 50)], [(C, 100)])
    first, second = (tier_column(DOWNLOAD, i, COUNTY) for i in (0, 1))
    kept = tiers.tier_share(*w.tables(), DOWNLOAD, COUNTY).first()
    cut = tiers.tier_share(
        w.filings(True), w.block_pop, w.denominators(), DOWNLOAD, COUNTY
    ).first()
    assert (kept[first], kept[second]) == (0.0, 50.0)
    assert (cut[first], cut[second]) == (50.0, 0.0)


def test_most_common_tier_takes_the_first_of_equals(spark):
    columns = [tier_column(DOWNLOAD, i, COUNTY) for i in range(12)]
    values = [0.0, 0.0, 40.0, 40.0, 20.0] + [0.0] * 7
    frame = spark.createDataFrame([tuple(values)], columns)
    row = frame.selectExpr(*tiers.most_common_tier(DOWNLOAD, COUNTY, AS_WRITTEN)).first()
    assert row["mcds_prop_c"] == 40.0
    assert row["mcds_tier_c"] == columns[2]


def test_national_label_compares_the_states_second_tier(spark):
    nation = [tier_column(DOWNLOAD, i, NATION) for i in range(12)]
    state = tier_column(DOWNLOAD, 1, STATE)
    values = [10.0, 5.0, 60.0] + [0.0] * 9 + [90.0]
    frame = spark.createDataFrame([tuple(values)], [*nation, state])
    written = frame.selectExpr(*tiers.most_common_tier(DOWNLOAD, NATION, AS_WRITTEN)).first()
    intended = frame.selectExpr(*tiers.most_common_tier(DOWNLOAD, NATION, INTENDED)).first()
    assert (written["mcds_prop_n"], written["mcds_tier_n"]) == (60.0, state)
    assert (intended["mcds_prop_n"], intended["mcds_tier_n"]) == (60.0, nation[2])


@pytest.mark.parametrize(
    "bucket_shares, written, bracket, intended",
    [
        ([0, 30, 40, 30], 50 / 30, 0, 1.5),
        ([0, 30, 0, 40, 30], math.inf, 1, 2.5),
        ([0, 60, 40], None, None, 50 / 60),
        ([0, 20], math.inf, 7, None),
        ([55, 45], None, None, None),
    ],
)
def test_interpolated_median(spark, bucket_shares, written, bracket, intended):
    padded = bucket_shares + [0] * (9 - len(bucket_shares))
    running = [float(sum(padded[: i + 1])) for i in range(9)]
    frame = spark.createDataFrame([(running,)], "cumulative ARRAY<DOUBLE>")

    def median(mode):
        found = frame.selectExpr(
            "cumulative", f"{providers.bracket_below('cumulative', mode)} AS bracket"
        )
        return found.selectExpr(
            f"{providers.interpolated('cumulative', 'bracket')} AS value", "bracket"
        ).first()

    assert median(AS_WRITTEN)["value"] == (None if written is None else pytest.approx(written))
    assert median(AS_WRITTEN)["bracket"] == bracket
    assert median(INTENDED)["value"] == (None if intended is None else pytest.approx(intended))


def test_padding_never_cuts(spark):
    rows = [(10010201001000, "010010201001000"), (1234567890123456, "1234567890123456")]
    frame = spark.createDataFrame(rows, "block BIGINT, expected STRING")
    block_code = F.col("block")
    got = frame.select(
        (keys.block_text(block_code) == F.col("expected")).alias("same"),
        keys.county_of_block(block_code).alias("county"),
        keys.state_of_block(block_code).alias("state"),
    ).collect()
    assert [tuple(r) for r in got] == [(True, 1001, 1), (True, 12345, 12)]


def test_composed_county_keys(spark):
    frame = spark.createDataFrame([(1, 1), (12, 86), (1, 1234)], "s INT, c INT")
    got = frame.select(
        keys.compose_county(F.col("s"), F.col("c")).alias("text"),
        keys.county_number(F.col("s"), F.col("c")).alias("number"),
    ).collect()
    assert [tuple(r) for r in got] == [("01001", 1001), ("12086", 12086), ("11234", 11234)]


def test_provider_buckets(world):
    a, b, c, d = (block(C, n) for n in range(1, 5))
    filings = [(a, h, 1, 0, 30.0, 5.0) for h in (7, 7, 9)]
    filings += [(b, h, 1, 0, 30.0, 5.0) for h in range(8)]
    filings += [(c, h, 1, 1, 30.0, 5.0) for h in range(13)]
    filings += [(d, None, 1, 0, 30.0, 5.0)]
    w = world(filings, [(x, 10) for x in (a, b, c, d)], [(C, 100)])
    counts = by_key(blocks.block_providers(w.filings()), "block_code", "prov_cons")
    assert counts == {a: 2, b: 8, c: 13, d: 0}
    business = by_key(blocks.block_providers(w.filings()), "block_code", "prov_bus")
    assert business == {a: None, b: None, c: 13, d: None}
    sums = providers.county_bucket_sums(*w.tables())
    row = providers.bucket_share(sums, COUNTY).first()
    assert row["sum_prov_cnty_c_0"] == 10.0
    assert row["sum_prov_cnty_c_2"] == 10.0
    assert row["sum_prov_cnty_greq_c_8"] == 20.0
    assert row["sum_prov_cnty_b_0"] == 30.0
    assert row["sum_prov_cnty_greq_b_8"] == 10.0


def test_uncovered_people_stay_in_the_denominator(world):
    w = edges(world)
    row = tiers.tier_share(*w.tables(), DOWNLOAD, COUNTY).first()
    assert sum(row[tier_column(DOWNLOAD, i, COUNTY)] for i in range(12)) == 90.0


@pytest.mark.parametrize(
    "part, whole, expected",
    [(5, 0, math.inf), (0, 0, 0.0), (5, None, 0.0), (1, 4, 25.0), (0, 4, 0.0)],
)
def test_percent_of_empty_and_unknown_wholes(spark, part, whole, expected):
    frame = spark.createDataFrame([(part, whole)], "part BIGINT, whole BIGINT")
    got = frame.selectExpr("part", f"{divisor('whole')} AS d").selectExpr(percent("part", "d"))
    assert got.first()[0] == expected


def test_repeated_population_rows_count_once(world):
    a = block(C, 1)
    w = world([(a, 1, 1, 0, 30.0, 5.0)], [(a, 40)] * 3, [(C, 100)])
    share = shares.access_share(*w.tables(), COUNTY)
    assert by_key(share, "county_fips", "pct_with_access") == {C: 40.0}


def test_contradicting_populations_are_an_error(spark, world):
    a = block(C, 1)
    w = world([], [(a, 40), (a, 41)], [(C, 100)])
    with pytest.raises(PySparkException, match="two populations"):
        populations(w.block_pop).collect()


def test_repeated_county_keys_are_an_error(spark):
    county_pop = spark.createDataFrame([(C, 1), (C, 1)], "county_fips BIGINT, county_pop BIGINT")
    with pytest.raises(PySparkException, match="unique county key"):
        geography.counties(county_pop).collect()


def test_provenance_of_every_row(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k INT, x STRING")
    right = spark.createDataFrame([(1, 10), (3, 30), (3, 31)], "k INT, y INT")
    got = with_provenance(left, right, "k").collect()
    assert sorted((r["k"], r["x"] or "", r["y"] or 0, r["provenance"]) for r in got) == [
        (1, "a", 10, "both"),
        (1, "b", 10, "both"),
        (2, "c", 0, "left_only"),
        (3, "", 30, "right_only"),
        (3, "", 31, "right_only"),
    ]


@pytest.mark.parametrize("mode, rows", [(AS_WRITTEN, 2), (INTENDED, 3)])
def test_outer_join_on_missing_keys(spark, mode, rows):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k INT, x STRING")
    right = spark.createDataFrame([(1, 10), (None, 20)], "k INT, y INT")
    assert enrichment.outer_join(left, right, "k", mode).count() == rows


def test_join_all_and_flag(spark):
    tables = [spark.createDataFrame([(1, n), (n, n)], f"k INT, v{n} INT") for n in (2, 3)]
    assert [tuple(r) for r in enrichment.join_all(tables, "k").collect()] == [(1, 2, 3)]
    frame = spark.createDataFrame([(1.0,), (-0.5,)], "x DOUBLE")
    flagged = enrichment.flag_any_negative(frame, "x", "below")
    assert [r["below"] for r in flagged.collect()] == [1, 1]
    clean = enrichment.flag_any_negative(frame.where("x > 0"), "x", "below")
    assert [r["below"] for r in clean.collect()] == [0]


def test_tiers_by_any_edges(world):
    """A floor given twice, speeds below the first, and a single tier."""
    speeds = [-1.0, 0.0, 0.5, 10.0, 24.5, 24.6, 1e9, None]
    frame = world([], [], []).spark.createDataFrame([(i, s) for i, s in enumerate(speeds)], "i INT, s DOUBLE")

    def tiers_of(*edges):
        rows = frame.select("i", blocks.speed_tier(F.col("s"), edges).alias("tier")).orderBy("i").collect()
        return [r["tier"] for r in rows]

    assert tiers_of(("none", 0), ("some", 0), ("ten", 10), ("exactly", 24.5), ("more", 24.5)) == [
        None, 0, 1, 2, 3, 4, 4, None,
    ]
    assert tiers_of(("all", 10)) == [None, None, None, 0, 0, 0, 0, None]
    assert tiers_of(*SPEED_TIERS) == [None, 0, 1, 6, 7, 7, 11, None]
    for wrong in ((), (("a", 1), ("b", 0)), (("a", 1), ("b", 1), ("c", 1)), (("a", 1), ("a", 2))):
        with pytest.raises(ValueError, match="rising floors"):
            tiers_of(*wrong)


def test_share_by_any_edges(world):
    w = edges(world)
    shares_ = tiers.speed_tier_share(*w.tables(), DOWNLOAD, (("slow", 20), ("fast", 100)), [COUNTY, NATION])
    rows = {(r["level"], r["tier"], r["name"]): r["share"] for r in shares_.collect()}
    assert rows == {(at, i, name): share for at in ("county", "nation") for i, name, share in ((0, "slow", 40.0), (1, "fast", 30.0))}


def test_filings_tied_at_the_top(world):
    a, b = block(C, 1), block(C, 2)
    w = world(
        [(a, 1, 1, 0, 50.0, 1.0), (a, 2, 1, 1, 50.0, 9.0), (a, 3, 0, 1, 90.0, 1.0), (a, 4, 1, 0, 10.0, 1.0),
         (a, 1, 1, 0, 50.0, 1.0), (b, 1, 1, 0, 0.0, 0.0), (None, 1, 1, 0, 5.0, 5.0)],
        [], [],
    )
    top = blocks.filings_at_top(w.filings(), "max_down")
    assert sorted((r["block_code"], r["hoco_num"]) for r in top.collect()) == [(a, 1), (a, 1), (a, 2), (b, 1)]
    assert top.columns == w.filings().columns


@pytest.mark.parametrize("mode", [AS_WRITTEN, INTENDED])
def test_quantiles_agree_with_the_median(world, mode):
    """All places that a level can have on a cumulative array, ties included."""
    spark = world([], [], []).spark
    arrays = [[0.0] * 9, [100.0] * 9, [25.0 * min(i, 4) for i in range(9)], [50.0] * 3 + [75.0] * 6,
              [0.0, 25.0, 25.0, 50.0, 50.0, 75.0, 75.0, 75.0, 75.0], [10.0 * i for i in range(9)], [49.0] * 9]
    frame = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i INT, cumulative ARRAY<DOUBLE>")
    for level in (0, 25, 50, 75, 100):
        first = F.expr(providers.first_reaching("cumulative", 9, level))
        found = {r["i"]: r["first"] for r in frame.select("i", first.alias("first")).collect()}
        assert found == {i: next((k for k, x in enumerate(a) if x >= level), 9) for i, a in enumerate(arrays)}
    # quantile_rows on one county's buckets against median_rows.
    people = {f"prov_{k}_{b}": (b + 1) * 10 for k in "cba" for b in range(9)}
    county = spark.range(1).selectExpr(
        "1001 AS county_fips", "1 AS state_fips", *[f"450D AS {lv}_divisor" for lv in ("county", "state", "nation")],
        *[f"{v}L AS {n}" for n, v in people.items()],
    )
    medians = {tuple(r) for r in providers.median_rows(county, mode).collect()}
    quantiles = providers.quantile_rows(county, [50, 10, 90], mode).collect()
    assert {(r["level"], r["geo_id"], r["class"], r["value"], r["bracket"]) for r in quantiles if r["quantile"] == 50} == medians
    assert {r["bracket"] for r in quantiles if r["quantile"] == 10} == {0 if mode == AS_WRITTEN else 1}
    assert len(quantiles) == 3 * 9


def test_sketches_unite(world):
    spark = world([], [], []).spark
    rows = spark.range(30_000).selectExpr(
        f"{block(C, 0)} + id % 40 AS block_code", "id % 7001 AS hoco_num", "int(id % 2) AS consumer", "int(id % 3 = 0) AS business"
    )
    kept = sketches.block_sketches(rows.where("hoco_num < 5000"))
    both = sketches.add_filings(kept, rows.where("hoco_num > 4000"))  # some of them again
    found = {(r["level"], r["class"]): r["providers"] for r in sketches.provider_estimates(both).collect()}
    whole = {(r["level"], r["class"]): r["providers"] for r in sketches.provider_estimates(sketches.block_sketches(rows)).collect()}
    assert set(found) == {(lv, k) for lv in ("county", "state", "nation") for k in "cba"}
    for key, n in found.items():
        exact = 7001 if key[1] != "a" else rows.where("consumer = 1 OR business = 1").select("hoco_num").distinct().count()
        assert abs(n - exact) <= 0.05 * exact and abs(n - whole[key]) <= 0.05 * exact


def test_missing_values_are_filled(world):
    spark = world([], [], []).spark
    frame = spark.createDataFrame(
        [(None, None, None, None, "x"), (1, 2.5, "a", True, None)], "i INT, d DOUBLE, `s.t` STRING, b BOOLEAN, kept STRING"
    )
    assert [tuple(r) for r in fill_missing(frame, ["i", "d", "s.t", "b"]).collect()] == [(0, 0.0, "0", None, "x"), (1, 2.5, "a", True, None)]
    assert fill_missing(frame).schema["i"].dataType == frame.schema["i"].dataType
    assert tuple(fill_missing(frame).first()) == (0, 0.0, "0", None, "x")


def test_report_fills_its_table(world):
    """As written, missing names and housing are 0 in the report; as intended they stay."""
    w = world([(block(C, n), n, 1, 1, 30.0, 5.0) for n in (1, 2)], [(block(C, n), 50) for n in (1, 2)], [(C, 100)])
    s = w.sources()
    names = w.spark.createDataFrame([(1, 1, None, "7", None)], "state_fp INT, county_fp INT, county_name STRING, `Unnamed: 0` STRING, `a.b` DOUBLE")
    housing = w.spark.createDataFrame([(C, None, 5)], "county_fips LONG, population LONG, housing_units LONG")
    sources = dataclasses.replace(s, county_names=names, county_housing=housing)
    row = CountyReport(sources).county_rows().first()
    assert (row["county_name"], row["Unnamed: 0"], row["a.b"], row["population"], row["housing_units"]) == ("0", "7", 0.0, 0, 5)
    row = CountyReport(sources, INTENDED).county_rows().first()
    assert (row["county_name"], row["Unnamed: 0"], row["a.b"], row["population"]) == (None, "7", None, None)
