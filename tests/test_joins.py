"""Joins that survive a hot block, and payload tables with awkward names."""

import pytest
from conftest import block

from covshare.layout import AS_WRITTEN, INTENDED
from covshare.operators import enrichment, geography
from covshare.operators.filings import enrich, filings_with_denominators, prepare_filings

HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def without_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in HOT}
    for k, v in HOT.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("join", [enrich, filings_with_denominators])
def test_a_hot_block_is_split(spark, tmp_path, without_broadcast, join):
    hot = block(1001, 7)
    spark.range(0, 300_000, 1, 8).selectExpr(
        f"CASE WHEN id % 3 = 0 THEN {hot} ELSE {hot} + 1 + id % 5000 END AS block_code",
        "id % 50 AS hoco_num", "concat('p', uuid()) AS dba_name", "1 AS consumer", "1 AS business",
        "double(id % 100) AS max_down", "double(id % 10) AS max_up",
    ).write.parquet(f"{tmp_path}/filings")
    people = spark.range(6000).selectExpr(f"{hot} + id AS block_code", "id % 9 + 1 AS gl_pop")
    counties = spark.createDataFrame([(1001, 30_000)], "county_fips LONG, county_pop LONG")
    joined = join(
        prepare_filings(spark.read.parquet(f"{tmp_path}/filings")), people, geography.denominators(counties)
    )
    assert joined.count() == 300_000
    plan = _final_plan(joined)
    assert "skew=true" in plan


def _final_plan(frame):
    execution = frame._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("mode", [AS_WRITTEN, INTENDED])
def test_payload_tables_that_share_names(spark, mode):
    report = spark.createDataFrame([(1001, 1, "national", 5.0, "n")], "county_fips INT, state_fips INT, merge_level STRING, share DOUBLE, `a.b` STRING")
    county = spark.createDataFrame([(1001, "x", 1.0, 0)], "county_fips LONG, `a.b` STRING, share DOUBLE, _c0 INT")
    state = spark.createDataFrame([(1, "low", 0)], "state_fips LONG, note STRING, _c0 INT")
    nation = spark.createDataFrame([("national", 7, 0)], "merge_level STRING, note INT, _c0 INT")
    row = enrichment.with_rural_tables(report, county, state, nation, mode).first().asDict()
    assert row == {
        "county_fips": 1001, "state_fips": 1, "merge_level": "national", "share_x": 5.0, "a.b_x": "n",
        "a.b_y": "x", "share_y": 1.0, "_c0_x": 0, "note_x": "low", "_c0_y": 0, "note_y": 7, "_c0": 0,
    }
    assert enrichment.left_enrich(report, county, state, nation).first().asDict() == row


def test_six_digit_counties_pass_and_repeated_ones_stop(spark):
    counties = spark.createDataFrame([(123456, 5), (1001, 6)], "county_fips LONG, county_pop LONG")
    assert geography.counties(counties).count() == 2
    with pytest.raises(Exception, match="not a unique county key"):
        geography.counties(counties.union(counties)).collect()
