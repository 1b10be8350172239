"""Source files in, published tables out."""

import os

import pytest
from conftest import block

from covshare.layout import INTENDED
from covshare.plans import job
from covshare.plans.report import CountyReport
from covshare.sources import schemas, scratch, sinks, staging

A, B = 1001, 1003


def write(path, header, rows):
    path.write_text("\n".join([header, *[",".join(map(str, r)) for r in rows]]) + "\n")
    return str(path)


@pytest.fixture
def paths(tmp_path):
    names = [field.split(" ")[0] for field in schemas.DEPLOYMENT.split(", ")]
    filings = []
    for n, (county, hoco, down, up) in enumerate(
        [(A, 1, 30, 5), (A, 2, 100, 10), (A, 2, 0.5, 0.2), (B, 1, 30, 5), (B, 3, 10, 1)]
    ):
        known = {
            "BlockCode": block(county, n), "HocoNum": hoco, "DBAName": f"Provider {hoco}",
            "Consumer": 1, "Business": 1, "MaxAdDown": down, "MaxAdUp": up,
        }
        filings.append([known.get(c, "") for c in names])
    people = [(f[names.index("BlockCode")], 20, 8, 7) for f in filings]
    return {
        "deployment": write(tmp_path / "deployment.csv", ",".join(names), filings),
        "block_pop": write(
            tmp_path / "people.csv", "block_fips,pop2017,hu2016,hh2016", people
        ),
        "county_pop": write(
            tmp_path / "county_pop.csv", "countyFIPS,CountyPop", [(A, 80), (B, 50)]
        ),
        "county_names": write(
            tmp_path / "names.csv", "STATEFP,COUNTYFP,NAME", [(1, 1, "Ay"), (1, 3, "Bee")]
        ),
        "county_housing": write(
            tmp_path / "housing.csv", "GEOID,P,H", [(A, 80, 30), (B, 50, 20)]
        ),
        "rural_county": write(
            tmp_path / "rural_c.csv", "countyFIPS,rural share", [(A, 12.5), (9001, 1)]
        ),
        "rural_state": write(tmp_path / "rural_s.csv", "stateFIPS,rural_s", [(1, 3)]),
        "rural_nation": write(
            tmp_path / "rural_n.csv", "merge_level,rural_n", [("national", 4)]
        ),
    }


def test_every_table_is_written(spark, paths, tmp_path):
    written = job.run(spark, paths, str(tmp_path / "out"))
    assert len(written) == 5 + 3 * 4 + 3
    report = sinks.read_published(spark, f"{tmp_path}/out", "county_report").collect()
    by_county = {r["countyFIPS"]: r for r in report}
    assert set(by_county) == {str(A), str(B), "9001"}
    assert float(by_county[str(A)]["pctpopwBBacc_county"]) == 50.0
    assert by_county[str(A)]["rural share"] == "12.5"
    tiers = sinks.read_published(spark, f"{tmp_path}/out", "tiers_dl_state").first()
    assert float(tiers["pctDSGt100000kAndLt1Gig_hi_s"]) == pytest.approx(100 * 20 / 130)
    filings = sinks.read_published(spark, f"{tmp_path}/out/", "consumer_filings")
    assert filings.count() == 5 and "state_fips" in filings.columns
    assert sinks.read_published(spark, f"{tmp_path}/out", "all_block_providers").count() == 5


def test_tables_agree_with_the_report(spark, paths):
    report = CountyReport(job.read_sources(spark, paths), INTENDED)
    rows = {r["county_fips"]: r for r in report.county_rows().collect()}
    for name, table in job.published_tables(report):
        keyed = "county_fips" in table.columns and "block_code" not in table.columns
        if not keyed or name == "county_report":
            continue
        for r in table.collect():
            for column in table.columns:
                assert r[column] == rows[r["county_fips"]][column], (name, column)


def test_steps_share_the_stored_sums(spark, paths):
    report = CountyReport(job.read_sources(spark, paths))
    report.county_rows()
    stored = dict(report._stored)
    report.access()
    report.tiers()
    assert report._stored == stored


def test_command_line(spark, paths, tmp_path):
    flags = [x for name, path in paths.items() for x in (f"--{name.replace('_', '-')}", path)]
    job.main([*flags, "--out", str(tmp_path / "out"), "--mode", INTENDED, "--truncate-speeds"])
    access = sinks.read_published(spark, f"{tmp_path}/out", "county_access")
    assert access.count() == 2


def test_raw_filings_are_scanned_once(spark, paths, tmp_path, monkeypatch):
    """The raw file is gone after the first thing that reads it."""
    scans = []

    def landed(table, label):
        if label == "landed-filings":
            plan = table._jdf.queryExecution().executedPlan().toString()
            scans.append(plan.count("FileScan csv"))
        back = stored(table, label)
        if label == "landed-filings":
            os.remove(paths["deployment"])
        return back

    stored = staging.stored
    monkeypatch.setattr(staging, "stored", landed)
    assert len(job.run(spark, paths, str(tmp_path / "out"))) == 5 + 3 * 4 + 3
    assert scans == [1]


def leftovers(folder):
    return sorted(f for f in os.listdir(folder) if f.startswith("covshare-"))


def test_nothing_stored_is_left(spark, paths, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    shared.mkdir()
    monkeypatch.setattr(scratch.tempfile, "mkdtemp", lambda prefix: str(shared))
    job.run(spark, paths, str(tmp_path / "out"))
    assert leftovers(shared) == [] and not spark.catalog.listTables()
    monkeypatch.setattr(CountyReport, "block_providers", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        job.run(spark, paths, str(tmp_path / "out"))
    assert leftovers(shared) == [] and not spark.catalog.listTables()


def test_a_failed_run_leaves_the_old_tables(spark, paths, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    job.run(spark, paths, out)
    before = sorted(map(tuple, sinks.read_published(spark, out, "provider_counts_county").collect()))
    with monkeypatch.context() as patch:
        patch.setattr(sinks.Publication, "abandon", lambda self: None)  # as if killed
        patch.setattr(CountyReport, "consumer_filings", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job.run(spark, paths, out, INTENDED)
    assert len(os.listdir(f"{out}/runs")) == 2
    assert sorted(map(tuple, sinks.read_published(spark, out, "provider_counts_county").collect())) == before
    reader = sinks.read_published(spark, out, "county_access")
    job.run(spark, paths, out, INTENDED)
    assert reader.count() == 2  # the run before stays for those that read it
    assert len(os.listdir(f"{out}/runs")) == 2
    with pytest.raises(ValueError, match="no published table"):
        sinks.read_published(spark, out, "other")


def test_files_by_state_are_few(spark, tmp_path):
    """However many tasks hold rows of a state, and also for one with most of them."""
    rows = spark.range(0, 20_000, 1, 40).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE int(id % 7) END AS state_fips", "id", "uuid() AS text"
    )
    path = str(tmp_path / "rows")
    sinks.write_parquet(rows, path, "state_fips")
    assert spark.read.parquet(path).count() == 20_000
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * 7


BLOCKS = "block_code LONG, hoco_num LONG, dba_name STRING, consumer INT, business INT, max_down DOUBLE, max_up DOUBLE"


@pytest.fixture
def with_a_heavy_block(spark):
    rows = [(block(A, n % 60), n % 9, "p", 1, n % 2, n % 120.0, n % 7.0) for n in range(400)]
    rows += [(block(A, 7), n % 30, "p", 1, 1, 1.0 * n, 3.0) for n in range(300)] + [(None, 1, "p", 1, 1, 1.0, 1.0)] * 5
    return spark.createDataFrame(rows, BLOCKS).repartition(6)


def test_staged_blocks_need_no_shuffle(spark, with_a_heavy_block):
    staged = staging.stage(with_a_heavy_block, buckets=8)
    try:
        ordinary, heavy = staged.parts
        assert {r[0] for r in heavy.filings.select("block_code").distinct().collect()} == {block(A, 7), None}
        assert staged.whole().count() == 705
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        per_block = ordinary.filings.groupBy("block_code").agg({"max_down": "max"})
        assert "Exchange" not in per_block._jdf.queryExecution().executedPlan().toString()
        people = spark.range(60).selectExpr(f"{block(A, 0)} + id AS block_code", "id AS gl_pop")
        joined = ordinary.join(ordinary.filings, people, "block_code")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(block_code") == 1  # of the other side
        one = heavy.join(heavy.filings, people, "block_code")
        assert one.count() + joined.count() == 700
        assert "BroadcastHashJoin" in one._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        staged.close()


def test_staged_report_is_the_same(spark, paths, tmp_path):
    plain = CountyReport(job.read_sources(spark, paths), INTENDED)
    staged = CountyReport(job.read_sources(spark, paths), INTENDED, staged=True)
    for (name, one), (_, other) in zip(job.published_tables(plain), job.published_tables(staged)):
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect())), name
    staged.close()


@pytest.fixture
def optional_paths(tmp_path):
    amounts = '"Poverty Estimate, All Ages",Median Household Income'
    found = {}
    for name in ("adoption", "progress"):
        found[f"{name}_county"] = write(tmp_path / f"{name}_c.csv", f",countyFIPS,{name} share", [(0, A, 7)])
        found[f"{name}_state"] = write(tmp_path / f"{name}_s.csv", f"stateFIPS,{name}_s", [(1, 8)])
        found[f"{name}_nation"] = write(tmp_path / f"{name}_n.csv", f"merge_level,{name}_n", [("national", 9)])
    found["income_county"] = write(
        tmp_path / "income_c.csv", f"Estimates\n\nState FIPS Code,County FIPS Code,{amounts}", [(1, 1, 10, 50000), (1, 5, 3, 4)]
    )
    found["income_state"] = write(tmp_path / "income_s.csv", f"t\n\nState FIPS Code,{amounts}", [(1, 20, 40000)])
    found["income_nation"] = write(tmp_path / "income_n.csv", f"t\nmerge_level,{amounts}", [("national", 30, 30000)])
    return found


def test_optional_sources_reach_the_extended_report(spark, paths, optional_paths):
    report = CountyReport(job.read_sources(spark, paths | optional_paths), INTENDED)
    assert "county_report_extended" in [name for name, _ in job.published_tables(report)]
    (row,) = report.extended().collect()  # the one county that the income files have too
    assert (row["county_fips"], row["adoption share"], row["progress_s"], row["progress_n"]) == (A, 7.0, 8.0, 9.0)
    assert (row["poverty_allages_c"], row["medianHHinc_s"], row["medianHHinc_n"]) == (10, 40000, 30000)
    assert (row["less_than_zero"], row["totalpct"], row["rural share"]) == (0, 100.0, 12.5)
    some = CountyReport(job.read_sources(spark, paths | {k: v for k, v in optional_paths.items() if "progress" in k}))
    found = {r["county_fips"]: r["progress share"] for r in some.extended().collect()}
    assert found == {A: 7.0, B: None, 9001: None}


def test_an_optional_source_is_whole(spark, paths, optional_paths):
    assert not CountyReport(job.read_sources(spark, paths)).is_extended()
    del optional_paths["income_state"]
    with pytest.raises(ValueError, match="income needs files"):
        job.read_sources(spark, paths | optional_paths)
