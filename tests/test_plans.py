"""Physical plans: pruned scans, no Python, no unbounded nested loops."""

import pytest
from conftest import SF_DIR

from __spark_entry__ import queries
from covshare.operators import providers
from covshare.operators.blocks import populated_blocks
from covshare.operators.filings import prepare_filings
from covshare.plans.catalogue import spark_queries

QUERIES = {name: build for name, build in queries().items() if name in spark_queries()}
# Queries that read the filings more often than once, apart from exchanges that are
# reused: from both sides of a join, or as tables that are joined or united.
SCANS = {
    "jn_outer_indicator": 2, "fn_null_fill": 2, "set_union_access": 2, "blk_top_filings_dl": 2,
    "blk_top_filings_ul": 2, "opt_provider_sketches": 9,
}
# Joins with the table of one national row, whose key is a constant on the other side.
ONE_ROW = {
    "jn_rural_shared_names", "rpt_final_intended", "opt_left_enrich", "opt_progress_enrich", "opt_income_join",
    "rpt_extended", "rpt_extended_intended",
}


def plan_of(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_nested_loops_and_few_scans(spark, name):
    plan = plan_of(spark, name)
    for word in ("Python", "ArrowEval", "CartesianProduct", *(() if name in ONE_ROW else ("NestedLoop",))):
        assert word not in plan
    scans = sum("FileScan" in line and "l_suppkey" in line for line in plan.splitlines())
    assert scans <= SCANS.get(name, 1)


def test_scan_reads_only_what_the_share_needs(spark):
    plan = plan_of(spark, "shr_access_county")
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "l_quantity" in line)
    for column in ("l_extendedprice", "l_shipdate", "l_comment", "l_returnflag"):
        assert column not in scan


def test_population_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "people")
    spark.range(10).selectExpr("id AS block_code", "id AS gl_pop", "id AS other").write.parquet(path)
    served = spark.range(10).selectExpr("id AS block_code")
    joined = populated_blocks(served, spark.read.parquet(path))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Not(EqualTo(gl_pop,0))" in plan
    assert "ReadSchema: struct<block_code:bigint,gl_pop:bigint>" in plan


def test_filings_are_aggregated_before_they_are_shuffled(spark):
    lines = plan_of(spark, "shr_access_county").splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "hashpartitioning(block_code" in line)
    assert "partial_" in lines[shuffle + 1]


def test_populations_join_blocks_without_another_shuffle(spark):
    plan = plan_of(spark, "shr_access_county")
    assert plan.count("hashpartitioning(block_code") == 2


def test_levels_of_provider_counts_share_one_pass(spark, tmp_path):
    path = str(tmp_path / "filings")
    spark.range(100).selectExpr(
        "10010000000000 + id AS block_code", "id % 7 AS hoco_num", "'p' AS dba_name",
        "1 AS consumer", "1 AS business", "1D AS max_down", "1D AS max_up",
    ).write.parquet(path)
    found = providers.county_providers(prepare_filings(spark.read.parquet(path)))
    counted = providers.provider_counts_all(found)
    assert counted.count() == 3
    counted.collect()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("FileScan") == 1
    assert "ReusedExchange" in final
