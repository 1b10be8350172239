"""The whole run: source files in, every published table out.

    spark-submit covshare/plans/job.py --deployment ... --out ...
"""

from __future__ import annotations

import argparse
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covshare.functions.keys import state_of_block
from covshare.layout import AS_WRITTEN, DIRECTIONS, INTENDED, LEVELS
from covshare.plans.report import CountyReport, LevelTables, Sources
from covshare.sources import readers, sinks

FILES = (
    "deployment",
    "block_pop",
    "county_pop",
    "county_names",
    "county_housing",
    "rural_county",
    "rural_state",
    "rural_nation",
)


# Optional sources, each with a file for counties, states and the nation.
OPTIONAL = ("adoption", "progress", "income")
PLACES = ("county", "state", "nation")


def _payloads(spark: SparkSession, county: str, state: str, nation: str) -> LevelTables:
    return LevelTables(
        readers.read_payload(spark, county, "county_fips", "countyFIPS"),
        readers.read_payload(spark, state, "state_fips", "stateFIPS"),
        readers.read_payload(spark, nation, "merge_level"),
    )


def _income(spark: SparkSession, county: str, state: str, nation: str) -> LevelTables:
    return LevelTables(
        readers.read_county_income(spark, county),
        readers.read_state_income(spark, state),
        readers.read_national_income(spark, nation),
    )


def _optional(spark: SparkSession, paths: dict[str, str], name: str) -> LevelTables | None:
    """An optional source, if its files are given: all three of them or none."""
    given = [paths.get(f"{name}_{place}") for place in PLACES]
    if not any(given):
        return None
    if not all(given):
        raise ValueError(f"{name} needs files for county, state and nation")
    return (_income if name == "income" else _payloads)(spark, *given)


def read_sources(spark: SparkSession, paths: dict[str, str]) -> Sources:
    rural = _payloads(spark, *[paths[f"rural_{place}"] for place in PLACES])
    return Sources(
        deployment=readers.read_deployment(spark, paths["deployment"]),
        block_pop=readers.read_block_population(spark, paths["block_pop"]),
        county_pop=readers.read_county_population(spark, paths["county_pop"]),
        county_names=readers.read_county_names(spark, paths["county_names"]),
        county_housing=readers.read_county_housing(spark, paths["county_housing"]),
        rural_county=rural.county,
        rural_state=rural.state,
        rural_nation=rural.nation,
        **{name: _optional(spark, paths, name) for name in OPTIONAL},
    )


def published_tables(report: CountyReport) -> Iterator[tuple[str, DataFrame]]:
    """Name and content of each table. The report comes first: the county sums
    it stores serve the smaller tables too."""
    yield "county_report", report.final()
    if report.is_extended():
        yield "county_report_extended", report.extended()
    yield "county_access", report.access()
    yield "county_tiers", report.tiers()
    yield "county_provider_counts", report.provider_counts()
    yield "county_provider_shares", report.provider_shares()
    for level in LEVELS:
        for direction in DIRECTIONS:
            name = f"tiers_{direction.code}_{level.name}"
            yield name, report.tier_table(direction, level)
        yield f"provider_counts_{level.name}", report.provider_count_table(level)
        yield f"provider_shares_{level.name}", report.provider_share_table(level)
    yield "consumer_filings", report.consumer_filings()
    yield "block_providers", report.block_providers()
    yield "all_block_providers", report.all_block_providers()


# As large as the filings or the blocks: written as Parquet by state.
LARGE = ("consumer_filings", "block_providers", "all_block_providers")


def run(
    spark: SparkSession,
    paths: dict[str, str],
    out: str,
    mode: str = AS_WRITTEN,
    truncate_speeds: bool = False,
) -> list[str]:
    """Publish every table below ``out`` and return where this run wrote them.

    The raw filings are scanned once. What the run stores on the way is removed at
    its end; if it fails, so is what it has written, and the tables that were
    published before stay.
    """
    publication = sinks.Publication(spark, out)
    report = CountyReport(read_sources(spark, paths), mode, truncate_speeds, staged=True)
    written = []
    try:
        for name, table in published_tables(report):
            if name in LARGE:
                path = publication.path(name, "parquet")
                if "state_fips" not in table.columns:
                    table = table.withColumn("state_fips", state_of_block(F.col("block_code")))
                sinks.write_parquet(table, path, "state_fips")
            else:
                path = publication.path(name)
                sinks.write_report(table, path)
            written.append(path)
        publication.commit()
    except BaseException:
        publication.abandon()
        raise
    finally:
        report.close()
    return written


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Compute the county coverage report.")
    for name in FILES:
        parser.add_argument(f"--{name.replace('_', '-')}", required=True, dest=name)
    more = [f"{name}_{place}" for name in OPTIONAL for place in PLACES]
    for name in more:
        parser.add_argument(f"--{name.replace('_', '-')}", dest=name)
    parser.add_argument("--out", required=True)
    parser.add_argument("--mode", choices=(AS_WRITTEN, INTENDED), default=AS_WRITTEN)
    parser.add_argument("--truncate-speeds", action="store_true")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("covshare").getOrCreate()
    paths = {name: getattr(options, name) for name in (*FILES, *more)}
    run(spark, paths, options.out, options.mode, options.truncate_speeds)


if __name__ == "__main__":
    main()
