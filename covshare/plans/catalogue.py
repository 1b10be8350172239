"""Every operator as a query over the derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covshare.functions import keys, numbers
from covshare.layout import (
    AS_WRITTEN,
    CLASSES,
    COUNTY,
    DIRECTIONS,
    INTENDED,
    LEVELS,
    NATION,
    STATE,
    TIERS,
    Direction,
    Level,
    tier_column,
)
from covshare.operators import (
    blocks,
    enrichment,
    filings as ops,
    geography,
    providers,
    shares,
    sketches,
    tiers,
)
from covshare.plans.report import CountyReport, LevelTables, Sources
from covshare.sources import readers, schemas, sinks
from covshare.sources.fixtures import Inputs
from covshare.sources.scratch import scratch_path

Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def _filings(t: Inputs, truncate_speeds: bool = False) -> DataFrame:
    return ops.prepare_filings(t.deployment_raw, truncate_speeds)


def _denominators(t: Inputs) -> DataFrame:
    return geography.denominators(t.county_pop_raw)


def _enriched(t: Inputs) -> DataFrame:
    return ops.enrich(_filings(t), t.block_pop_raw, _denominators(t)).withColumn(
        "block_code", keys.block_text(F.col("block_code"))
    )


def _report(t: Inputs, mode: str = AS_WRITTEN, **more: LevelTables) -> CountyReport:
    return CountyReport(
        Sources(
            deployment=t.deployment_raw,
            block_pop=t.block_pop_raw,
            county_pop=t.county_pop_raw,
            county_names=t.county_names_raw,
            county_housing=t.county_housing_raw,
            rural_county=t.rural_county_raw,
            rural_state=t.rural_state_raw,
            rural_nation=t.rural_national_raw,
            **more,
        ),
        mode,
    )


# -- sources and sinks -------------------------------------------------------


def _deployment_file(t: Inputs) -> str:
    path = scratch_path(t.spark, "deployment")
    own = {ours: theirs for theirs, ours in schemas.DEPLOYMENT_NAMES.items()}
    named = t.deployment_raw.withColumnsRenamed(own)
    columns = []
    for field in schemas.DEPLOYMENT.split(", "):
        name, kind = field.split(" ")
        filled = F.col(name) if name in named.columns else F.lit(None).cast(kind)
        columns.append(filled.alias(name))
    sinks.write_csv(named.select(*columns), path, encoding=schemas.WESTERN)
    return path


@query("src_block_pop")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "block-population")
    own = {ours: theirs for theirs, ours in schemas.BLOCK_POPULATION_NAMES.items()}
    sinks.write_csv(t.block_pop_raw.withColumnsRenamed(own), path)
    return readers.read_block_population(t.spark, path).withColumn(
        "block_code", keys.block_text(F.col("block_code"))
    )


@query("src_deployment")
def _(t: Inputs) -> DataFrame:
    deployment = readers.read_deployment(t.spark, _deployment_file(t))
    return ops.prepare_filings(deployment).withColumn(
        "block_code", keys.block_text(F.col("block_code"))
    )


@query("src_deployment_whole_speeds")
def _(t: Inputs) -> DataFrame:
    deployment = readers.read_deployment(t.spark, _deployment_file(t))
    return ops.prepare_filings(deployment, truncate_speeds=True).select(
        "block_code", "hoco_num", "max_down", "max_up"
    )


@query("src_reordered")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "block-population-reordered")
    own = {ours: theirs for theirs, ours in schemas.BLOCK_POPULATION_NAMES.items()}
    named = t.block_pop_raw.withColumnsRenamed(own)
    sinks.write_csv(named.select(*reversed(named.columns)), path)
    return readers.read_block_population(t.spark, path).withColumn(
        "block_code", keys.block_text(F.col("block_code"))
    )


@query("src_unnamed_column")
def _(t: Inputs) -> DataFrame:
    """Files as other writers leave them: some with an index column that has no name,
    some without it and in another order."""
    path = scratch_path(t.spark, "block-population-indexed")
    own = {ours: theirs for theirs, ours in schemas.BLOCK_POPULATION_NAMES.items()}
    named = t.block_pop_raw.withColumnsRenamed(own)
    indexed = named.where("block_fips % 2 = 0").select((F.col("block_fips") % 1000).alias(""), *named.columns)
    sinks.write_csv(indexed, path)
    named.where("block_fips % 2 <> 0").select(*reversed(named.columns)).write.mode("append").csv(path, header=True)
    table = readers.read_block_population(t.spark, path)
    return table.withColumnRenamed("Unnamed: 0", "own_index").withColumn(
        "block_code", keys.block_text(F.col("block_code"))
    )


@query("src_extra_columns")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "county-names-extra")
    named = t.county_names_raw.selectExpr(
        "concat('S', state_fp) AS `state.name`", "county_name", "county_fp AS COUNTYFP",
        "'H1' AS class_code", "state_fp AS STATEFP",
    )
    sinks.write_csv(named, path)
    return readers.read_county_names(t.spark, path).withColumnRenamed("state.name", "state_name")


@query("src_county_housing")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "county-housing")
    sinks.write_csv(t.county_housing_raw.toDF("GEOID", "POP", "HU"), path)
    return readers.read_county_housing(t.spark, path)


@query("src_county_population")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "county-population")
    own = {ours: theirs for theirs, ours in schemas.COUNTY_POPULATION_NAMES.items()}
    sinks.write_csv(t.county_pop_raw.withColumnsRenamed(own), path)
    return readers.read_county_population(t.spark, path)


@query("src_county_names")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "county-names")
    own = {ours: theirs for theirs, ours in schemas.COUNTY_NAMES_NAMES.items()}
    sinks.write_csv(t.county_names_raw.withColumnsRenamed(own), path)
    return readers.read_county_names(t.spark, path)


@query("src_pruned")
def _(t: Inputs) -> DataFrame:
    deployment = readers.read_deployment(t.spark, _deployment_file(t))
    return ops.prepare_filings(deployment).select(
        "consumer", "business", "block_code", "hoco_num", "county_fips", "state_fips"
    )


@query("jn_rural_shared_names")
def _(t: Inputs) -> DataFrame:
    report = geography.with_merge_level(geography.counties(t.county_pop_raw))
    payloads = [
        table.withColumnRenamed(name, "blocks")
        for table, name in (
            (t.rural_county_raw, "rural_blocks_c"),
            (t.rural_state_raw, "rural_blocks_s"),
            (t.rural_national_raw, "rural_blocks_n"),
        )
    ]
    return enrichment.with_rural_tables(report, *payloads, INTENDED)


@query("snk_csv_roundtrip")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "roundtrip")
    table = geography.counties(t.county_pop_raw).select("county_fips", "county_pop")
    sinks.write_csv(table, path, encoding=schemas.WESTERN)
    return readers.read_table(
        t.spark, path, "county_fips INT, county_pop BIGINT", encoding=schemas.WESTERN
    )


@query("snk_published")
def _(t: Inputs) -> DataFrame:
    """Two runs published one after another and a third that fails: the second counts."""
    out = scratch_path(t.spark, "published")
    table = geography.counties(t.county_pop_raw).select("county_fips", "state_fips", "county_pop")
    for rows in (table.where("county_fips % 2 = 0"), table):
        run = sinks.Publication(t.spark, out)
        sinks.write_parquet(rows, run.path("counties", "parquet"), "state_fips")
        run.commit()
    failed = sinks.Publication(t.spark, out)
    sinks.write_parquet(table.limit(0), failed.path("counties", "parquet"), "state_fips")
    return sinks.read_published(t.spark, out, "counties")


@query("snk_report")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "report")
    report = _report(t).access()
    sinks.write_report(report, path)
    return t.spark.read.csv(path, schema=report.schema, header=True)


# -- projections and scalar functions ----------------------------------------


@query("prj_select")
def _(t: Inputs) -> DataFrame:
    return _enriched(t).select(
        "block_code", "county_fips", "gl_pop", "max_down", "max_up"
    )


@query("fn_zero_pad")
def _(t: Inputs) -> DataFrame:
    block = F.col("block_code")
    county, state = keys.county_of_block(block), keys.state_of_block(block)
    return t.block_pop_raw.select(
        "block_code",
        keys.zero_pad(block, 15).alias("block_text"),
        keys.zero_pad(county, 5).alias("county_text"),
        keys.zero_pad(county % 1000, 3).alias("county_part_text"),
        keys.zero_pad(state, 2).alias("state_text"),
        keys.zero_pad(block, 5).alias("too_long_text"),
    )


@query("fn_geo_keys")
def _(t: Inputs) -> DataFrame:
    block = F.col("block_code")
    text = keys.block_text(block)
    return t.block_pop_raw.select(
        text.alias("block_code"),
        keys.county_of_block(block).alias("county_fips"),
        keys.state_of_block(block).alias("state_fips"),
        keys.key_prefix(text, 5).alias("county_from_text"),
        keys.key_prefix(text, 2).alias("state_from_text"),
    )


@query("fn_left")
def _(t: Inputs) -> DataFrame:
    return t.deployment_raw.select(
        "block_code",
        "hoco_num",
        F.col("dba_name").alias("full_name"),
        keys.left(F.col("dba_name")).alias("dba_name"),
    )


@query("fn_compose_key")
def _(t: Inputs) -> DataFrame:
    return t.county_names_raw.select(
        "state_fp",
        "county_fp",
        keys.compose_county(F.col("state_fp"), F.col("county_fp")).alias("county_fips"),
    )


@query("fn_null_fill")
def _(t: Inputs) -> DataFrame:
    joined = ops.filings_with_population(_filings(t), t.block_pop_raw)
    return joined.select("block_code", "hoco_num", "gl_pop", "max_down", "max_up")


@query("fn_fill_table")
def _(t: Inputs) -> DataFrame:
    """Every kind of column with missing values, all filled."""
    table = geography.county_data(t.county_names_raw, t.county_housing_raw).selectExpr(
        "county_fips",
        "CASE WHEN county_fips % 4 <> 1 THEN county_name END AS county_name",
        "CASE WHEN county_fips % 3 <> 0 THEN population END AS population",
        "CASE WHEN county_fips % 5 <> 2 THEN double(housing_units) / 2 END AS half_units",
    )
    return numbers.fill_missing(table)


# -- filters -----------------------------------------------------------------


def _filtered(t: Inputs, condition: str) -> DataFrame:
    return (
        _enriched(t)
        .where(condition)
        .select("block_code", "county_fips", "gl_pop", "max_down", "max_up")
    )


@query("flt_populated")
def _(t: Inputs) -> DataFrame:
    joined = ops.filings_with_denominators(
        _filings(t), t.block_pop_raw, _denominators(t)
    )
    return joined.where(ops.POPULATED).select(
        keys.block_text(F.col("block_code")).alias("block_code"),
        "county_fips",
        "gl_pop",
        "max_down",
        "max_up",
    )


@query("flt_access")
def _(t: Inputs) -> DataFrame:
    return _filtered(t, ops.ACCESS)


@query("flt_no_access")
def _(t: Inputs) -> DataFrame:
    return _filtered(t, ops.LACK)


@query("flt_speed")
def _(t: Inputs) -> DataFrame:
    return _filtered(t, ops.FAST_DOWN)


@query("flt_speed_up")
def _(t: Inputs) -> DataFrame:
    return _filtered(t, ops.FAST_UP)


@query("flt_class")
def _(t: Inputs) -> DataFrame:
    return (
        _enriched(t)
        .where(ops.EITHER)
        .select(
            "block_code", "county_fips", "gl_pop", "max_down", "max_up", "consumer", "business"
        )
    )


# -- block tables ------------------------------------------------------------


def _covered_blocks(t: Inputs) -> DataFrame:
    found = blocks.populated_blocks(blocks.block_speeds(_filings(t)), t.block_pop_raw)
    return _with_shares(t, found)


def _with_shares(t: Inputs, found: DataFrame) -> DataFrame:
    known = found.drop("state_fips").join(_denominators(t), "county_fips")
    return known.selectExpr("*", *ops.shares_of_block()).withColumn(
        "block_code", keys.block_text(F.col("block_code"))
    )


SHARES = ("pct_of_county", "pct_of_state", "pct_of_nation")


@query("blk_pct")
def _(t: Inputs) -> DataFrame:
    return _covered_blocks(t).select("block_code", *SHARES)


@query("blk_population")
def _(t: Inputs) -> DataFrame:
    return geography.block_population(t.block_pop_raw).withColumn(
        "block_code", keys.block_text(F.col("block_code"))
    )


def _top_blocks(t: Inputs, direction: Direction) -> DataFrame:
    return _with_shares(t, tiers.tiered_blocks(_filings(t), t.block_pop_raw, direction))


# Tiers besides the published ones: with and without one for exactly a speed, and
# with speeds below the first.
OTHER_EDGES = {
    DIRECTIONS[0]: (("none", 0), ("some", 0), ("ten", 10), ("exactly 24.5", 24.5), ("more", 24.5), ("hundred", 100)),
    DIRECTIONS[1]: (("one", 1), ("three", 3), ("twenty", 20)),
}


def _register_directions() -> None:
    for direction in DIRECTIONS:
        code = direction.code

        @query(f"blk_top_{code}")
        def _(t: Inputs, d: Direction = direction) -> DataFrame:
            return _top_blocks(t, d).select(
                "block_code", "county_fips", "state_fips", "gl_pop", d.top_speed
            )

        @query(f"blk_top_filings_{code}")
        def _(t: Inputs, d: Direction = direction) -> DataFrame:
            return blocks.filings_at_top(_enriched(t), d.speed).select(
                "block_code", "county_fips", "hoco_num", "gl_pop", "max_down", "max_up"
            )

        @query(f"tier_share_{code}_other_edges")
        def _(t: Inputs, d: Direction = direction) -> DataFrame:
            return tiers.speed_tier_share(
                _filings(t), t.block_pop_raw, _denominators(t), d, OTHER_EDGES[d]
            )

        @query(f"tier_blocks_{code}")
        def _(t: Inputs, d: Direction = direction) -> DataFrame:
            tier = F.col(d.tier).alias("tier")
            return _top_blocks(t, d).select("block_code", tier, *SHARES)

        for level in LEVELS:

            @query(f"tier_share_{code}_{level.name if level.key else 'national'}")
            def _(t: Inputs, d: Direction = direction, at: Level = level) -> DataFrame:
                return tiers.tier_share(
                    _filings(t), t.block_pop_raw, _denominators(t), d, at
                )

        @query(f"tier_share_{code}_whole_speeds")
        def _(t: Inputs, d: Direction = direction) -> DataFrame:
            return tiers.tier_share(
                _filings(t, truncate_speeds=True),
                t.block_pop_raw,
                _denominators(t),
                d,
                COUNTY,
            )


_register_directions()


# -- joins -------------------------------------------------------------------


@query("jn_outer_indicator")
def _(t: Inputs) -> DataFrame:
    joined = ops.with_provenance(_filings(t), t.block_pop_raw, "block_code")
    return joined.groupBy("provenance").agg(F.count("*").alias("n"))


@query("jn_county_data")
def _(t: Inputs) -> DataFrame:
    return geography.county_data(t.county_names_raw, t.county_housing_raw).select(
        keys.zero_pad(F.col("county_fips"), 5).alias("county_fips"),
        keys.zero_pad(F.col("state_fips"), 2).alias("state_fips"),
        "county_name",
        "population",
        "housing_units",
    )


@query("jn_county_state_pop")
def _(t: Inputs) -> DataFrame:
    return _denominators(t).select(
        "county_fips", "state_fips", "county_pop", "state_pop"
    )


@query("jn_block_denominators")
def _(t: Inputs) -> DataFrame:
    return ops.filings_with_denominators(
        _filings(t), t.block_pop_raw, _denominators(t)
    ).select(
        keys.block_text(F.col("block_code")).alias("block_code"),
        "hoco_num",
        "county_fips",
        "state_fips",
        "gl_pop",
        "county_pop",
        "state_pop",
    )


@query("jn_national")
def _(t: Inputs) -> DataFrame:
    counties = geography.counties(t.county_pop_raw)
    nation = geography.national_population(t.county_pop_raw)
    return geography.with_merge_level(
        enrichment.attach_single_row(counties, nation, "nation")
    ).select("county_fips", "merge_level", "nation.national_pop")


# -- population totals -------------------------------------------------------


@query("agg_state_pop")
def _(t: Inputs) -> DataFrame:
    return geography.state_populations(t.county_pop_raw)


@query("agg_national_pop")
def _(t: Inputs) -> DataFrame:
    return geography.national_population(t.county_pop_raw)


# -- population shares -------------------------------------------------------


def _access(t: Inputs, level: Level, mode: str = AS_WRITTEN) -> DataFrame:
    return shares.access_share(
        _filings(t), t.block_pop_raw, _denominators(t), level, mode
    )


@query("shr_access_county")
def _(t: Inputs) -> DataFrame:
    return _access(t, COUNTY)


@query("shr_access_state")
def _(t: Inputs) -> DataFrame:
    return _access(t, STATE)


@query("shr_access_national")
def _(t: Inputs) -> DataFrame:
    return _access(t, NATION)


@query("shr_access_county_intended")
def _(t: Inputs) -> DataFrame:
    return _access(t, COUNTY, INTENDED)


def _speed_share(t: Inputs, flag: str, mode: str) -> DataFrame:
    return shares.speed_share(
        _filings(t), t.block_pop_raw, _denominators(t), flag, mode
    )


@query("shr_down_as_written")
def _(t: Inputs) -> DataFrame:
    return _speed_share(t, "any_down", AS_WRITTEN)


@query("shr_down_intended")
def _(t: Inputs) -> DataFrame:
    return _speed_share(t, "any_down", INTENDED)


@query("shr_up_as_written")
def _(t: Inputs) -> DataFrame:
    return _speed_share(t, "any_up", AS_WRITTEN)


@query("shr_up_intended")
def _(t: Inputs) -> DataFrame:
    return _speed_share(t, "any_up", INTENDED)


@query("shr_grouping_sets")
def _(t: Inputs) -> DataFrame:
    return shares.all_shares(_filings(t), t.block_pop_raw, _denominators(t))


# -- set operations ----------------------------------------------------------


@query("set_union_access")
def _(t: Inputs) -> DataFrame:
    keyed = ["state_fips", "county_fips", "block_code"]
    with_access = _covered_blocks(t).where("any_access").select(*keyed, *SHARES)
    without = (
        _enriched(t)
        .where(ops.LACK)
        .select(*keyed, *[F.lit(0.0).alias(s) for s in SHARES], "max_down", "max_up")
    )
    return with_access.unionByName(without, allowMissingColumns=True)


@query("set_distinct_blocks")
def _(t: Inputs) -> DataFrame:
    # The shares depend on the block alone, so distinct block codes are enough
    # and nothing but them is shuffled.
    found = _filings(t).where(ops.ACCESS).select("block_code", "county_fips").distinct()
    return _with_shares(t, blocks.populated_blocks(found, t.block_pop_raw)).select(
        "state_fips", "county_fips", "block_code", *SHARES
    )


@query("set_county_keys")
def _(t: Inputs) -> DataFrame:
    served = blocks.top_speed(_filings(t), "max_down", "top_down")
    populated = blocks.populated_blocks(served, t.block_pop_raw)
    counties = populated.select("county_fips").distinct()
    return counties.join(_denominators(t), "county_fips").select(
        "state_fips", "county_pop", "county_fips"
    )


# -- providers ---------------------------------------------------------------


@query("prov_count_block")
def _(t: Inputs) -> DataFrame:
    return blocks.block_providers(_filings(t)).withColumn(
        "block_code", keys.block_text(F.col("block_code"))
    )


@query("prov_blocks")
def _(t: Inputs) -> DataFrame:
    counted = providers.counted_blocks(_filings(t), t.block_pop_raw)
    counts = [F.coalesce(k.column, F.lit(0)).alias(k.column) for k in CLASSES]
    buckets = [k.bucket for k in CLASSES]
    return _with_shares(t, counted).select("block_code", *counts, *buckets, *SHARES)


def _bucket_sums(t: Inputs) -> DataFrame:
    return providers.county_bucket_sums(
        _filings(t), t.block_pop_raw, _denominators(t)
    )


def _register_levels() -> None:
    for level in LEVELS:
        label = level.name if level.key else "national"

        @query(f"prov_count_{label}")
        def _(t: Inputs, at: Level = level) -> DataFrame:
            found = providers.county_providers(_filings(t))
            return providers.provider_counts(found, at)

        @query(f"prov_share_{label}")
        def _(t: Inputs, at: Level = level) -> DataFrame:
            return providers.bucket_share(_bucket_sums(t), at)

        @query(f"prov_cumulative_{label}")
        def _(t: Inputs, at: Level = level) -> DataFrame:
            rows = providers.class_rows(_bucket_sums(t))
            key = [F.col("geo_id").alias(at.key)] if at.key else []
            return (
                rows.where(F.col("level") == at.name)
                .select(*key, "class", F.posexplode("cumulative").alias("bucket", "share"))
            )


_register_levels()


@query("prov_share_all_classes")
def _(t: Inputs) -> DataFrame:
    return providers.bucket_share_rows(_bucket_sums(t))


@query("prov_median_as_written")
def _(t: Inputs) -> DataFrame:
    return providers.median_rows(_bucket_sums(t), AS_WRITTEN)


@query("prov_median_intended")
def _(t: Inputs) -> DataFrame:
    return providers.median_rows(_bucket_sums(t), INTENDED)


QUANTILES = (25, 50, 75)


@query("prov_quantiles_as_written")
def _(t: Inputs) -> DataFrame:
    return providers.quantile_rows(_bucket_sums(t), QUANTILES, AS_WRITTEN)


@query("prov_quantiles_intended")
def _(t: Inputs) -> DataFrame:
    return providers.quantile_rows(_bucket_sums(t), QUANTILES, INTENDED)


@query("opt_provider_sketches")
def _(t: Inputs) -> DataFrame:
    """Sketches of half of the filings kept and the other half added, beside the
    exact counts: three standard errors apart at most."""
    filings = _filings(t)
    kept = sketches.block_sketches(filings.where("hoco_num % 2 = 0"))
    found = sketches.provider_estimates(sketches.add_filings(kept, filings.where("hoco_num % 2 <> 0")))
    exact = providers.provider_counts_all(providers.county_providers(filings)).select(
        "level", "geo_id", F.inline(F.array(*[F.struct(F.lit(k.code).alias("class"), F.col(k.code).alias("n")) for k in CLASSES]))
    )
    error = 3 * 1.04 / 2 ** (sketches.BITS / 2)
    return exact.join(found, ["level", "geo_id", "class"]).select(
        "level", "geo_id", "class", "n", (F.abs(F.col("providers") - F.col("n")) <= F.col("n") * error).alias("close")
    )


# -- the county report -------------------------------------------------------


@query("rpt_access")
def _(t: Inputs) -> DataFrame:
    return _report(t).access().drop(
        *[f"pctpopwoBBacc_{level.access_suffix}" for level in LEVELS]
    )


@query("rpt_access_intended")
def _(t: Inputs) -> DataFrame:
    return _report(t, INTENDED).access()


@query("rpt_without_access")
def _(t: Inputs) -> DataFrame:
    suffixes = [level.access_suffix for level in LEVELS]
    return _report(t).access().select(
        "county_fips",
        *[f"pctpopwBBacc_{s}" for s in suffixes],
        *[f"pctpopwoBBacc_{s}" for s in suffixes],
    )


@query("rpt_tiers")
def _(t: Inputs) -> DataFrame:
    shares_of_tiers = [
        tier_column(d, i, level) for d in DIRECTIONS for level in LEVELS for i in TIERS
    ]
    table = _report(t).tiers()
    return table.select("county_fips", "state_fips", "county_name", *shares_of_tiers)


def _common_tiers(t: Inputs, mode: str) -> DataFrame:
    names = [
        f"mc{d.letter.lower()}s_{what}_{level.tier_suffix}"
        for d in DIRECTIONS
        for level in LEVELS
        for what in ("prop", "tier")
    ]
    return _report(t, mode).tiers().select("county_fips", *names)


@query("tier_most_common")
def _(t: Inputs) -> DataFrame:
    return _common_tiers(t, AS_WRITTEN)


@query("tier_most_common_intended")
def _(t: Inputs) -> DataFrame:
    return _common_tiers(t, INTENDED)


@query("tier_totals")
def _(t: Inputs) -> DataFrame:
    return _report(t).fast_tiers().select("county_fips", "totalDSPCT", "totalUSPCT")


@query("tier_at_least")
def _(t: Inputs) -> DataFrame:
    return _report(t).fast_tiers().drop("totalDSPCT", "totalUSPCT")


@query("prov_median_lower_bound")
def _(t: Inputs) -> DataFrame:
    return _report(t).county_rows().select("county_fips", "lb")


@query("rpt_provider_counts")
def _(t: Inputs) -> DataFrame:
    return _report(t).provider_counts()


@query("rpt_provider_shares")
def _(t: Inputs) -> DataFrame:
    return _report(t).provider_shares()


@query("rpt_final")
def _(t: Inputs) -> DataFrame:
    return _report(t).final()


@query("rpt_final_intended")
def _(t: Inputs) -> DataFrame:
    return _report(t, INTENDED).final()


# -- optional enrichment -----------------------------------------------------


def _access_rows(t: Inputs) -> DataFrame:
    table = _report(t).access().select(
        "county_fips", "state_fips", "pctpopwBBacc_county", "pctpopwoBBacc_county"
    )
    return geography.with_merge_level(table)


@query("opt_left_enrich")
def _(t: Inputs) -> DataFrame:
    return enrichment.left_enrich(
        _access_rows(t),
        t.adoption_county_raw,
        t.adoption_state_raw,
        t.adoption_national_raw,
    )


@query("opt_progress_enrich")
def _(t: Inputs) -> DataFrame:
    return enrichment.left_enrich(
        _access_rows(t),
        t.progress_county_raw,
        t.progress_state_raw,
        t.progress_national_raw,
    )


@query("opt_any_negative")
def _(t: Inputs) -> DataFrame:
    return enrichment.flag_any_negative(
        _access_rows(t), "pctpopwoBBacc_county", "less_than_zero"
    ).select("county_fips", "less_than_zero")


@query("opt_total_pct")
def _(t: Inputs) -> DataFrame:
    total = F.col("pctpopwoBBacc_county") + F.col("pctpopwBBacc_county")
    return _access_rows(t).select("county_fips", total.alias("totalpct"))


def _income_file(t: Inputs, table: DataFrame, label: str) -> str:
    """The table as CSV text behind title lines and a header, with the files' own
    names, a column more, and thousands separators."""
    path = scratch_path(t.spark, label)
    own = {
        ours: theirs
        for names in (
            schemas.INCOME_STATE_KEY, schemas.INCOME_COUNTY_KEY,
            schemas.INCOME_NATION_KEY, schemas.INCOME_AMOUNTS,
        )
        for theirs, ours in names.items()
    }
    header = ",".join(f'"{own.get(c, c)}"' for c in table.columns)
    amounts = [
        F.concat(F.lit('"'), F.format_number(c, 0), F.lit('"'))
        if c in schemas.INCOME_AMOUNTS.values()
        else F.col(c)
        for c in table.columns
    ]
    preamble = t.spark.createDataFrame(
        [("Income and poverty estimates",), ("",), (header,)], "value STRING"
    )
    preamble.union(table.select(F.concat_ws(",", *amounts))).write.text(path)
    return path


def _county_income(t: Inputs) -> DataFrame:
    rows = t.income_county_raw.select(
        "state_code",
        "county_code",
        F.lit("XX").alias("Postal Code"),
        F.lit("A name").alias("Name"),
        "poverty",
        "median_income",
    )
    return readers.read_county_income(t.spark, _income_file(t, rows, "income-county"))


@query("opt_income_source")
def _(t: Inputs) -> DataFrame:
    return _county_income(t)


def _state_income(t: Inputs) -> DataFrame:
    rows = t.income_state_raw.select(
        "state_code", F.lit("XX").alias("Postal Code"), "poverty", "median_income"
    )
    return readers.read_state_income(t.spark, _income_file(t, rows, "income-state"))


def _national_income(t: Inputs) -> DataFrame:
    return readers.read_national_income(
        t.spark, _income_file(t, t.income_national_raw, "income-nation")
    )


@query("opt_income_join")
def _(t: Inputs) -> DataFrame:
    return enrichment.with_income(
        _access_rows(t), _county_income(t), _state_income(t), _national_income(t)
    )


def _extended(t: Inputs, mode: str) -> DataFrame:
    def levels(name: str) -> LevelTables:
        return LevelTables(*[getattr(t, f"{name}_{place}_raw") for place in ("county", "state", "national")])

    income = LevelTables(_county_income(t), _state_income(t), _national_income(t))
    return _report(
        t, mode, adoption=levels("adoption"), progress=levels("progress"), income=income
    ).extended()


@query("rpt_extended")
def _(t: Inputs) -> DataFrame:
    return _extended(t, AS_WRITTEN)


@query("rpt_extended_intended")
def _(t: Inputs) -> DataFrame:
    return _extended(t, INTENDED)


def _county_pop_from_blocks(t: Inputs, mode: str) -> DataFrame:
    summed = geography.county_pop_from_blocks(_filings(t), t.block_pop_raw, mode)
    named = geography.county_data(t.county_names_raw, t.county_housing_raw)
    return named.join(summed, "county_fips").select(
        "county_fips", "county_name", "population", "gl_pop"
    )


@query("opt_county_pop_from_blocks")
def _(t: Inputs) -> DataFrame:
    return _county_pop_from_blocks(t, AS_WRITTEN)


@query("opt_county_pop_from_blocks_intended")
def _(t: Inputs) -> DataFrame:
    return _county_pop_from_blocks(t, INTENDED)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Inputs(spark, sf_dir))

    return {name: bind(build) for name, build in QUERIES.items()}
