"""Schemas of the source files; nothing is ever inferred."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Header names of the source files and their types.
BLOCK_POPULATION = "block_fips BIGINT, pop2017 BIGINT, hu2016 BIGINT, hh2016 BIGINT"

DEPLOYMENT = (
    "LogRecNo BIGINT, Provider_Id BIGINT, FRN BIGINT, DBAName STRING, "
    "HocoNum BIGINT, StateAbbr STRING, BlockCode BIGINT, TechCode INT, "
    "Consumer INT, MaxAdDown DOUBLE, MaxAdUp DOUBLE, Business INT, "
    "MaxCIRDown DOUBLE, MaxCIRUp DOUBLE"
)

COUNTY_HOUSING = "county_fips BIGINT, population BIGINT, housing_units BIGINT"

COUNTY_POPULATION = "countyFIPS BIGINT, CountyPop BIGINT"

COUNTY_NAMES = "STATEFP INT, COUNTYFP INT"  # and whatever else the file has

# Columns of the income files, the amounts as text: they have separators.
INCOME_STATE_KEY = {"State FIPS Code": "state_code"}
INCOME_COUNTY_KEY = {"County FIPS Code": "county_code"}
INCOME_NATION_KEY = {"merge_level": "merge_level"}
INCOME_AMOUNTS = {
    "Poverty Estimate, All Ages": "poverty",
    "Median Household Income": "median_income",
}
MISSING_AMOUNT = "."

BLOCK_POPULATION_NAMES = {
    "block_fips": "block_code",
    "pop2017": "gl_pop",
    "hu2016": "gl_housing_units",
    "hh2016": "gl_households",
}

DEPLOYMENT_NAMES = {
    "BlockCode": "block_code",
    "HocoNum": "hoco_num",
    "DBAName": "dba_name",
    "Consumer": "consumer",
    "Business": "business",
    "MaxAdDown": "max_down",
    "MaxAdUp": "max_up",
}

COUNTY_POPULATION_NAMES = {"countyFIPS": "county_fips", "CountyPop": "county_pop"}

COUNTY_NAMES_NAMES = {"STATEFP": "state_fp", "COUNTYFP": "county_fp"}

# Column names of the published report that differ from ours.
REPORT_NAMES = {
    "county_fips": "countyFIPS",
    "state_fips": "stateFIPS",
    "county_pop": "CountyPop",
    "state_pop_covered": "StatePop",
    "population": "Population",
    "housing_units": "Housing_Units",
}

WESTERN = "ISO-8859-1"
UNICODE = "UTF-8"
# ----------------------------------------------------------------------------
