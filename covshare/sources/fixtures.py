"""Source-shaped tables derived from the star-schema test data.

One SQL text per table serves both engines: in Spark the names in braces are
DataFrames, for the oracle they are the names of earlier CTEs or tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("lineitem", "orders", "customer", "supplier")

COUNTY_OF_BLOCK = "CAST(floor(block_code / 10000000000) AS BIGINT)"
STATE_OF_BLOCK = "CAST(floor(block_code / 10000000000000) AS BIGINT)"



def _moved(key: str, every: int, rest: int, by: int) -> str:
    """The key, but for some values one that no other table has: every row stays,
    and joins still have rows without a partner on both sides."""
    return f"CAST(CASE WHEN {key} % {every} = {rest} THEN {key} + {by} ELSE {key} END AS BIGINT)"


VIEWS = {
    "deployment_raw": """
SELECT CAST((c.c_nationkey + 1) * 10000000000000
          + (1 + 2 * (o.o_custkey % 10)) * 10000000000
          + l.l_orderkey
          + CASE WHEN o.o_orderkey % 13 = 5 THEN 5000000000 ELSE 0 END AS BIGINT) AS block_code,
       CAST(l.l_suppkey AS BIGINT) AS hoco_num,
       concat('Provider ', s.s_name, ' Holdings') AS dba_name,
       CASE WHEN l.l_returnflag = 'R' THEN 0 ELSE 1 END AS consumer,
       CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END AS business,
       CASE WHEN l.l_linenumber % 2 = 0
            THEN (l.l_quantity - 1) * (l.l_quantity - 1) * 0.5
            ELSE (l.l_quantity - 1) * 0.5 END AS max_down,
       round(l.l_discount * 100) * (1 + round(l.l_tax * 100)) * 0.25
         * (CASE WHEN l.l_linenumber = 1 THEN 64 ELSE 1 END) AS max_up
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey""",
    "block_pop_raw": """
SELECT CAST((c.c_nationkey + 1) * 10000000000000
          + (1 + 2 * (o.o_custkey % 10)) * 10000000000
          + o.o_orderkey
          + CASE WHEN o.o_orderkey % 17 = 4 THEN 7000000000 ELSE 0 END AS BIGINT) AS block_code,
       CAST(CASE WHEN o.o_orderkey % 11 = 3 THEN 0
                 ELSE floor(o.o_totalprice / 1000) END AS BIGINT) AS gl_pop,
       CAST(floor(o.o_totalprice / 2000) AS BIGINT) AS gl_housing_units,
       CAST(floor(o.o_totalprice / 2500) AS BIGINT) AS gl_households
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey""",
    "county_pop_raw": f"""
SELECT {COUNTY_OF_BLOCK} AS county_fips,
       CAST(sum(gl_pop) AS BIGINT) AS county_pop
FROM {{block_pop_raw}}
GROUP BY {COUNTY_OF_BLOCK}""",
    "county_housing_raw": """
SELECT CAST(CASE WHEN county_fips % 23 = 11 THEN county_fips + 500
                 ELSE county_fips END AS BIGINT) AS county_fips,
       county_pop AS population,
       CAST(floor(county_pop / 2) AS BIGINT) AS housing_units
FROM {county_pop_raw}""",
    "county_names_raw": """
SELECT CAST(floor(county_fips / 1000) AS INT) AS state_fp,
       CAST(county_fips % 1000
            + CASE WHEN county_fips % 19 = 7 THEN 600 ELSE 0 END AS INT) AS county_fp,
       concat('County ', CAST(county_fips AS VARCHAR(10))) AS county_name
FROM {county_pop_raw}""",
    "rural_county_raw": f"""
SELECT {_moved(COUNTY_OF_BLOCK, 5, 0, 700)} AS county_fips,
       CAST(sum(CASE WHEN block_code % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rural_blocks_c
FROM {{block_pop_raw}}
GROUP BY {_moved(COUNTY_OF_BLOCK, 5, 0, 700)}
UNION ALL SELECT CAST(99001 AS BIGINT), CAST(1 AS BIGINT)""",
    "rural_state_raw": f"""
SELECT {_moved(STATE_OF_BLOCK, 4, 0, 50)} AS state_fips,
       CAST(sum(CASE WHEN block_code % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rural_blocks_s
FROM {{block_pop_raw}}
GROUP BY {_moved(STATE_OF_BLOCK, 4, 0, 50)}
UNION ALL SELECT CAST(99 AS BIGINT), CAST(1 AS BIGINT)""",
    "rural_national_raw": """
SELECT 'national' AS merge_level,
       CAST(sum(CASE WHEN block_code % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rural_blocks_n
FROM {block_pop_raw}""",
    # Payload tables for the left-join enrichments: households stand for
    # adopting households, housing units for a progress measure.
    "adoption_county_raw": f"""
SELECT {_moved(COUNTY_OF_BLOCK, 7, 3, 700)} AS county_fips,
       CAST(sum(gl_households) AS BIGINT) AS adopting_c
FROM {{block_pop_raw}}
GROUP BY {_moved(COUNTY_OF_BLOCK, 7, 3, 700)}""",
    "adoption_state_raw": f"""
SELECT {_moved(STATE_OF_BLOCK, 6, 2, 50)} AS state_fips,
       CAST(sum(gl_households) AS BIGINT) AS adopting_s
FROM {{block_pop_raw}}
GROUP BY {_moved(STATE_OF_BLOCK, 6, 2, 50)}""",
    "adoption_national_raw": """
SELECT 'national' AS merge_level, CAST(sum(gl_households) AS BIGINT) AS adopting_n
FROM {block_pop_raw}""",
    "progress_county_raw": f"""
SELECT {_moved(COUNTY_OF_BLOCK, 9, 4, 700)} AS county_fips,
       CAST(sum(gl_housing_units) AS BIGINT) AS progress_c
FROM {{block_pop_raw}}
GROUP BY {_moved(COUNTY_OF_BLOCK, 9, 4, 700)}""",
    "progress_state_raw": f"""
SELECT {_moved(STATE_OF_BLOCK, 8, 5, 50)} AS state_fips,
       CAST(sum(gl_housing_units) AS BIGINT) AS progress_s
FROM {{block_pop_raw}}
GROUP BY {_moved(STATE_OF_BLOCK, 8, 5, 50)}""",
    "progress_national_raw": """
SELECT 'national' AS merge_level, CAST(sum(gl_housing_units) AS BIGINT) AS progress_n
FROM {block_pop_raw}""",
    "income_county_raw": """
SELECT CAST(floor(county_fips / 1000) AS INT) AS state_code,
       CAST(county_fips % 1000
            + CASE WHEN county_fips % 13 = 6 THEN 700 ELSE 0 END AS INT) AS county_code,
       CAST(floor(county_pop / 8) AS BIGINT) AS poverty,
       CAST(30000 + county_pop % 40000 AS BIGINT) AS median_income
FROM {county_pop_raw}""",
    "income_state_raw": """
SELECT CAST(floor(county_fips / 1000) AS INT) AS state_code,
       CAST(floor(sum(county_pop) / 8) AS BIGINT) AS poverty,
       CAST(30000 + sum(county_pop) % 40000 AS BIGINT) AS median_income
FROM {county_pop_raw} GROUP BY CAST(floor(county_fips / 1000) AS INT)""",
    "income_national_raw": """
SELECT 'national' AS merge_level,
       CAST(floor(sum(county_pop) / 8) AS BIGINT) AS poverty,
       CAST(30000 + sum(county_pop) % 40000 AS BIGINT) AS median_income
FROM {county_pop_raw}""",
}


class Inputs:
    """The derived tables of one test-data folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in BASE_TABLES and name not in VIEWS:
            raise AttributeError(name)
        if name not in self._tables:
            self._tables[name] = self._build(name)
        return self._tables[name]

    def _build(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self._sf_dir}/{name}.parquet")
        sql = VIEWS[name]
        sources = [t for t in (*BASE_TABLES, *VIEWS) if f"{{{t}}}" in sql]
        return self.spark.sql(sql, **{t: getattr(self, t) for t in sources})


def oracle_ctes() -> str:
    """All derived tables as CTEs, in an order that satisfies their references."""
    names = {t: t for t in (*BASE_TABLES, *VIEWS)}
    return ",\n".join(
        f"{name} AS ({sql.format(**names)}\n)" for name, sql in VIEWS.items()
    )
