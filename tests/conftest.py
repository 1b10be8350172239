import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from check_oracle import local_session  # noqa: E402

from covshare.operators import geography  # noqa: E402
from covshare.operators.filings import prepare_filings  # noqa: E402
from covshare.plans.report import Sources  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class World:
    """Small hand-made source tables."""

    def __init__(self, spark, filings, populations, counties, names=None, rural=None):
        self.spark = spark
        self.deployment = spark.createDataFrame(
            [
                (block, hoco, f"Provider {hoco}", consumer, business, down, up)
                for block, hoco, consumer, business, down, up in filings
            ],
            "block_code BIGINT, hoco_num BIGINT, dba_name STRING, consumer INT, "
            "business INT, max_down DOUBLE, max_up DOUBLE",
        )
        self.block_pop = spark.createDataFrame(
            populations, "block_code BIGINT, gl_pop BIGINT"
        )
        self.county_pop = spark.createDataFrame(
            counties, "county_fips BIGINT, county_pop BIGINT"
        )
        known = names if names is not None else [c for c, _ in counties]
        self.county_names = spark.createDataFrame(
            [(c // 1000, c % 1000, f"County {c}") for c in known],
            "state_fp INT, county_fp INT, county_name STRING",
        )
        self.county_housing = spark.createDataFrame(
            [(c, p or 0, (p or 0) // 2) for c, p in counties],
            "county_fips BIGINT, population BIGINT, housing_units BIGINT",
        )
        rural = rural or ([], [], [])
        self.rural = [
            spark.createDataFrame(rural[0], "county_fips BIGINT, rural_c BIGINT"),
            spark.createDataFrame(rural[1], "state_fips BIGINT, rural_s BIGINT"),
            spark.createDataFrame(rural[2], "merge_level STRING, rural_n BIGINT"),
        ]

    def filings(self, truncate_speeds=False):
        return prepare_filings(self.deployment, truncate_speeds)

    def denominators(self):
        return geography.denominators(self.county_pop)

    def tables(self):
        return self.filings(), self.block_pop, self.denominators()

    def sources(self):
        return Sources(
            self.deployment,
            self.block_pop,
            self.county_pop,
            self.county_names,
            self.county_housing,
            *self.rural,
        )


@pytest.fixture(scope="session")
def world(spark):
    return lambda *args, **kwargs: World(spark, *args, **kwargs)


def block(county, number):
    return county * 10**10 + number


def by_key(frame, key, value):
    return {row[key]: row[value] for row in frame.collect()}
