"""CSV readers. A path may be a file, a folder or a glob."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructField, StructType

from covshare.functions.keys import compose_county
from covshare.sources import schemas
from covshare.sources.headers import header_groups


def read_table(
    spark: SparkSession,
    path: str,
    schema: str,
    names: dict[str, str] | None = None,
    delimiter: str = ",",
    encoding: str = schemas.UNICODE,
) -> DataFrame:
    """A CSV with a header line; its columns are found by name.

    Those that ``schema`` names are typed, renamed and come first; whatever else
    the file has is carried along as text under the names of
    :meth:`~covshare.sources.headers.Group.names`. The files of a folder may have
    other orders and other further columns, which are null where a file lacks
    them; a name of ``schema`` that a file lacks is an error.
    """
    declared = {field.name: field for field in StructType.fromDDL(schema)}
    found = None
    for group in header_groups(spark, path, delimiter, encoding):
        missing = [name for name in declared if name not in group.header]
        if missing:
            raise ValueError(f"{group.files[0]} has no column {', '.join(missing)}")
        columns = group.names(declared)
        in_file_order = StructType([declared.get(c, StructField(c, StringType())) for c in columns])
        table = spark.read.csv(
            group.files, schema=in_file_order, header=True, enforceSchema=True,
            sep=delimiter, encoding=encoding, mode="FAILFAST",
        )
        carried = [c for c in columns if c not in declared]
        table = table.select(*[F.col(f"`{c}`") for c in (*declared, *carried)])
        found = table if found is None else found.unionByName(table, allowMissingColumns=True)
    return found.withColumnsRenamed(names or {})


def read_by_position(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV whose header line is replaced by ``schema``."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=True, mode="FAILFAST")


def read_block_population(spark: SparkSession, path: str) -> DataFrame:
    return read_table(
        spark, path, schemas.BLOCK_POPULATION, schemas.BLOCK_POPULATION_NAMES
    )


def read_deployment(spark: SparkSession, path: str) -> DataFrame:
    """All provider filings; select what is needed and the scan reads no more."""
    return read_table(
        spark,
        path,
        schemas.DEPLOYMENT,
        schemas.DEPLOYMENT_NAMES,
        encoding=schemas.WESTERN,
    )


def read_county_housing(spark: SparkSession, path: str) -> DataFrame:
    """The one file whose own column names are not used."""
    return read_by_position(spark, path, schemas.COUNTY_HOUSING)


def read_county_population(spark: SparkSession, path: str) -> DataFrame:
    return read_table(
        spark, path, schemas.COUNTY_POPULATION, schemas.COUNTY_POPULATION_NAMES
    )


def read_county_names(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.COUNTY_NAMES, schemas.COUNTY_NAMES_NAMES)


def read_payload(
    spark: SparkSession, path: str, key: str, own_key: str | None = None
) -> DataFrame:
    """A table under whatever names its header gives, by one key.

    ``own_key`` is what the file calls the key. Without it the key is text,
    as the national one is. Columns that hold numbers only are numbers, others
    stay text. These tables have a row per county at most, so looking at all
    values first costs little.
    """
    read, numbers, text = [], set(), set()
    for group in header_groups(spark, path, ",", schemas.WESTERN):
        columns = group.names([own_key or key])
        options = {"header": True, "encoding": schemas.WESTERN}
        in_file_order = StructType([StructField(c, StringType()) for c in columns])
        read.append(spark.read.csv(group.files, schema=in_file_order, enforceSchema=True, **options))
        looked_at = spark.read.csv(group.files, inferSchema=True, **options).schema
        for name, field in zip(columns, looked_at, strict=True):
            (numbers if isinstance(field.dataType, NumericType) else text).add(name)
    table = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), read)
    found = F.col(f"`{own_key or key}`")
    payload = [c for c in table.columns if c != (own_key or key)]
    return table.select(
        found.cast("bigint").alias(key) if own_key else found,
        *[F.col(f"`{c}`").cast("double" if c in numbers - text else "string").alias(c) for c in payload],
    )


def _after_preamble(
    spark: SparkSession, path: str, names: dict[str, str], is_data_row
) -> DataFrame:
    """The named columns of a CSV with title lines before its header, as text.

    The header is the line that holds all names. Titles and header are told from
    data by content, not by line number: a splittable scan has no line numbers.
    """
    text = spark.read.text(path)
    for name in names:
        text = text.where(F.col("value").contains(name))
    line = text.first()
    if line is None:
        raise ValueError(f"{path} has no header with {', '.join(names)}")
    header = next(csv.reader([line.value]))
    schema = ", ".join(f"c{i} STRING" for i in range(len(header)))
    rows = spark.read.csv(path, schema=schema, header=False)
    return rows.select(
        *[F.trim(f"c{header.index(name)}").alias(ours) for name, ours in names.items()]
    ).where(is_data_row)


def _amount(name: str):
    """A number with thousands separators; the mark for a missing one is null, any
    other text an error."""
    return F.when(F.col(name) != schemas.MISSING_AMOUNT, F.regexp_replace(name, ",", "").cast("bigint"))


def read_county_income(spark: SparkSession, path: str) -> DataFrame:
    rows = _after_preamble(
        spark,
        path,
        schemas.INCOME_STATE_KEY | schemas.INCOME_COUNTY_KEY | schemas.INCOME_AMOUNTS,
        F.col("state_code").rlike("^[0-9]+$") & F.col("county_code").rlike("^[0-9]+$"),
    )
    county = compose_county(F.col("state_code"), F.col("county_code"))
    return rows.select(
        county.cast("int").alias("county_fips"),
        _amount("poverty").alias("poverty_allages_c"),
        _amount("median_income").alias("medianHHinc_c"),
    )


def read_state_income(spark: SparkSession, path: str) -> DataFrame:
    rows = _after_preamble(
        spark,
        path,
        schemas.INCOME_STATE_KEY | schemas.INCOME_AMOUNTS,
        F.col("state_code").rlike("^[0-9]+$"),
    )
    return rows.select(
        F.col("state_code").cast("int").alias("state_fips"),
        _amount("poverty").alias("poverty_allages_s"),
        _amount("median_income").alias("medianHHinc_s"),
    )


def read_national_income(spark: SparkSession, path: str) -> DataFrame:
    rows = _after_preamble(
        spark,
        path,
        schemas.INCOME_NATION_KEY | schemas.INCOME_AMOUNTS,
        F.col("poverty").rlike("^([0-9,]+|[.])$"),
    )
    return rows.select(
        "merge_level",
        _amount("poverty").alias("poverty_allages_n"),
        _amount("median_income").alias("medianHHinc_n"),
    )
