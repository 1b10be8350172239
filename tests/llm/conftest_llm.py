"""Small documents with everything that may be odd about a table."""

import pytest

SCHEMA = (
    "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, id LONG, row STRING, "
    "spans STRING, maybe STRING, sha STRING, key STRING, size STRING, spread STRING, train STRING"
)
_BASE = " ".join(f"word{i % 37}x{i}" for i in range(90))


def table(spark, rows):
    """Documents with further columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", None, 7, *["z"] * 8) for i, t in rows], SCHEMA)


EDGE = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b"),
    (4, "Ab cd"),
    (5, "aB cd"),
    (5, "aB cd"),
    (None, _BASE + " more"),
    (6, _BASE),
    (7, _BASE + " more"),
    (8, "Über Straße " + _BASE[20:400] + " ñandú"),
    (9, "lang " * 30_000),
    (10, "x" * 5000),
    (11, "Ä" * 60 + "é" * 60),
    (12, "e" + "Ä" * 60 + "é" * 55),
]


@pytest.fixture(scope="session")
def edge(spark):
    return table(spark, EDGE).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return table(spark, []).repartition(1)
