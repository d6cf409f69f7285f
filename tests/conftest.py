from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("censusloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no test tables under {SF_DIR}")
    return SF_DIR


BASE = (
    "year int, department_code string, region_code string, canton_code string, commune_code string, "
    "iris_code string, age int, sex string, population double"
)
LOOKUP = (
    "commune_code string, epci_code string, commune_name string, department_code string, commune_population bigint"
)


@pytest.fixture(scope="session")
def make(spark):
    """Small frames of the tables' shapes."""

    class Make:
        def base(self, rows):
            return spark.createDataFrame(rows, BASE)

        def cells(self, rows):
            """(department, age, sex, population) as cells of one commune per department."""
            return self.base(
                [(2022, d, "11", f"{d}99", f"{d}101", f"{d}1010101", a, s, float(p)) for d, a, s, p in rows]
            )

        def lookup(self, pairs):
            return spark.createDataFrame([(c, e, f"Commune {c}", c[:2], 100) for c, e in pairs], LOOKUP)

        def births(self, departments):
            return spark.createDataFrame(
                [(d, m, 1 / 12) for d in departments for m in range(1, 13)],
                "department_code string, month int, month_ratio double",
            )

        def frame(self, rows, schema):
            return spark.createDataFrame(rows, schema)

    return Make()


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def as_dict(df, keys, value):
    keys = [keys] if isinstance(keys, str) else keys
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r[value] for r in df.collect()}
