"""Column contracts of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censusloom.config import LEVELS

CENSUS_COLUMNS = ("IRIS", "DEPT", "REGION", "CANTVILLE", "ANAI", "SEXE", "IPONDI")
FLOW_COLUMNS = ("COMMUNE", "DCETUF", "AGEREV10", "SEXE", "IPONDI")
BIRTH_COLUMNS = ("DEPT", "REGION", "MNAI", "IPONDI")

BASE = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("department_code", T.StringType()),
        T.StructField("region_code", T.StringType()),
        T.StructField("canton_code", T.StringType()),
        T.StructField("commune_code", T.StringType()),
        T.StructField("iris_code", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("sex", T.StringType()),
        T.StructField("population", T.DoubleType()),
    ]
)

# Geography columns of each published level, coarse to fine.
LEVEL_GEO = {
    "department": ("department_code", "region_code"),
    "epci": ("department_code", "region_code", "epci_code"),
    "canton": ("department_code", "region_code", "canton_code"),
    "iris": ("department_code", "region_code", "epci_code", "commune_code", "iris_code"),
}
# The column that identifies an area of the level.
LEVEL_CODE = {"department": "department_code", "epci": "epci_code", "canton": "canton_code", "iris": "iris_code"}

_MEANING = {
    "year": (T.IntegerType(), "Projected year"),
    "month": (T.IntegerType(), "Month of the snapshot; 1 in a yearly build"),
    "birth_month": (T.IntegerType(), "Month of birth the row is apportioned to"),
    "snapshot_month": (T.DateType(), "First day of the snapshot month"),
    "born_date": (T.DateType(), "First day of the birth month"),
    "decimal_age": (T.DoubleType(), "Years between born_date and snapshot_month"),
    "department_code": (T.StringType(), "Department"),
    "region_code": (T.StringType(), "Region"),
    "epci_code": (T.StringType(), "Inter-communal authority"),
    "canton_code": (T.StringType(), "Canton"),
    "commune_code": (T.StringType(), "Commune"),
    "iris_code": (T.StringType(), "Infra-communal area"),
    "age": (T.IntegerType(), "Projected year minus birth year"),
    "sex": (T.StringType(), "male or female"),
    "geo_precision": (T.StringType(), "How the area was assigned"),
    "population": (T.DoubleType(), "Estimated persons"),
    "confidence_pct": (T.DoubleType(), "Half-width of the interval, as a fraction"),
    "population_low": (T.DoubleType(), "Lower bound"),
    "population_high": (T.DoubleType(), "Upper bound"),
}


def output_schema(level: str) -> T.StructType:
    """The published column order, types and meaning of one level."""
    check_level(level)
    names = (
        ["year", "month", "birth_month", "snapshot_month", "born_date", "decimal_age"]
        + list(LEVEL_GEO[level])
        + ["age", "sex", "geo_precision", "population", "confidence_pct", "population_low", "population_high"]
    )
    return T.StructType([T.StructField(n, _MEANING[n][0], True, {"comment": _MEANING[n][1]}) for n in names])


def conform(df: DataFrame, level: str) -> DataFrame:
    """Select and cast a level to its published contract; a missing column is an error."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in output_schema(level)]
    )


def check_level(level: str) -> None:
    if level not in LEVELS:
        raise ValueError(f"Unknown level {level!r}; expected one of {LEVELS}")
