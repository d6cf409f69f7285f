"""Commune reference data: EPCI membership and canton membership."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusloom.config import DISTRICT_EPCIS
from censusloom.functions import unique

_RECORD = "code string, nom string, codeEpci string, codeDepartement string, population bigint"


def read_commune_records(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Commune records of a JSON array, or of one JSON object per line, with a fixed schema.

    An array is read by one task per file; lines are split like any text.
    """
    return spark.read.schema(_RECORD).option("multiLine", not lines).json(path)


def district_rows(spark: SparkSession) -> DataFrame:
    """City districts, which the commune reference does not list, with their EPCI."""
    rows = [
        (str(first + i), epci, f"District {first + i}", str(first + i)[:2], 0)
        for first, count, epci in DISTRICT_EPCIS
        for i in range(count)
    ]
    return spark.createDataFrame(
        rows,
        "commune_code string, epci_code string, commune_name string, department_code string, commune_population bigint",
    )


def commune_lookup(records: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Commune -> EPCI. Communes outside any EPCI are left out; ``extra`` rows are added.

    A commune that occurs twice would multiply its persons: it stops the run, when the lookup is read.
    """
    lookup = records.where(F.col("codeEpci").isNotNull()).select(
        F.col("code").alias("commune_code"),
        F.col("codeEpci").alias("epci_code"),
        F.col("nom").alias("commune_name"),
        F.col("codeDepartement").alias("department_code"),
        F.coalesce(F.col("population").cast("bigint"), F.lit(0)).alias("commune_population"),
    )
    rows = lookup if extra is None else lookup.unionByName(extra)
    return unique(rows, ["commune_code"], "commune lookup")


def read_cog(spark: SparkSession, path: str) -> DataFrame:
    """Commune reference CSV: commune, department and canton codes, kept as strings."""
    return (
        spark.read.option("header", True)
        .csv(path)
        .select(
            F.col("COM").alias("commune_code"),
            F.col("DEP").alias("department_code"),
            F.col("CAN").alias("canton_code"),
        )
    )
