"""Outside figures the estimates are tied to or compared with."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusloom.functions import decode_sex


def estimates_long(wide: DataFrame) -> DataFrame:
    """National estimates (year, naissance, male, female) -> one row per sex.

    Title, blank and note lines have no number in one of the cells and drop out
    whole. A birth year must be written as an integer.
    """
    typed = wide.select(
        F.col("year").cast("int").alias("year"),
        F.col("naissance").try_cast("int").alias("naissance"),
        F.col("male").try_cast("double").alias("male"),
        F.col("female").try_cast("double").alias("female"),
    ).where(F.col("naissance").isNotNull() & F.col("male").isNotNull() & F.col("female").isNotNull())
    return typed.unpivot(["year", "naissance"], ["male", "female"], "sex", "population")


def read_semicolon(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """A published CSV file: semicolons, a header line, every cell a string."""
    return spark.read.option("header", True).option("sep", ";").option("encoding", encoding).option("ignoreLeadingWhiteSpace", False).csv(path)


def read_pyramid_csv(raw: DataFrame, year: int) -> DataFrame:
    """Semicolon pyramid (Année;Âge;Sexe;Pop) of one year.

    Males are published as negative numbers for display. Headers may carry blanks.
    """
    df = raw.toDF(*[c.strip() for c in raw.columns])
    return (
        df.where(F.col("Année").try_cast("double") == year)
        .select(
            F.col("Âge").try_cast("double").cast("int").alias("age"),
            decode_sex(F.col("Sexe")).alias("sex"),
            F.abs(F.col("Pop").try_cast("double")).alias("population"),
        )
        .dropna()
        .where(F.col("population") > 0)
    )


def read_reference_pyramid(
    spark: SparkSession, paths: str | list[str], region_pattern: str = r"([^/]+)/[^/]+$"
) -> DataFrame:
    """Official regional pyramids, one CSV per region, in a single scan.

    The region code is the folder a file lies in.
    """
    raw = spark.read.option("header", True).csv(paths)
    return reference_pyramid(
        raw.withColumn("region_code", F.regexp_extract(F.col("_metadata.file_path"), region_pattern, 1))
    )


def reference_pyramid(raw: DataFrame) -> DataFrame:
    """Typed (year, region_code, age, sex, pop) from ANNEE, AGE, SEXE ('M'/'F'), POP."""
    return raw.select(
        F.col("ANNEE").cast("int").alias("year"),
        "region_code",
        F.col("AGE").cast("int").alias("age"),
        F.when(F.col("SEXE") == "M", F.lit("male")).when(F.col("SEXE") == "F", F.lit("female")).alias("sex"),
        F.col("POP").cast("double").alias("pop"),
    )


def academic_year(year: int) -> str:
    """2022 -> '2022-23'."""
    return f"{year}-{(year + 1) % 100:02d}"


def read_enrolment(df: DataFrame, year: int, groups: Iterable[str] | None = None) -> DataFrame:
    """Enrolled students per commune in one academic year, optionally of some course groups."""
    rows = df.where(
        (F.col("annee_universitaire") == academic_year(year)) & F.col("com_id").isNotNull() & (F.col("com_id") != "")
    )
    if groups is not None:
        rows = rows.where(F.col("regroupement").isin(list(groups)))
    return rows.groupBy("com_id").agg(F.sum(F.col("effectif").cast("bigint")).alias("enrolled"))


# Course groups counted as bachelor and master study.
DEGREE_GROUPS = ("UNIV", "GE", "INP", "UT", "ENS")
