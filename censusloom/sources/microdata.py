"""Scans of the three microdata files: census, birth months, school commuting."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusloom.config import COM_DEPARTMENTS, DOM_DEPARTMENTS, Config
from censusloom.functions import clean_code, union_all
from censusloom.schemas import BIRTH_COLUMNS, CENSUS_COLUMNS, FLOW_COLUMNS


def read_columns(spark: SparkSession, path: str | list[str], columns: Sequence[str], optional: Iterable[str] = ()) -> DataFrame:
    """Columns of one or several files (a year's file or folder each), by name, as strings.

    Files may differ in the order, case and types of their columns and in columns that are not asked for. An
    ``optional`` column that a file lacks is null there; any other one is an error that names file and column, before
    any row is read. Each file is scanned once, with its own pruned columns.
    """
    parts = []
    for one in [path] if isinstance(path, str) else list(path):
        df = spark.read.parquet(one)
        found: dict[str, list[str]] = {}
        for c in df.columns:
            found.setdefault(c.lower(), []).append(c)
        missing = [c for c in columns if c.lower() not in found and c not in set(optional)]
        if missing:
            raise ValueError(f"{one}: no column {', '.join(missing)}; it has {', '.join(df.columns)}")
        cells = []
        for c in columns:
            same = found.get(c.lower(), [])
            if len(same) > 1 and c not in same:
                raise ValueError(f"{one}: several columns {', '.join(same)} for {c}")
            cells.append((F.col(f"`{c if c in same else same[0]}`").cast("string") if same else F.lit(None).cast("string")).alias(c))
        parts.append(df.select(*cells))
    return union_all(parts)


def read_census(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Census persons: codes, birth year, sex and weight, all as published strings.

    Cantons are missing in some years; persons then have no canton.
    """
    return read_columns(spark, path, CENSUS_COLUMNS, optional=("CANTVILLE",))


def in_scope(census: DataFrame, cfg: Config, extra: Iterable[str] = ()) -> DataFrame:
    """Leave out the territories a run excludes.

    The filter is on the raw column, so parquet row groups are skipped. Ages are
    never filtered here: later years need younger census ages.
    """
    dropped = list(extra)
    if not cfg.include_dom:
        dropped += DOM_DEPARTMENTS
    if not cfg.include_com:
        dropped += COM_DEPARTMENTS
    return census.where(~F.col("DEPT").isin(dropped)) if dropped else census


def read_flows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pupils and students: commune of residence, commune of study, age group, sex, weight."""
    return read_columns(spark, path, FLOW_COLUMNS)


def read_birth_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Birth records: department, region, month of birth, weight, as published strings."""
    return read_columns(spark, path, BIRTH_COLUMNS)


def read_birth_months(df: DataFrame) -> DataFrame:
    """Usable birth-month records as (department_code, region_code, month, weight).

    An unreadable weight counts as zero; unknown months and zero weights drop out.
    """
    month = clean_code(F.col("MNAI").cast("string")).try_cast("double")
    weight = F.coalesce(F.col("IPONDI").try_cast("double"), F.lit(0.0))
    return (
        df.select(*BIRTH_COLUMNS)
        .select(
            clean_code(F.col("DEPT").cast("string")).alias("department_code"),
            clean_code(F.col("REGION").cast("string")).alias("region_code"),
            month.alias("month"),
            weight.alias("weight"),
        )
        .where(F.col("month").between(1, 12) & (F.col("weight") > 0))
        .withColumn("month", F.col("month").cast("int"))
    )
