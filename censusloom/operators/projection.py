"""Department projection: cohorts moved through the years, tied to national estimates."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from censusloom.config import Config
from censusloom.functions import age_window, confidence, months_between_firsts, positive, unique

log = logging.getLogger(__name__)

CELL = ["year", "month", "age", "sex"]


def census_departments(base: DataFrame) -> DataFrame:
    """Census persons per department, age and sex, with one region per department."""
    cells = base.groupBy("department_code", "age", "sex").agg(
        F.sum("population").alias("population"), F.min("region_code").alias("_region")
    )
    regions = cells.groupBy("department_code").agg(F.min("_region").alias("region_code"))
    return cells.drop("_region").join(regions, "department_code", "left")


def cohort_totals(departments: DataFrame) -> DataFrame:
    """National persons per age and sex."""
    return departments.groupBy("age", "sex").agg(F.sum("population").alias("total"))


def dept_age_shares(departments: DataFrame, totals: DataFrame) -> DataFrame:
    """Each department's share of a national age and sex; NULL where the nation has none."""
    return departments.join(totals, ["age", "sex"]).select(
        "department_code",
        "region_code",
        "age",
        "sex",
        (F.col("population") / F.nullif(F.col("total"), F.lit(0.0))).alias("dept_share"),
    )


def years(cfg: Config) -> Column:
    return F.explode(F.sequence(F.lit(cfg.start_year), F.lit(cfg.end_year)))


def snapshots(df: DataFrame, cfg: Config, births: DataFrame | None = None) -> DataFrame:
    """One snapshot per year, or one per month the department has births in.

    Population is a stock: every month carries the whole cohort.
    """
    if not cfg.monthly:
        return df.withColumn("month", F.lit(1))
    if births is None:
        raise ValueError("monthly snapshots need the birth-month table")
    return df.join(births.select("department_code", "month"), "department_code")


def finish(df: DataFrame, cfg: Config) -> DataFrame:
    """Dates, precision and confidence bounds of positive cells, in column order."""
    snapshot = F.make_date("year", "month", F.lit(1))
    born = F.make_date(F.col("year") - F.col("age"), F.lit(1), F.lit(1))
    margin = confidence(F.col("year"), cfg.census_year)
    return df.where(positive(F.col("population"))).select(
        "year",
        "month",
        snapshot.alias("snapshot_month"),
        born.alias("born_date"),
        (months_between_firsts(born, snapshot) / F.lit(12.0)).alias("decimal_age"),
        "department_code",
        "region_code",
        "age",
        "sex",
        F.lit("exact").alias("geo_precision"),
        "population",
        margin.alias("confidence_pct"),
        (F.col("population") * (1.0 - margin)).alias("population_low"),
        (F.col("population") * (1.0 + margin)).alias("population_high"),
    )


def project_aging(departments: DataFrame, cfg: Config, births: DataFrame | None = None) -> DataFrame:
    """Every census cohort ages where it was counted."""
    moved = (
        departments.withColumn("year", years(cfg))
        .withColumn("age", F.col("age") + F.col("year") - F.lit(cfg.census_year))
        .where(age_window(F.col("age"), cfg.min_age, cfg.max_age))
    )
    return finish(snapshots(moved, cfg, births), cfg)


def project_stable(departments: DataFrame, cfg: Config, births: DataFrame | None = None) -> DataFrame:
    """National cohorts age; each age keeps its census distribution over departments."""
    totals = cohort_totals(departments)
    moved = (
        dept_age_shares(departments, totals)
        .where(age_window(F.col("age"), cfg.min_age, cfg.max_age))
        .withColumn("year", years(cfg))
        .withColumn("_census_age", F.col("age") - (F.col("year") - F.lit(cfg.census_year)))
        .join(totals.select(F.col("age").alias("_census_age"), "sex", "total"), ["_census_age", "sex"])
        .withColumn("population", F.col("total") * F.col("dept_share"))
    )
    return finish(snapshots(moved, cfg, births), cfg)


def anchor_factors(
    projected: DataFrame, estimates: DataFrame, excluded: Iterable[str], last_year: int
) -> DataFrame:
    """Published over projected national total, per snapshot, age and sex.

    The projected total leaves out the territories the estimates do not cover.
    Years past the last published one use that one; the birth year is kept. Two
    estimates for one cell would multiply its rows: they stop the run.
    """
    totals = (
        projected.where(~F.col("department_code").isin(list(excluded)))
        .groupBy(*CELL)
        .agg(F.sum("population").alias("_projected"))
        .withColumn("_year", F.least(F.col("year"), F.lit(last_year)))
        .withColumn("naissance", F.col("year") - F.col("age"))
    )
    published = unique(estimates.select("year", "naissance", "sex", "population"), ["year", "naissance", "sex"], "estimates").select(
        F.col("year").alias("_year"), "naissance", "sex", F.col("population").alias("_published")
    )
    return totals.join(published, ["_year", "naissance", "sex"], "left").select(
        *CELL, F.coalesce(F.try_divide("_published", "_projected"), F.lit(1.0)).alias("factor")
    )


def anchor(projected: DataFrame, estimates: DataFrame, excluded: Iterable[str], last_year: int) -> DataFrame:
    """Scale covered departments so that every national cell meets its estimate."""
    excluded = list(excluded)
    factor = F.when(F.col("department_code").isin(excluded), F.lit(1.0)).otherwise(
        F.coalesce("factor", F.lit(1.0))
    )
    scaled = ["population", "population_low", "population_high"]
    return (
        projected.join(anchor_factors(projected, estimates, excluded, last_year), CELL, "left")
        .withColumns({c: F.col(c) * factor for c in scaled})
        .select(*projected.columns)
    )


def project(
    departments: DataFrame, cfg: Config, estimates: DataFrame | None = None, births: DataFrame | None = None
) -> DataFrame:
    """Project by the configured method; without estimates the anchored one stays unanchored."""
    if cfg.method == "cohort-aging":
        return project_aging(departments, cfg, births)
    stable = project_stable(departments, cfg, births)
    if cfg.method == "cohort-stable":
        return stable
    if estimates is None:
        log.warning("no national estimates: totals stay at the census level")
        return stable
    return anchor(stable, estimates, cfg.excluded_codes, cfg.estimates_last_year)


def uncovered_cells(spark: SparkSession, projected: DataFrame, cfg: Config) -> DataFrame:
    """Requested (year, age, sex) cells without any projected row."""
    wanted = spark.range(1).select(
        years(cfg).alias("year"), F.sequence(F.lit(cfg.min_age), F.lit(cfg.max_age)).alias("_ages")
    )
    wanted = wanted.select("year", F.explode("_ages").alias("age")).withColumn(
        "sex", F.explode(F.array(F.lit("male"), F.lit("female")))
    )
    found = projected.select("year", "age", "sex").distinct()
    return wanted.join(found, ["year", "age", "sex"], "left_anti")
