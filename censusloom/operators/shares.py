"""How a department's population of an age band and sex splits over finer areas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusloom.config import NO_GEO
from censusloom.functions import age_band, share_within, usable_iris

GROUP = ["department_code", "age_band", "sex"]


def _banded(base: DataFrame) -> DataFrame:
    return base.withColumn("age_band", age_band(F.col("age"))).where(F.col("age_band").isNotNull())


def fallback_departments(base: DataFrame, covered: DataFrame) -> DataFrame:
    """Departments with no usable area of their own that do have area-less persons."""
    known = covered.select("department_code").where(F.col("department_code").isNotNull()).distinct()
    return (
        base.where((F.col("iris_code") == NO_GEO) & F.col("department_code").isNotNull())
        .select("department_code")
        .distinct()
        .join(known, "department_code", "left_anti")
    )


def epci_population(base: DataFrame, lookup: DataFrame) -> DataFrame:
    """Persons per department x EPCI x band x sex, of communes that have an EPCI.

    Cells are summed to communes before the lookup, so the join sees one row per
    commune, band and sex instead of one per area and age.
    """
    communes = (
        _banded(base.where((F.col("commune_code") != "") & (F.col("iris_code") != NO_GEO)))
        .groupBy("department_code", "commune_code", "age_band", "sex")
        .agg(F.sum("population").alias("population"))
    )
    return (
        communes.join(lookup.select("commune_code", "epci_code"), "commune_code")
        .groupBy("department_code", "epci_code", "age_band", "sex")
        .agg(F.sum("population").alias("population"))
    )


def geo_ratios_epci(base: DataFrame, lookup: DataFrame) -> DataFrame:
    """EPCI shares; a department without any commune passes through as its own EPCI."""
    population = epci_population(base, lookup)
    columns = ["department_code", "epci_code", "age_band", "sex", "geo_ratio"]
    shares = share_within(population, GROUP, "population", "geo_ratio").select(*columns)
    fallback = fallback_departments(base, population)
    groups = _banded(base).select(*GROUP).distinct()
    passthrough = (
        groups.join(fallback, "department_code", "left_semi")
        .withColumn("epci_code", F.col("department_code"))
        .withColumn("geo_ratio", F.lit(1.0))
    )
    return shares.unionByName(passthrough.select(*columns))


def iris_population(base: DataFrame) -> DataFrame:
    """Persons per usable area x band x sex."""
    return (
        _banded(base.where(usable_iris(F.col("iris_code"))))
        .groupBy("department_code", "region_code", "commune_code", "iris_code", "age_band", "sex")
        .agg(F.sum("population").alias("population"))
    )


def geo_ratios_iris(base: DataFrame, lookup: DataFrame) -> DataFrame:
    """Area shares, with the area's EPCI where it has one.

    A department without usable areas keeps the codes it has, share 1.
    """
    columns = [
        "department_code", "region_code", "commune_code", "iris_code", "epci_code", "age_band", "sex", "geo_ratio",
    ]
    shares = (
        share_within(iris_population(base), GROUP, "population", "geo_ratio")
        .join(lookup.select("commune_code", "epci_code"), "commune_code", "left")
        .select(*columns)
    )
    usable = F.coalesce(usable_iris(F.col("iris_code")), F.lit(False))
    covered = _banded(base.where(usable)).select("department_code")
    passthrough = (
        _banded(base.where(~usable))
        .select("department_code", "region_code", "commune_code", "iris_code", "age_band", "sex")
        .distinct()
        .join(fallback_departments(base, covered), "department_code", "left_semi")
        .withColumn("epci_code", F.lit(None).cast("string"))
        .withColumn("geo_ratio", F.lit(1.0))
    )
    return shares.unionByName(passthrough.select(*columns))


def geo_ratios_canton(base: DataFrame) -> DataFrame:
    """Canton shares. Departments without cantons have none."""
    population = (
        _banded(base.where(F.col("canton_code").isNotNull() & (F.col("canton_code") != "")))
        .groupBy("department_code", "region_code", "canton_code", "age_band", "sex")
        .agg(F.sum("population").alias("population"))
    )
    return share_within(population, GROUP, "population", "geo_ratio").select(
        "department_code", "region_code", "canton_code", "age_band", "sex", "geo_ratio"
    )


def geo_ratios(level: str, base: DataFrame, lookup: DataFrame) -> DataFrame:
    if level == "epci":
        return geo_ratios_epci(base, lookup)
    if level == "canton":
        return geo_ratios_canton(base)
    if level == "iris":
        return geo_ratios_iris(base, lookup)
    raise ValueError(f"Unknown level: {level}")


def ratio_size(ratios: DataFrame, code: str) -> DataFrame:
    """Rows and distinct areas of a share table."""
    return ratios.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(code).alias("n_areas"))
