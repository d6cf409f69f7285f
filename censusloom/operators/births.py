"""Month-of-birth distribution per department, with fallbacks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from censusloom.config import BIG_DEPARTMENT_WEIGHT, known_departments
from censusloom.functions import share_within, single, union_all


def department_dimension(spark: SparkSession, rows: Iterable[tuple] | None = None) -> DataFrame:
    """(department_code, region_code, is_metro) for each department to publish."""
    return spark.createDataFrame(
        list(known_departments() if rows is None else rows),
        "department_code string, region_code string, is_metro boolean",
    )


def birth_cells(records: DataFrame) -> DataFrame:
    """Weight per department x region x month: a few thousand rows whatever the input size."""
    return records.groupBy("department_code", "region_code", "month").agg(F.sum("weight").alias("weight"))


def month_shares(cells: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Share of each ``keys`` cell in its ``within`` group (in everything if empty)."""
    weights = cells.groupBy(*keys).agg(F.sum("weight").alias("weight"))
    if within:
        shares = share_within(weights, within, "weight", "month_ratio")
    else:
        total = single(weights, F.sum("weight"))
        shares = weights.withColumn("month_ratio", F.coalesce(F.try_divide(F.col("weight"), total), F.lit(0.0)))
    return shares.select(*keys, "month_ratio")


def big_groups(cells: DataFrame, departments: DataFrame, threshold: float | Column = BIG_DEPARTMENT_WEIGHT) -> DataFrame:
    """Known departments heavy enough to have a distribution of their own."""
    return (
        cells.groupBy("department_code")
        .agg(F.sum("weight").alias("weight"))
        .join(departments.select("department_code"), "department_code", "left_semi")
        .where(F.col("weight") >= threshold)
        .select("department_code")
    )


def birth_month_distribution(
    cells: DataFrame, departments: DataFrame, threshold: float | Column = BIG_DEPARTMENT_WEIGHT
) -> DataFrame:
    """(department_code, month, month_ratio) for every department of the dimension.

    A big department uses its own months. Any other takes its region's whole
    distribution (which counts every record of the region, pooled ones included),
    or the metropolitan one where the region has no record. A fallback replaces
    the distribution as a whole, never single months.
    """
    big = big_groups(cells, departments, threshold)
    regions = month_shares(cells, ["region_code", "month"], ["region_code"])
    metro = month_shares(
        cells.join(departments.where("is_metro").select("department_code"), "department_code", "left_semi"), ["month"]
    )
    own = month_shares(
        cells.join(big, "department_code", "left_semi"), ["department_code", "month"], ["department_code"]
    )
    small = departments.select("department_code", "region_code").join(big, "department_code", "left_anti")
    covered = cells.select("region_code").where(F.col("region_code").isNotNull()).distinct()
    from_region = small.join(regions, "region_code").select("department_code", "month", "month_ratio")
    # At most twelve values by construction: the reader keeps months 1 to 12 only.
    metro_months = single(metro, F.collect_list(F.struct("month", "month_ratio")))
    from_metro = (
        small.join(covered, "region_code", "left_anti")
        .select("department_code", F.explode(metro_months).alias("_m"))
        .select("department_code", "_m.month", "_m.month_ratio")
    )
    return union_all([own, from_region, from_metro])
