"""Checks of base cells, share tables and projected levels.

Every check returns a small DataFrame; none collects.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from censusloom.functions import quantile_sketch, quantiles, single, union_all
from censusloom.schemas import LEVEL_CODE


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


BAD = "population IS NULL OR population < 0"


def _summed(base: DataFrame) -> DataFrame:
    """Per department, year and age: distinct counts then run over a few thousand rows instead of every cell."""
    return base.groupBy("department_code", "year", "age").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("population").alias("_population"), F.count_if(F.expr(BAD)).alias("_bad")
    )


_STATS = (
    (F.sum, "_rows", "total_rows"),
    (F.sum, "_population", "total_population"),
    (F.countDistinct, "department_code", "departments"),
    (F.countDistinct, "year", "years"),
    (F.min, "age", "min_age"),
    (F.max, "age", "max_age"),
)


def validation_stats(base: DataFrame) -> DataFrame:
    """Rows, persons, departments, years and the age range of the base cells."""
    return _summed(base).agg(*[f(column).alias(name) for f, column, name in _STATS])


def invalid_rows(base: DataFrame) -> DataFrame:
    return base.agg(F.count_if(F.expr(BAD)).alias("invalid_rows"))


def department_coverage(base: DataFrame, expected: DataFrame) -> DataFrame:
    """Each expected (department_code, territory) with whether the cells hold it."""
    found = base.select("department_code").distinct().withColumn("present", F.lit(True))
    return expected.join(found, "department_code", "left").select(
        "department_code", "territory", F.coalesce("present", F.lit(False)).alias("present")
    )


def validate(base: DataFrame, expected: DataFrame) -> DataFrame:
    """One row: verdict, statistics, and the missing or present departments per territory.

    Missing departments are warnings; only NULL or negative populations are errors.
    """

    def here(x, territory: str):
        return (x["territory"] == territory) & F.coalesce(F.array_contains("_found", x["department_code"]), F.lit(False))

    def codes(territory: str, present: bool):
        hit = F.filter("_known", lambda x: here(x, territory) if present else (x["territory"] == territory) & ~here(x, territory))
        return F.array_join(F.array_sort(F.transform(hit, lambda x: x["department_code"])), ",")

    # One pass over the cells; the expected departments are a short list.
    known = single(expected, F.collect_list(F.struct("department_code", "territory")))
    stats = [f(column).alias(name) for f, column, name in _STATS]
    return (
        _summed(base)
        .agg(*stats, F.coalesce(F.sum("_bad"), F.lit(0)).alias("invalid_rows"), F.collect_set("department_code").alias("_found"))
        .withColumn("_known", known)
        .withColumns(
            {
                "missing_metro": codes("metro", False),
                "missing_dom": codes("dom", False),
                "missing_tom": codes("tom", False),
                "dom_present": codes("dom", True),
                "tom_present": codes("tom", True),
                "mayotte_present": F.exists("_known", lambda x: here(x, "mayotte")),
                "is_valid": F.col("invalid_rows") == 0,
            }
        )
        .drop("_known", "_found")
    )


def level_stats(levels: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, persons, areas, coverage of the department level and mean stock, per level."""
    rows = union_all(
        [
            df.select(F.lit(level).alias("level"), F.col(LEVEL_CODE[level]).alias("code"), "year", "month", "population")
            for level, df in levels.items()
        ]
    )
    cells = rows.groupBy("level", "code", "year", "month").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("population").alias("_population")
    )
    stats = cells.groupBy("level").agg(
        F.sum("_rows").alias("n_rows"),
        F.sum("_population").alias("population"),
        F.countDistinct("code").alias("n_areas"),
        F.countDistinct("year").alias("_years"),
        F.countDistinct("month").alias("_months"),
    )
    return coverage_of_levels(stats)


def coverage_of_levels(stats: DataFrame) -> DataFrame:
    """Coverage of the department level and mean stock, from one row of counts per level."""
    # One row per level, so the unpartitioned window sees at most four rows.
    parent = F.max(F.when(F.col("level") == "department", F.col("population"))).over(Window.partitionBy())
    return stats.select(
        "level",
        "n_rows",
        "population",
        "n_areas",
        F.round(F.try_divide(100 * F.col("population"), parent), 1).alias("coverage_pct"),
        F.try_divide(F.col("population"), F.col("_years") * F.col("_months")).alias("avg_snapshot"),
    )


def level_summary(df: DataFrame, code: str) -> DataFrame:
    """Rows, persons, areas, years, ages, and means per month and per age."""
    cells = df.groupBy(code, "year", "age").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("population").alias("_population")
    )
    stats = cells.agg(
        F.sum("_rows").alias("n_rows"),
        F.sum("_population").alias("population"),
        F.countDistinct(code).alias("n_areas"),
        F.countDistinct("year").alias("n_years"),
        F.countDistinct("age").alias("n_ages"),
    )
    return stats.withColumn(
        "avg_month", F.coalesce(F.try_divide("population", F.col("n_years") * 12), F.lit(0.0))
    ).withColumn("avg_age", F.coalesce(F.try_divide("avg_month", "n_ages"), F.lit(0.0)))


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def share_sum_audit(
    ratios: DataFrame, keys: Sequence[str], low: float = 0.999, high: float = 1.001, value: str = "geo_ratio"
) -> DataFrame:
    """Sum of the shares per group, and whether it is one within tolerance."""
    return (
        ratios.groupBy(*keys)
        .agg(F.sum(value).alias("ratio_sum"))
        .withColumn("ok", F.col("ratio_sum").between(low, high))
    )


def child_parent(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], low: float | None, high: float
) -> DataFrame:
    """Child over parent population per key, where both exist, and whether it lies in bounds."""
    parts = child.groupBy(*keys).agg(F.sum("population").alias("child_pop"))
    whole = parent.groupBy(*keys).agg(F.sum("population").alias("parent_pop"))
    ratio = F.try_divide("child_pop", "parent_pop")
    ok = ratio <= high if low is None else ratio.between(low, high)
    return whole.join(parts, list(keys)).withColumn("ratio", ratio).withColumn("ok", ok)


def coverage_by_department(department: DataFrame, epci: DataFrame, iris: DataFrame) -> DataFrame:
    """How much of each department's population its EPCI and area rows carry."""

    def total(df, name):
        return df.groupBy("department_code").agg(F.sum("population").alias(name))

    def part(name):
        return F.coalesce(F.col(name), F.lit(0.0))

    return (
        total(department, "dept_pop")
        .join(total(epci, "_epci"), "department_code", "left")
        .join(total(iris, "_iris"), "department_code", "left")
        .select(
            "department_code",
            "dept_pop",
            part("_epci").alias("epci_pop"),
            part("_iris").alias("iris_pop"),
            F.try_divide(part("_epci"), F.col("dept_pop")).alias("epci_ratio"),
            F.try_divide(part("_iris"), F.col("dept_pop")).alias("iris_ratio"),
        )
    )


def yoy_change(df: DataFrame, limit: float = 0.03) -> DataFrame:
    """Relative change of the total from one year to the next."""
    totals = df.groupBy("year").agg(F.sum("population").alias("total_pop"))
    # One row per projected year.
    before = F.lag("total_pop").over(Window.orderBy("year"))
    return (
        totals.withColumn("_before", before)
        .where(F.col("_before").isNotNull())
        .select("year", "total_pop", F.try_divide(F.abs(F.col("total_pop") - F.col("_before")), "_before").alias("change"))
        .withColumn("ok", F.col("change") < limit)
    )


def bounds(df: DataFrame, cell_max: float, mean_low: float, mean_high: float) -> DataFrame:
    """Smallest, largest and mean cell, and whether they are plausible."""
    stats = df.agg(
        F.min("population").alias("min_pop"), F.max("population").alias("max_pop"), F.avg("population").alias("avg_pop")
    )
    ok = (F.col("min_pop") > 0) & (F.col("max_pop") < cell_max) & F.col("avg_pop").between(mean_low, mean_high)
    return stats.withColumn("ok", ok)


def relative_bounds(df: DataFrame, by: str, spread: float = 20.0, fraction: float = 0.99) -> DataFrame:
    """Smallest, largest and mean cell of each group, and whether they are plausible for a table of any size.

    A cell may exceed the value that ``fraction`` of the group's cells stay below ``spread`` times at most, and the
    mean must lie within that factor of the median. Both values come from a sketch with counts of buckets (within one
    percent), so there is one pass over the cells and no sort. Groups are values of a code list.
    """
    sketch = quantile_sketch(df, "population", [by])
    levels = quantiles(sketch, (0.5, fraction), [by]).select(by, F.col("q0").alias("median_pop"), F.col("q1").alias("high_pop"))
    stats = df.groupBy(by).agg(
        F.min("population").alias("min_pop"), F.max("population").alias("max_pop"), F.avg("population").alias("avg_pop"),
        F.count_if(F.col("population").isNull()).alias("_nulls"),
    )
    middle = F.col("avg_pop").between(F.col("median_pop") / spread, F.col("median_pop") * spread)
    fine = (F.col("_nulls") == 0) & (F.col("min_pop") > 0) & (F.col("max_pop") <= F.col("high_pop") * spread) & middle
    return stats.join(levels, by, "left").withColumn("ok", F.coalesce(fine, F.lit(False))).drop("_nulls")


def snapshot_stock(df: DataFrame) -> DataFrame:
    """Population of every snapshot month relative to that year's January."""
    months = df.groupBy("year", "month").agg(F.sum("population").alias("stock"))
    january = months.where("month = 1").select("year", F.col("stock").alias("_january"))
    return months.join(january, "year", "left").select(
        "year", "month", "stock", F.try_divide("stock", "_january").alias("vs_january")
    )


def concentration(ratios: DataFrame, band: str) -> DataFrame:
    """Mean over (department, sex) of the standard deviation of a band's shares."""
    spread = (
        ratios.where(F.col("age_band") == band)
        .groupBy("department_code", "sex")
        .agg(F.stddev_samp("geo_ratio").alias("_std"))
    )
    return spread.agg(F.avg("_std").alias("mean_stddev"))


def precision_split(df: DataFrame) -> DataFrame:
    """Part of each department's population placed exactly."""
    exact = F.when(F.col("geo_precision") == "exact", F.col("population")).otherwise(F.lit(0.0))
    return (
        df.groupBy("department_code")
        .agg(F.sum(exact).alias("exact_pop"), F.sum("population").alias("total_pop"))
        .withColumn("exact_pct", F.try_divide("exact_pop", "total_pop"))
    )


def single_snapshot(df: DataFrame, expected: int = 1) -> DataFrame:
    """Cells that do not have the expected number of snapshot months."""
    return (
        df.groupBy("year", "department_code", "age", "sex")
        .agg(F.countDistinct("month").alias("n_months"))
        .where(F.col("n_months") != expected)
    )
