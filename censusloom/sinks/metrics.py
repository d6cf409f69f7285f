"""Figures of a level, observed while it is written, so that no check scans the written files again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from censusloom.operators.quality import BAD, coverage_of_levels
from censusloom.schemas import LEVEL_CODE, check_level

STATS = "level string, n_rows long, population double, n_areas long, _years long, _months long"


class LevelMetrics:
    """Rows, persons, areas, years, months, ages, invalid rows and nulls of a level, collected by its write.

    Areas, departments, years, months and ages are values of code lists, so the sets that travel are bounded by them
    (some ten thousand areas at most), however many rows are written. The figures are there once the write has ended.
    """

    def __init__(self, level: str, audited: Sequence[str] = ("department_code", "age", "sex", "population")):
        check_level(level)
        self.level, self.audited = level, tuple(audited)
        self.observation = Observation(f"level {level}")

    def watch(self, df: DataFrame) -> DataFrame:
        population = F.col("population").cast("double")
        sets = {"areas": LEVEL_CODE[self.level], "departments": "department_code", "years": "year", "months": "month"}
        return df.observe(
            self.observation,
            F.count(F.lit(1)).alias("n_rows"),
            F.coalesce(F.sum(population), F.lit(0.0)).alias("population"),
            F.count_if(F.expr(BAD)).alias("invalid_rows"),
            F.min("age").alias("min_age"),
            F.max("age").alias("max_age"),
            *[F.collect_set(c).alias(name) for name, c in sets.items()],
            *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in self.audited],
        )

    @property
    def values(self) -> dict:
        return self.observation.get

    def stats_row(self) -> tuple:
        v = self.values
        return (self.level, v["n_rows"], v["population"], len(v["areas"]), len(v["years"]), len(v["months"]))


def observed_level_stats(spark: SparkSession, metrics: Mapping[str, LevelMetrics]) -> DataFrame:
    """What level_stats says of the written levels, from the figures of their writes: one row for each level."""
    return coverage_of_levels(spark.createDataFrame([m.stats_row() for m in metrics.values()], STATS))


def observed_validation(spark: SparkSession, metrics: Mapping[str, LevelMetrics]) -> DataFrame:
    """Rows, persons, departments, years, ages, invalid rows and verdict of each written level."""
    rows = [
        (m.level, v["n_rows"], v["population"], len(v["departments"]), len(v["years"]), v["min_age"], v["max_age"], v["invalid_rows"], v["invalid_rows"] == 0)
        for m in metrics.values()
        for v in (m.values,)
    ]
    return spark.createDataFrame(
        rows,
        "level string, total_rows long, total_population double, departments long, years long, min_age int, max_age int, invalid_rows long, is_valid boolean",
    )


def observed_nulls(spark: SparkSession, metrics: Mapping[str, LevelMetrics]) -> DataFrame:
    """(level, column, nulls) of the audited columns."""
    rows = [(m.level, c, m.values[f"{c}_nulls"]) for m in metrics.values() for c in m.audited]
    return spark.createDataFrame(rows, "level string, column string, nulls long")
