"""From departments to finer areas, and from years of age to months of birth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusloom.config import CONFIDENCE_EXTRA
from censusloom.functions import age_band, months_between_firsts, positive
from censusloom.schemas import LEVEL_GEO, check_level


def disaggregate(
    departments: DataFrame, ratios: DataFrame, level: str, extra: float | None = None
) -> DataFrame:
    """Department population x area share, with a wider margin.

    One plain join at every size: Spark broadcasts the departments below its byte threshold and shuffles both sides
    above. Shuffled, a department's rows fall apart into its forty keys (band, sex), so one that holds a third of all
    areas spreads over forty tasks. The region is the department's for an EPCI and the area's own otherwise.
    """
    check_level(level)
    extra = CONFIDENCE_EXTRA[level] if extra is None else extra
    area = ratios if level != "epci" else ratios.drop("region_code")
    parent = departments.withColumn("age_band", age_band(F.col("age"))).drop(
        "geo_precision", "population_low", "population_high"
    )
    if level != "epci":
        parent = parent.drop("region_code")
    margin = F.col("confidence_pct") + F.lit(extra)
    people = F.col("population") * F.col("geo_ratio")
    joined = area.join(parent, ["department_code", "age_band", "sex"])
    return joined.where(positive(people)).select(
        "year",
        "month",
        "snapshot_month",
        "born_date",
        "decimal_age",
        *LEVEL_GEO[level],
        "age",
        "sex",
        F.lit("exact").alias("geo_precision"),
        people.alias("population"),
        margin.alias("confidence_pct"),
        (people * (1.0 - margin)).alias("population_low"),
        (people * (1.0 + margin)).alias("population_high"),
    )


def expand_birth_month(level_df: DataFrame, births: DataFrame, level: str) -> DataFrame:
    """Split every row over the birth months of its department (up to twelve rows).

    Kept last: the births are broadcast, as they have twelve rows for each code of the department list at most, so no
    row moves. Departments without birth months drop out.
    """
    check_level(level)
    geo = LEVEL_GEO[level]
    months = births.select("department_code", F.col("month").alias("birth_month"), "month_ratio")
    born = F.make_date(F.col("year") - F.col("age"), F.col("birth_month"), F.lit(1))
    people = F.col("population") * F.col("month_ratio")
    return (
        level_df.join(F.broadcast(months), "department_code")
        .where(positive(people))
        .select(
            "year",
            "month",
            "birth_month",
            "snapshot_month",
            born.alias("born_date"),
            (months_between_firsts(born, F.col("snapshot_month")) / F.lit(12.0)).alias("decimal_age"),
            *geo,
            "age",
            "sex",
            "geo_precision",
            people.alias("population"),
            "confidence_pct",
            (people * (1.0 - F.col("confidence_pct"))).alias("population_low"),
            (people * (1.0 + F.col("confidence_pct"))).alias("population_high"),
        )
    )
