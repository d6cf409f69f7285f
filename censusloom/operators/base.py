"""Base cells: weighted census counts by area, age and sex, plus appended territories."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusloom.config import NO_GEO, TERRITORIES, TOM_DEPARTMENTS, Territory
from censusloom.functions import birth_age, clean_code, commune_of, decode_sex, union_all, valid_cell, weight
from censusloom.schemas import BASE

log = logging.getLogger(__name__)


def base_population(census: DataFrame, year: int) -> DataFrame:
    """Weighted persons per area x age x sex: one scan, one shuffle of partial sums.

    Every later step reads these cells, never the persons again.
    """
    # Strict casts fail on junk, so a missing raw value is the only way to a missing
    # age or weight, and the reader can skip it before anything is parsed.
    persons = census.where(valid_cell(F.col("ANAI"), F.col("IPONDI"))).select(
        clean_code(F.col("DEPT")).alias("department_code"),
        clean_code(F.col("REGION")).alias("region_code"),
        clean_code(F.col("CANTVILLE")).alias("canton_code"),
        clean_code(F.col("IRIS")).alias("iris_code"),
        birth_age(F.col("ANAI"), year).alias("age"),
        decode_sex(F.col("SEXE")).alias("sex"),
        weight(F.col("IPONDI")).alias("weight"),
    )
    # The commune follows from the area code, so it is derived per cell, not per
    # person, and stays out of the shuffled key.
    keys = ["department_code", "region_code", "canton_code", "iris_code", "age", "sex"]
    cells = persons.groupBy(*keys).agg(F.sum("weight").alias("population"))
    return cells.withColumns({"year": F.lit(year), "commune_code": commune_of(F.col("iris_code"))}).select(
        *[f.name for f in BASE.fields]
    )


def age_forward(pyramid: DataFrame, territory: Territory, year: int) -> DataFrame:
    """A territory's (age, sex, population) as base cells, aged from its census to ``year``."""
    gap = year - territory.census_year
    if gap < 0 and not territory.accept_newer:
        raise ValueError(
            f"territory {territory.department_code}: base year {year} lies before its census {territory.census_year}"
        )
    geo = {
        "year": F.lit(year),
        "department_code": F.lit(territory.department_code),
        "region_code": F.lit(territory.region_code),
        "canton_code": F.lit(territory.canton_code),
        "commune_code": F.lit(""),
        "iris_code": F.lit(NO_GEO),
        "age": F.col("age") + max(0, gap),
        "sex": F.col("sex"),
        "population": F.col("population"),
    }
    return pyramid.where(F.col("population") > 0).select(
        *[geo[f.name].cast(f.dataType).alias(f.name) for f in BASE.fields]
    )


def append(base: DataFrame, *others: DataFrame) -> DataFrame:
    return union_all([base, *others])


def append_territories(
    base: DataFrame,
    pyramids: Mapping[str, DataFrame],
    year: int,
    allowed: Iterable[str] | None = None,
    territories: Iterable[Territory] = TERRITORIES,
) -> DataFrame:
    """Append every wanted territory that has a pyramid.

    ``allowed`` limits the Pacific group (by default to the eligible two). A group
    of required territories with no rows at all stops the run; an optional one is
    skipped with a warning.
    """
    wanted = set(TOM_DEPARTMENTS if allowed is None else allowed)
    eligible = [t for t in territories if t.group != "tom" or t.department_code in wanted]
    filled = _filled({t.department_code: pyramids[t.department_code] for t in eligible if t.department_code in pyramids})
    used = [t for t in eligible if t.department_code in filled]
    for territory in eligible:
        if territory not in used:
            log.warning("territory %s has no population rows", territory.department_code)
    missing = {t.group for t in eligible if t.required} - {t.group for t in used}
    if missing:
        raise ValueError(f"no population for required territories: {sorted(missing)}")
    return append(base, *[age_forward(pyramids[t.department_code], t, year) for t in used])


def _filled(pyramids: Mapping[str, DataFrame]) -> set[str]:
    """Codes of the pyramids with any person: one job, one row per territory."""
    if not pyramids:
        return set()
    found = union_all(
        [p.where(F.col("population") > 0).select(F.lit(code).alias("code")).limit(1) for code, p in pyramids.items()]
    )
    return {row.code for row in found.collect()}


def canton_weights(cog: DataFrame, lookup: DataFrame) -> DataFrame:
    """Share of each canton's population living in each EPCI (0 for an empty canton)."""
    cells = (
        cog.select("commune_code", "canton_code")
        .join(lookup.select("commune_code", "epci_code", "commune_population"), "commune_code")
        .where(F.col("canton_code").isNotNull() & F.col("epci_code").isNotNull())
        .groupBy("canton_code", "epci_code")
        .agg(F.sum(F.coalesce(F.col("commune_population").try_cast("double"), F.lit(0.0))).alias("population"))
    )
    totals = cells.groupBy("canton_code").agg(F.sum("population").alias("total"))
    return cells.join(totals, "canton_code").select(
        "canton_code",
        "epci_code",
        F.coalesce(F.try_divide("population", "total"), F.lit(0.0)).alias("weight"),
    )
