"""Column expressions over geographic, sex and age codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from censusloom.config import BAND_WIDTH, MASKED_SUFFIX, MAX_AGE, NO_GEO, OPEN_BAND_START


def clean_code(code: Column) -> Column:
    return F.trim(code)


def decode_sex(code: Column) -> Column:
    """'1' is male, '2' is female, anything else is unknown (NULL)."""
    return F.when(code == "1", F.lit("male")).when(code == "2", F.lit("female"))


def commune_of(iris: Column) -> Column:
    """Commune of a trimmed area code; empty where there is no geography.

    A masked code still names its commune.
    """
    return F.when(iris.isNull() | (iris == NO_GEO), F.lit("")).otherwise(F.substring(iris, 1, 5))


def department_of(commune: Column) -> Column:
    """Overseas departments (97x) take three characters of the commune, others two."""
    return F.when(commune.startswith("97"), F.substring(commune, 1, 3)).otherwise(F.substring(commune, 1, 2))


def usable_iris(iris: Column) -> Column:
    """A full nine-character area code, neither missing nor masked."""
    return (iris != NO_GEO) & ~iris.endswith(MASKED_SUFFIX) & (F.length(iris) == 9)


def iris_or_commune(iris: Column) -> Column:
    """Fall back from a masked area code to its commune."""
    return F.when(iris.endswith(MASKED_SUFFIX), F.substring(iris, 1, 5)).otherwise(iris)


def age_band(age: Column) -> Column:
    """Five-year band of an age: 0_4 ... 90_94, then 95_plus; NULL outside 0..120.

    An expression instead of a lookup table, so banding never costs a join.
    """
    start = (F.floor(age / BAND_WIDTH) * BAND_WIDTH).cast("int")
    closed = F.concat_ws("_", start.cast("string"), (start + (BAND_WIDTH - 1)).cast("string"))
    return F.when(age.between(0, OPEN_BAND_START - 1), closed).when(
        age.between(OPEN_BAND_START, MAX_AGE), F.lit(f"{OPEN_BAND_START}_plus")
    )
