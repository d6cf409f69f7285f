"""Column expressions over ages, weights, dates and published table cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from censusloom.config import CONFIDENCE_MID, CONFIDENCE_NEAR, CONFIDENCE_PER_YEAR


def birth_age(birth_year: Column, year: int) -> Column:
    """Age as the difference of calendar years, which is constant over the year."""
    return F.lit(year) - birth_year.cast("int")


def weight(value: Column) -> Column:
    return value.cast("double")


def valid_cell(age: Column, weight_: Column) -> Column:
    return age.isNotNull() & weight_.isNotNull()


def positive(value: Column) -> Column:
    return value > 0


def january(month: Column) -> Column:
    return month == 1


def age_window(age: Column, low: int, high: int) -> Column:
    return age.between(low, high)


def confidence(year: Column, census_year: int) -> Column:
    """Error margin growing with the distance from the census, as a double."""
    gap = F.abs(year - F.lit(census_year))
    return (
        F.when(gap <= 1, F.lit(CONFIDENCE_NEAR))
        .when(gap <= 3, F.lit(CONFIDENCE_MID))
        .otherwise(F.lit(CONFIDENCE_PER_YEAR) * gap.cast("double"))
    )


def months_between_firsts(start: Column, end: Column) -> Column:
    """Whole months between two first-of-month dates."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


# -- cells of published spreadsheets, ingested as strings --------------------


def sex_code(cell: Column) -> Column:
    """'1', '1.0' and 1 all mean code 1; text that is no number stays as it is."""
    text = F.trim(cell.cast("string"))
    return F.coalesce(text.try_cast("double").cast("int").cast("string"), text)


def age_label(cell: Column) -> Column:
    """'17', '017', '17 ans' -> 17 and '100 ou plus' -> 100; blank or junk -> NULL."""
    text = F.lower(F.trim(cell.cast("string")))
    digits = F.regexp_replace(text, "[^0-9]", "")
    leading = F.element_at(F.split(text, r"\s+"), 1)
    return F.when(text.contains("plus"), digits.try_cast("int")).otherwise(
        F.floor(leading.try_cast("double")).cast("int")
    )


def french_number(cell: Column) -> Column:
    """'1 234,5' -> 1234.5; blank or junk counts as zero."""
    text = F.regexp_replace(F.regexp_replace(cell.cast("string"), r"[\s\u00a0\u202f]", ""), ",", ".")
    return F.coalesce(text.try_cast("double"), F.lit(0.0))
