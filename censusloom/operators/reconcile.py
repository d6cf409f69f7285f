"""Estimates against their parents and against outside figures.

Each report is one grouped join over January rows. ``year`` narrows a level to
one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusloom.config import NO_GEO
from censusloom.functions import age_window, safe_ratio, single
from censusloom.sources.levels import read_level

# The sub-bands a student correction is read from.
SUB_BANDS = ((15, 17, "15-17"), (18, 19, "18-19"), (20, 24, "20-24"))
YOUNG, STUDENT = (15, 24), (20, 24)


def _in(ages: tuple[int, int], value: str = "pop") -> Column:
    return F.sum(F.when(age_window(F.col("age"), *ages), F.col(value)).otherwise(F.lit(0.0)))


def _of(sex: str, value: str = "pop") -> Column:
    return F.sum(F.when(F.col("sex") == sex, F.col(value)))


def _pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def _same_ages(ref: DataFrame, ours: DataFrame, ages: tuple[int, int] | None) -> DataFrame:
    """The reference rows within the ages we project; without their window the level is read for it once more."""
    low, high = ages or (None, None)
    if ages is None:
        found = single(ours, F.min("age").alias("low"), F.max("age").alias("high"))
        low, high = found["low"], found["high"]
    return ref.where(F.col("age").between(low, high))


# -- regions against an official pyramid -------------------------------------


def region_rollup(level: DataFrame, year: int) -> DataFrame:
    return read_level(level, ["year", "region_code", "age", "sex"], year, "region_code")


def region_diff(level: DataFrame, ref: DataFrame, year: int, ages: tuple[int, int] | None = None) -> DataFrame:
    """Total per region against the reference; the difference is NULL without reference persons."""
    ours = region_rollup(level, year)
    theirs = _same_ages(ref.where(F.col("year") == year), ours, ages)
    ref_total = theirs.groupBy("region_code").agg(F.sum("pop").alias("_ref"))
    return (
        ours.groupBy("region_code")
        .agg(F.sum("pop").alias("our_pop"))
        .join(ref_total, "region_code", "left")
        .withColumn("ref_pop", F.coalesce("_ref", F.lit(0.0)))
        .select(
            "region_code", "our_pop", "ref_pop", _pct(F.col("our_pop") - F.col("ref_pop"), F.col("ref_pop")).alias("diff_pct")
        )
    )


def subband_shares(
    level: DataFrame, ref: DataFrame, year: int, bands: Sequence[tuple[int, int, str]] = SUB_BANDS, limit: float = 0.3,
    ages: tuple[int, int] | None = None,
) -> DataFrame:
    """Share of each sub-band in a region, ours and theirs; flags a moved first band."""
    ours = region_rollup(level, year)
    theirs = _same_ages(ref.where(F.col("year") == year), ours, ages)

    def shares(df, name):
        total = df.groupBy("region_code").agg(
            F.sum("pop").alias("_total"), *[_in((lo, hi)).alias(label) for lo, hi, label in bands]
        )
        return total.unpivot(["region_code", "_total"], [b[2] for b in bands], "band", "_pop").select(
            "region_code", "band", F.coalesce(_pct(F.col("_pop"), F.col("_total")), F.lit(0.0)).alias(name)
        )

    diff = F.col("our_share") - F.col("ref_share")
    return (
        shares(ours, "our_share")
        .join(shares(theirs, "_ref"), ["region_code", "band"], "left")
        .withColumn("ref_share", F.coalesce("_ref", F.lit(0.0)))
        .select("region_code", "band", "our_share", "ref_share", diff.alias("diff_pp"))
        .withColumn("flag", (F.abs("diff_pp") > limit) & (F.col("band") == bands[0][2]))
    )


def sex_ratio(level: DataFrame, ref: DataFrame, year: int, ages: tuple[int, int] | None = None) -> DataFrame:
    """Males per female in each region, ours and theirs."""
    ours = region_rollup(level, year)
    theirs = _same_ages(ref.where(F.col("year") == year), ours, ages)

    def ratio(df, name):
        females = F.coalesce(F.nullif(_of("female"), F.lit(0.0)), F.lit(1.0))
        return df.groupBy("region_code").agg((F.coalesce(_of("male"), F.lit(0.0)) / females).alias(name))

    return (
        ratio(ours, "our_ratio")
        .join(ratio(theirs, "_ref"), "region_code", "left")
        .withColumn("ref_ratio", F.coalesce("_ref", F.lit(0.0)))
        .select("region_code", "our_ratio", "ref_ratio", (F.col("our_ratio") - F.col("ref_ratio")).alias("diff"))
    )


def year_drift(level: DataFrame, ref: DataFrame, ages: tuple[int, int] | None = None) -> DataFrame:
    """Total of the regions both sides know, year by year."""
    ours = read_level(level, ["year", "region_code", "age"], None, "region_code")
    theirs = _same_ages(ref, ours, ages).join(ours.select("region_code").distinct(), "region_code", "left_semi")
    known = ref.select("region_code").distinct()
    our_total = ours.join(known, "region_code", "left_semi").groupBy("year").agg(F.sum("pop").alias("our_total"))
    ref_total = theirs.groupBy("year").agg(F.sum("pop").alias("ref_total"))
    return (
        our_total.join(ref_total, "year")
        .where(F.col("ref_total") > 0)
        .select(
            "year",
            "our_total",
            "ref_total",
            _pct(F.col("our_total") - F.col("ref_total"), F.col("ref_total")).alias("diff_pct"),
        )
    )


# -- a finer level against its parent ----------------------------------------


def coverage(child: DataFrame, parent: DataFrame, year: int, code: str, by: str = "region_code") -> DataFrame:
    """Population a child level carries of its parent, per ``by`` and in all ('ALL')."""
    parts = read_level(child, [by], year, code).withColumnRenamed("pop", "_child")
    whole = read_level(parent, [by], year, by).withColumnRenamed("pop", "_parent")
    joined = whole.join(parts, by, "full").select(
        by,
        F.coalesce("_parent", F.lit(0.0)).alias("parent_pop"),
        F.coalesce("_child", F.lit(0.0)).alias("child_pop"),
    )
    overall = joined.agg(F.sum("parent_pop").alias("parent_pop"), F.sum("child_pop").alias("child_pop"))
    missing = F.col("parent_pop") - F.col("child_pop")
    return joined.unionByName(overall.withColumn(by, F.lit("ALL"))).select(
        by,
        "parent_pop",
        "child_pop",
        (safe_ratio(F.col("child_pop"), F.col("parent_pop")) * 100).alias("coverage_pct"),
        missing.alias("missing"),
        (safe_ratio(missing, F.col("parent_pop")) * 100).alias("missing_pct"),
    )


def band_share(
    child: DataFrame,
    parent: DataFrame,
    year: int,
    codes: Sequence[str] | None = None,
    code: str = "epci_code",
    num: tuple[int, int] = STUDENT,
    den: tuple[int, int] = YOUNG,
) -> DataFrame:
    """Share of one age band in another per area, next to the national share."""
    national = single(read_level(parent, ["age"], year, "region_code"), _pct(_in(num), _in(den)))
    rows = read_level(child, [code, "age"], year, code)
    if codes is not None:
        rows = rows.where(F.col(code).isin(list(codes)))
    areas = rows.groupBy(code).agg(
        F.sum("pop").alias("_total"), _in(num).alias("num_pop"), _in(den).alias("den_pop")
    )
    share = F.coalesce(_pct(F.col("num_pop"), F.col("den_pop")), F.lit(0.0))
    return (
        areas.where(F.col("_total") > 0)
        .select(code, "num_pop", "den_pop", share.alias("share_pct"), (share - national).alias("vs_national"))
    )


def extreme_shares(
    child: DataFrame,
    year: int,
    n: int = 20,
    min_pop: float = 10_000,
    desc: bool = True,
    code: str = "epci_code",
    num: tuple[int, int] = STUDENT,
    den: tuple[int, int] = YOUNG,
) -> DataFrame:
    """The ``n`` areas with the highest (or lowest) share, among large enough ones."""
    areas = (
        read_level(child, [code, "age"], year, code)
        .groupBy(code)
        .agg(F.sum("pop").alias("_total"), _in(num).alias("num_pop"), _in(den).alias("den_pop"))
        .where(F.col("_total") > min_pop)
        .select(code, "num_pop", "den_pop", _pct(F.col("num_pop"), F.col("den_pop")).alias("share_pct"))
    )
    # Compared at nine decimals, so that sums added in another order tie alike.
    share = F.round("share_pct", 9)
    order = share.desc_nulls_last() if desc else share.asc_nulls_last()
    return areas.orderBy(order, code).limit(n)


def sex_ratio_diff(child: DataFrame, parent: DataFrame, year: int, code: str, by: str = "region_code") -> DataFrame:
    """Males per female of a child level against its parent."""

    def ratio(df, area, name):
        return (
            read_level(df, [by, "sex"], year, area)
            .groupBy(by)
            .agg(F.coalesce(F.try_divide(_of("male"), _of("female")), F.lit(0.0)).alias(name))
        )

    return (
        ratio(parent, by, "parent_ratio")
        .join(ratio(child, code, "_child"), by, "left")
        .withColumn("child_ratio", F.coalesce("_child", F.lit(0.0)))
        .select(by, "parent_ratio", "child_ratio", (F.col("child_ratio") - F.col("parent_ratio")).alias("diff"))
    )


def share_by_year(
    child: DataFrame,
    codes: Sequence[str],
    code: str = "epci_code",
    num: tuple[int, int] = STUDENT,
    den: tuple[int, int] = YOUNG,
) -> DataFrame:
    """Share per year of the listed areas, next to the share over all areas."""
    rows = read_level(child, ["year", code, "age"]).where(age_window(F.col("age"), *den))

    def share(df, keys):
        sums = df.groupBy(*keys).agg(_in(num).alias("num_pop"), _in(den).alias("den_pop"))
        return sums.withColumn("share_pct", _pct(F.col("num_pop"), F.col("den_pop")))

    national = share(rows, ["year"]).select("year", F.col("share_pct").alias("national_pct"))
    return (
        share(rows.where(F.col(code).isin(list(codes))), ["year", code])
        .join(national, "year")
        .select("year", code, "num_pop", "den_pop", "share_pct", "national_pct")
        .withColumn("delta", F.col("share_pct") - F.col("national_pct"))
    )


def share_pivot(shares: DataFrame, codes: Sequence[str], code: str = "epci_code") -> DataFrame:
    """One row per year, one column per listed area."""
    return shares.groupBy("year", "national_pct").pivot(code, list(codes)).agg(F.first("share_pct"))


def drift_summary(shares: DataFrame, code: str = "epci_code", limit: float = 1.0) -> DataFrame:
    """How far each area's share moves over the years; areas seen once drop out."""
    return (
        shares.groupBy(code)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("year").alias("first_year"),
            F.max("year").alias("last_year"),
            F.min_by("share_pct", "year").alias("first_share"),
            F.max_by("share_pct", "year").alias("last_share"),
            (F.max("share_pct") - F.min("share_pct")).alias("drift_pp"),
        )
        .where(F.col("_n") > 1)
        .drop("_n")
        .withColumn("flag", F.col("drift_pp") > limit)
    )


# -- areas against EPCIs, departments and the census -------------------------


def level_coverage(iris: DataFrame, epci: DataFrame, year: int) -> DataFrame:
    """One row: EPCIs and persons the area level carries of the EPCI level."""

    totals = [F.count("epci_code").alias("epcis"), F.sum("pop").alias("pop")]
    areas = single(read_level(iris, ["epci_code"], year, "iris_code"), *totals)
    return (
        read_level(epci, ["epci_code"], year, "epci_code")
        .agg(*totals)
        .withColumn("_areas", areas)
        .select(
            F.col("epcis").alias("epci_epcis"),
            F.col("pop").alias("epci_pop"),
            F.col("_areas.epcis").alias("iris_epcis"),
            F.col("_areas.pop").alias("iris_pop"),
        )
        .withColumn("coverage_pct", _pct(F.col("iris_pop"), F.col("epci_pop")))
    )


def level_gap(iris: DataFrame, epci: DataFrame, year: int, tolerance: float = 0.01, n: int = 20) -> DataFrame:
    """EPCIs whose areas add up to something else, over the cells both sides have."""
    keys = ["epci_code", "department_code", "age", "sex"]
    ours = read_level(iris, keys, year, "iris_code").withColumnRenamed("pop", "_iris")
    theirs = read_level(epci, keys, year, "epci_code").withColumnRenamed("pop", "_epci")
    gaps = (
        ours.join(theirs, keys)
        .groupBy("epci_code")
        .agg(F.sum("_iris").alias("iris_pop"), F.sum("_epci").alias("epci_pop"))
        .withColumn("coverage_pct", _pct(F.col("iris_pop"), F.col("epci_pop")))
    )
    gap = F.abs(F.try_divide("iris_pop", "epci_pop") - 1)
    return gaps.where(gap > tolerance).orderBy(F.round(gap, 9).desc(), "epci_code").limit(n)


def dept_coverage(iris: DataFrame, department: DataFrame, year: int, n: int = 20, desc: bool = False) -> DataFrame:
    """Departments least (or most) covered by areas."""
    keys = ["department_code", "age", "sex"]
    parts = read_level(iris, keys, year, "iris_code").withColumnRenamed("pop", "_iris")
    covered = (
        read_level(department, keys, year, "department_code")
        .join(parts, keys, "left")
        .groupBy("department_code")
        .agg(F.sum("pop").alias("dept_pop"), F.sum("_iris").alias("iris_pop"))
        .withColumn("coverage_pct", _pct(F.col("iris_pop"), F.col("dept_pop")))
    )
    share = F.round("coverage_pct", 9)
    order = share.desc_nulls_last() if desc else share.asc_nulls_last()
    return covered.orderBy(order, "department_code").limit(n)


def census_areas(base: DataFrame, ages: tuple[int, int] = YOUNG) -> DataFrame:
    """Census persons per area, age and sex; an unknown sex counts as female here."""
    iris = F.col("iris_code")
    return (
        base.where(age_window(F.col("age"), *ages) & iris.isNotNull() & (iris != "") & (iris != NO_GEO))
        .groupBy("iris_code", "age", F.coalesce("sex", F.lit("female")).alias("sex"))
        .agg(F.sum("population").alias("census_pop"))
    )


def _our_areas(iris: DataFrame, year: int, ages: tuple[int, int] = YOUNG) -> DataFrame:
    rows = read_level(iris, ["iris_code", "department_code", "age", "sex"], year, "iris_code")
    return rows.where(age_window(F.col("age"), *ages)).withColumnRenamed("pop", "our_pop")


def code_match(iris: DataFrame, census: DataFrame, year: int) -> DataFrame:
    """One row: area codes in both, only in the estimates, only in the census."""
    ours = _our_areas(iris, year).select("iris_code").distinct().withColumn("_ours", F.lit(1))
    theirs = census.select("iris_code").distinct().withColumn("_census", F.lit(1))
    return ours.join(theirs, "iris_code", "full").agg(
        F.count_if(F.col("_ours").isNotNull() & F.col("_census").isNotNull()).alias("matched"),
        F.count_if(F.col("_census").isNull()).alias("only_ours"),
        F.count_if(F.col("_ours").isNull()).alias("only_census"),
    )


def census_diff(
    iris: DataFrame, census: DataFrame, year: int, departments: Sequence[str] | None = None
) -> DataFrame:
    """Persons per department against the census persons of the same area, age and sex."""
    ours = _our_areas(iris, year)
    if departments is not None:
        ours = ours.where(F.col("department_code").isin(list(departments)))
    return (
        ours.join(census, ["iris_code", "age", "sex"], "left")
        .groupBy("department_code")
        .agg(F.sum("our_pop").alias("our_pop"), F.coalesce(F.sum("census_pop"), F.lit(0.0)).alias("census_pop"))
        .where(F.col("our_pop") != 0)
        .withColumn("diff_pct", _pct(F.col("our_pop") - F.col("census_pop"), F.col("census_pop")))
    )


def outliers(iris: DataFrame, census: DataFrame, year: int, min_pop: float = 100, n: int = 15) -> DataFrame:
    """Areas furthest from the census, among those it counts enough persons in."""
    areas = (
        _our_areas(iris, year)
        .join(census, ["iris_code", "age", "sex"])
        .groupBy("iris_code", "department_code")
        .agg(F.sum("our_pop").alias("our_pop"), F.sum("census_pop").alias("census_pop"))
        .where(F.col("census_pop") > min_pop)
        .withColumn("abs_diff", F.abs(F.col("our_pop") - F.col("census_pop")))
        .withColumn("pct_diff", _pct(F.col("our_pop") - F.col("census_pop"), F.col("census_pop")))
    )
    return areas.orderBy(F.round("abs_diff", 6).desc(), "iris_code", "department_code").limit(n)


# -- enrolment ---------------------------------------------------------------


def enrolment_by_epci(enrolment: DataFrame, lookup: DataFrame) -> DataFrame:
    """Enrolled students per EPCI and department of the commune."""
    places = lookup.select(F.col("commune_code").alias("com_id"), "epci_code", "department_code")
    return enrolment.join(places, "com_id").groupBy("epci_code", "department_code").agg(
        F.sum("enrolled").alias("enrolled")
    )


def enrolment_match(enrolment: DataFrame, lookup: DataFrame) -> DataFrame:
    """One row: students whose commune belongs to an EPCI."""
    matched = enrolment_by_epci(enrolment, lookup).agg(
        F.countDistinct("epci_code").alias("n_epcis"), F.sum("enrolled").alias("matched")
    )
    return matched.withColumn("enrolled", single(enrolment, F.sum("enrolled"))).withColumn(
        "matched_pct", _pct(F.col("matched").cast("double"), F.col("enrolled"))
    )


def _students(level: DataFrame, year: int, ages: tuple[int, int] = STUDENT) -> DataFrame:
    rows = read_level(level, ["epci_code", "age"], year, "epci_code").where(age_window(F.col("age"), *ages))
    return rows.groupBy("epci_code").agg(F.sum("pop").alias("pop_20_24"))


def enrolment_ratio(
    enrolment: DataFrame,
    lookup: DataFrame,
    level: DataFrame,
    year: int,
    codes: Sequence[str] | None = None,
    low: float = 10,
    high: float = 100,
) -> DataFrame:
    """Enrolled students per 100 persons of 20-24 in each EPCI, with a flag out of bounds."""
    areas = _students(level, year)
    if codes is not None:
        areas = areas.where(F.col("epci_code").isin(list(codes)))
    students = (
        enrolment_by_epci(enrolment, lookup).groupBy("epci_code").agg(F.sum("enrolled").alias("_enrolled"))
    )
    ratio = F.col("ratio_pct")
    return (
        areas.where(F.col("pop_20_24") != 0)
        .join(students, "epci_code", "left")
        .withColumn("enrolled", F.coalesce("_enrolled", F.lit(0)))
        .withColumn("ratio_pct", _pct(F.col("enrolled").cast("double"), F.col("pop_20_24")))
        .withColumn("flag", F.when(ratio > high, F.lit("high")).when(ratio < low, F.lit("low")).otherwise(F.lit("")))
        .select("epci_code", "enrolled", "pop_20_24", "ratio_pct", "flag")
    )


def enrolment_national(enrolment: DataFrame, lookup: DataFrame, level: DataFrame, year: int) -> DataFrame:
    """One row: matched students against persons of 20-24 and 15-24."""
    ages = read_level(level, ["age"], year, "epci_code").agg(
        _in(STUDENT).alias("pop_20_24"), _in(YOUNG).alias("pop_15_24")
    )
    matched = single(enrolment_by_epci(enrolment, lookup), F.coalesce(F.sum("enrolled"), F.lit(0)))
    return ages.withColumn("enrolled", matched).withColumn(
        "ratio_pct", _pct(F.col("enrolled").cast("double"), F.col("pop_20_24"))
    )


def top_enrolment(
    enrolment: DataFrame, lookup: DataFrame, level: DataFrame, year: int, min_pop: float = 5_000, n: int = 20
) -> DataFrame:
    """Highest enrolment ratios among large EPCIs.

    Students are counted per EPCI and department but persons per EPCI, so an EPCI
    over two departments appears once for each.
    """
    ratio = _pct(F.col("enrolled").cast("double"), F.col("pop_20_24"))
    return (
        enrolment_by_epci(enrolment, lookup)
        .join(_students(level, year).where(F.col("pop_20_24") > min_pop), "epci_code")
        .select("epci_code", "department_code", "enrolled", "pop_20_24", ratio.alias("ratio_pct"))
        .orderBy(F.round("ratio_pct", 9).desc(), "epci_code", "department_code")
        .limit(n)
    )


def distinct_values(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """All values of a column in order, or the first ``n``, for diagnosis."""
    values = df.select(column).distinct().orderBy(column)
    return values if n is None else values.limit(n)
