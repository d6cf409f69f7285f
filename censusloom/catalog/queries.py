"""Every operator as a named query over the driver's tables.

Doubles are rounded at the very end, so that results of engines that add in
another order compare equal; no operator rounds. A billionth is added first:
values such as 0.0640625 lie halfway between two roundings, and engines settle
such ties differently.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censusloom import functions as fn
from censusloom.catalog.testbed import CENSUS_YEAR, EXCLUDED, WINDOW, Testbed
from censusloom.config import Config, Territory
from censusloom.operators import base as base_ops
from censusloom.operators import births as birth_ops
from censusloom.operators import mobility, projection, quality, reconcile, shares
from censusloom.operators.disaggregate import disaggregate, expand_birth_month
from censusloom.plans.build import Inputs, build_levels
from censusloom.plans.storage import run_folder
from censusloom.sinks.export import export_levels, write_level
from censusloom.sinks.metrics import LevelMetrics, observed_level_stats, observed_validation
from censusloom.sources import (
    commune_lookup,
    estimates_long,
    expand_bands,
    pyramid_unpivot,
    read_birth_months,
    read_census,
    read_cog,
    read_commune_records,
    read_enrolment,
    read_flows,
    read_level,
    read_pyramid_csv,
    read_semicolon,
)
from censusloom.sources.external import DEGREE_GROUPS

YEAR = 2024
MONTHLY = replace(WINDOW, monthly=True)
ALL_AGES = replace(WINDOW, min_age=0, max_age=110)
# Compared to twelve digits; everything else is a number of persons, compared to six.
RATIOS = (
    "geo_ratio", "study_geo_ratio", "month_ratio", "dept_share", "mobility_rate", "blend_weight", "intra_frac", "ratio_sum",
    "mean_stddev", "vs_january", "change", "decimal_age", "confidence_pct",
)
PIVOT_CODES = ("E0_0", "E3_1", "E7_2", "E11_3")
LEVEL_KEYS = ["year", "month", "department_code", "age", "sex"]

# Appended territories of the test tables: code, pyramid (a customer segment), census year.
TERRITORY_SEGMENTS = {
    "976": "BUILDING",
    "986": "MACHINERY",
    "987": "FURNITURE",
    "988": "HOUSEHOLD",
    "975": "AUTOMOBILE",
}

_REGISTRY: dict[str, Callable[[Testbed], DataFrame]] = {}
_CONFIGS: dict[str, Config] = {}


def query(name: str, cfg: Config = WINDOW):
    def register(f):
        _REGISTRY[name], _CONFIGS[name] = f, cfg
        return f

    return register


def rounded(df: DataFrame) -> DataFrame:
    def one(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.DoubleType):
            return value
        return (F.round(value, 12) if field.name in RATIOS else F.round(value + 1e-9, 6)).alias(field.name)

    return df.select(*[one(f) for f in df.schema.fields])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name):
        return lambda spark, sf_dir: rounded(_REGISTRY[name](Testbed(spark, sf_dir, _CONFIGS[name])))

    return {name: bind(name) for name in _REGISTRY}


# -- sources -----------------------------------------------------------------


@query("census_scan")
def _(b):
    """S1: raw columns, profiled per department code as published."""
    census = read_census(b.spark, b.file(b.census, "parquet"))
    return census.groupBy("DEPT", "REGION", "SEXE").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(fn.weight(F.col("IPONDI"))).alias("weight"),
        F.count_if(F.col("ANAI").isNull()).alias("no_birth_year"),
    )


@query("census_scan_years")
def _(b):
    """S1 over two years' files that differ in the order, case and number of their columns."""
    early, late = b.census.where("SEXE = '1'"), b.census.where("SEXE IS NULL OR SEXE <> '1'")
    early = early.select(*[F.col(c).alias(c.lower()) for c in sorted(early.columns) if c != "CANTVILLE"])
    late = late.select(F.lit("x").alias("UNUSED"), *late.columns)
    census = read_census(b.spark, [b.file(early, "parquet"), b.file(late, "parquet")])
    return census.groupBy("DEPT", "REGION", "SEXE").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(fn.weight(F.col("IPONDI"))).alias("weight"),
        F.count_if(F.col("CANTVILLE").isNull()).alias("no_canton"),
    )


@query("birth_record_scan")
def _(b):
    """S2."""
    return (
        read_birth_months(b.birth_records)
        .groupBy("department_code", "region_code", "month")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight"))
    )


@query("flow_cells")
def _(b):
    """S3, F2, F9: the commuting file as cells."""
    return mobility.flow_cells(read_flows(b.spark, b.file(b.flows, "parquet")))


@query("commune_lookup")
def _(b):
    """S4, of one record per line."""
    return commune_lookup(read_commune_records(b.spark, b.file(b.commune_records, "json"), lines=True))


@query("commune_reference")
def _(b):
    """S5."""
    published = b.cog.select(F.col("commune_code").alias("COM"), F.col("department_code").alias("DEP"), F.col("canton_code").alias("CAN"))
    return read_cog(b.spark, b.file(published, "csv", header=True))


@query("pyramid_csv")
def _(b):
    """S6."""
    path = b.file(b.pyramid_csv, "csv", header=True, sep=";", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rows = read_pyramid_csv(read_semicolon(b.spark, path), 2019)
    return rows.groupBy("age", "sex").agg(F.count(F.lit(1)).alias("n"), F.sum("population").alias("population"))


@query("reference_pyramid")
def _(b):
    """S7."""
    return b.reference.groupBy("year", "region_code", "age", "sex").agg(F.sum("pop").alias("pop"))


@query("enrolment")
def _(b):
    """S8, all courses."""
    return read_enrolment(read_semicolon(b.spark, b.file(b.enrolment_rows, "csv", header=True, sep=";")), 2022)


@query("enrolment_degrees")
def _(b):
    """S8, bachelor and master courses."""
    return read_enrolment(b.enrolment_rows, 2022, DEGREE_GROUPS)


@query("level_scan")
def _(b):
    """S9."""
    return read_level(b.level("epci"), ["year", "epci_code", "age"], YEAR, "epci_code")


@query("estimates_long")
def _(b):
    """S10."""
    return estimates_long(b.estimates_wide)


# -- base cells and territories ------------------------------------------------


@query("base_population")
def _(b):
    """F1-F6, B1."""
    return b.base_cells


@query("territory_filter")
def _(b):
    """F7."""
    from censusloom.sources.microdata import in_scope

    # rpad keeps the published three-character codes
    kept = in_scope(b.census, b.cfg, extra=[f"{c} " for c in EXCLUDED])
    return base_ops.base_population(kept, CENSUS_YEAR).groupBy("department_code").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("population").alias("population")
    )


@query("age_band_totals")
def _(b):
    """F8."""
    band = fn.age_band(F.col("age"))
    return b.base_cells.groupBy("department_code", band.alias("age_band"), "sex").agg(
        F.sum("population").alias("population")
    )


@query("masked_iris_fallback")
def _(b):
    """F10, F14."""
    iris = F.col("iris_code")
    return b.base_cells.groupBy(fn.iris_or_commune(iris).alias("area"), fn.usable_iris(iris).alias("usable")).agg(
        F.sum("population").alias("population")
    )


@query("pyramid_unpivot")
def _(b):
    """B2."""
    return pyramid_unpivot(b.sheet)


@query("bands_from_labels")
def _(b):
    """B4."""
    return b.bands


@query("expand_bands")
def _(b):
    """B3."""
    return expand_bands(b.bands, 80)


@query("age_forward_reject")
def _(b):
    """B5: a census older than the base year."""
    return base_ops.age_forward(
        b.territory_pyramid("BUILDING"), Territory("976", "06", "9799", 2017, accept_newer=False), CENSUS_YEAR
    )


@query("age_forward_floor")
def _(b):
    """B6: a census newer than the base year is taken as it is."""
    return base_ops.age_forward(
        b.territory_pyramid("MACHINERY"), Territory("986", "98", "9869", 2023), CENSUS_YEAR
    )


@query("append_territories")
def _(b):
    """B7, B8."""
    pyramids = {code: b.territory_pyramid(segment) for code, segment in TERRITORY_SEGMENTS.items()}
    grown = base_ops.append_territories(b.base_cells, pyramids, CENSUS_YEAR)
    return grown.groupBy("department_code", "region_code", "age").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("population").alias("population")
    )


@query("canton_weights")
def _(b):
    """B9."""
    return base_ops.canton_weights(b.cog, b.lookup)


# -- birth months --------------------------------------------------------------


@query("birth_month_own")
def _(b):
    """M1, M3."""
    big = birth_ops.big_groups(b.birth_cells, b.departments, b.big_department)
    cells = b.birth_cells.join(big, "department_code", "left_semi")
    return birth_ops.month_shares(cells, ["department_code", "month"], ["department_code"])


@query("birth_month_region")
def _(b):
    """M1 within regions, pooled records included."""
    return birth_ops.month_shares(b.birth_cells, ["region_code", "month"], ["region_code"])


@query("birth_month_national")
def _(b):
    """M2."""
    return birth_ops.month_shares(b.birth_cells, ["month"])


@query("birth_month_all")
def _(b):
    """M4."""
    return b.births


# -- shares ----------------------------------------------------------------------


@query("geo_ratio_epci")
def _(b):
    """G1, G4."""
    return b.ratios("epci")


@query("geo_ratio_iris")
def _(b):
    """G2."""
    return b.ratios("iris")


@query("geo_ratio_canton")
def _(b):
    """G3."""
    return b.ratios("canton")


@query("fallback_departments")
def _(b):
    """G5."""
    return shares.fallback_departments(b.base, shares.epci_population(b.base, b.lookup))


@query("ratio_sizes")
def _(b):
    """G6."""
    sizes = [
        shares.ratio_size(b.ratios(level), f"{level}_code").withColumn("level", F.lit(level))
        for level in ("epci", "canton", "iris")
    ]
    return fn.union_all(sizes)


# -- mobility ----------------------------------------------------------------------


@query("mobility_rates")
def _(b):
    """Y1, Y2."""
    return b.mobility.rates


@query("mobility_weights")
def _(b):
    """Y3."""
    return mobility.mobility_weights(b.mobility.rates, b.base)


@query("student_flows_epci")
def _(b):
    """Y4, Y10."""
    return b.mobility.to_epci


@query("iris_commune_share")
def _(b):
    """Y5."""
    return mobility.iris_commune_share(b.base, b.lookup)


@query("student_flows_iris")
def _(b):
    """Y6."""
    return b.mobility.to_iris


@query("blend_epci")
def _(b):
    """Y7."""
    return b.blended_epci


@query("intra_fraction")
def _(b):
    """Y8."""
    return b.mobility.intra


@query("blend_iris")
def _(b):
    """Y9."""
    return b.blended_iris


# -- projection ----------------------------------------------------------------------


@query("census_departments")
def _(b):
    """J1."""
    return b.census_departments


@query("cohort_totals")
def _(b):
    """J4."""
    return projection.cohort_totals(b.census_departments)


@query("dept_age_shares")
def _(b):
    """J5."""
    census = b.census_departments
    return projection.dept_age_shares(census, projection.cohort_totals(census))


@query("project_aging")
def _(b):
    """J2, J3, J10, J11, F11, F13."""
    return projection.project(b.census_departments, replace(b.cfg, method="cohort-aging"))


@query("project_stable")
def _(b):
    """J6."""
    return projection.project(b.census_departments, replace(b.cfg, method="cohort-stable"))


@query("project_estimates")
def _(b):
    """J7, J8."""
    return projection.project(b.census_departments, b.cfg, b.estimates)


@query("project_monthly", MONTHLY)
def _(b):
    """J9."""
    return projection.project(b.census_departments, b.cfg, b.estimates, b.births_table)


@query("uncovered_cells", replace(WINDOW, min_age=0, max_age=110))
def _(b):
    """J15."""
    return projection.uncovered_cells(b.spark, b.stable, b.cfg)


@query("disaggregate_epci")
def _(b):
    """J12."""
    return b.level("epci")


@query("disaggregate_canton")
def _(b):
    """J13."""
    return b.level("canton")


@query("disaggregate_iris")
def _(b):
    """J14, over every age, sex and snapshot; listed per area and year."""
    return (
        b.level("iris")
        .groupBy("year", "department_code", "region_code", "epci_code", "commune_code", "iris_code", "confidence_pct")
        .agg(
            F.count(F.lit(1)).alias("cells"),
            F.sum("population").alias("population"),
            F.sum("population_low").alias("population_low"),
            F.sum("population_high").alias("population_high"),
        )
    )


def _by_band(df, level):
    return (
        df.groupBy("year", f"{level}_code", fn.age_band(F.col("age")).alias("age_band"))
        .agg(F.count(F.lit(1)).alias("cells"), F.sum("population").alias("population"))
    )


@query("all_ages_epci", ALL_AGES)
def _(b):
    """J12 over all twenty bands."""
    return _by_band(b.level("epci"), "epci")


@query("all_ages_canton", ALL_AGES)
def _(b):
    """J13 over all twenty bands."""
    return _by_band(b.level("canton"), "canton")


@query("all_ages_iris", ALL_AGES)
def _(b):
    """J14 over all twenty bands."""
    return _by_band(b.level("iris"), "iris")


def _monthly(b, level):
    rows = expand_birth_month(b.level(level), b.births_table, level)
    return rows.groupBy("year", "month", "department_code").agg(F.count(F.lit(1)).alias("cells"), F.sum("population").alias("population"))


@query("monthly_epci", MONTHLY)
def _(b):
    """J12, J16: 144 rows per cell, a birth month for every snapshot month."""
    return _monthly(b, "epci")


@query("monthly_iris", MONTHLY)
def _(b):
    """J14, J16 in monthly mode."""
    return _monthly(b, "iris")


@query("disaggregate_blended")
def _(b):
    """J12 after the mobility correction."""
    return disaggregate(b.parent, b.blended_epci, "epci")


@query("expand_birth_month")
def _(b):
    """J16."""
    return expand_birth_month(b.stable, b.births_table, "department")


@query("expand_birth_month_iris")
def _(b):
    """J16 at the finest level, listed per area and birth month."""
    rows = expand_birth_month(b.level("iris"), b.births_table, "iris")
    return rows.groupBy("department_code", "iris_code", "birth_month").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("population").alias("population")
    )


@query("yearly_downsample", MONTHLY)
def _(b):
    """F12."""
    return (
        b.stable.where(fn.january(F.col("month")))
        .groupBy("year", "department_code")
        .agg(F.count(F.lit(1)).alias("cells"), F.sum("population").alias("population"))
    )


@query("full_build")
def _(b):
    """J17: the whole run with anchoring, territories and mobility, listed per level."""
    return _listed(build_levels(_inputs(b), b.cfg))


@query("resumed_build")
def _(b):
    """J17 twice on the same inputs: the second run finds the first one's tables and scans no microdata."""
    build_levels(_inputs(b), b.cfg, resume=True)
    return _listed(build_levels(_inputs(b), b.cfg, resume=True))


def _inputs(b) -> Inputs:
    return Inputs(
        census=b.census,
        birth_records=b.birth_records,
        lookup=commune_lookup(b.commune_records),
        departments=b.departments,
        flows=b.flows,
        estimates=b.estimates,
        pyramids={code: b.territory_pyramid(segment) for code, segment in TERRITORY_SEGMENTS.items()},
    )


def _listed(built) -> DataFrame:
    return fn.union_all(
        [
            df.groupBy(F.lit(level).alias("level"), "year", "department_code", "region_code").agg(
                F.count(F.lit(1)).alias("cells"), F.sum("population").alias("population")
            )
            for level, df in built.levels.items()
        ]
    )


# -- sinks ------------------------------------------------------------------------------


@query("write_level")
def _(b):
    """K1, K4: written and read back, all years."""
    path = write_level(b.level("epci"), b.births_table, "epci", f"{_export_folder(b.spark)}/population_epci")
    back = b.spark.read.parquet(path)
    return back.groupBy("year", "epci_code", "department_code", "birth_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("population").alias("population")
    )


@query("export_levels", MONTHLY)
def _(b):
    """K2, K3: department monthly, cantons yearly."""
    folder = _export_folder(b.spark)
    levels = {level: b.level(level) for level in ("department", "canton")}
    paths = export_levels(levels, b.births_table, folder, list(levels), ["canton"])
    return fn.union_all(
        [
            b.spark.read.parquet(path)
            .groupBy(F.lit(level).alias("level"), "year", "month")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("population").alias("population"))
            for level, path in paths.items()
        ]
    )


@query("rewrite_year")
def _(b):
    """K1, K4: one year of a published level is written anew, the others stay."""
    path = f"{_export_folder(b.spark)}/population_canton"
    cantons = b.level("canton")
    write_level(cantons, b.births_table, "canton", path)
    doubled = cantons.where("year = 2024").withColumn("population", 2 * F.col("population"))
    write_level(doubled, b.births_table, "canton", path, replace=False)
    back = b.spark.read.parquet(path)
    return back.groupBy("year", "canton_code").agg(F.count(F.lit(1)).alias("n"), F.sum("population").alias("population"))


@query("export_stats")
def _(b):
    """K2, Q6: the figures of an export, observed while its levels are written."""
    return observed_level_stats(b.spark, _exported(b))


@query("export_validation")
def _(b):
    """K2, Q2, Q3: checks of an export, observed while its levels are written."""
    return observed_validation(b.spark, _exported(b))


def _exported(b) -> dict[str, LevelMetrics]:
    metrics: dict[str, LevelMetrics] = {}
    levels = {level: b.level(level) for level in ("department", "epci", "canton")}
    export_levels(levels, b.births_table, _export_folder(b.spark), list(levels), metrics=metrics)
    return metrics


def _export_folder(spark: SparkSession) -> str:
    return f"{run_folder(spark)}/{uuid.uuid4().hex}"


# -- quality -----------------------------------------------------------------------------


@query("row_count")
def _(b):
    """Q1."""
    return quality.row_count(b.base_cells)


@query("validation_stats")
def _(b):
    """Q2."""
    return quality.validation_stats(b.base_cells)


@query("invalid_rows")
def _(b):
    """Q3."""
    return quality.invalid_rows(b.base_cells)


@query("department_coverage")
def _(b):
    """Q4."""
    return quality.department_coverage(b.base_cells, b.expected)


@query("validate")
def _(b):
    """Q5."""
    return quality.validate(b.base, b.expected)


@query("level_stats")
def _(b):
    """Q6."""
    return quality.level_stats({level: b.level(level) for level in ("department", "epci", "canton", "iris")})


@query("level_summary")
def _(b):
    """Q7."""
    return quality.level_summary(b.level("canton"), "canton_code")


@query("null_audit")
def _(b):
    """Q8."""
    return quality.null_audit(b.base_cells, ["department_code", "iris_code", "sex", "age", "population"])


@query("share_sum_audit")
def _(b):
    """Q9, after blending."""
    return quality.share_sum_audit(b.blended_epci, ["department_code", "age_band", "sex"])


@query("child_parent_epci")
def _(b):
    """Q10, EPCI within 5 %."""
    return quality.child_parent(b.level("epci"), b.parent, LEVEL_KEYS, 0.95, 1.05)


@query("child_parent_iris")
def _(b):
    """Q10, areas at most 1 % above."""
    return quality.child_parent(b.level("iris"), b.parent, LEVEL_KEYS, None, 1.01)


@query("coverage_by_department")
def _(b):
    """Q10, coverage of each department by its finer levels."""
    return quality.coverage_by_department(b.parent, b.level("epci"), b.level("iris"))


@query("yoy_change")
def _(b):
    """Q11."""
    return quality.yoy_change(b.stable)


@query("bounds")
def _(b):
    """Q12."""
    return quality.bounds(b.stable, 60_000, 600, 12_000)


@query("relative_bounds")
def _(b):
    """Q12 with limits that follow the data: by department, from a mergeable sketch of quantiles."""
    return quality.relative_bounds(b.stable, "department_code")


@query("snapshot_stock", MONTHLY)
def _(b):
    """Q13."""
    return quality.snapshot_stock(b.stable)


@query("share_concentration")
def _(b):
    """Q14, before and after blending."""
    before = quality.concentration(b.ratios("epci"), "20_24").withColumn("stage", F.lit("census"))
    after = quality.concentration(b.blended_epci, "20_24").withColumn("stage", F.lit("corrected"))
    return before.unionByName(after)


@query("precision_split")
def _(b):
    """Q15, with some cells estimated."""
    known = F.when(F.col("age") >= 18, F.lit("exact")).otherwise(F.lit("estimated"))
    return quality.precision_split(b.level("epci").withColumn("geo_precision", known))


@query("single_snapshot", MONTHLY)
def _(b):
    """Q16, on a monthly build, where every cell has more than one."""
    return quality.single_snapshot(b.stable)


# -- reconciliation ------------------------------------------------------------------------


@query("region_rollup")
def _(b):
    """R1."""
    return reconcile.region_rollup(b.stable, YEAR)


@query("region_diff")
def _(b):
    """R2."""
    return reconcile.region_diff(b.stable, b.reference, YEAR, b.ages)


@query("subband_shares")
def _(b):
    """R3."""
    return reconcile.subband_shares(b.stable, b.reference, YEAR, ages=b.ages)


@query("sex_ratio")
def _(b):
    """R4."""
    return reconcile.sex_ratio(b.stable, b.reference, YEAR, b.ages)


@query("year_drift")
def _(b):
    """R5."""
    return reconcile.year_drift(b.parent, b.reference, b.ages)


@query("epci_coverage")
def _(b):
    """R6."""
    return reconcile.coverage(b.level("epci"), b.parent, YEAR, "epci_code")


@query("band_share_vs_national")
def _(b):
    """R7."""
    return reconcile.band_share(b.level("epci"), b.parent, YEAR)


@query("top20_share")
def _(b):
    """R8."""
    return reconcile.extreme_shares(b.level("epci"), YEAR, 20, 100.0, True)


@query("bottom20_share")
def _(b):
    """R8."""
    return reconcile.extreme_shares(b.level("epci"), YEAR, 20, 100.0, False)


@query("sex_ratio_diff")
def _(b):
    """R9."""
    return reconcile.sex_ratio_diff(b.level("epci"), b.parent, YEAR, "epci_code")


@query("share_by_year")
def _(b):
    """R10, before the pivot."""
    return reconcile.share_by_year(b.level("epci"), PIVOT_CODES)


@query("share_pivot")
def _(b):
    """R10."""
    return reconcile.share_pivot(reconcile.share_by_year(b.level("epci"), PIVOT_CODES), PIVOT_CODES)


@query("drift_summary")
def _(b):
    """R11."""
    return reconcile.drift_summary(reconcile.share_by_year(b.level("epci"), PIVOT_CODES))


@query("iris_level_coverage")
def _(b):
    """R12."""
    return reconcile.level_coverage(b.level("iris"), b.level("epci"), YEAR)


@query("iris_epci_gap")
def _(b):
    """R13."""
    return reconcile.level_gap(b.level("iris"), b.level("epci"), YEAR)


@query("iris_dept_coverage")
def _(b):
    """R14, least covered."""
    return reconcile.dept_coverage(b.level("iris"), b.parent, YEAR)


@query("iris_dept_coverage_top")
def _(b):
    """R14, most covered."""
    return reconcile.dept_coverage(b.level("iris"), b.parent, YEAR, 10, True)


@query("code_match_rate")
def _(b):
    """R15."""
    return reconcile.code_match(b.level("iris"), reconcile.census_areas(b.base), CENSUS_YEAR)


@query("census_diff")
def _(b):
    """R16."""
    return reconcile.census_diff(b.level("iris"), reconcile.census_areas(b.base), CENSUS_YEAR)


@query("iris_outliers")
def _(b):
    """R17."""
    return reconcile.outliers(b.level("iris"), reconcile.census_areas(b.base), CENSUS_YEAR, 10.0)


@query("enrolment_match")
def _(b):
    """R18, matched part."""
    return reconcile.enrolment_match(read_enrolment(b.enrolment_rows, 2022), b.lookup)


@query("enrolment_ratio")
def _(b):
    """R18, per EPCI."""
    return reconcile.enrolment_ratio(read_enrolment(b.enrolment_rows, 2022), b.lookup, b.level("epci"), CENSUS_YEAR)


@query("enrolment_national")
def _(b):
    """R18, all."""
    return reconcile.enrolment_national(
        read_enrolment(b.enrolment_rows, 2022), b.lookup, b.level("epci"), CENSUS_YEAR
    )


@query("top_enrolment")
def _(b):
    """R19."""
    enrolment = read_enrolment(b.enrolment_rows, 2022, DEGREE_GROUPS)
    return reconcile.top_enrolment(enrolment, b.lookup, b.level("epci"), CENSUS_YEAR, 100.0)


@query("distinct_groups")
def _(b):
    """R20."""
    return reconcile.distinct_values(b.enrolment_rows.where("annee_universitaire = '2022-23'"), "regroupement")


@query("preview_rows")
def _(b):
    """K5: any ten rows, so their number is compared, and how many of them are rows of the level."""
    from censusloom.sinks.export import preview

    rows = b.level("epci")
    shown = preview(rows).select("year", "epci_code", "age", "sex", "population")
    same = shown.join(rows.select(*shown.columns), shown.columns, "left_semi")
    return shown.agg(F.count(F.lit(1)).alias("n")).withColumn("members", fn.single(same, F.count(F.lit(1))))

