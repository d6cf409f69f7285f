"""Student mobility: where students of a department study, blended into area shares.

The commuting file is scanned once, into ``flow_cells``. Everything else here
works on those cells.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusloom.config import STUDENT_BANDS, StudentBand
from censusloom.functions import (
    clean_code,
    decode_sex,
    department_of,
    safe_ratio,
    share_within,
    usable_iris,
    weight,
)

ORIGIN = ["age_band", "department_code", "sex"]


def band_roles(spark: SparkSession, bands: Iterable[StudentBand] = STUDENT_BANDS) -> DataFrame:
    """Which bands an age group feeds, as main or as secondary group (a few literal rows)."""
    rows = []
    for b in bands:
        rows.append((b.age_group, b.age_band, True, b.secondary_weight))
        if b.secondary_group and b.secondary_weight > 0:
            rows.append((b.secondary_group, b.age_band, False, b.secondary_weight))
    return spark.createDataFrame(rows, "age_group string, age_band string, is_main boolean, secondary_weight double")


def flow_cells(flows: DataFrame) -> DataFrame:
    """Weight per residence department x study commune x age group x sex."""
    return (
        flows.select(
            department_of(clean_code(F.col("COMMUNE"))).alias("department_code"),
            clean_code(F.col("DCETUF")).alias("study_commune"),
            clean_code(F.col("AGEREV10")).alias("age_group"),
            decode_sex(F.col("SEXE")).alias("sex"),
            weight(F.col("IPONDI")).alias("weight"),
        )
        .groupBy("department_code", "study_commune", "age_group", "sex")
        .agg(F.sum("weight").alias("weight"))
    )


def _by_role(cells: DataFrame, roles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Main and secondary weights side by side, so mixing them needs no outer join."""
    return (
        cells.join(F.broadcast(roles), "age_group")
        .groupBy("age_band", "secondary_weight", *keys)
        .agg(
            F.sum(F.when(F.col("is_main"), F.col("weight"))).alias("main"),
            F.sum(F.when(~F.col("is_main"), F.col("weight"))).alias("secondary"),
        )
    )


def mobility_rates(cells: DataFrame, roles: DataFrame) -> DataFrame:
    """Share of students leaving their department, per band and department.

    A department without any main-group student has no rate. An unknown
    destination counts as staying.
    """
    main, leaves = F.col("is_main"), F.col("department_code") != department_of(F.col("study_commune"))
    total = F.col("weight")
    left = F.when(leaves, F.col("weight")).otherwise(F.lit(0.0))
    rates = (
        cells.join(F.broadcast(roles), "age_group")
        .groupBy("age_band", "department_code", "secondary_weight")
        .agg(
            F.count(F.when(main, F.lit(1))).alias("_n_main"),
            F.sum(F.when(main, total)).alias("_main"),
            F.sum(F.when(main, left)).alias("_main_left"),
            F.sum(F.when(~main, total)).alias("_secondary"),
            F.sum(F.when(~main, left)).alias("_secondary_left"),
        )
        .where(F.col("_n_main") > 0)
    )
    sw = F.col("secondary_weight")
    return rates.select(
        "age_band",
        "department_code",
        (
            (1.0 - sw) * safe_ratio(F.col("_main_left"), F.col("_main"))
            + sw * safe_ratio(F.col("_secondary_left"), F.col("_secondary"))
        ).alias("mobility_rate"),
    )


def mobility_weights(
    rates: DataFrame, base: DataFrame, bands: Iterable[StudentBand] = STUDENT_BANDS
) -> DataFrame:
    """Blend weight: the capped rate, or the band's (uncapped) default without one."""
    bands = list(bands)
    cap = F.create_map(*[F.lit(x) for b in bands for x in (b.age_band, b.cap)])
    defaults = F.array(
        *[F.struct(F.lit(b.age_band).alias("age_band"), F.lit(b.default).alias("blend_default")) for b in bands]
    )
    observed = rates.select(
        "age_band",
        "department_code",
        "mobility_rate",
        F.least(F.col("mobility_rate"), cap[F.col("age_band")]).alias("blend_weight"),
    )
    missing = (
        base.select("department_code")
        .distinct()
        .select("department_code", F.explode(defaults).alias("_b"))
        .select("department_code", "_b.age_band", "_b.blend_default")
        .join(rates.select("age_band", "department_code"), ["age_band", "department_code"], "left_anti")
        .select(
            "age_band",
            "department_code",
            F.col("blend_default").alias("mobility_rate"),
            F.col("blend_default").alias("blend_weight"),
        )
    )
    return observed.unionByName(missing)


def _mixed_share(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Share of its origin's students each row of ``df`` receives.

    The main and the secondary distribution are each divided by their total and
    mixed. Each sums to one, so the mix sums to the weight of the distributions
    an origin has, and dividing by that weight normalises without another pass.
    """
    sw = F.col("secondary_weight")
    mixed = (1.0 - sw) * F.coalesce(safe_ratio(F.col("main"), F.col("_main")), F.lit(0.0)) + sw * F.coalesce(
        safe_ratio(F.col("secondary"), F.col("_secondary")), F.lit(0.0)
    )
    present = (1.0 - sw) * F.when(F.col("_main") > 0, 1.0).otherwise(0.0) + sw * F.when(
        F.col("_secondary") > 0, 1.0
    ).otherwise(0.0)
    # A row for each band, department and sex.
    return df.join(F.broadcast(totals), ORIGIN).withColumn("study_geo_ratio", safe_ratio(mixed, present))


def _origin_totals(df: DataFrame) -> DataFrame:
    return df.groupBy(*ORIGIN).agg(F.sum("main").alias("_main"), F.sum("secondary").alias("_secondary"))


def student_flows_epci(cells: DataFrame, lookup: DataFrame, roles: DataFrame) -> DataFrame:
    """Where a department's students study, by EPCI."""
    by_epci = _by_role(
        cells.join(
            lookup.where(F.col("epci_code").isNotNull()).select(
                F.col("commune_code").alias("study_commune"), "epci_code"
            ),
            "study_commune",
        ),
        roles,
        ["department_code", "epci_code", "sex"],
    )
    return _mixed_share(by_epci, _origin_totals(by_epci)).select(
        "age_band", "department_code", "epci_code", "sex", "study_geo_ratio"
    )


def iris_commune_share(base: DataFrame, lookup: DataFrame) -> DataFrame:
    """Persons of each usable area next to the persons of its commune."""
    areas = (
        base.where(usable_iris(F.col("iris_code")))
        .groupBy("commune_code", "department_code", "region_code", "iris_code")
        .agg(F.sum("population").alias("iris_pop"))
        .join(lookup.select("commune_code", "epci_code"), "commune_code", "left")
    )
    totals = areas.groupBy("commune_code").agg(F.sum("iris_pop").alias("commune_pop"))
    return areas.join(totals, "commune_code")


def student_flows_commune(cells: DataFrame, share: DataFrame, roles: DataFrame) -> DataFrame:
    """Where a department's students study, by commune that has areas."""
    communes = share.select("commune_code", "commune_pop").distinct()
    flows = _by_role(cells, roles, ["department_code", "study_commune", "sex"]).withColumnRenamed(
        "study_commune", "commune_code"
    )
    reached = flows.join(communes, "commune_code")
    totals = _origin_totals(reached.where(F.col("commune_pop") > 0))
    return _mixed_share(reached.drop("commune_pop"), totals).select(
        *ORIGIN, "commune_code", F.col("study_geo_ratio").alias("commune_ratio")
    )


def _areas(share: DataFrame) -> DataFrame:
    return share.select(
        F.col("department_code").alias("iris_dept"),
        "region_code",
        "commune_code",
        "iris_code",
        "epci_code",
        safe_ratio(F.col("iris_pop"), F.col("commune_pop")).alias("_area_share"),
    )


def _placed(joined: DataFrame) -> DataFrame:
    return joined.select(
        "age_band",
        "department_code",
        "iris_dept",
        "region_code",
        "commune_code",
        "iris_code",
        "epci_code",
        "sex",
        (F.col("commune_ratio") * F.col("_area_share")).alias("study_geo_ratio"),
    )


def student_flows_iris(by_commune: DataFrame, share: DataFrame) -> DataFrame:
    """Where a department's students study, by area of any department.

    The shares of study communes are worked out before, on small commune-level cells; splitting a commune over its
    areas is the last step and the only one that multiplies rows. The key is the commune, of which there are thousands.
    """
    return _placed(by_commune.join(_areas(share), "commune_code"))


def local_flows_iris(by_commune: DataFrame, share: DataFrame) -> DataFrame:
    """The same, of areas in the students' own department only: a row per area, band and sex at most.

    The department is part of the join key, so flows that leave it are never split over areas.
    """
    areas = _areas(share).withColumn("department_code", F.col("iris_dept"))
    return _placed(by_commune.join(areas, ["commune_code", "department_code"]))


def _split_bands(base_ratios: DataFrame, bands: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    student = F.col("age_band").isin(list(bands))
    return base_ratios.where(~student), base_ratios.where(student)


def blend_epci(
    base_ratios: DataFrame, flows: DataFrame, weights: DataFrame, bands: Iterable[StudentBand] = STUDENT_BANDS
) -> DataFrame:
    """Move student-band EPCI shares towards the places of study, then renormalise.

    The census drives the result: an EPCI where a department's students study but
    nobody lives takes part only if the department has no census share at all for
    that band and sex. Other bands pass through untouched.
    """
    group = ["department_code", "age_band", "sex"]
    columns = ["department_code", "epci_code", "age_band", "sex", "geo_ratio"]
    unchanged, student = _split_bands(base_ratios, [b.age_band for b in bands])
    study = flows.select("department_code", "epci_code", "age_band", "sex", "study_geo_ratio")
    lived = student.select(*columns).join(study, ["department_code", "epci_code", "age_band", "sex"], "left")
    only_study = (
        # Groups, and below the weights, have a row for each department, band and sex at most.
        study.join(F.broadcast(student.select(*group).distinct()), group, "left_anti")
        .join(F.broadcast(base_ratios.select("department_code", "sex").distinct()), ["department_code", "sex"], "left_semi")
        .withColumn("geo_ratio", F.lit(0.0))
    )
    w, lives = F.col("blend_weight"), F.coalesce("geo_ratio", F.lit(0.0))
    studies = F.coalesce("study_geo_ratio", F.lit(0.0))
    raw = (
        lived.unionByName(only_study)
        .where(F.col("sex").isNotNull() & ((lives > 0) | (studies > 0)))
        .join(F.broadcast(weights.select("department_code", "age_band", "blend_weight")), ["department_code", "age_band"])
        .select(
            "department_code", "epci_code", "age_band", "sex", ((1.0 - w) * lives + w * studies).alias("geo_ratio")
        )
    )
    return unchanged.select(*columns).unionByName(share_within(raw, group, "geo_ratio", "geo_ratio").select(*columns))


def intra_fraction(by_commune: DataFrame, share: DataFrame) -> DataFrame:
    """Part of an origin's students who study inside their own department.

    Worked out by commune: its share of the students times the part of its persons in that department.
    """
    parts = share.groupBy("commune_code", "department_code").agg(
        F.sum(safe_ratio(F.col("iris_pop"), F.col("commune_pop"))).alias("_part")
    )
    stays = F.col("commune_ratio") * F.coalesce("_part", F.lit(0.0))
    return (
        by_commune.join(parts, ["commune_code", "department_code"], "left").groupBy(*ORIGIN).agg(F.sum(stays).alias("intra_frac"))
    )


def blend_iris(
    base_ratios: DataFrame,
    local_flows: DataFrame,
    intra: DataFrame,
    weights: DataFrame,
    bands: Iterable[StudentBand] = STUDENT_BANDS,
) -> DataFrame:
    """Move student-band area shares towards areas of study inside the department.

    Only the students who stay can be placed, so the census share gives way in
    proportion to them: (1 - w p) census + w study, p being the part that stays.
    """
    group = ["department_code", "age_band", "sex"]
    columns = [
        "department_code", "region_code", "commune_code", "iris_code", "epci_code", "age_band", "sex", "geo_ratio",
    ]
    unchanged, student = _split_bands(base_ratios, [b.age_band for b in bands])
    local = local_flows.select("department_code", "iris_code", "age_band", "sex", "study_geo_ratio")
    w, p = F.col("blend_weight"), F.coalesce("intra_frac", F.lit(0.0))
    raw = (
        student.select(*columns)
        .where(F.col("sex").isNotNull())
        .join(local, ["department_code", "iris_code", "age_band", "sex"], "left")
        # Weights and staying parts have a row for each department, band and sex at most.
        .join(F.broadcast(weights.select("department_code", "age_band", "blend_weight")), ["department_code", "age_band"])
        .join(F.broadcast(intra), group, "left")
        .withColumn(
            "geo_ratio", (1.0 - w * p) * F.col("geo_ratio") + w * F.coalesce("study_geo_ratio", F.lit(0.0))
        )
        .select(*columns)
    )
    return unchanged.select(*columns).unionByName(share_within(raw, group, "geo_ratio", "geo_ratio").select(*columns))
