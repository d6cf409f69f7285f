from __future__ import annotations

import pytest
from conftest import as_dict
from pyspark.sql import functions as F

from censusloom.config import STUDENT_BANDS
from censusloom.operators import mobility, shares
from censusloom.operators.quality import share_sum_audit
from censusloom.schemas import FLOW_COLUMNS

GROUP = ["department_code", "age_band", "sex"]


@pytest.fixture(scope="module")
def base(make):
    places = [("31", "31555", "315550101"), ("31", "31149", "311490101"), ("82", "82121", "821210101")]
    return make.base(
        [(2022, d, "76", f"{d}01", c, i, a, s, 100.0) for d, c, i in places for a in range(15, 25) for s in ("male", "female")]
    ).cache()


@pytest.fixture(scope="module")
def lookup(make):
    return make.lookup([("31555", "EA"), ("31149", "EB"), ("82121", "EC"), ("75101", "E1"), ("75102", "E2")])


def flows(make, with_pupils=True):
    """Of 120 older students of department 31, 90 leave it; of 25 pupils, 5."""
    trips = [("31555", "82121", "18", 90), ("31555", "31149", "18", 30), ("82121", "82121", "18", 70), ("31555", "82121", "25", 500)]
    if with_pupils:
        trips += [("31555", "31149", "15", 20), ("31555", "82121", "15", 5), ("82121", "82121", "15", 40)]
    rows = [(home, study, group, sex, str(n)) for home, study, group, n in trips for sex in ("1", "2")]
    return mobility.flow_cells(make.frame(rows, ", ".join(f"{c} string" for c in FLOW_COLUMNS)))


@pytest.fixture(scope="module")
def parts(spark, make, base, lookup):
    cells, roles, bands = flows(make), mobility.band_roles(spark), STUDENT_BANDS
    weights = mobility.mobility_weights(mobility.mobility_rates(cells, roles), base, bands)
    return weights, mobility.student_flows_epci(cells, lookup, roles)


def test_rates_and_blend_weights(parts):
    found = {(r.age_band, r.department_code): (r.mobility_rate, r.blend_weight) for r in parts[0].collect()}
    # 3/4 of 5/25 and 1/4 of 90/120, capped at 0.25; 90/120, capped at 0.6
    assert found[("15_19", "31")] == pytest.approx((0.3375, 0.25))
    assert found[("20_24", "31")] == pytest.approx((0.75, 0.6))
    assert found[("20_24", "82")] == (0, 0)


def test_study_destinations(parts):
    shares_ = as_dict(parts[1].where("department_code = '31' AND sex = 'male'"), ["age_band", "epci_code"], "study_geo_ratio")
    assert shares_ == pytest.approx(
        {("15_19", "EB"): 0.75 * 0.8 + 0.25 * 0.25, ("15_19", "EC"): 0.75 * 0.2 + 0.25 * 0.75, ("20_24", "EB"): 0.25, ("20_24", "EC"): 0.75}
    )


def test_blended_epci_shares(base, lookup, parts):
    census = shares.geo_ratios_epci(base, lookup)
    blended = mobility.blend_epci(census, parts[1], parts[0])
    found = as_dict(blended.where("department_code = '31' AND sex = 'female'"), ["age_band", "epci_code"], "geo_ratio")
    # nobody of department 31 lives in EC: (0.4 / 2, 0.4 / 2 + 0.6 / 4) and (0.75 / 2, 0.75 / 2 + 0.6625 / 4), each made to sum to one
    assert found == pytest.approx(
        {("15_19", "EA"): 0.375 / 0.915625, ("15_19", "EB"): 0.540625 / 0.915625, ("20_24", "EA"): 4 / 11, ("20_24", "EB"): 7 / 11}
    )
    assert share_sum_audit(blended, GROUP).where("NOT ok").count() == 0


def test_other_bands_stay_bit_identical(make, lookup, parts):
    older = make.base(
        [(2022, "31", "76", "3101", c, f"{c}0101", a, "male", p) for c, a, p in (("31555", 30, 7.0), ("31149", 31, 3.0), ("31555", 18, 1.0))]
    )
    census = shares.geo_ratios_epci(older, lookup)
    blended = mobility.blend_epci(census, parts[1], parts[0])
    band = "age_band = '30_34'"
    assert sorted(map(tuple, blended.where(band).collect())) == sorted(map(tuple, census.where(band).collect()))


def test_a_place_of_study_only_enters_where_nobody_has_a_census_share(make, lookup, parts):
    # department 31 has a 20-24 share but none for 15-19
    lone = make.base([(2022, "31", "76", "3101", "31555", "315550101", 22, "male", 5.0)])
    blended = mobility.blend_epci(shares.geo_ratios_epci(lone, lookup), parts[1], parts[0])
    found = as_dict(blended, ["age_band", "epci_code", "sex"], "geo_ratio")
    assert found == pytest.approx(
        {("20_24", "EA", "male"): 1.0, ("15_19", "EB", "male"): 0.6625, ("15_19", "EC", "male"): 0.3375}
    )


@pytest.fixture(scope="module")
def iris(spark, make, base, lookup):
    cells, roles, bands = flows(make, with_pupils=False), mobility.band_roles(spark), STUDENT_BANDS
    weights = mobility.mobility_weights(mobility.mobility_rates(cells, roles), base, bands)
    share = mobility.iris_commune_share(base, lookup)
    return weights, mobility.student_flows_commune(cells, share, roles), share


def test_default_weight_without_main_group(iris):
    found = as_dict(iris[0], ["age_band", "department_code"], "blend_weight")
    assert found[("15_19", "31")] == 0.1 and found[("20_24", "31")] == pytest.approx(0.6)


def test_part_that_stays(iris):
    found = as_dict(mobility.intra_fraction(iris[1], iris[2]).where("department_code = '31'"), ["age_band", "sex"], "intra_frac")
    assert found == pytest.approx({(b, s): 0.25 for b in ("15_19", "20_24") for s in ("male", "female")})


def test_local_flows_are_the_flows_within_the_department(iris):
    every = mobility.student_flows_iris(iris[1], iris[2])
    local = mobility.local_flows_iris(iris[1], iris[2])
    inside = every.where("iris_dept = department_code")
    assert sorted(map(tuple, local.collect())) == sorted(map(tuple, inside.select(*local.columns).collect()))
    sums = as_dict(every.groupBy(*GROUP).agg(F.sum("study_geo_ratio").alias("s")), GROUP, "s")
    assert all(v == pytest.approx(1) for v in sums.values()) and inside.count() < every.count()


def test_blended_area_shares(base, lookup, iris):
    local, intra = mobility.local_flows_iris(iris[1], iris[2]), mobility.intra_fraction(iris[1], iris[2])
    blended = mobility.blend_iris(shares.geo_ratios_iris(base, lookup), local, intra, iris[0])
    found = as_dict(blended.where("department_code = '31' AND sex = 'male'"), ["age_band", "iris_code"], "geo_ratio")
    # a quarter stays: (1 - w / 4) / 2, and w / 4 more where it studies; w is 0.1 and 0.6
    assert found == pytest.approx(
        {("15_19", "315550101"): 0.4875, ("15_19", "311490101"): 0.5125, ("20_24", "315550101"): 0.425, ("20_24", "311490101"): 0.575}
    )
    assert share_sum_audit(blended, GROUP).where("NOT ok").count() == 0


def test_area_rows_are_not_shuffled_for_their_shares(spark, base, lookup):
    """Also where nothing is small enough to be broadcast by its size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = shares.geo_ratios_canton(base)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_unknown_destination_counts_as_staying(spark, make):
    rows = [("75101", None, "18", "1", "30"), ("75101", "13001", "18", "1", "10")]
    cells = mobility.flow_cells(make.frame(rows, ", ".join(f"{c} string" for c in FLOW_COLUMNS)))
    rates = mobility.mobility_rates(cells, mobility.band_roles(spark))
    assert as_dict(rates, "age_band", "mobility_rate") == {"20_24": 0.25}


def test_area_share_counts_persons_of_the_commune(make, lookup):
    base = make.base(
        [(2022, "75", "11", "7599", "75101", i, 20, "male", p) for i, p in (("751010101", 30.0), ("751010102", 10.0), ("75101XXXX", 99.0))]
    )
    share = mobility.iris_commune_share(base, lookup)
    assert {(r.iris_code, r.iris_pop, r.commune_pop) for r in share.collect()} == {("751010101", 30, 40), ("751010102", 10, 40)}


# -- shares -----------------------------------------------------------------------


def test_department_without_areas_passes_through(make, lookup):
    base = make.base(
        [
            (2022, "75", "11", "7599", "75101", "751010101", 20, "male", 10.0),
            (2022, "75", "11", "7599", "", "ZZZZZZZZZ", 20, "male", 99.0),
            (2022, "976", "06", "9799", "", "ZZZZZZZZZ", 20, "male", 50.0),
            (2022, "976", "06", "9799", "", "ZZZZZZZZZ", 21, None, 50.0),
        ]
    )
    epci = {(r.department_code, r.epci_code, r.sex, r.geo_ratio) for r in shares.geo_ratios_epci(base, lookup).collect()}
    assert epci == {("75", "E1", "male", 1.0), ("976", "976", "male", 1.0), ("976", "976", None, 1.0)}
    iris = {(r.department_code, r.iris_code, r.epci_code, r.sex) for r in shares.geo_ratios_iris(base, lookup).collect()}
    assert iris == {("75", "751010101", "E1", "male"), ("976", "ZZZZZZZZZ", None, "male"), ("976", "ZZZZZZZZZ", None, None)}


def test_masked_rows_count_for_epci_but_not_for_areas(make, lookup):
    base = make.base(
        [
            (2022, "75", "11", "7599", "75101", "751010101", 20, "male", 10.0),
            (2022, "75", "11", "7599", "75102", "75102XXXX", 20, "male", 30.0),
            (2022, "75", "11", "7599", "75103", "751030101", 20, "male", 60.0),
        ]
    )
    assert as_dict(shares.geo_ratios_epci(base, lookup), "epci_code", "geo_ratio") == {"E1": 0.25, "E2": 0.75}
    # the commune without EPCI takes part in the area shares
    assert as_dict(shares.geo_ratios_iris(base, lookup), "iris_code", "geo_ratio") == pytest.approx({"751010101": 1 / 7, "751030101": 6 / 7})


def test_canton_shares_have_no_fallback(make):
    base = make.base(
        [
            (2022, "75", "11", "7501", "75101", "751010101", 20, "male", 10.0),
            (2022, "75", "11", "7502", "", "ZZZZZZZZZ", 21, "male", 30.0),
            (2022, "75", "11", "", "", "ZZZZZZZZZ", 21, "male", 30.0),
            (2022, "976", "06", None, "", "ZZZZZZZZZ", 21, "male", 30.0),
        ]
    )
    assert as_dict(shares.geo_ratios_canton(base), "canton_code", "geo_ratio") == {"7501": 0.25, "7502": 0.75}


def test_shares_sum_to_one(base, lookup):
    for level in ("epci", "canton", "iris"):
        ratios = shares.geo_ratios(level, base, lookup)
        assert share_sum_audit(ratios, GROUP).where("NOT ok").count() == 0
        assert ratios.where(F.col("geo_ratio") <= 0).count() == 0


def test_unknown_level_is_an_error(base, lookup):
    with pytest.raises(ValueError):
        shares.geo_ratios("planet", base, lookup)
