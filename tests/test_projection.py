from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from conftest import as_dict
from pyspark.sql import functions as F

from censusloom.config import Config
from censusloom.operators import projection as pj
from censusloom.operators import shares
from censusloom.operators.disaggregate import disaggregate, expand_birth_month

CFG = Config(min_age=14, max_age=18, end_year=2026, method="cohort-stable")


@pytest.fixture(scope="module")
def census(make):
    cells = make.cells([("75", 14, "male", 100), ("75", 18, "male", 300), ("13", 14, "male", 300), ("13", 18, "male", 100)])
    return pj.census_departments(cells).cache()


def test_stable_applies_the_age_share_to_the_cohort(census):
    found = as_dict(pj.project(census, CFG).where("age = 18"), ["year", "department_code"], "population")
    assert found == {(2022, "75"): 300, (2022, "13"): 100, (2026, "75"): 300, (2026, "13"): 100}


def test_ageing_moves_cohorts_in_place(census):
    found = as_dict(pj.project(census, replace(CFG, method="cohort-aging")).where("year = 2026"), ["department_code", "age"], "population")
    assert found == {("75", 18): 100, ("13", 18): 300}


def test_ageing_keeps_rows_of_unknown_sex(make):
    cells = pj.census_departments(make.cells([("75", 15, None, 7), ("75", 15, "male", 1)]))
    assert pj.project(cells, replace(CFG, method="cohort-aging", end_year=2022)).count() == 2
    assert pj.project(cells, replace(CFG, end_year=2022)).count() == 1


def test_national_cohorts_are_preserved(census):
    assert as_dict(pj.project(census, CFG).groupBy("year", "age").agg(F.sum("population").alias("p")), ["year", "age"], "p") == {
        (2022, 14): 400, (2022, 18): 400, (2026, 18): 400,
    }


def test_one_region_per_department(make):
    cells = make.base(
        [(2022, "75", r, "1", "", "ZZZZZZZZZ", a, "male", 1.0) for r, a in (("11", 15), ("12", 15), ("12", 16))]
    )
    assert {(r.age, r.region_code, r.population) for r in pj.census_departments(cells).collect()} == {(15, "11", 2.0), (16, "11", 1.0)}


def test_dates_and_margins(make):
    row = pj.project(pj.census_departments(make.cells([("75", 18, "male", 100)])), replace(CFG, end_year=2022)).collect()[0]
    assert (row.snapshot_month, row.born_date) == (dt.date(2022, 1, 1), dt.date(2004, 1, 1))
    assert (row.decimal_age, row.confidence_pct, row.population_low, row.population_high) == (18.0, 0.02, 98.0, 102.0)


def test_unknown_method():
    with pytest.raises(ValueError):
        Config(method="guess")


def test_monthly_snapshots_carry_the_full_stock(make, census):
    monthly = pj.project(census, replace(CFG, monthly=True, end_year=2022), births=make.births(["75", "13"]))
    stock = as_dict(monthly.groupBy("month").agg(F.sum("population").alias("p")), "month", "p")
    assert stock == {m: 800 for m in range(1, 13)}
    with pytest.raises(ValueError):
        pj.project(census, replace(CFG, monthly=True))


def test_cohorts_not_yet_born_are_reported(spark, make):
    cells = pj.census_departments(make.cells([("75", a, s, 1) for a in range(3) for s in ("male", "female")]))
    cfg = Config(min_age=0, max_age=2, end_year=2024, method="cohort-stable")
    assert cfg.lost_cohorts == 2
    missing = pj.uncovered_cells(spark, pj.project(cells, cfg), cfg)
    assert {(r.year, r.age) for r in missing.collect()} == {(2023, 0), (2024, 0), (2024, 1)}


# -- anchoring ----------------------------------------------------------------------------

PROJECTED = (
    "year int, month int, department_code string, age int, sex string, population double, "
    "population_low double, population_high double"
)
ESTIMATES = "year int, naissance int, sex string, population double"


def projected(make, rows):
    return make.frame([(y, m, d, a, "male", p, p * 0.95, p * 1.05) for y, m, d, a, p in rows], PROJECTED)


@pytest.fixture
def estimates(make):
    return make.frame([(2025, 1995, "male", 1000.0)], ESTIMATES)


ROWS = [(2025, 1, "31", 30, 1200.0), (2025, 1, "82", 30, 300.0), (2025, 1, "986", 30, 77.0)]


def anchored(df, estimates):
    return pj.anchor(df, estimates, ("975", "977", "978", "986", "988"), 2025)


def test_anchored_total_meets_the_estimate(make, estimates):
    out = as_dict(anchored(projected(make, ROWS), estimates), "department_code", "population")
    # 1000 published, 1500 projected: two thirds
    assert out == pytest.approx({"31": 800, "82": 200, "986": 77})


def test_bounds_scale_alike(make, estimates):
    row = anchored(projected(make, ROWS), estimates).where("department_code = '31'").collect()[0]
    assert (row.population_low, row.population_high) == pytest.approx((760, 840))


def test_cells_without_estimate_stay(make, estimates):
    out = anchored(projected(make, [(2025, 1, "31", 29, 5.0), (2025, 1, "975", 30, 19.0)]), estimates)
    assert as_dict(out, "department_code", "population") == {"31": 5.0, "975": 19.0}


def test_every_month_is_anchored_on_its_own(make, estimates):
    both = projected(make, ROWS[:2] + [(2025, 2, d, a, p) for _, _, d, a, p in ROWS[:2]])
    stock = anchored(both, estimates).groupBy("month").agg(F.sum("population").alias("p"))
    assert as_dict(stock, "month", "p") == pytest.approx({1: 1000, 2: 1000})


def test_later_years_hold_the_last_estimate(make, estimates):
    later = make.frame([(2025, 1995, "male", 640.0)], ESTIMATES)
    out = anchored(projected(make, [(2027, 1, "31", 32, 500.0)]), later)
    assert out.collect()[0].population == pytest.approx(640)


def test_two_estimates_of_one_cell_stop_the_run(make, estimates):
    with pytest.raises(Exception, match="estimates: more than one row for 2025, 1995, male"):
        anchored(projected(make, ROWS), estimates.union(estimates)).collect()


def test_without_estimates_totals_stay(census):
    assert sorted(map(tuple, pj.project(census, replace(CFG, method="cohort-estimates")).collect())) == sorted(
        map(tuple, pj.project(census, CFG).collect())
    )


# -- finer areas ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def levels(make):
    base = make.base(
        [
            (2022, "75", "11", f"75{k:02d}", c, i, a, s, float(a + k))
            for k, (c, i) in enumerate([("75101", "751010101"), ("75101", "751010102"), ("75102", "751020101")])
            for a in range(15, 20)
            for s in ("male", "female")
        ]
    )
    lookup = make.lookup([("75101", "E1"), ("75102", "E2")])
    parent = pj.project(pj.census_departments(base), Config(min_age=15, max_age=19, method="cohort-stable")).cache()
    return parent, {lv: shares.geo_ratios(lv, base, lookup) for lv in ("epci", "canton", "iris")}


@pytest.mark.parametrize(("level", "extra"), [("epci", 0.03), ("canton", 0.05), ("iris", 0.10)])
def test_finer_levels_add_up_to_the_department(levels, level, extra):
    parent, ratios = levels
    child = disaggregate(parent, ratios[level], level)
    keys = ["year", "month", "age", "sex"]
    sums = as_dict(child.groupBy(*keys).agg(F.sum("population").alias("p")), keys, "p")
    assert sums == pytest.approx(as_dict(parent, keys, "population"))
    row = child.where("year = 2022").collect()[0]
    assert row.confidence_pct == pytest.approx(0.02 + extra)
    assert row.population_low == pytest.approx(row.population * (1 - 0.02 - extra))


def test_months_of_birth_keep_the_total_and_date_the_cohort(make, levels):
    parent, births = levels[0], make.births(["75"])
    rows = expand_birth_month(parent, births, "department")
    assert rows.count() == 12 * parent.count()
    assert rows.agg(F.sum("population")).collect()[0][0] == pytest.approx(parent.agg(F.sum("population")).collect()[0][0])
    july = rows.where("year = 2022 AND age = 18 AND birth_month = 7").collect()[0]
    assert (july.born_date, july.decimal_age) == (dt.date(2004, 7, 1), 17.5)


def test_department_without_births_drops_out(make, levels):
    assert expand_birth_month(levels[0], make.births(["13"]), "department").count() == 0
