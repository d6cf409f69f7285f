from __future__ import annotations

import pytest
from conftest import as_dict, rows

from censusloom.operators import quality as ql
from censusloom.operators import reconcile as rc

EXPECTED = "department_code string, territory string"


@pytest.fixture(scope="module")
def base(make):
    return make.cells(
        [("75", 18, "male", 1000), ("75", 18, "female", 950), ("75", 19, "male", 1100), ("13", 18, "male", 900), ("13", 18, "female", 850), ("13", 19, "male", 1050)]
    )


@pytest.fixture(scope="module")
def expected(make):
    return make.frame([("75", "metro"), ("13", "metro"), ("01", "metro"), ("971", "dom"), ("976", "mayotte"), ("986", "tom")], EXPECTED)


def test_validate(base, expected):
    row = ql.validate(base, expected).collect()[0]
    assert row.is_valid and (row.total_rows, row.total_population, row.departments, row.years) == (6, 5850, 2, 1)
    assert (row.min_age, row.max_age, row.missing_metro, row.missing_dom, row.tom_present) == (18, 19, "01", "971", "")
    assert not row.mayotte_present


@pytest.mark.parametrize("bad", [-5.0, None])
def test_bad_population_is_an_error(base, expected, make, bad):
    worse = base.union(make.base([(2022, "75", "11", "7599", "75101", "751010101", 18, "male", bad)]))
    row = ql.validate(worse, expected).collect()[0]
    assert not row.is_valid and row.invalid_rows == 1


def test_department_coverage(base, expected):
    assert as_dict(ql.department_coverage(base, expected), "department_code", "present") == {
        "75": True, "13": True, "01": False, "971": False, "976": False, "986": False,
    }


LEVEL = "year int, month int, department_code string, region_code string, epci_code string, age int, sex string, geo_precision string, population double"


def level(make, rows_):
    return make.frame([(y, m, d, "11", e, a, s, "exact", float(p)) for y, m, d, e, a, s, p in rows_], LEVEL)


def test_child_parent(make):
    parent = level(make, [(2022, 1, "75", "", 18, "male", 100), (2022, 1, "13", "", 18, "male", 100)])
    child = level(make, [(2022, 1, "75", "E1", 18, "male", 60), (2022, 1, "75", "E2", 18, "male", 38), (2022, 1, "13", "E3", 18, "male", 120)])
    found = as_dict(ql.child_parent(child, parent, ["department_code"], 0.95, 1.05), "department_code", "ok")
    assert found == {"75": True, "13": False}


def test_year_over_year(make):
    df = level(make, [(2022, 1, "75", "", 18, "male", 100), (2023, 1, "75", "", 18, "male", 102), (2024, 1, "75", "", 18, "male", 110)])
    assert rows(ql.yoy_change(df), "year", "ok") == [(2023, True), (2024, False)]


def test_snapshots(make):
    df = level(make, [(2022, m, "75", "", 18, "male", 100) for m in range(1, 13)])
    assert ql.single_snapshot(df).count() == 1 and ql.single_snapshot(df, 12).count() == 0
    assert {r.vs_january for r in ql.snapshot_stock(df).collect()} == {1.0}


def test_concentration_ignores_single_areas(make):
    ratios = make.frame(
        [("75", "male", "20_24", 0.2), ("75", "male", "20_24", 0.8), ("13", "male", "20_24", 1.0)],
        "department_code string, sex string, age_band string, geo_ratio double",
    )
    assert ql.concentration(ratios, "20_24").collect()[0][0] == pytest.approx(0.3 * 2**0.5)


def test_bounds(make):
    df = level(make, [(2022, 1, "75", "", 18, "male", 1000), (2022, 1, "75", "", 19, "male", 3000)])
    assert ql.bounds(df, 60_000, 600, 12_000).collect()[0].ok
    assert not ql.bounds(df, 2_000, 600, 12_000).collect()[0].ok


# -- reports -----------------------------------------------------------------------------

REF = "year int, region_code string, age int, sex string, pop double"


def test_region_diff_compares_the_same_ages(make):
    ours = level(make, [(2022, 1, "75", "", a, s, 55) for a in (15, 16) for s in ("male", "female")])
    ref = make.frame([(2022, "11", a, s, 50.0) for a in (14, 15, 16, 17) for s in ("male", "female")], REF)
    row = rc.region_diff(ours, ref, 2022).collect()[0]
    assert (row.our_pop, row.ref_pop, row.diff_pct) == (220, 200, pytest.approx(10))
    assert rc.sex_ratio(ours, ref, 2022).collect()[0]["diff"] == 0


def test_region_without_reference_has_no_difference(make):
    ours = level(make, [(2022, 1, "75", "", 15, "male", 55)])
    row = rc.region_diff(ours, make.frame([], REF), 2022).collect()[0]
    assert row.ref_pop == 0 and row.diff_pct is None


def test_moved_first_band_is_flagged(make):
    ours = level(make, [(2022, 1, "75", "", 16, "male", 31), (2022, 1, "75", "", 18, "male", 20), (2022, 1, "75", "", 22, "male", 49)])
    ref = make.frame([(2022, "11", 16, "male", 30.0), (2022, "11", 18, "male", 20.0), (2022, "11", 22, "male", 50.0)], REF)
    assert as_dict(rc.subband_shares(ours, ref, 2022), "band", "flag") == {"15-17": True, "18-19": False, "20-24": False}


def test_top_shares_break_ties_by_code(make):
    cells = [(2022, 1, "75", e, a, "male", p) for e, y, o in (("E2", 50, 50), ("E1", 50, 50), ("E3", 90, 10), ("E4", 1, 1)) for a, p in ((16, y), (21, o))]
    df = level(make, cells)
    top = [r.epci_code for r in rc.extreme_shares(df, 2022, 2, 10).collect()]
    bottom = [r.epci_code for r in rc.extreme_shares(df, 2022, 1, 10, desc=False).collect()]
    assert top == ["E1", "E2"] and bottom == ["E3"]


def test_drift(make):
    df = level(make, [(y, 1, "75", "E1", a, "male", p) for y, s in ((2022, 40), (2023, 43)) for a, p in ((16, 100 - s), (21, s))])
    row = rc.drift_summary(rc.share_by_year(df, ["E1"])).collect()[0]
    assert (row.first_share, row.last_share, row.drift_pp, row.flag) == (40, 43, 3, True)
    wide = rc.share_pivot(rc.share_by_year(df, ["E1"]), ["E1"])
    assert rows(wide, "year", "E1") == [(2022, 40.0), (2023, 43.0)]


def test_coverage_reports_missing_population(make):
    parent = level(make, [(2022, 1, "75", "", 18, "male", 100)])
    child = level(make, [(2022, 1, "75", "E1", 18, "male", 90), (2022, 1, "75", "", 18, "male", 10)])
    found = as_dict(rc.coverage(child, parent, 2022, "epci_code"), "region_code", "missing")
    assert found == {"11": 10, "ALL": 10}


def test_an_epci_over_two_departments_is_listed_for_each(make):
    enrolment = make.frame([("75101", 60), ("13001", 40), ("99999", 5)], "com_id string, enrolled bigint")
    lookup = make.lookup([("75101", "E1"), ("13001", "E1")])
    df = level(make, [(2022, 1, "75", "E1", 21, "male", 200)])
    top = rc.top_enrolment(enrolment, lookup, df, 2022, 100)
    assert [(r.department_code, r.ratio_pct) for r in top.collect()] == [("75", 30), ("13", 20)]
    ratio = rc.enrolment_ratio(enrolment, lookup, df, 2022).collect()[0]
    assert (ratio.enrolled, ratio.ratio_pct, ratio.flag) == (100, 50, "")
    assert rc.enrolment_match(enrolment, lookup).collect()[0].matched_pct == pytest.approx(100 / 105 * 100)
