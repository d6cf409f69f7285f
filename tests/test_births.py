from __future__ import annotations

import pytest
from conftest import as_dict

from censusloom.operators.births import birth_cells, birth_month_distribution, department_dimension
from censusloom.schemas import BIRTH_COLUMNS
from censusloom.sources import read_birth_months

RECORD = ", ".join(f"{c} string" for c in BIRTH_COLUMNS)


def records(make, rows):
    return read_birth_months(make.frame([(d, r, f"{m:02d}", str(w)) for d, r, m, w in rows], RECORD))


@pytest.fixture(scope="module")
def months(spark, make):
    rows = [("59", "32", 2, 900_000), ("59", "32", 9, 100_000), ("09", "76", 4, 720)]
    rows += [("48", "76", m, 20) for m in range(1, 13)]
    cells = birth_cells(records(make, rows))
    return as_dict(birth_month_distribution(cells, department_dimension(spark)), ["department_code", "month"], "month_ratio")


def test_big_department_keeps_its_own_months(months):
    assert {m: v for (d, m), v in months.items() if d == "59"} == {2: 0.9, 9: 0.1}


def test_small_department_takes_its_region(months):
    region = {m: 20 / 960 for m in range(1, 13)} | {4: 740 / 960}
    for code in ("48", "09", "31"):
        assert {m: v for (d, m), v in months.items() if d == code} == pytest.approx(region)


def test_department_without_region_records_takes_the_metropolitan_months(months):
    metro = {m: 20 for m in range(1, 13)} | {2: 900_020, 4: 740, 9: 100_020}
    total = sum(metro.values())
    for code in ("976", "18", "975"):
        assert {m: v for (d, m), v in months.items() if d == code} == pytest.approx({m: w / total for m, w in metro.items()})


def test_shares_add_up_for_every_department(months, spark):
    sums = {}
    for (d, _), v in months.items():
        sums[d] = sums.get(d, 0) + v
    assert set(sums) == {r.department_code for r in department_dimension(spark).collect()}
    assert all(v == pytest.approx(1) for v in sums.values())


def test_pooled_records_count_for_their_region_only(spark, make):
    rows = [("99", "53", 11, 600_000), ("99", "53", 2, 200_000), ("99", "00", 5, 1_000_000), ("44", "52", 8, 900_000)]
    cells = birth_cells(records(make, rows))
    months = as_dict(birth_month_distribution(cells, department_dimension(spark)), ["department_code", "month"], "month_ratio")
    assert {m: v for (d, m), v in months.items() if d == "35"} == {2: 0.25, 11: 0.75}
    assert not any(d == "99" for d, _ in months)
    # pooled records are not metropolitan ones
    assert {m: v for (d, m), v in months.items() if d == "976"} == {8: 1.0}


def test_unusable_records(make):
    raw = make.frame(
        [(" 75", "11", "01", "5"), ("75", "11", "XX", "5"), ("75", "11", "13", "5"), ("75", "11", "02", "bad"), ("75", "11", "03", "0")],
        RECORD,
    )
    assert [tuple(r) for r in read_birth_months(raw).collect()] == [("75", "11", 1, 5.0)]
