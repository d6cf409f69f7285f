from __future__ import annotations

import pytest
from conftest import as_dict, rows

from censusloom.config import NO_GEO, TERRITORIES, Config, Territory, known_departments
from censusloom.operators.base import age_forward, append_territories, base_population, canton_weights
from censusloom.schemas import BASE, CENSUS_COLUMNS
from censusloom.sources import bands_from_labels, expand_bands, in_scope, pyramid_unpivot
from censusloom.sources.pyramids import band_labels

PERSONS = [
    ("330630203", "33", "75", "3307", "1990", "2", "12.0"),
    ("330630204", "33 ", "75", "3307", "1990", "1", "8.5"),
    ("33063XXXX", "33", "75", "3307", "1971", "1", "30.25"),
    (NO_GEO, "33", "75", "3312", "2010", "2", "4.0"),
    ("973020105", "973", "03", "9702", "1990", "2", "6.0"),
]


@pytest.fixture
def census(make):
    return make.frame(PERSONS, ", ".join(f"{c} string" for c in CENSUS_COLUMNS))


def test_base_cells(census):
    base = base_population(census, 2022)
    assert [(f.name, f.dataType) for f in base.schema] == [(f.name, f.dataType) for f in BASE]
    assert rows(base, "department_code", "commune_code", "iris_code", "age", "sex", "population") == [
        ("33", "", NO_GEO, 12, "female", 4.0),
        ("33", "33063", "330630203", 32, "female", 12.0),
        ("33", "33063", "330630204", 32, "male", 8.5),
        ("33", "33063", "33063XXXX", 51, "male", 30.25),
        ("973", "97302", "973020105", 32, "female", 6.0),
    ]


def test_equal_persons_add_up_and_incomplete_ones_drop_out(make, census):
    more = make.frame(
        [PERSONS[0], ("330630203", "33", "75", "3307", None, "2", "7"), ("330630203", "33", "75", "3307", "1990", "2", None)],
        ", ".join(f"{c} string" for c in CENSUS_COLUMNS),
    )
    cells = as_dict(base_population(census.union(more), 2022), ["iris_code", "sex"], "population")
    assert cells[("330630203", "female")] == 24.0


def test_unknown_sex_is_kept_as_null(make):
    df = make.frame([("751010101", "75", "11", "7599", "2004", "9", "3")], ", ".join(f"{c} string" for c in CENSUS_COLUMNS))
    assert rows(base_population(df, 2022), "sex", "population") == [(None, 3.0)]


def test_territory_filter(census):
    assert in_scope(census, Config()).count() == 5
    assert in_scope(census, Config(include_dom=False)).count() == 4


def test_bad_birth_year_is_an_error(make):
    df = make.frame([("751010101", "75", "11", "7599", "18.7", "1", "3")], ", ".join(f"{c} string" for c in CENSUS_COLUMNS))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        base_population(df, 2022).collect()


def test_one_shuffle_and_a_pruned_scan(spark, census, tmp_path):
    path = str(tmp_path / "census")
    census.selectExpr("*", "'x' AS UNUSED").write.parquet(path)
    from censusloom.sources import read_census

    plan = base_population(in_scope(read_census(spark, path), Config(include_dom=False)), 2022)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "UNUSED" not in text.split("ReadSchema")[1]
    assert "In(DEPT" in text or "Not(In(DEPT" in text  # reaches the parquet reader


def sheet(make, *lines):
    width = max(len(line) for line in lines) - 1
    return make.frame(
        [tuple(line) + (None,) * (width + 1 - len(line)) for line in lines],
        "row int, " + ", ".join(f"c{i} string" for i in range(width)),
    )


def test_wide_pyramid(make):
    df = sheet(
        make,
        (5, "Variables :", "SEXE", "2", "2", "1.0", "1"),
        (6, None, "AGED100", "010", "11", "010", "100 ou plus"),
        (10, "CODGEO", "LIBGEO"),
        (11, "98811", "N", "3", "8", "1 002,5", "4"),
        (12, "98818", "P", "4", "1", "7", "0"),
        (13, None, "note", "9", "9", "9", "9"),
    )
    assert as_dict(pyramid_unpivot(df), ["sex", "age"], "population") == {
        ("female", 10): 7, ("female", 11): 9, ("male", 10): 1009.5, ("male", 100): 4,
    }


def test_wide_pyramid_of_one_territory(make):
    df = sheet(
        make,
        (3, "Variables :", "SEXE", "2", "1"),
        (4, None, "AGED100", "040", "041"),
        (7, "CODGEO", "LIBGEO"),
        (8, "98611", "U", "12", "3"),
        (9, "98613", "W", "30", "1"),
        (10, "98735", "T", "200", "5"),
    )
    assert as_dict(pyramid_unpivot(df, prefix="986"), ["sex", "age"], "population")[("female", 40)] == 42
    assert as_dict(pyramid_unpivot(df), ["sex", "age"], "population")[("female", 40)] == 242


def test_a_sheet_without_header_is_an_error(make):
    df = sheet(make, (16, "Variables :", "SEXE", "2"), (17, None, "AGED100", "5"), (20, "CODGEO", "L"), (21, "98611", "U", "12"))
    with pytest.raises(Exception, match="no CODGEO line above line 15"):
        pyramid_unpivot(df).collect()
    assert as_dict(pyramid_unpivot(df, header_lines=30), ["sex", "age"], "population") == {("female", 5): 12}


def test_bands_spread_evenly(make, spark):
    table = make.frame(
        [("20 à 24 ans", "35", "60"), ("80 ans et +", "", "42"), ("Total", "1 000", "2")],
        "label string, male string, female string",
    )
    ages = as_dict(expand_bands(bands_from_labels(table, band_labels(spark)), 80), ["age", "sex"], "population")
    assert {a: v for a, v in ages.items() if a[0] < 25} == {(a, s): v for a in range(20, 25) for s, v in (("male", 7), ("female", 12))}
    assert {a for a, s in ages if a >= 80} == set(range(80, 101)) and ages[(100, "female")] == 2
    assert not any(s == "male" for a, s in ages if a >= 80)


PYRAMID = "age int, sex string, population double"


def test_ageing_forward(make):
    pyramid = make.frame([(10, "male", 100.0), (10, "female", 120.0), (11, "male", 50.0), (12, "male", 0.0)], PYRAMID)
    mayotte = next(t for t in TERRITORIES if t.department_code == "976")
    assert rows(age_forward(pyramid, mayotte, 2022), "department_code", "region_code", "age", "sex", "population") == [
        ("976", "06", 15, "female", 120.0),
        ("976", "06", 15, "male", 100.0),
        ("976", "06", 16, "male", 50.0),
    ]
    with pytest.raises(ValueError, match="2016"):
        age_forward(pyramid, mayotte, 2016)


def test_a_newer_census_is_taken_as_it_is(make):
    pyramid = make.frame([(15, "male", 10.0)], PYRAMID)
    newer = Territory("986", "98", "9869", 2023)
    assert rows(age_forward(pyramid, newer, 2022), "age") == [(15,)]
    assert rows(age_forward(pyramid, Territory("975", "975", "9750", 2022), 2024), "age") == [(17,)]


def test_appended_territories(make):
    base = make.cells([("75", 18, "male", 5)])
    one = make.frame([(15, "male", 100.0)], PYRAMID)
    none = one.where("false")
    pyramids = {"976": one, "986": one, "987": one, "988": one, "975": none}
    grown = append_territories(base, pyramids, 2022)
    assert {r.department_code for r in grown.collect()} == {"75", "976", "986", "988"}
    only = append_territories(base, pyramids, 2022, allowed=["987"])
    assert {r.department_code for r in only.collect()} == {"75", "976", "987"}


def test_a_required_territory_may_not_be_empty(make):
    base, one = make.cells([("75", 18, "male", 5)]), make.frame([(15, "male", 100.0)], PYRAMID)
    with pytest.raises(ValueError, match="mayotte"):
        append_territories(base, {"986": one, "975": one}, 2022)
    with pytest.raises(ValueError, match="tom"):
        append_territories(base, {"976": one}, 2022)


def test_canton_weights(make):
    cog = make.frame(
        [("75101", "75", "A"), ("75102", "75", "A"), ("13001", "13", "B"), ("13999", "13", "B")],
        "commune_code string, department_code string, canton_code string",
    )
    lookup = make.frame(
        [("75101", "E1", 300), ("75102", "E2", 100), ("13001", "E3", 0)],
        "commune_code string, epci_code string, commune_population bigint",
    )
    assert rows(canton_weights(cog, lookup), "canton_code", "epci_code", "weight") == [
        ("A", "E1", 0.75), ("A", "E2", 0.25), ("B", "E3", 0.0),
    ]


def test_known_departments():
    dims = known_departments()
    assert len(dims) == 106 and sum(metro for _, _, metro in dims) == 96
    assert dict((d, r) for d, r, _ in dims)["975"] is None


LATE = ((16, "Variables :", "SEXE", "2"), (17, None, "AGED100", "5"), (20, "CODGEO", "L"), (21, "98611", "U", "12"))


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_the_missing_header_is_noticed_every_time(spark, make, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for lines in (LATE, LATE[:2], LATE[3:], ()):
            df = sheet(make, *lines) if lines else sheet(make, *LATE).where("false")
            for _ in range(5):
                with pytest.raises(Exception, match="no CODGEO line above line 15"):
                    pyramid_unpivot(df).collect()
                with pytest.raises(Exception, match="no CODGEO line above line 15"):
                    pyramid_unpivot(df).write.format("noop").mode("overwrite").save()
            if not any(line[1] == "CODGEO" for line in lines):
                with pytest.raises(Exception, match="no CODGEO line of the sheet"):
                    pyramid_unpivot(df, header_lines=None).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_header_below_any_line_is_found(make):
    notes = [(k, f"note {k}", None) for k in range(300)]
    df = sheet(make, *notes, (400, "Variables :", "SEXE", "2", "1"), (401, None, "AGED100", "5", "100 ou plus"), (777, " codgeo ", "L"), (778, "98611", "U", "12", "1 000,5"))
    assert as_dict(pyramid_unpivot(df, header_lines=None), ["sex", "age"], "population") == {("female", 5): 12, ("male", 100): 1000.5}


def test_the_pyramid_has_no_join(make):
    plan = pyramid_unpivot(sheet(make, *LATE), header_lines=None)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
