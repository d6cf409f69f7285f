from __future__ import annotations

import json

from conftest import as_dict, rows

from censusloom.sources import (
    academic_year,
    commune_lookup,
    district_rows,
    estimates_long,
    read_cog,
    read_commune_records,
    read_enrolment,
    read_level,
    read_pyramid_csv,
    read_reference_pyramid,
)
from censusloom.sources.external import DEGREE_GROUPS


def test_commune_lookup_from_json(spark, tmp_path):
    path = tmp_path / "communes.json"
    records = [
        {"code": "01001", "nom": "Une", "codeEpci": "200069193", "codeDepartement": "01", "population": 800},
        {"code": "01002", "nom": "Deux", "codeDepartement": "01", "population": 10},
        {"code": "01003", "nom": "Trois", "codeEpci": "200069193", "codeDepartement": "01"},
    ]
    path.write_text(json.dumps(records))
    lookup = commune_lookup(read_commune_records(spark, str(path)), district_rows(spark))
    assert rows(lookup.where("department_code = '01'"), "commune_code", "commune_population") == [("01001", 800), ("01003", 0)]
    districts = as_dict(lookup.where("commune_population = 0 AND commune_code <> '01003'"), "commune_code", "epci_code")
    assert len(districts) == 45
    assert (districts["75120"], districts["69389"], districts["13216"]) == ("200054781", "200046977", "200054807")


def test_commune_reference_keeps_leading_zeros(spark, tmp_path):
    path = tmp_path / "cog.csv"
    path.write_text("TYPECOM,COM,DEP,CAN\nCOM,01001,01,0108\nCOM,2A004,2A,2A01\n")
    assert rows(read_cog(spark, str(path)), "commune_code", "department_code", "canton_code") == [
        ("01001", "01", "0108"), ("2A004", "2A", "2A01"),
    ]


def test_semicolon_pyramid(spark, tmp_path):
    path = tmp_path / "pyramid.csv"
    path.write_text("Année; Âge ;Sexe;Pop\n2019;17;1;-120\n2019;17;2;118\n2018;17;2;7\n2019;90+;2;4\n2019;18;T;9\n2019;19;1;0\n")
    raw = spark.read.option("header", True).option("sep", ";").csv(str(path))
    assert rows(read_pyramid_csv(raw, 2019), "age", "sex", "population") == [(17, "female", 118.0), (17, "male", 120.0)]


def test_regional_pyramids_are_one_scan(spark, tmp_path):
    for region, pop in (("11", 5), ("53", 7)):
        folder = tmp_path / region
        folder.mkdir()
        (folder / "pyramid.csv").write_text(f"ANNEE,AGE,SEXE,POP\n2022,18,M,{pop}\n2022,18,F,{pop + 1}\n")
    ref = read_reference_pyramid(spark, [str(tmp_path / "11"), str(tmp_path / "53")])
    assert rows(ref, "region_code", "year", "age", "sex", "pop") == [
        ("11", 2022, 18, "female", 6.0), ("11", 2022, 18, "male", 5.0),
        ("53", 2022, 18, "female", 8.0), ("53", 2022, 18, "male", 7.0),
    ]


def test_estimates_keep_only_lines_with_numbers(make):
    wide = make.frame(
        [("2022", "2006", "434", "416"), ("2022", "Total", "9", "9"), ("2026", "2006", "418", "402"), ("2026", "2005", "1", "n.d."), ("2026", None, None, None)],
        "year string, naissance string, male string, female string",
    )
    sums = as_dict(estimates_long(wide).groupBy("year", "naissance").sum("population"), ["year", "naissance"], "sum(population)")
    assert sums == {(2022, 2006): 850, (2026, 2006): 820}


def test_enrolment(make):
    df = make.frame(
        [("2022-23", "75056", "UNIV", "100"), ("2022-23", "75056", "STS", "10"), ("2021-22", "75056", "UNIV", "7"), ("2022-23", "", "UNIV", "5"), ("2022-23", None, "GE", "5")],
        "annee_universitaire string, com_id string, regroupement string, effectif string",
    )
    assert academic_year(2022) == "2022-23" and academic_year(1999) == "1999-00"
    assert rows(read_enrolment(df, 2022), "com_id", "enrolled") == [("75056", 110)]
    assert rows(read_enrolment(df, 2022, DEGREE_GROUPS), "com_id", "enrolled") == [("75056", 100)]


def test_level_scan_reads_one_year(spark, make, tmp_path):
    df = make.frame(
        [(2022, 1, "E1", 18, 5.0), (2022, 2, "E1", 18, 5.0), (2023, 1, "E1", 18, 6.0), (2022, 1, "", 18, 9.0), (2022, 1, None, 18, 9.0)],
        "year int, month int, epci_code string, age int, population double",
    )
    path = str(tmp_path / "epci")
    df.write.partitionBy("year").parquet(path)
    level = read_level(spark.read.parquet(path), ["epci_code", "age"], 2022, "epci_code")
    assert rows(level, "epci_code", "age", "pop") == [("E1", 18, 5.0)]
    assert "PartitionFilters: [isnotnull(year" in level._jdf.queryExecution().executedPlan().toString()


def test_commune_records_by_line_and_as_an_array(spark, tmp_path):
    import json

    from censusloom.sources import read_commune_records

    records = [{"code": f"3100{k}", "nom": "x", "codeEpci": "E", "codeDepartement": "31", "population": k} for k in range(5)]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, records)))
    (tmp_path / "array.json").write_text(json.dumps(records, indent=1))
    lines = read_commune_records(spark, str(tmp_path / "lines.json"), lines=True)
    array = read_commune_records(spark, str(tmp_path / "array.json"))
    assert sorted(map(tuple, lines.collect())) == sorted(map(tuple, array.collect())) and lines.count() == 5


def test_a_repeated_commune_stops_the_run(spark, make):
    from censusloom.sources import commune_lookup

    records = make.frame([("31555", "T", "E", "31", 1), ("31555", "T", "F", "31", 1)], "code string, nom string, codeEpci string, codeDepartement string, population bigint")
    with __import__("pytest").raises(Exception, match="commune lookup: more than one row for 31555"):
        commune_lookup(records).collect()


def test_semicolon_files(spark, tmp_path):
    from censusloom.sources import read_enrolment, read_pyramid_csv, read_semicolon

    (tmp_path / "p.csv").write_text(" Année;Âge ;Sexe;Pop\n2019;7;1;-30\n2019;7;2;25\n2020;7;2;1\n", encoding="utf-8")
    rows_ = read_pyramid_csv(read_semicolon(spark, str(tmp_path / "p.csv")), 2019).collect()
    assert sorted((r.age, r.sex, r.population) for r in rows_) == [(7, "female", 25.0), (7, "male", 30.0)]
    (tmp_path / "e.csv").write_text("annee_universitaire;com_id;regroupement;effectif\n2022-23;31555;UNIV;4\n2022-23;31555;GE;3\n2021-22;31555;GE;9\n")
    assert [tuple(r) for r in read_enrolment(read_semicolon(spark, str(tmp_path / "e.csv")), 2022).collect()] == [("31555", 7)]


def test_years_of_microdata_with_other_columns(spark, tmp_path):
    from pytest import raises

    from censusloom.schemas import CENSUS_COLUMNS
    from censusloom.sources import read_birth_records, read_census, read_flows

    one, two, three = (str(tmp_path / n) for n in ("one", "two", "three"))
    spark.createDataFrame([("751010101", "75", "11", "7599", "2004", "1", "100.5", "x")], "IRIS string, DEPT string, REGION string, CANTVILLE string, ANAI string, SEXE string, IPONDI string, EXTRA string").write.parquet(one)
    spark.createDataFrame([(50.25, "2", 2003, "84", "01", "010010000")], "ipondi double, sexe string, ANAI int, region string, Dept string, IRIS string").write.parquet(two)
    spark.createDataFrame([("2", "2003")], "SEXE string, ANAI string").write.parquet(three)
    got = read_census(spark, [one, two])
    assert got.columns == list(CENSUS_COLUMNS) and set(got.dtypes) == {(c, "string") for c in CENSUS_COLUMNS}
    assert sorted(map(tuple, got.collect())) == [("010010000", "01", "84", None, "2003", "2", "50.25"), ("751010101", "75", "11", "7599", "2004", "1", "100.5")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EXTRA" not in plan and "Exchange" not in plan
    with raises(ValueError, match="three: no column IRIS, DEPT, REGION, IPONDI"):
        read_census(spark, [one, three])
    with raises(ValueError, match="one: no column COMMUNE, DCETUF, AGEREV10"):
        read_flows(spark, [one])
    with raises(ValueError, match="two: no column MNAI"):
        read_birth_records(spark, two)
