from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from censusloom import functions as fn


def evaluate(spark, values, expression, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_age_bands(spark):
    ages = [-1, 0, 4, 5, 17, 19, 20, 94, 95, 120, 121, None]
    assert evaluate(spark, ages, fn.age_band, "int") == [
        None, "0_4", "0_4", "5_9", "15_19", "15_19", "20_24", "90_94", "95_plus", "95_plus", None, None,
    ]


def test_every_age_has_one_of_twenty_bands(spark):
    bands = evaluate(spark, list(range(121)), fn.age_band, "int")
    assert None not in bands and len(set(bands)) == 20


def test_sex_codes(spark):
    assert evaluate(spark, ["1", "2", "9", "", None], fn.decode_sex) == ["male", "female", None, None, None]


def test_commune_of_area_code(spark):
    assert evaluate(spark, ["751010101", "75101XXXX", "ZZZZZZZZZ", None], fn.commune_of) == ["75101", "75101", "", ""]


def test_department_of_commune(spark):
    codes = ["75101", "97101", "2A004", "98818", None]
    assert evaluate(spark, codes, fn.department_of) == ["75", "971", "2A", "98", None]


def test_usable_area(spark):
    codes = ["751010101", "75101XXXX", "ZZZZZZZZZ", "7510101", None]
    assert evaluate(spark, codes, fn.usable_iris) == [True, False, False, False, None]


def test_masked_area_falls_back_to_commune(spark):
    assert evaluate(spark, ["75101XXXX", "751010101"], fn.iris_or_commune) == ["75101", "751010101"]


def test_birth_age_is_a_difference_of_years(spark):
    assert evaluate(spark, ["2004", "1922"], lambda c: fn.birth_age(c, 2022)) == [18, 100]


def test_confidence_steps_are_doubles(spark):
    df = spark.range(2016, 2029).select(fn.confidence(F.col("id"), 2022).alias("x"))
    assert dict(df.dtypes)["x"] == "double"
    assert [r.x for r in df.collect()] == pytest.approx(
        [0.06, 0.05, 0.04, 0.03, 0.03, 0.02, 0.02, 0.02, 0.03, 0.03, 0.04, 0.05, 0.06]
    )


def test_age_labels(spark):
    labels = ["0", "017", "17 ans", "100", "100 ou plus", "", "SEXE", None]
    assert evaluate(spark, labels, fn.age_label) == [0, 17, 17, 100, 100, None, None, None]


def test_sheet_sex_codes(spark):
    assert evaluate(spark, ["1", "1.0", " 2 ", "Ensemble"], fn.sex_code) == ["1", "1", "2", "Ensemble"]


def test_french_numbers(spark):
    cells = ["12", "1 234,5", "1 234,5", "", "n.d.", None]
    assert evaluate(spark, cells, fn.french_number) == [12.0, 1234.5, 1234.5, 0.0, 0.0, 0.0]


def test_safe_ratio_never_divides_by_zero(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "a double, b double")
    assert [r.x for r in df.select(fn.safe_ratio(F.col("a"), F.col("b")).alias("x")).collect()] == [0.25, 0, 0, None]


def test_unique_names_the_repeated_key(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "k string, v int")
    assert sorted(map(tuple, fn.unique(df.distinct(), ["k"], "table").collect())) == [("a", 1), ("b", 2)]
    with pytest.raises(Exception, match="table: more than one row for b"):
        fn.unique(df, ["k"], "table").collect()


def test_unique_holds_one_row_of_a_key_that_occurs_ten_million_times(spark):
    rows = spark.range(10_000_000).selectExpr("'hot' as k", "id as v", "cast(id as string) as name")
    with pytest.raises(Exception, match="table: more than one row for hot"):
        fn.unique(rows, ["k"], "table").collect()
    plan = fn.unique(rows, ["k"], "table")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "partial_first" in plan
