from __future__ import annotations

import os
from dataclasses import replace

import pytest
from conftest import as_dict, rows
from pyspark.sql import functions as F

from censusloom.config import LEVELS, Config
from censusloom.operators.births import department_dimension
from censusloom.plans import Inputs, build_levels, clear, settle, shared_folder
from censusloom.schemas import BIRTH_COLUMNS, CENSUS_COLUMNS, FLOW_COLUMNS, conform, output_schema
from censusloom.sinks import export_levels, preview, write_level


def strings(columns):
    return ", ".join(f"{c} string" for c in columns)


CFG = Config(min_age=15, max_age=24, end_year=2023, include_mayotte=False, include_tom=False, include_com=False)


@pytest.fixture(scope="module")
def inputs(spark, make):
    places = [("75", "11", "751010101"), ("75", "11", "751020101"), ("13", "93", "130010101")]
    persons = [
        (i, d, r, f"{d}99", str(2022 - a), s, "100") for d, r, i in places for a in range(13, 25) for s in ("1", "2")
    ]
    births = [(d, r, f"{m:02d}", "70000") for d, r in (("75", "11"), ("13", "93")) for m in range(1, 13)]
    flows = [("75101", study, "18", s, "50") for study in ("75102", "13001") for s in ("1", "2")]
    estimates = [(y, 2022 - a + (y - 2022), s, 600.0) for y in (2022, 2023) for a in range(15, 25) for s in ("male", "female")]
    return Inputs(
        census=make.frame(persons, strings(CENSUS_COLUMNS)),
        birth_records=make.frame(births, strings(BIRTH_COLUMNS)),
        lookup=make.lookup([("75101", "E1"), ("75102", "E2"), ("13001", "E3")]),
        departments=department_dimension(spark),
        flows=make.frame(flows, strings(FLOW_COLUMNS)),
        estimates=make.frame(estimates, "year int, naissance int, sex string, population double"),
    )


@pytest.fixture(scope="module")
def built(inputs):
    return build_levels(inputs, CFG)


def test_every_level_meets_the_estimates(built):
    for level, df in built.levels.items():
        sums = as_dict(df.groupBy("year", "age", "sex").agg(F.sum("population").alias("p")), ["year", "age", "sex"], "p")
        assert len(sums) == 40, level
        assert all(v == pytest.approx(600) for v in sums.values()), level


def test_all_cells_are_positive(built):
    for df in built.levels.values():
        assert df.where("population <= 0 OR population IS NULL").count() == 0


def test_mobility_moves_students_only(inputs, built):
    plain = build_levels(inputs, replace(CFG, correct_mobility=False))
    moved = as_dict(built.ratios["epci"].where("department_code = '75'"), ["epci_code", "age_band", "sex"], "geo_ratio")
    still = as_dict(plain.ratios["epci"].where("department_code = '75'"), ["epci_code", "age_band", "sex"], "geo_ratio")
    assert moved[("E2", "20_24", "male")] > still[("E2", "20_24", "male")] == 0.5
    assert moved[("E2", "10_14", "male")] == still[("E2", "10_14", "male")]


@pytest.mark.parametrize("level", LEVELS)
def test_written_levels_follow_the_contract(spark, built, tmp_path, level):
    path = write_level(built.levels[level], built.births, level, str(tmp_path / level))
    back = conform(spark.read.parquet(path), level)
    assert back.columns == output_schema(level).names
    assert sorted(p for p in os.listdir(path) if p.startswith("year=")) == ["year=2022", "year=2023"]
    total = back.agg(F.sum("population")).collect()[0][0]
    assert total == pytest.approx(built.levels[level].agg(F.sum("population")).collect()[0][0])
    assert {f.metadata["comment"] for f in output_schema(level)}


def test_contract_columns():
    assert output_schema("iris").names == [
        "year", "month", "birth_month", "snapshot_month", "born_date", "decimal_age", "department_code", "region_code",
        "epci_code", "commune_code", "iris_code", "age", "sex", "geo_precision", "population", "confidence_pct",
        "population_low", "population_high",
    ]


def test_writing_twice_replaces(spark, built, tmp_path):
    path = str(tmp_path / "department")
    for _ in range(2):
        write_level(built.levels["department"], built.births, "department", path)
    assert spark.read.parquet(path).count() == 12 * built.levels["department"].count()


def test_monthly_build_and_yearly_levels(spark, inputs, tmp_path):
    monthly = build_levels(inputs, replace(CFG, monthly=True, end_year=2022))
    paths = monthly.export(str(tmp_path), ["department", "canton"], ["canton"])
    months = {lv: rows(spark.read.parquet(p).select("month").distinct(), "month") for lv, p in paths.items()}
    assert months == {"department": [(m,) for m in range(1, 13)], "canton": [(1,)]}


def test_unknown_level_is_refused_before_any_work(built, tmp_path):
    with pytest.raises(ValueError, match="planet"):
        export_levels(built.levels, built.births, str(tmp_path), ["department", "planet"])
    with pytest.raises(ValueError, match="planet"):
        export_levels(built.levels, built.births, str(tmp_path), ["department"], ["planet"])
    assert os.listdir(tmp_path) == []


def test_a_build_needs_its_inputs(inputs, make):
    with pytest.raises(ValueError, match="flows"):
        build_levels(replace_inputs(inputs, flows=None), CFG)
    with pytest.raises(ValueError, match="birth"):
        build_levels(replace_inputs(inputs, birth_records=make.frame([], strings(BIRTH_COLUMNS)), departments=inputs.departments.limit(0)), CFG)
    with pytest.raises(ValueError, match="required"):
        build_levels(inputs, replace(CFG, include_mayotte=True))


def replace_inputs(inputs, **changes):
    from dataclasses import replace as dc_replace

    return dc_replace(inputs, **changes)


def test_preview(built):
    assert preview(built.levels["epci"], 3).count() == 3


def test_settled_tables_lie_in_the_shared_folder(spark, make):
    table = settle(make.births(["75"]), "births")
    assert shared_folder(spark).removeprefix("file:") + "/censusloom/" in table.inputFiles()[0]
    assert table.schema == make.births(["75"]).schema and table.count() == 12


class _Cluster:
    def __init__(self, master, folder):
        self.sparkContext = self
        self.conf = self
        self.master, self.folder = master, folder

    def get(self, key, default):
        return self.folder

    def getCheckpointDir(self):
        return None


def test_a_cluster_needs_a_folder_that_all_machines_share():
    with pytest.raises(ValueError, match="set spark.checkpoint.dir"):
        shared_folder(_Cluster("yarn", None))
    with pytest.raises(ValueError, match="one machine"):
        shared_folder(_Cluster("spark://head:7077", "file:/tmp/x"))
    assert shared_folder(_Cluster("yarn", "hdfs://x/y")) == "hdfs://x/y"
    assert shared_folder(_Cluster("local[2]", "file:/tmp/x")) == "file:/tmp/x"


def test_levels_are_planned_without_a_job(spark, built):
    from censusloom.operators.disaggregate import disaggregate

    spark.sparkContext.setJobGroup("plan", "plan")
    df = disaggregate(built.levels["department"], built.ratios["iris"], "iris")
    plan = df._jdf.queryExecution().executedPlan().toString()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) == 0 and "SinglePartition" not in plan


def test_a_hot_department_spreads_over_its_keys(spark, make):
    from censusloom.operators.disaggregate import disaggregate
    from censusloom.operators.projection import census_departments, project
    from censusloom.operators.shares import geo_ratios

    base = make.base(
        [(2022, "31", "76", "3101", "31555", f"31555{k:04d}", a, s, 1.0 + k) for k in range(40) for a in range(0, 90, 5) for s in ("male", "female")]
        + [(2022, "82", "76", "8201", "82121", "821210101", a, "male", 9.0) for a in range(0, 90, 5)]
    )
    parent = project(census_departments(base), Config(method="cohort-stable", min_age=0, max_age=90))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(k) for k in keys]
    for k, v in zip(keys, ("-1", "false", "16"), strict=True):
        spark.conf.set(k, v)
    try:
        df = disaggregate(parent, geo_ratios("iris", base, make.lookup([])), "iris")
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)
    assert len(sizes) > 8 and max(sizes) < sum(sizes) / 4


def test_clear_deletes_the_settled_tables(spark, make, monkeypatch):
    from censusloom.plans import storage

    monkeypatch.setattr(storage, "run_folder", lambda s: f"{shared_folder(s)}/cleared")
    table = settle(make.births(["75"]), "births")
    assert table.count() == 12
    clear(spark)
    assert not os.path.exists(f"{shared_folder(spark)}/cleared".removeprefix("file:"))


def test_no_python_and_no_cartesian_product(built):
    for df in built.levels.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "Window" not in plan


def test_no_area_row_is_exchanged(built):
    """Departments come to the area rows, whatever the level; the settled tables' sizes decide it."""
    for level in ("epci", "canton", "iris"):
        listed = built.levels[level].groupBy("year", "department_code").agg(F.sum("population").alias("p"))
        listed.collect()
        plan = listed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan, level
        above = plan.split("Exchange hashpartitioning")[1]
        assert "partial_sum" in above.split("\n")[1] + above.split("\n")[2] and plan.count("BroadcastHashJoin") == 1
