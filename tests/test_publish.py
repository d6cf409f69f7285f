"""Replacing written levels, figures observed by the write, and runs that resume."""

from __future__ import annotations

import json
import os
from dataclasses import replace

import pytest
from conftest import as_dict, rows
from pyspark.sql import functions as F

from censusloom.operators import quality as ql
from censusloom.plans import Inputs, build_levels, shared_folder
from censusloom.plans.storage import Manifest, fingerprint, settle
from censusloom.schemas import LEVEL_CODE
from censusloom.sinks import LevelMetrics, observed_level_stats, observed_nulls, observed_validation, publish, recover, write_level
from test_build import CFG, _Cluster, inputs  # noqa: F401


def years(make, *pairs):
    return make.frame([(y, v) for y, v in pairs], "year int, v int")


def table(spark, path):
    return rows(spark.read.schema("v int, year int").parquet(path), "year", "v")


def hidden(path):
    return [n for n in os.listdir(path) if n.startswith("_") and n != "_SUCCESS"]


def test_replacing_drops_and_keeps(spark, make, tmp_path):
    path = str(tmp_path / "t")
    publish(years(make, (2022, 1), (2023, 2)), path, "year")
    assert table(spark, path) == [(2022, 1), (2023, 2)]
    untouched = os.listdir(f"{path}/year=2022")
    publish(years(make, (2023, 5)), path, "year", replace=False)
    assert table(spark, path) == [(2022, 1), (2023, 5)] and os.listdir(f"{path}/year=2022") == untouched
    publish(years(make, (2024, 7)), path, "year")
    assert table(spark, path) == [(2024, 7)] and hidden(path) == []


def test_a_failed_write_leaves_the_old_table(spark, make, tmp_path):
    path = str(tmp_path / "t")
    publish(years(make, (2022, 1), (2023, 2)), path, "year")
    bad = years(make, (2022, 10), (2023, 20)).withColumn("v", F.when(F.col("year") == 2023, F.raise_error(F.lit("lost midway")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost midway"):
        publish(bad, path, "year")
    assert table(spark, path) == [(2022, 1), (2023, 2)] and hidden(path) == []


@pytest.mark.parametrize("steps", range(7))
def test_a_writer_that_dies_while_renaming_is_finished_by_the_next(spark, make, tmp_path, monkeypatch, steps):
    """The rename number ``steps`` fails for good; readers see old or new partitions, recover() ends with the new table."""
    from censusloom.sinks import publishing as module

    path = str(tmp_path / "t")
    publish(years(make, (2021, 0), (2022, 1), (2023, 2)), path, "year")
    real = module.file_system
    left = [steps]

    class Dying:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == "rename":
                if left[0] == 0:
                    raise KeyboardInterrupt
                left[0] -= 1
            return getattr(self.fs, name)

    monkeypatch.setattr(module, "file_system", lambda s, p: (Dying(real(s, p)[0]), real(s, p)[1]))
    new = years(make, (2022, 10), (2023, 20))
    try:
        publish(new, path, "year")
        died = False
    except KeyboardInterrupt:
        died = True
    monkeypatch.setattr(module, "file_system", real)
    seen = dict(table(spark, path))
    assert all(seen.get(y) in (None, a, b) for y, a, b in ((2021, 0, 0), (2022, 1, 10), (2023, 2, 20)))
    committed = any(n.startswith("_commit-") for n in os.listdir(path))
    recover(spark, path)
    assert table(spark, path) == ([(2022, 10), (2023, 20)] if committed or not died else [(2021, 0), (2022, 1), (2023, 2)])
    assert hidden(path) == [] and died == (steps < 6)


def test_a_journal_is_json_that_names_partitions(spark, make, tmp_path):
    path = str(tmp_path / "t")
    publish(years(make, (2022, 1)), path, "year")
    os.makedirs(f"{path}/_staged-k/year=2022")
    with open(f"{path}/_commit-k", "w") as out:
        json.dump({"put": ["year=2022"], "drop": []}, out)
    recover(spark, path)
    assert table(spark, path) == [] and hidden(path) == []


# -- figures of a write --------------------------------------------------------------------


@pytest.fixture(scope="module")
def built(inputs):  # noqa: F811
    return build_levels(inputs, CFG)


def test_level_stats_without_a_second_scan(spark, built, tmp_path):
    metrics: dict[str, LevelMetrics] = {}
    paths = built.export(str(tmp_path), metrics=metrics)
    written = {level: spark.read.parquet(p) for level, p in paths.items()}
    want = {r["level"]: r.asDict() for r in ql.level_stats(written).collect()}
    got = {r["level"]: r.asDict() for r in observed_level_stats(spark, metrics).collect()}
    assert set(want) == set(got) == set(LEVEL_CODE)
    for level, row in want.items():
        assert got[level] == pytest.approx(row), level
    checked = {r["level"]: r for r in observed_validation(spark, metrics).collect()}
    for level, df in written.items():
        stats, bad = ql.validation_stats(df).first(), ql.invalid_rows(df).first()[0]
        row = checked[level]
        assert (row.total_rows, row.departments, row.years, row.min_age, row.max_age, row.invalid_rows) == (stats.total_rows, stats.departments, stats.years, stats.min_age, stats.max_age, bad)
        assert row.total_population == pytest.approx(stats.total_population) and row.is_valid
        nulls = ql.null_audit(df, metrics[level].audited).first().asDict()
        assert {f"{r.column}_nulls": r.nulls for r in observed_nulls(spark, {level: metrics[level]}).collect()} == nulls


def test_each_level_is_read_once(spark, built, tmp_path):
    """The export with figures has as many jobs' scans as the export alone: no job reads the written files."""
    spark.sparkContext.setJobGroup("export", "export")
    paths = built.export(str(tmp_path), ["department"], metrics=(metrics := {}))
    observed_level_stats(spark, metrics).collect()
    spark.sparkContext.setJobGroup("", "")
    plan = observed_level_stats(spark, metrics)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and os.listdir(paths["department"])


def test_one_year_rewrites_one_partition(spark, built, tmp_path):
    path = write_level(built.levels["department"], built.births, "department", str(tmp_path / "d"))
    kept = sorted(os.listdir(f"{path}/year=2022"))
    before = os.listdir(f"{path}/year=2023")
    write_level(built.levels["department"].where("year = 2023"), built.births, "department", path, replace=False)
    assert sorted(os.listdir(f"{path}/year=2022")) == kept and os.listdir(f"{path}/year=2023") != before
    assert spark.read.parquet(path).count() == 12 * built.levels["department"].count()


# -- runs that resume ----------------------------------------------------------------------


@pytest.fixture
def on_files(spark, inputs, tmp_path):  # noqa: F811
    def kept(name):
        getattr(inputs, name).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    return Inputs(**{n: kept(n) for n in ("census", "birth_records", "lookup", "departments", "flows", "estimates")})


def test_a_second_run_scans_no_microdata(spark, on_files, tmp_path):
    first = build_levels(on_files, CFG, resume=True)
    want = {lv: as_dict(df.groupBy("year").agg(F.sum("population").alias("p")), "year", "p") for lv, df in first.levels.items()}
    tables = first.manifest.tables()
    assert {"base", "flow_cells", "births", "department", "corrected_iris", "mobility_weights"} <= set(tables)
    # With the files' rows gone but names, sizes and times as before, any scan of them would fail.
    for name in ("census", "birth_records", "flows"):
        for part in os.listdir(tmp_path / name):
            if part.endswith(".parquet"):
                status = os.stat(tmp_path / name / part)
                with open(tmp_path / name / part, "r+b") as out:
                    out.write(b"\0" * status.st_size)
                os.utime(tmp_path / name / part, ns=(status.st_atime_ns, status.st_mtime_ns))
    second = build_levels(on_files, CFG, resume=True)
    for level, df in second.levels.items():
        assert as_dict(df.groupBy("year").agg(F.sum("population").alias("p")), "year", "p") == pytest.approx(want[level])
    second.close()
    assert second.manifest.tables() == []


def test_other_inputs_parameters_or_rows_have_another_fingerprint(spark, on_files, make):
    base = fingerprint(on_files.frames(), CFG)
    assert fingerprint(on_files.frames(), CFG) == base
    assert fingerprint(on_files.frames(), replace(CFG, end_year=2024)) != base
    assert fingerprint(on_files.frames() | {"census": on_files.census.where("DEPT = '75'")}, CFG) != base
    assert fingerprint(on_files.frames() | {"flows": None}, CFG) != base
    one, two = make.frame([(1, "a")], "k int, v string"), make.frame([(1, "b")], "k int, v string")
    assert fingerprint({"x": one}) == fingerprint({"x": make.frame([(1, "a")], "k int, v string")}) != fingerprint({"x": two})
    assert fingerprint({"x": one.union(two)}) == fingerprint({"x": two.union(one)}) != fingerprint({"x": one.union(one)})


def test_a_broken_table_is_not_taken(spark, make):
    manifest = Manifest(spark, "broken-" + os.urandom(4).hex())
    df = make.frame([(1, "a")], "k int, v string")
    with pytest.raises(Exception, match="midway"):
        manifest.settle(df.withColumn("k", F.raise_error(F.lit("midway")).cast("int")), "t")
    assert manifest.tables() == []
    assert rows(manifest.settle(df, "t"), "k", "v") == [(1, "a")] and manifest.tables() == ["t"]
    # The second frame is another one; the name is what counts.
    assert rows(manifest.settle(df.where("false"), "t"), "k", "v") == [(1, "a")]
    manifest.clear()


def test_an_unqualified_folder_is_judged_by_its_file_system(spark):
    class Unqualified(_Cluster):
        _jvm, _jsc = spark._jvm, spark._jsc

    with pytest.raises(ValueError, match="one machine"):
        shared_folder(Unqualified("yarn", "/shared/tables"))
    assert shared_folder(Unqualified("local[2]", "/shared/tables")) == "/shared/tables"
    assert settle(spark.range(3).toDF("id"), "ids", under=f"{shared_folder(spark)}/own").count() == 3
