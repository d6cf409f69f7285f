"""Queries that settle tables, on a cluster whose shared folder is a mounted one."""

from __future__ import annotations

import shutil

import pytest
from compare import differences, duckdb_views

from censusloom.catalog import oracle, queries
from censusloom.plans import shared_folder
from censusloom.plans.storage import Manifest, run_folder

SETTLING = [
    "all_ages_canton",
    "all_ages_epci",
    "all_ages_iris",
    "band_share_vs_national",
    "birth_month_all",
    "birth_month_national",
    "birth_month_own",
    "birth_month_region",
    "blend_iris",
    "blend_epci",
    "bottom20_share",
    "canton_weights",
    "bounds",
    "census_departments",
    "census_diff",
    "census_scan",
    "child_parent_epci",
    "census_scan_years",
    "child_parent_iris",
    "cohort_totals",
    "code_match_rate",
    "commune_lookup",
    "commune_reference",
    "coverage_by_department",
]
# Queries that run after another one, when the shared folder was cleared in between.
LATER = [
    "all_ages_epci",
    "all_ages_iris",
    "band_share_vs_national",
    "birth_month_all",
    "birth_month_national",
    "birth_month_own",
    "birth_month_region",
    "blend_iris",
    "blend_epci",
    "bottom20_share",
    "canton_weights",
    "bounds",
    "census_departments",
    "census_diff",
    "census_scan",
    "child_parent_epci",
    "census_scan_years",
    "child_parent_iris",
    "cohort_totals",
    "code_match_rate",
    "commune_lookup",
    "commune_reference",
    "coverage_by_department",
]

# Queries that settle before any other one has, when the folder that Spark made at the start was cleared by then.
FIRST = [
    "all_ages_iris",
    "band_share_vs_national",
    "birth_month_all",
    "birth_month_national",
    "birth_month_own",
    "birth_month_region",
    "blend_iris",
    "blend_epci",
    "bottom20_share",
    "canton_weights",
    "bounds",
    "census_departments",
    "census_diff",
    "census_scan",
    "child_parent_epci",
    "census_scan_years",
    "child_parent_iris",
    "cohort_totals",
    "code_match_rate",
    "commune_lookup",
    "commune_reference",
    "coverage_by_department",
]


@pytest.fixture
def cluster(spark, tmp_path, monkeypatch):
    """The session as if its executors were on other machines, with a local path as shared folder."""
    _name(spark, monkeypatch, f"file:{tmp_path}")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://head:7077")
    return spark


def _name(spark, monkeypatch, folder):
    get = spark.conf.get
    monkeypatch.setattr(spark.conf, "get", lambda key, *default: folder if key == "spark.checkpoint.dir" else get(key, *default))


def _cleared(spark, tmp_path, monkeypatch):
    """The shared folder as if Spark had made it for the application and somebody had cleared it away."""
    _name(spark, monkeypatch, f"file:{tmp_path}/cleared")
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: f"file:{tmp_path}/cleared/0f0f")


@pytest.fixture(scope="module")
def views(sf_dir):
    return duckdb_views(sf_dir)


def test_a_local_path_that_all_machines_see_is_taken(cluster, tmp_path):
    assert shared_folder(cluster) == f"file:{tmp_path}"
    assert list((tmp_path / "censusloom").iterdir()) == []


def test_a_local_path_that_loses_rows_is_refused(cluster, monkeypatch):
    some = cluster.range(1)  # what is left if the other cores wrote to disks of their own
    monkeypatch.setattr(cluster, "range", lambda *a: some)
    for _ in range(2):
        with pytest.raises(ValueError, match="one machine"):
            shared_folder(cluster)


def test_a_local_path_that_is_not_there_is_refused(cluster, tmp_path, monkeypatch):
    _name(cluster, monkeypatch, f"file://{tmp_path}/none")
    with pytest.raises(ValueError, match="one machine"):
        shared_folder(cluster)


@pytest.mark.parametrize("name", SETTLING)
def test_query_on_a_cluster(cluster, sf_dir, views, name):
    assert differences(queries.queries()[name](cluster, sf_dir), views, oracle.oracle_sql()[name]) == []


def test_a_cleared_folder_that_loses_rows_is_refused(cluster, tmp_path, monkeypatch):
    shared_folder(cluster)
    shutil.rmtree(tmp_path)
    some = cluster.range(1)
    monkeypatch.setattr(cluster, "range", lambda *a: some)
    for _ in range(2):
        with pytest.raises(ValueError, match="one machine"):
            shared_folder(cluster)


@pytest.mark.parametrize("name", LATER)
def test_query_after_the_folder_was_cleared(cluster, sf_dir, views, tmp_path, name):
    shared_folder(cluster)
    shutil.rmtree(tmp_path)
    assert differences(queries.queries()[name](cluster, sf_dir), views, oracle.oracle_sql()[name]) == []


def test_a_folder_that_spark_made_is_tried_once_cleared(cluster, tmp_path, monkeypatch):
    _cleared(cluster, tmp_path, monkeypatch)
    assert shared_folder(cluster) == f"file:{tmp_path}/cleared"


def test_a_folder_that_spark_made_and_that_loses_rows_is_refused(cluster, tmp_path, monkeypatch):
    _cleared(cluster, tmp_path, monkeypatch)
    some = cluster.range(1)
    monkeypatch.setattr(cluster, "range", lambda *a: some)
    for _ in range(2):
        with pytest.raises(ValueError, match="one machine"):
            shared_folder(cluster)


def test_a_missing_folder_beside_the_one_that_spark_made_is_refused(cluster, tmp_path, monkeypatch):
    _cleared(cluster, tmp_path, monkeypatch)
    _name(cluster, monkeypatch, f"file:{tmp_path}/clear")
    with pytest.raises(ValueError, match="one machine"):
        shared_folder(cluster)


@pytest.mark.parametrize("master", ["spark://head:7077", "local[8]"])
@pytest.mark.parametrize("mode", [0o1777, 0o755])
def test_whom_the_shared_folder_is_open_to_may_settle_there(cluster, tmp_path, monkeypatch, master, mode):
    monkeypatch.setattr(cluster.sparkContext, "master", master)
    tmp_path.chmod(mode)
    assert run_folder(cluster).startswith(f"file:{tmp_path}/censusloom/")
    assert (tmp_path / "censusloom").stat().st_mode & 0o7777 == mode


def test_each_user_resumes_tables_of_their_own(cluster, monkeypatch):
    first = Manifest(cluster, "0f").folder
    monkeypatch.setattr(cluster.sparkContext, "sparkUser", lambda: "another")
    assert Manifest(cluster, "0f").folder.split("/")[-2:] != first.split("/")[-2:]


@pytest.mark.parametrize("name", FIRST)
def test_query_after_the_folder_that_spark_made_was_cleared(cluster, sf_dir, views, tmp_path, monkeypatch, name):
    _cleared(cluster, tmp_path, monkeypatch)
    assert differences(queries.queries()[name](cluster, sf_dir), views, oracle.oracle_sql()[name]) == []
