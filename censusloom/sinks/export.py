"""Publishing levels: birth-month expansion, partitioned files, contract."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusloom.config import LEVELS
from censusloom.functions import january
from censusloom.operators.disaggregate import expand_birth_month
from censusloom.schemas import check_level, conform
from censusloom.sinks.metrics import LevelMetrics
from censusloom.sinks.publishing import publish

#: Rows of an output file at most: some hundred megabytes.
ROWS_PER_FILE = 5_000_000


def level_rows(df: DataFrame, births: DataFrame, level: str, yearly: bool = False) -> DataFrame:
    """The published rows of a compact level, lazily; ``yearly`` keeps January snapshots.

    The compact rows are rebalanced by year before the expansion: a twelfth of
    the bytes moves, and Spark splits a year that is too big for one task. As files then grow twelvefold, their rows
    are bounded when they are written.
    """
    check_level(level)
    rows = df.where(january(F.col("month"))) if yearly else df
    rows = rows.hint("rebalance", F.col("year"))
    return conform(expand_birth_month(rows, births, level), level)


def write_level(
    df: DataFrame,
    births: DataFrame,
    level: str,
    path: str,
    yearly: bool = False,
    replace: bool = True,
    metrics: LevelMetrics | None = None,
) -> str:
    """Write one level as parquet partitioned by year, replacing what is there.

    The old files stay readable until the new ones are whole. Without ``replace``
    years that ``df`` does not hold stay as they are. ``metrics`` are taken from
    the rows as they are written.
    """
    rows = level_rows(df, births, level, yearly)
    if metrics is not None:
        rows = metrics.watch(rows)
    return publish(rows, path, "year", replace, ROWS_PER_FILE)


def write_levels(
    levels: Mapping[str, DataFrame],
    births: DataFrame,
    folder: str,
    yearly_levels: Iterable[str] = (),
    replace: bool = True,
    metrics: dict[str, LevelMetrics] | None = None,
) -> dict[str, str]:
    """Write levels under ``folder``; returns level -> path, and puts the figures of each into ``metrics``."""
    yearly, paths = set(yearly_levels), {}
    for level, df in levels.items():
        observed = None if metrics is None else metrics.setdefault(level, LevelMetrics(level))
        path = f"{folder}/population_{level}"
        paths[level] = write_level(df, births, level, path, level in yearly, replace, observed)
    return paths


def export_levels(
    levels: Mapping[str, DataFrame],
    births: DataFrame,
    folder: str,
    selected: Iterable[str] | None = None,
    yearly_levels: Iterable[str] = (),
    replace: bool = True,
    metrics: dict[str, LevelMetrics] | None = None,
) -> dict[str, str]:
    """Write the selected levels (all by default); an unknown level is an error before any work."""
    wanted = list(LEVELS) if selected is None else list(selected)
    for level in [*wanted, *yearly_levels]:
        check_level(level)
    return write_levels({lv: levels[lv] for lv in wanted}, births, folder, yearly_levels, replace, metrics)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)
