"""Scan of a published level for reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusloom.functions import january


def read_level(df: DataFrame, keys: Sequence[str], year: int | None = None, code: str | None = None) -> DataFrame:
    """January population by ``keys``; rows without the ``code`` area are left out.

    ``year`` is the partition column of written levels, so one year reads one folder.
    """
    rows = df.where(january(F.col("month")))
    if year is not None:
        rows = rows.where(F.col("year").cast("int") == year)
    if code is not None:
        rows = rows.where(F.col(code).isNotNull() & (F.col(code) != ""))
    if "age" in keys:
        rows = rows.withColumn("age", F.col("age").cast("int"))
    return rows.groupBy(*keys).agg(F.sum("population").alias("pop"))
