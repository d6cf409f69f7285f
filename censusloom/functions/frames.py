"""Shapes shared by the operators: shares, scalar aggregates, unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def safe_ratio(part: Column, total: Column) -> Column:
    """part / total where the total is positive, else 0."""
    return F.when(total > 0, part / total).otherwise(F.lit(0.0))


def share_within(df: DataFrame, within: Sequence[str], value: str, out: str) -> DataFrame:
    """Replace ``value`` by its share of the group total; rows with a NULL key drop out.

    The groups are cells of code lists (departments or regions, age bands, sexes: some thousands at most, however many
    persons or areas there are), so their totals are broadcast and the rows of ``df`` stay where they are. A window, or
    a join on the group, would gather each group in one task, and one department can hold a third of all areas.
    """
    totals = df.groupBy(*within).agg(F.sum(value).alias("_total"))
    return (
        df.join(F.broadcast(totals), list(within))
        .withColumn(out, safe_ratio(F.col(value), F.col("_total")))
        .drop("_total", *([] if out == value else [value]))
    )


def unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` as it is, or an error that names a key which occurs more than once. Checked when the frame is read.

    A key's state is a count and one row, also if it occurs millions of times.
    """
    rest = [c for c in df.columns if c not in keys]
    named = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
    only = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(F.concat(F.lit(f"{what}: more than one row for "), named)))
    return rows.withColumn("_row", only).select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def single(df: DataFrame, *columns: Column) -> Column:
    """A one-row aggregate of ``df`` as a column: the value itself, or a struct of several.

    A scalar subquery: evaluated once, and no join with a one-row table.
    """
    return df.agg(columns[0] if len(columns) == 1 else F.struct(*columns)).scalar()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
