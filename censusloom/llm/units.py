"""Comparing all members of buckets with each other, in units of work that no bucket's size can exceed.

A bucket of up to ``block`` members is one unit. A larger one is cut into blocks by a hash of the member, and every two
of its blocks (and each by itself) are a unit. Units travel in packs of about even size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusloom.plans.storage import settle


def deal(entries: DataFrame, rows: int, block: int, pack: int) -> DataFrame:
    """(bucket, id, ...) rows -> the other columns, id, unit, side and pack; rows is their number before.

    Side 3: all rows of the unit are compared with each other; else rows of side 1 with rows of side 2.
    """
    names = [c for c in entries.columns if c != "bucket"]
    heavy = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    heavy = settle(heavy.select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"), "n"), "heavy")
    more = heavy.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    packs = max(1, math.ceil((rows + more) / pack))
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    cut = entries.join(heavy.drop("n"), "bucket", "left").withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    unit = F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other"))
    side = F.when(F.col("block") == F.col("other"), F.lit(3)).when(F.col("block") < F.col("other"), F.lit(1)).otherwise(F.lit(2))
    return cut.select(*names, unit.alias("unit"), side.alias("side")).withColumn("pack", F.pmod("unit", F.lit(packs)))


def column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def work(table: pa.Table) -> Iterator[np.ndarray]:
    """Rows of each unit of a pack, ordered by id."""
    unit, ids = column(table, "unit"), column(table, "id")
    order = np.lexsort((ids, unit))
    yield from np.split(order, np.flatnonzero(np.diff(unit[order])) + 1)


def sides(side: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """The two sets of rows that a unit compares; whether they are one and the same."""
    whole = bool((side[own] == 3).all())
    return (own, own, True) if whole else (own[side[own] == 1], own[side[own] == 2], False)
