"""A quantile sketch as a table: counts in buckets whose edges grow by a constant factor.

Sketches of parts are merged by adding their counts, in any order and to the same result; a sketch of a billion rows has
some thousand buckets. A quantile is off by a relative error of ACCURACY at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 0.01


def _growth(accuracy: float) -> float:
    return (1 + accuracy) / (1 - accuracy)


def bucket(value: Column, accuracy: float = ACCURACY) -> Column:
    """The bucket of a positive value: g ** (k - 1) < value <= g ** k. Others have none."""
    step = F.ceil(F.ln(value) / F.ln(F.lit(_growth(accuracy))))
    return F.when(value > 0, step.cast("int"))


def middle(step: Column, accuracy: float = ACCURACY) -> Column:
    """The value that stands for a bucket."""
    g = _growth(accuracy)
    return F.lit(2.0) * F.pow(F.lit(g), step) / F.lit(g + 1)


def quantile_sketch(df: DataFrame, value: str, by: Sequence[str] = (), accuracy: float = ACCURACY) -> DataFrame:
    """(by, bucket, n) of the positive values."""
    cells = df.select(*by, bucket(F.col(value).cast("double"), accuracy).alias("bucket")).where(F.col("bucket").isNotNull())
    return cells.groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    rows = sketches[0]
    for other in sketches[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, fractions: Sequence[float], by: Sequence[str] = (), accuracy: float = ACCURACY) -> DataFrame:
    """(by, q0, q1, ...): the value at each fraction of the rows, within the accuracy.

    A window runs over the buckets of a group, some thousand rows however many values they count.
    """
    order = Window.partitionBy(*by).orderBy("bucket")
    counted = sketch.withColumn("_upto", F.sum("n").over(order)).withColumn("_all", F.sum("n").over(Window.partitionBy(*by)))
    picks = [
        middle(F.min(F.when(F.col("_upto") >= F.lit(float(q)) * F.col("_all"), F.col("bucket"))), accuracy).alias(f"q{k}")
        for k, q in enumerate(fractions)
    ]
    return counted.groupBy(*by).agg(*picks)
