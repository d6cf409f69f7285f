"""Sums of counting tables of fixed size over all tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusloom.llm.packed import planes, unplanes

#: Cells of a segment; a table travels in segments.
SEGMENT = 1 << 14
NAMES = ["segment", "counts"]
SCHEMA = "segment int, counts binary"


def segments(table: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """A task's table as rows; segments without a count are left out."""
    parts = table.astype(np.uint32).reshape(-1, SEGMENT)
    used = np.flatnonzero(parts.any(axis=1))
    return pa.array(used.astype(np.int32)), pa.array([planes(parts[k]) for k in used], pa.binary())


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k not in sums:
                sums[k] = np.zeros(SEGMENT, np.int64)
            sums[k] += unplanes(counts, np.uint32)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], NAMES)


def total(rows: DataFrame, cells: int) -> np.ndarray:
    """The sum of all tasks' tables; every segment is added up as it streams by. The result has a fixed size."""
    out = np.zeros(cells, np.int64).reshape(-1, SEGMENT)
    for row in rows.select(*NAMES).repartition(F.col("segment")).mapInArrow(_add, SCHEMA).collect():
        out[row["segment"]] += np.frombuffer(row["counts"], np.int64)
    return out.reshape(-1)
