"""Near-duplicate vectors: signs of random hyperplanes in several tables, exact cosines, connected components.

Equal vectors of a label are one class with a number of copies, so a vector that a third of all rows hold is compared
once. A class's signature is one key of a few hyperplane signs for every table. Classes that share the label and a
table's key stand in one bucket; a bucket of more than BLOCK classes is cut into blocks, and every two of its blocks are
a unit of work of their own, so no task holds a whole bucket. Work is done in two rounds:

1. Units read signatures only, some bytes a class. Two classes are candidates in the first table in which they agree, so
   a pair is looked at once, if their whole signatures differ in no more signs than vectors at the threshold do (five
   standard deviations above the mean). What leaves a unit is not pairs but the classes that have a candidate in it.
2. Those classes' vectors come to the unit, where cosines are taken in double precision. Again no pairs leave it: each
   class has the number of copies that it links with, and the least class it is connected with inside the unit.

The numbers add up to exact counts of links, the least classes are links enough for the components. Of n different
vectors that are all near each other, every two are compared (in blocks, one matrix product each), as each asks for its
own number of links; shuffled are n * n / BLOCK rows for them, and rows in proportion to n for all others.

The number of signs in a key follows the number of rows (so that buckets keep their size), the number of tables follows
from it: a pair exactly at the threshold is missed with a probability of MISSED, one above it with less.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censusloom.llm.components import components
from censusloom.llm.units import column, deal, sides, work
from censusloom.plans.storage import settle

THRESHOLD = 0.93
#: Classes of a bucket to aim at, and of a block at most.
BUCKET, BLOCK = 128, 1024
#: Share of the pairs exactly at the threshold that no table brings together.
MISSED = 0.0005
LEAST_SIGNS, MOST_SIGNS = 8, 28
#: Entries that travel as one group of work.
ENTRIES = 1 << 15
SEED = 11


class Scheme:
    """Signs of a key and number of tables for a threshold and the rows of the largest label."""

    def __init__(self, rows: int, threshold: float):
        self.threshold = threshold
        self.differ = math.acos(threshold) / math.pi  # chance that a sign tells two vectors at the threshold apart
        self.signs = min(MOST_SIGNS, max(LEAST_SIGNS, math.ceil(math.log2(max(1, rows) / BUCKET))))
        self.tables = math.ceil(math.log(MISSED) / math.log1p(-((1 - self.differ) ** self.signs)))
        bits = self.signs * self.tables
        self.most = math.floor(bits * self.differ + 5 * math.sqrt(bits * self.differ * (1 - self.differ)))
        self.kind = np.dtype(np.uint8 if self.signs <= 8 else np.uint16 if self.signs <= 16 else np.uint32)

    def signatures(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, tables) keys."""
        planes = _planes(vectors.shape[1], self.signs * self.tables)
        above = (vectors @ planes >= 0).reshape(len(vectors), self.tables, self.signs)
        return (above * (1 << np.arange(self.signs, dtype=np.int64))).sum(axis=2).astype(self.kind)


@lru_cache(maxsize=16)
def _planes(size: int, bits: int) -> np.ndarray:
    return np.random.default_rng((SEED, size)).standard_normal((bits, size)).T.copy()


def _units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled by their largest component first, so that no square over- or underflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


ROW = [T.StructField("class", T.BinaryType()), T.StructField("label", T.StringType()), T.StructField("vector", T.BinaryType()), T.StructField("signature", T.BinaryType())]


def _signed(scheme: Scheme) -> Callable:
    """(key, label, vector) -> key, class (a digest of label and vector), label, vector as bytes of doubles, signature.

    All but the key are null where the label is missing or the vector is missing, zero, or not all finite numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, labels = batch.column(2), batch.column(1).to_pylist()
            values = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False) + 0.0  # nulls are NaN; no negative zero
            offsets = lists.offsets.to_numpy().astype(np.int64)
            present = lists.is_valid().to_numpy(zero_copy_only=False) & batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            sizes = np.diff(offsets) * present
            out: list[tuple] = [(None, None, None, None)] * len(sizes)
            for size in np.unique(sizes[sizes > 0]):
                own = np.flatnonzero(sizes == size)
                vectors = values[offsets[own][:, None] + np.arange(size)]
                usable = np.isfinite(vectors).all(axis=1) & vectors.any(axis=1)
                own, vectors = own[usable], vectors[usable]
                if not len(own):
                    continue
                for i, v, sign in zip(own, vectors, scheme.signatures(_units(vectors)), strict=True):
                    raw = v.tobytes()
                    out[i] = (blake2b(labels[i].encode() + b"\0" + raw, digest_size=16).digest(), labels[i], raw, sign.tobytes())
            columns = zip(*out, strict=True) if out else [[]] * 4
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.string(), pa.binary(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [batch.schema.names[0], *(f.name for f in ROW)])

    return run


def _first_agreement(signs: np.ndarray, a: np.ndarray, b: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which pairs agree in this table and in none before it."""
    agree = signs[a] == signs[b]
    return agree.any(axis=1) & (agree.argmax(axis=1) == table[a]) & (table[a] == table[b])


def _screen(scheme: Scheme) -> Callable:
    """Of each unit the classes that have a candidate in it."""

    def run(table: pa.Table) -> pa.Table:
        signs = np.frombuffer(b"".join(table["signature"].to_pylist()), scheme.kind).reshape(-1, scheme.tables)
        size = signs.shape[1] * scheme.kind.itemsize
        wide = np.zeros((len(signs), -(-size // 8) * 8), np.uint8)
        wide[:, :size] = np.ascontiguousarray(signs).view(np.uint8).reshape(len(signs), size)
        wide, side, number = wide.view(np.uint64), column(table, "side"), column(table, "number")
        hit = np.zeros(len(signs), bool)
        for own in work(table):
            left, right, same = sides(side, own)
            for k in range(0, len(left), 128):
                part = left[k : k + 128]
                apart = sum(np.bitwise_count(wide[part, w][:, None] ^ wide[right, w][None, :]).astype(np.uint16) for w in range(wide.shape[1]))
                i, j = np.nonzero(apart <= scheme.most)
                if same:
                    i, j = i[i + k < j], j[i + k < j]
                a, b = part[i], right[j]
                near = _first_agreement(signs, a, b, number)
                hit[a[near]] = True
                hit[b[near]] = True
        return table.filter(pa.array(hit)).select(["pack", "unit", "number", "side", "id"])

    return run


def _least(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each of n rows reaches over the pairs (a, b)."""
    least = np.arange(n)
    while True:
        new = least.copy()
        np.minimum.at(new, a, least[b])
        np.minimum.at(new, b, least[a])
        new = new[new]
        if (new == least).all():
            return least
        least = new


def _compare(scheme: Scheme) -> Callable:
    """Of each unit the classes that link in it: copies they link with, and the least class they are connected with."""

    def run(table: pa.Table) -> pa.Table:
        signs = np.frombuffer(b"".join(table["signature"].to_pylist()), scheme.kind).reshape(-1, scheme.tables)
        side, number, ids, copies = (column(table, n) for n in ("side", "number", "id", "copies"))
        raw, labels = table["vector"].to_pylist(), table["label"].to_pylist()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for unit in work(table):
            spaces: dict[tuple, list[int]] = {}
            for k in unit.tolist():
                spaces.setdefault((labels[k], len(raw[k])), []).append(k)
            for own in map(np.array, spaces.values()):
                left, right, same = sides(side, own)
                if not len(left) or not len(right):
                    continue
                vectors = _units(np.frombuffer(b"".join(raw[k] for k in own), np.float64).reshape(len(own), -1))
                place = np.zeros(len(side), np.int64)
                place[own] = np.arange(len(own))
                i, j = np.nonzero(vectors[place[left]] @ vectors[place[right]].T >= scheme.threshold)
                if same:
                    i, j = i[i < j], j[i < j]
                a, b = left[i], right[j]
                near = _first_agreement(signs, a, b, number)
                a, b = a[near], b[near]
                if not len(a):
                    continue
                pa_, pb = place[a], place[b]
                links = np.zeros(len(own), np.int64)
                np.add.at(links, pa_, copies[b])
                np.add.at(links, pb, copies[a])
                least = _least(len(own), pa_, pb)
                linked = np.flatnonzero(links)
                out.append((ids[own[linked]], links[linked], ids[own[least[linked]]]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(columns, names=["id", "links", "least"])

    return run


def _found(classes: DataFrame, scheme: Scheme) -> DataFrame:
    """(id, links, least) for each class and unit in which it links."""
    bytes_ = scheme.kind.itemsize
    part = F.expr(f"substring(signature, number * {bytes_} + 1, {bytes_})")
    entries = classes.select("id", "signature", F.col("label"), F.octet_length("vector").alias("size"), F.explode(F.sequence(F.lit(0), F.lit(scheme.tables - 1))).alias("number"))
    entries = entries.select("id", "signature", "number", F.xxhash64("label", "size", "number", part).alias("bucket"))
    units = deal(entries, classes.count() * scheme.tables, BLOCK, ENTRIES)
    near = units.groupBy("pack").applyInArrow(_screen(scheme), "pack long, unit long, number int, side int, id long")
    full = near.join(classes.select("id", "label", "vector", "signature", "copies"), "id")
    return full.groupBy("pack").applyInArrow(_compare(scheme), "id long, links long, least long")


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of df: key, n_links long, component_id, kept boolean.

    Only rows of one label are compared. n_links counts the other rows whose cosine with this one is at least the
    threshold, component_id is the least key that a row reaches by links, itself included, kept says whether that is
    its own. Rows without a label or a usable vector (null, empty, zero, with null, infinite or NaN components) link
    with nothing; neither do vectors of different length. Rows that repeat a key are rows of their own. A null key is
    never the least one of several; alone it is its own component. An empty table gives no rows. Only the three named
    columns are read.
    """
    rows = df.select(F.col(key).alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("embedding"))
    largest = rows.where("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    scheme = Scheme(largest or 0, threshold)
    signed = settle(rows.mapInArrow(_signed(scheme), T.StructType([rows.schema["vec_id"], *ROW])), "signed")
    grouped = signed.where("class is not null").groupBy("class", "label", "vector", "signature").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    classes = settle(grouped.withColumn("id", F.monotonically_increasing_id()), "classes")
    found = settle(_found(classes, scheme), "found")
    ends = components(found.select(F.col("id").alias("u"), F.col("least").alias("v")))
    linked = classes.join(found.groupBy("id").agg(F.sum("links").alias("links")), "id").join(ends, F.col("id") == F.col("node"))
    linked = settle(linked.select("class", "links", "component", "first"), "linked")
    least = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    linked = linked.join(least, "component").select("class", "links", "component_id")
    alone = F.octet_length("class") < 16  # rows without a class: no partner, and spread over all tasks
    own = F.coalesce("class", F.unhex(F.hex(F.xxhash64("vec_id")))).alias("class")
    answers = classes.select("class", "copies", "first").join(linked, "class", "left")
    answers = answers.select("class", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "first").alias("component_id"))
    found_of = signed.select("vec_id", own).join(answers, "class", "left")
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    out = found_of.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).withColumnRenamed("vec_id", key)
