"""Importance resampling towards a target text: array-scored weights, Gumbel noise, exact ranks by regular sampling.

Words of raw and target texts are counted in a fixed number of buckets (crc32). A bucket's gain is the log ratio of its
smoothed shares, a document's weight the floored mean of its words' gains, looked up in one array. Noise that depends
on the key alone turns "the k highest scores" into a draw in proportion to the weights.

The ranks come from a parallel sort by regular sampling: every task sorts its run and takes samples at regular steps;
the sorted samples give splitters that part all runs into even segments; segments are exchanged, merged where they
arrive, and numbered from the counts of the segments before. Runs are ordered by (score, key, run, place), so rows that
tie fall into different segments too. Segments behind the last drawn rank are never exchanged.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusloom.llm.text import ALNUM, LOWER, slices, utf8, words
from censusloom.plans.storage import settle

BUCKETS = 10_000
PERCENT, LEAST_WORDS, SEED = 10, 20, 2024
#: Bytes of text handled at once, if it is not one longer text.
AT_ONCE = 1 << 22
#: Words of more bytes are hashed one by one.
LONG = 48
#: Runs of the sort at most; the driver holds the square of their number of sample keys.
MOST_RUNS = 512
SCORED = "doc_id long, n_features long, weight long, score long"


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()


def crc32s(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of every word, byte by byte over all words that are long enough."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    sizes, at = size[order], starts[order]
    out = np.full(len(order), 0xFFFFFFFF, np.uint32)
    long = int(np.searchsorted(-sizes, -LONG, "left"))
    for j in range(int(sizes[long]) if long < len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -j, "left"))
        part = out[long:n]
        out[long:n] = _TABLE[(part ^ buf[at[long:n] + j]) & np.uint32(255)] ^ (part >> np.uint32(8))
    out ^= np.uint32(0xFFFFFFFF)
    for k in range(long):
        out[k] = zlib.crc32(buf[at[k] : at[k] + sizes[k]])
    result = np.empty_like(out)
    result[order] = out
    return result


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of all words, and len + 1 bounds of the texts, for slices of a text column in its order."""
    buf, offs = utf8(column)
    for i, j in slices(offs, AT_ONCE):
        part = LOWER[buf[offs[i] : offs[j]]]
        starts, ends, bounds = words(part, offs[i : j + 1] - offs[i], ALNUM)
        yield (crc32s(part, starts, ends) % np.uint32(BUCKETS)).astype(np.int64), bounds


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for found, _ in features(batch.column(0)):
            table += np.bincount(found, minlength=BUCKETS)
    used = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(table[used])], ["bucket", "n"])


def gains(raw: DataFrame, target: DataFrame, text: str = "text") -> np.ndarray:
    """The gain of every bucket, from the counts of all words of all texts. The driver gets one row for each bucket."""
    count = lambda df, of: df.select(F.col(text)).mapInArrow(_counts, "bucket long, n long").withColumn("target", F.lit(of))
    sums = count(raw, False).unionByName(count(target, True)).groupBy("bucket", "target").agg(F.sum("n").alias("n"))
    s, t = [0] * BUCKETS, [0] * BUCKETS
    for row in sums.collect():
        (t if row["target"] else s)[row["bucket"]] = row["n"]
    all_s, all_t = sum(s) + BUCKETS, sum(t) + BUCKETS
    ratio = lambda k: float(t[k] + 1) * float(all_s) / (float(s[k] + 1) * float(all_t))
    return np.array([math.floor(1000 * math.log(ratio(k))) for k in range(BUCKETS)], np.int64)


def noise(key: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, from sha256 of "seed:key"; a null key is empty."""
    h = int(sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scores(table: np.ndarray, seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, weights = [], []
            for found, bounds in features(batch.column(1)):
                sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(table[found])))
                n = np.diff(bounds)
                counts.append(n)
                weights.append(np.where(n > 0, np.diff(sums[bounds]) // np.maximum(n, 1), 0))
            keys = batch.column(0)
            weight = np.concatenate(weights) if weights else np.zeros(0, np.int64)
            score = weight + np.array([noise(k, seed) for k in keys.to_pylist()], np.int64)
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([keys, pa.array(n), pa.array(weight), pa.array(score)], ["doc_id", "n_features", "weight", "score"])

    return run


RUN = SCORED + ", run int, place long"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = len(batch)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, run, np.int32)), pa.array(np.arange(place, place + n))], [*batch.schema.names, "run", "place"]
        )
        place += n


def _key(score: int, key: int | None, run: int, place: int) -> tuple:
    return -score, key is not None, key or 0, run, place


def _parted(splitters: list[tuple]) -> Callable:
    """Adds to the rows of sorted runs the number of splitters that are not above them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("score", "doc_id", "run", "place")]
            keys, at = [_key(*x) for x in zip(*columns, strict=True)], 0
            segment = np.zeros(len(keys), np.int32)
            # A batch may hold pieces of several runs: each piece is sorted.
            cuts = [k for k in range(1, len(keys)) if keys[k] < keys[k - 1]]
            for begin, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                at = begin
                while at < end:
                    k = bisect_left(splitters, keys[at])
                    k += k < len(splitters) and splitters[k] == keys[at]
                    stop = bisect_left(keys, splitters[k], at, end) if k < len(splitters) else end
                    segment[at:stop], at = k, stop
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment)], [*batch.schema.names, "segment"])

    return run


def _ranked(first: dict[int, int], k: int) -> Callable:
    """Ranks of rows that come sorted, segment by segment; first: how many rows stand in the segments before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = -1, 0
        for batch in batches:
            segment = batch.column(batch.schema.get_field_index("segment")).to_numpy()
            rank = np.zeros(len(segment), np.int64)
            edges = [0, *(np.flatnonzero(np.diff(segment)) + 1).tolist(), len(segment)]
            for begin, end in zip(edges, edges[1:], strict=False):
                if begin == end:
                    continue
                if segment[begin] != now:
                    now, seen = int(segment[begin]), 0
                rank[begin:end] = first[now] + seen + np.arange(1, end - begin + 1)
                seen += end - begin
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(rank, mask=rank > k)], [*batch.schema.names[:4], "rank"])

    return run


def ranked(scored: DataFrame, drawn: DataFrame, k: int) -> DataFrame:
    """scored with the rank of the k best of the rows drawn: highest score, then least doc_id (null first).

    drawn holds rows of scored; k of them at most get a rank.
    """
    spark = scored.sparkSession
    runs = max(1, min(MOST_RUNS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    sorted_runs = settle(drawn.coalesce(runs).sortWithinPartitions(*order).mapInArrow(_numbered, RUN), "runs")
    n = sorted_runs.count()
    step = max(1, n // (runs * runs))
    samples = sorted_runs.where(F.col("place") % step == step - 1).select("score", "doc_id", "run", "place").collect()  # runs ** 2 + runs at most
    samples = sorted(_key(*x) for x in samples)
    splitters = sorted({samples[len(samples) * j // runs] for j in range(1, runs)}) if samples else []
    parted = sorted_runs.mapInArrow(_parted(splitters), RUN + ", segment int")
    first, before = {}, 0
    for segment, count in sorted(tuple(x) for x in parted.groupBy("segment").agg(F.count(F.lit(1))).collect()):  # runs rows at most
        first[segment], before = before, before + count
    needed = [s for s, b in first.items() if b < k]
    last = max(needed, default=-1)
    exchanged = parted.where(F.col("segment") <= last).repartition(max(1, len(needed)), F.col("segment"))
    merged = exchanged.sortWithinPartitions("segment", *order, "run", "place").mapInArrow(_ranked(first, k), SCORED + ", rank long")
    behind = parted.where(F.col("segment") > last).select(*scored.columns, F.lit(None).cast("long").alias("rank"))
    return merged.unionByName(behind)


def resample(raw: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Every row of raw: doc_id, n_features, weight, score, rank (null if it is not drawn).

    Drawn are percent of 100 of the texts with at least so many words, those with the highest scores, ties to the
    smaller key. Null texts have no words and weight 0; a null key has the noise of an empty one and comes first among
    ties. Rows equal in key and score are ranked in any order, all different. The key is an integer. Empty tables give
    no rows; an empty target counts as smoothing alone. Only key and text are read.
    """
    table = gains(raw, target, text)
    scored = raw.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(_scores(table, seed), SCORED)
    scored = settle(scored, "scored")
    enough = scored.where(F.col("n_features") >= least)
    rest = scored.where(F.col("n_features") < least).withColumn("rank", F.lit(None).cast("long"))
    drawn = ranked(scored, enough, enough.count() * percent // 100)
    return drawn.unionByName(rest).withColumnRenamed("doc_id", key)


def select(raw: DataFrame, ranks: DataFrame, key: str = "doc_id") -> DataFrame:
    """The drawn rows of raw, all columns; keys must be unique."""
    return raw.join(ranks.where("rank is not null").select(key), key, "left_semi")
