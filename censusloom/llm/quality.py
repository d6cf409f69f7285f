"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are counted: one of the target text (labelled documents of good quality that
are not toxic), one of all raw text. A document's log weight is the mean log ratio of the two over its n-grams. The
documents kept are the Gumbel top-k of these weights; k is the number of documents above the weight that best parts
the labelled documents that the target model has not seen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusloom.llm import counting
from censusloom.llm.text import ALNUM, LOWER, byte_set, mix, slices, utf8, word_hashes, words
from censusloom.plans.storage import settle

#: Labelled documents that are learnt from at most; half of them fit the target model, half set the cut.
LABELLED = 100_000
#: Cells for single words and punctuation, and for pairs of words.
SINGLE, PAIR = 1 << 20, 1 << 18
#: Pseudo-count that draws a ratio to one, and the least log ratio that counts: below it is mostly chance.
PSEUDO, MARGIN = 1.0, 1.5
#: n-grams without evidence that every document is given, so that a few words cannot decide.
PRIOR = 150
#: Scale of the Gumbel noise.
TEMPERATURE = 0.0005
AT_ONCE = 1 << 19
#: Runs of ASCII punctuation.
PUNCTUATION = ~byte_set([c for c in range(0x21, 0x7F) if not chr(c).isalnum()])
_REPEAT = np.uint64(0x2545F4914F6CDD1D)


def _features(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, cells of all n-grams of its rows, and the row of each."""
    buf, offs = utf8(column)
    buf = LOWER[buf]
    for i, j in slices(offs, AT_ONCE):
        part, edges = buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        cells, rows = [], []
        for inside, seed in ((ALNUM, 5), (PUNCTUATION, 6)):
            starts, ends, bounds = words(part, edges, inside)
            hashes = word_hashes(part, starts, ends, seed)
            owner = np.repeat(np.arange(j - i), np.diff(bounds))
            cells.append((hashes % np.uint64(SINGLE)).astype(np.int64))
            rows.append(owner)
            if inside is ALNUM:
                same = owner[1:] == owner[:-1]
                again = same & (hashes[1:] == hashes[:-1])  # a word that follows itself
                cells.append(np.full(int(again.sum()), int(_REPEAT % np.uint64(SINGLE))))
                rows.append(owner[1:][again])
                pairs = mix(hashes[:-1] * np.uint64(3) + hashes[1:])[same]
                cells.append((pairs % np.uint64(PAIR)).astype(np.int64) + SINGLE)
                rows.append(owner[1:][same])
        yield i, j, np.concatenate(cells), np.concatenate(rows)


def _tables(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the raw and of the target text. docs: text, fits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = SINGLE + PAIR
        table = np.zeros(2 * cells, np.int64)
        for batch in batches:
            fits = np.array(batch.column(1).to_pylist(), bool)
            for i, j, found, rows in _features(batch.column(0)):
                table[:cells] += np.bincount(found, minlength=cells)
                table[cells:] += np.bincount(found[fits[i:j][rows]], minlength=cells)
        yield pa.RecordBatch.from_arrays(list(counting.segments(table)), counting.NAMES)

    both = counting.total(docs.mapInArrow(run, counting.SCHEMA), 2 * (SINGLE + PAIR))
    return both[: SINGLE + PAIR], both[SINGLE + PAIR :]


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the target model to the raw one in every cell, drawn to zero where counts are small."""
    out = np.zeros(len(raw), np.float32)
    for part in (slice(0, SINGLE), slice(SINGLE, None)):
        expected = raw[part] * (target[part].sum() / max(1, raw[part].sum()))
        ratio = np.log((target[part] + PSEUDO) / (expected + PSEUDO))
        out[part] = np.where(np.abs(ratio) < MARGIN, 0, ratio)
    return out


def _sample(labels: DataFrame, key: str) -> DataFrame:
    """_key, good, fits of a bounded sample of the labelled documents; several labels of one: the worst counts."""
    known = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    each = known.groupBy(F.col(key).alias("_key")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    some = each.orderBy(F.xxhash64("_key"), "_key").limit(LABELLED)
    return some.select("_key", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"), (F.pmod(F.xxhash64("_key", F.lit(3)), F.lit(2)) == 0).alias("fits"))


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight from which on documents are kept: where the parts of bad and of good documents below differ most."""
    if not len(weights) or good.all() or not good.any():
        return -math.inf
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    gain = np.cumsum(~good) / (~good).sum() - np.cumsum(good) / good.sum()
    ends = np.append(weights[1:] != weights[:-1], True)
    gain = np.where(ends, gain, -1)
    k = int(gain.argmax())
    if gain[k] <= 0:
        return -math.inf
    return float((weights[k] + weights[k + 1]) / 2) if k + 1 < len(weights) else math.inf


def nth_largest(rows: DataFrame, column: str, n: int, bins: int = 4096, enough: int = 10_000) -> float:
    """The exact n-th largest value, by counting in ever narrower bins; only counts and a few values reach the driver."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while True:
        inside = rows.where((F.col(column) >= low) & (F.col(column) <= high))
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            return low
        place = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        counts = {r["bin"]: (r["n"], r["low"], r["high"]) for r in inside.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()}
        for k in sorted(counts, reverse=True):
            if counts[k][0] >= n:
                break
            n -= counts[k][0]
        count, low, high = counts[k]
        if low == high:
            return low
        if count <= enough:
            return sorted((r[0] for r in rows.where((F.col(column) >= low) & (F.col(column) <= high)).select(column).collect()), reverse=True)[n - 1]


class Resampler:
    """Fitted on documents and labels; gives every text its log weight and every document its Gumbel key."""

    def __init__(self, docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id"):
        self.text, self.key = text, key
        # At most LABELLED rows of three small columns.
        sample = F.broadcast(settle(_sample(labels, key), "labelled"))
        rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(sample, "_key", "left")
        raw, target = _tables(rows.select("_text", F.coalesce(F.col("fits") & F.col("good"), F.lit(False)).alias("fits")))
        ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(raw, target))

        @F.arrow_udf("double")
        def weight(column: pa.Array) -> pa.Array:
            out = np.zeros(len(column))
            for i, j, cells, owner in _features(column):
                size = np.bincount(owner, minlength=j - i) + PRIOR
                out[i:j] = np.bincount(owner, weights=ratios.value[cells], minlength=j - i) / size
            return pa.array(out)

        self._weight = weight
        scored = settle(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).select("_key", weight("_text").alias("weight")), "weights")
        held = scored.join(sample.where("not fits"), "_key").select("weight", "good").collect()  # at most LABELLED keys
        self.cut = best_cut(np.array([r["weight"] for r in held]), np.array([r["good"] for r in held], bool))
        self.scored = scored.withColumn("gumbel", self.gumbel(F.col("weight"), F.col("_key")))
        k = scored.where(F.col("weight") >= F.lit(self.cut)).count() if self.cut < math.inf else 0
        if self.cut == -math.inf:
            self.least = -math.inf
        else:
            self.least = nth_largest(self.scored, "gumbel", k) if k else math.inf

    def gumbel(self, weight: Column, key: Column) -> Column:
        """Weight plus Gumbel noise that the key alone decides."""
        bits = F.shiftrightunsigned(F.xxhash64(F.coalesce(key.cast("string"), F.lit("")), F.lit(11)), 11)
        uniform = (bits.cast("double") + 0.5) / F.lit(float(1 << 53))
        return weight - F.lit(TEMPERATURE) * F.log(-F.log(uniform))

    def weight(self) -> Column:
        return self._weight(F.col(self.text))

    def keep(self, docs: DataFrame) -> DataFrame:
        """The rows of docs, all columns as they are, that the resampling keeps."""
        return docs.where(self.gumbel(self.weight(), F.col(self.key)) >= F.lit(self.least))

    def decisions(self) -> DataFrame:
        """key, log_weight, gumbel_key, keep for every row."""
        return self.scored.select(F.col("_key").alias(self.key), F.col("weight").alias("log_weight"), F.col("gumbel").alias("gumbel_key"), (F.col("gumbel") >= F.lit(self.least)).alias("keep"))


def resample(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> Resampler:
    """Fit on docs (key, text) and labels (key, quality, toxic).

    Null and empty texts have no n-grams and the log weight 0. Rows with equal weight and key are kept or dropped
    together; ties at the k-th place are kept. Labels with a null are not used; without labels of both kinds all
    documents are kept. An empty table keeps nothing. Other columns are not read.
    """
    return Resampler(docs, labels, text, key)
