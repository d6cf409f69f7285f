"""SimHash fingerprints, and permuted block tables that find all fingerprints within a Hamming radius.

Every term (pair of consecutive words; a lone word is a term by itself) votes with its weight, the number of its
occurrences, for or against each of 64 bits. For the radius r the bits are cut into r + 2 blocks; two fingerprints
within r agree on two blocks at least, so a table for every two blocks, keyed by their bits, brings them together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censusloom.llm.text import LOWER, SPACED, mix, slices, utf8, word_hashes, words
from censusloom.llm.units import column, deal, sides, work
from censusloom.plans.storage import settle

BITS, RADIUS = 64, 3
AT_ONCE = 1 << 19
#: Fingerprints of a unit of comparison at most (twice as many for two blocks), and entries that travel together.
BLOCK, ENTRIES = 2048, 1 << 16


def fingerprints(column) -> np.ndarray:
    """A fingerprint for every text of an Arrow column; texts without words have 0."""
    buf, offs = utf8(column)
    buf = LOWER[buf]
    out = np.zeros(len(offs) - 1, np.int64)
    for i, j in slices(offs, AT_ONCE):
        part = buf[offs[i] : offs[j]]
        starts, ends, bounds = words(part, offs[i : j + 1] - offs[i], SPACED)
        one, n = word_hashes(part, starts, ends, 9), np.diff(bounds)
        rows = np.repeat(np.arange(j - i), n)
        terms = np.zeros(len(one), np.uint64)
        terms[:-1] = mix(one[:-1] * np.uint64(3) + one[1:])
        keep = np.zeros(len(one), bool)
        keep[:-1] = rows[1:] == rows[:-1]
        lone = bounds[:-1][n == 1]
        terms[lone], keep[lone] = one[lone], True
        terms, rows = terms[keep], rows[keep]
        if not len(terms):
            continue
        first = np.flatnonzero(np.concatenate((np.ones(1, bool), rows[1:] != rows[:-1])))
        votes = np.unpackbits(terms.astype(">u8").view(np.uint8)).reshape(-1, BITS)
        yes = np.add.reduceat(votes, first, axis=0, dtype=np.int32)
        total = np.diff(first, append=len(terms))[:, None]
        bits = np.packbits(2 * yes > total, axis=1).reshape(-1, 8)
        out[i + rows[first]] = np.ascontiguousarray(bits).view(">u8").reshape(-1).astype(np.uint64).view(np.int64)
    return out


@F.arrow_udf(T.LongType())
def fingerprint(column: pa.Array) -> pa.Array:
    return pa.array(fingerprints(column))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_text(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def block_masks(radius: int) -> list[int]:
    """The bits of the key of each permuted block table: of every two of radius + 2 blocks."""
    blocks = radius + 2
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    masks = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks)]
    return [_signed(masks[a] | masks[b]) for a, b in combinations(range(blocks), 2)]


def _near(table: pa.Table, radius: int, masks: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Fingerprints of a pack, and rows of the pairs within the radius; a pair counts in the first table it meets in."""
    prints, number, side = (column(table, n) for n in ("id", "number", "side"))
    bits, tables = prints.view(np.uint64), np.array(masks, np.int64)
    for own in work(table):
        left, right, same = sides(side, own)
        for k in range(0, len(left), 256):
            part = left[k : k + 256]
            i, j = np.nonzero(np.bitwise_count(bits[part][:, None] ^ bits[right][None, :]) <= radius)
            if same:
                i, j = i[i + k < j], j[i + k < j]
            a, b = part[i], right[j]
            agree = ((prints[a] ^ prints[b])[:, None] & tables) == 0
            first = agree.any(axis=1) & (agree.argmax(axis=1) == number[a]) & (number[a] == number[b])
            yield prints, a[first], b[first]


def _counted(radius: int, masks: list[int]):
    def run(table: pa.Table) -> pa.Table:
        near, prints = np.zeros(len(table), np.int64), column(table, "id")
        for _, a, b in _near(table, radius, masks):
            np.add.at(near, a, 1)
            np.add.at(near, b, 1)
        hit = np.flatnonzero(near)
        return pa.table([prints[hit], near[hit]], names=["print", "n"])

    return run


def _listed(radius: int, masks: list[int]):
    def run(table: pa.Table) -> pa.Table:
        pairs = [(np.minimum(p[a], p[b]), np.maximum(p[a], p[b])) for p, a, b in _near(table, radius, masks)]
        u, v = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else [np.zeros(0, np.int64)] * 2
        return pa.table([u, v], names=["u", "v"])

    return run


def _units(prints: DataFrame, masks: list[int]) -> DataFrame:
    """The distinct fingerprints, dealt by the bits of every block table into units of comparison."""
    each = settle(prints.where("print is not null").select(F.col("print").alias("id")).distinct(), "prints")
    dealt = each.select("id", F.posexplode(F.array(*[F.col("id").bitwiseAND(F.lit(m)) for m in masks])).alias("number", "part"))
    return deal(dealt.select("id", "number", F.xxhash64("number", "part").alias("bucket")), each.count() * len(masks), BLOCK, ENTRIES)


def near_counts(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """print, n_near: for every fingerprint (column print) that has others within the radius, how many different ones.

    Equal fingerprints are one; nulls have no partner. Fingerprints with equal bits in two blocks meet in a bucket;
    buckets are compared in units of bounded size, and no pair leaves a unit, only counts.
    """
    masks = block_masks(radius)
    found = _units(prints, masks).groupBy("pack").applyInArrow(_counted(radius, masks), "print long, n long")
    return found.groupBy("print").agg(F.sum("n").alias("n_near"))


def near_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs u < v of different fingerprints (column print) at most radius bits apart, each once.

    For callers that want the pairs themselves; their number may grow with the square of a group of near fingerprints.
    """
    masks = block_masks(radius)
    return _units(prints, masks).groupBy("pack").applyInArrow(_listed(radius, masks), "u long, v long")


def _cuts(df: DataFrame, column: str, bins: int) -> list[int]:
    """Values that part a column into about even bins."""
    found = df.approxQuantile(column, [k / bins for k in range(1, bins)], 0.25 / bins)
    return sorted({int(x) for x in found})


def _bin(value: Column, cuts: list[int], fan: int = 64) -> Column:
    """How many cuts are not above the value, searched in two levels; null: -1."""
    if not cuts:
        return F.when(value.isNull(), F.lit(-1)).otherwise(F.lit(0))
    count = lambda xs: F.size(F.filter(xs, lambda x: x <= value))
    runs = [cuts[k : k + fan] for k in range(0, len(cuts), fan)]
    coarse = count(F.array(*[F.lit(r[0]) for r in runs]))
    fine = F.array(*[F.array(*[F.lit(x) for x in r]) for r in runs])
    place = F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * fan + count(F.get(fine, coarse - 1)))
    return F.when(value.isNull(), F.lit(-1)).otherwise(place)


def with_next(df: DataFrame, key: str, value: str, bins: int) -> DataFrame:
    """bin, tail, doc, text, place in the bin and following, the text of the next row by (doc, text), the first row's for the last.

    Rows are dealt into ranges of the key; the first row of a range is also the last (tail) row of the one before, so
    that no order over all rows is needed. Null keys come first.
    """
    rows = df.select(F.col(key).alias("doc"), F.coalesce(F.col(value), F.lit("")).alias("text"))
    rows = rows.withColumn("bin", _bin(F.col("doc"), _cuts(rows, "doc", bins)))
    used = sorted(r["bin"] for r in rows.select("bin").distinct().collect())  # at most bins + 1
    before = df.sparkSession.createDataFrame([(b, used[k - 1]) for k, b in enumerate(used)], "bin int, into int")
    firsts = rows.groupBy("bin").agg(F.min(F.struct("doc", "text")).alias("row"))
    tails = firsts.join(F.broadcast(before), "bin").select(F.col("row.doc").alias("doc"), F.col("row.text").alias("text"), F.col("into").alias("bin"), F.lit(True).alias("tail"))
    both = rows.withColumn("tail", F.lit(False)).unionByName(tails)
    order = Window.partitionBy("bin").orderBy("tail", "doc", "text")
    return both.withColumns({"place": F.row_number().over(order), "following": F.coalesce(F.lead("text").over(order), F.lit(""))})


def edited_likeness(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """Fingerprints of every text and of its edited form, how alike they are, and how many others are near.

    The edited form has its last quarter of code points replaced by the first as many of the next text by key. Columns:
    key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near (other fingerprints
    within the radius). Null counts as empty, whose fingerprint is 0; null keys come first, equal keys in the order of
    their texts. Only key and text are read.
    """
    bins = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(df, key, text, bins)
    size = F.length("text")
    quarter = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - quarter), F.substring(F.col("following"), F.lit(1), quarter))
    rows = rows.select("bin", "tail", "doc", "place", size.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    digest = F.sha2(F.col("edited"), 256).alias("edited_sha256")
    printed = rows.select("bin", "tail", "doc", "place", "n_chars", digest, fingerprint("text").alias("print"), fingerprint("edited").alias("changed"))
    printed = settle(printed, "fingerprints")
    order = Window.partitionBy("bin").orderBy("place")
    rows = printed.withColumn("next", F.lead("print").over(order)).where("not tail")
    rows = rows.join(near_counts(rows.select("print"), radius), "print", "left")
    return rows.select(
        F.col("doc").alias(key), "n_chars", "edited_sha256", as_text(F.col("print")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("changed")).alias("near_edited"), likeness(F.col("print"), F.col("next")).alias("near_next"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )
