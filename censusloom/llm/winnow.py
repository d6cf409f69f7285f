"""Benchmark decontamination by winnowing.

Of every WINDOW words' k-grams, the one with the least hash in each run of w = WINDOW - k + 1 is kept as a fingerprint.
Any shared span of at least WINDOW words then shares a fingerprint. Fingerprints of documents and benchmark items are
joined; hits are extended: the windows around a hit are digested (128 bits) and joined with the items' windows. Items
shorter than a window are one window of their own length, whose fingerprint is the whole of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusloom.llm.text import ALNUM, LOWER, mix, slices, utf8, window_hashes, window_starts, word_hashes, words
from censusloom.plans.storage import settle

#: Words of a window, and of the k-grams that are winnowed.
WINDOW, GRAM = 13, 7
#: Bytes of text that are worked on at a time.
AT_ONCE = 1 << 19


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def winnow(hashes: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints; equal least hashes of a run are all kept."""
    run = window - gram + 1
    at = window_starts(bounds, gram)
    grams = np.maximum(window_hashes(hashes, at, gram), np.uint64(1))
    full = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
    full[at] = grams
    begins = window_starts(bounds, window)
    if not len(begins):
        return at[:0], grams[:0]
    least = np.zeros(len(full), np.uint64)
    least[begins] = _sliding_min(np.concatenate((full, np.full(run, full.max(), np.uint64))), run)[begins]
    # A gram is kept if it is the least of any run that it lies in: the greatest least of those is its own hash.
    padded = np.concatenate((np.zeros(run - 1, np.uint64), least))
    greatest = ~_sliding_min(~padded, run)
    kept = at[(greatest[at] == grams) ]
    return kept, full[kept]


def _tagged(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of grams of one size, told apart from those of another."""
    return mix(hashes + np.uint64(size * 0x9E3779B97F4A7C15 % (1 << 64))).view(np.int64)


def _parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Row range, word bounds and two independent word hashes of some rows at a time."""
    buf, offs = utf8(column)
    buf = LOWER[buf]
    for i, j in slices(offs, AT_ONCE):
        part = buf[offs[i] : offs[j]]
        starts, ends, bounds = words(part, offs[i : j + 1] - offs[i], ALNUM)
        yield i, j, bounds, word_hashes(part, starts, ends, 1), word_hashes(part, starts, ends, 2)


def _lists(values: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    """Values sorted by row, as a list for each of n rows."""
    counts = np.bincount(rows, minlength=n)
    offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
    return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(values)).cast(pa.list_(pa.from_numpy_dtype(values.dtype)))


def item_windows(items: DataFrame, window: int, gram: int, text: str, key: str) -> DataFrame:
    """key, size, one, two (digest of each window) and prints (its fingerprints; in the first window only)."""
    kind = items.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, bounds, one, two in _parts(batch.column(1)):
                for row in range(i, j):
                    a, b = bounds[row - i], bounds[row - i + 1]
                    n = min(window, int(b - a))
                    if not n:
                        continue
                    own = np.array([0, b - a])
                    at = window_starts(own, n)
                    if n == window:
                        prints = _tagged(winnow(one[a:b], own, window, gram)[1], gram)
                    else:
                        prints = _tagged(window_hashes(one[a:b], at, n), n)
                    lists = [prints] + [prints[:0]] * (len(at) - 1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column(0)[row].as_py()] * len(at), batch.column(0).type),
                            pa.array(np.full(len(at), n, np.int32)),
                            pa.array(window_hashes(one[a:b], at, n, 1).view(np.int64)),
                            pa.array(window_hashes(two[a:b], at, n, 2).view(np.int64)),
                            pa.array(lists, pa.list_(pa.int64())),
                        ],
                        ["item", "size", "one", "two", "prints"],
                    )

    return items.select(key, text).mapInArrow(run, f"item {kind}, size int, one long, two long, prints array<long>")


def text_tag(text: Column) -> Column:
    """128 bits that tell a row's text from those of other rows with its key; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _prints(docs: DataFrame, sizes: list[int], window: int, gram: int) -> DataFrame:
    """doc, tag, at, print: all fingerprints of the documents; for items of size < window, all their grams of that size."""
    kind = docs.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, bounds, one, _ in _parts(batch.column(1)):
                found = [winnow(one, bounds, window, gram)] if window in sizes else []
                found = [(at, _tagged(hashes, gram)) for at, hashes in found]
                for n in sizes:
                    if n < window:
                        at = window_starts(bounds, n)
                        found.append((at, _tagged(window_hashes(one, at, n), n)))
                for at, prints in found:
                    rows = np.searchsorted(bounds, at, "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(k).take(pa.array(rows + i)) for k in (0, 2)), pa.array((at - bounds[rows]).astype(np.int32)), pa.array(prints)],
                        ["doc", "tag", "at", "print"],
                    )

    return docs.select("doc", "text", "tag").mapInArrow(run, f"doc {kind}, tag binary, at int, print long")


def _windows(docs: DataFrame, sizes: list[int], window: int, gram: int) -> DataFrame:
    """doc, tag, n_words, found (the windows around hits: at, size, one, two) of every document."""
    kind = docs.schema["doc"].dataType.simpleString()
    item = pa.struct([("at", pa.int32()), ("size", pa.int32()), ("one", pa.int64()), ("two", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column(2)
            for i, j, bounds, one, two in _parts(batch.column(1)):
                lists = hits.slice(i, j - i)
                counts = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
                rows = np.repeat(np.arange(j - i), counts)
                places = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + bounds[rows]
                own = places < bounds[rows + 1]  # not a place of another text
                places, rows = places[own], rows[own]
                out = []
                for n in sizes:
                    starts = window_starts(bounds, n)
                    around = np.zeros(len(one) + 1, np.int64)
                    back = window - gram if n == window else 0
                    np.add.at(around, np.maximum(places - back, bounds[rows]), 1)
                    np.add.at(around, np.minimum(places, len(one) - 1) + 1, -1)
                    starts = starts[np.cumsum(around)[starts] > 0]
                    out.append((starts, np.full(len(starts), n), window_hashes(one, starts, n, 1), window_hashes(two, starts, n, 2)))
                at, size, first, second = (np.concatenate(x) for x in zip(*out, strict=True)) if out else [np.zeros(0, np.int64)] * 4
                order = np.argsort(at, kind="stable")
                at, size, first, second = at[order], size[order], first[order], second[order]
                owner = np.searchsorted(bounds, at, "right") - 1
                flat = pa.StructArray.from_arrays(
                    [
                        pa.array((at - bounds[owner]).astype(np.int32)),
                        pa.array(size.astype(np.int32)),
                        pa.array(first.astype(np.uint64).view(np.int64)),
                        pa.array(second.astype(np.uint64).view(np.int64)),
                    ],
                    fields=list(item),
                )
                ends = np.concatenate((np.zeros(1, np.int32), np.cumsum(np.bincount(owner, minlength=j - i)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        batch.column(3).slice(i, j - i),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), flat),
                    ],
                    ["doc", "tag", "n_words", "found"],
                )

    fields = f"doc {kind}, tag binary, n_words long, found array<struct<at: int, size: int, one: long, two: long>>"
    return docs.select("doc", "text", "hits", "tag").mapInArrow(run, fields)


def overlaps(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, each_row: bool = False) -> DataFrame:
    """key, tag (text_tag of the text), n_words, n_hit, n_items, items (sorted as strings), contaminated, for every document.

    Null and wordless texts have no words and are never hit; null items have no window. Rows equal in key and text
    give one row, with each_row a row each; rows equal in key only are told apart by their text. An empty table of items hits nothing. Only the
    named columns are read.
    """
    documents = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"), text_tag(F.col(text)).alias("tag"))
    benchmark = settle(item_windows(items, window, gram, text, item_key), "item_windows")
    sizes = sorted(r["size"] for r in benchmark.select("size").distinct().collect())  # at most as many as a window has words
    wanted = settle(benchmark.select(F.explode("prints").alias("print")).distinct(), "item_prints")
    known = settle(
        benchmark.groupBy("size", "one", "two").agg(F.sort_array(F.collect_set("item")).alias("owners")), "item_owners"
    )
    # Spark broadcasts the items' tables below its threshold and shuffles both sides above.
    hits = settle(
        _prints(documents, sizes, window, gram).join(wanted, "print", "left_semi").groupBy("doc", "tag").agg(F.collect_set("at").alias("hits")), "hits"
    )
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("tag") == F.col("_tag"))
    flagged = documents.join(hits.withColumnsRenamed({"doc": "_doc", "tag": "_tag"}), same, "left")
    found = _windows(flagged, sizes, window, gram)
    each = found.select("doc", "tag", "n_words", F.explode_outer("found").alias("w")).select("doc", "tag", "n_words", "w.*")
    each = each.join(known, ["size", "one", "two"], "left")
    span = F.when(F.col("owners").isNotNull(), F.struct("at", "size"))
    per_doc = each.groupBy("doc", "tag", "n_words").agg(F.collect_set(span).alias("spans"), F.collect_set("owners").alias("owners"))
    covered = F.expr(
        "aggregate(sort_array(spans), struct(0 as upto, 0L as n),"
        " (a, x) -> struct(greatest(a.upto, x.at + x.size) as upto, a.n + greatest(0, x.at + x.size - greatest(a.upto, x.at)) as n), a -> a.n)"
    )
    named = F.sort_array(F.transform(F.array_distinct(F.flatten("owners")), lambda x: x.cast("string")))
    answers = per_doc.select(
        F.col("doc").alias(key), "tag", "n_words", covered.alias("n_hit"), F.size("owners").cast("long").alias("_sets"), named.alias("items")
    ).select(
        key, "tag", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
    if not each_row:
        return answers
    same = F.col("doc").eqNullSafe(F.col(key)) & (F.col("_tag") == F.col("tag"))
    return documents.select("doc", F.col("tag").alias("_tag")).join(answers, same).drop("doc", "_tag")
