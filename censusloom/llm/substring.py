"""Substring dedup with fixed-block anchors: words within a repeated window of MIN_WORDS words are removed.

Every document is cut into non-overlapping blocks of half a window; each window holds a whole block. The blocks are the
index; every rolling run of a block's length in every document probes it. Around a hit, the windows that hold it are
digested (96 bits) and counted over all documents, which extends the hit to all its partners at once; consecutive
repeated windows are the maximal exact repeats. No pair of documents is ever listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusloom.llm import packed
from censusloom.llm.text import SPACED, slices, utf8, window_hashes, window_starts, word_hashes, words

MIN_WORDS = 35
#: Bytes of text that are hashed at a time, and words whose digests are grouped before they travel.
AT_ONCE, GROUP = 1 << 19, 1 << 20


def _hashed(keys: np.ndarray, column, seeds: tuple[int, ...]) -> Iterator[tuple[int, int, np.ndarray, list[np.ndarray]]]:
    buf, offs = utf8(column)
    for i, j in slices(offs, AT_ONCE):
        part = buf[offs[i] : offs[j]]
        starts, ends, bounds = words(part, offs[i : j + 1] - offs[i], SPACED)
        yield i, j, bounds, [word_hashes(part, starts, ends, s) for s in seeds]


def _around(places: np.ndarray, rows: np.ndarray, bounds: np.ndarray, block: int, window: int) -> np.ndarray:
    """Starts of the windows that hold a run of block words at one of the places."""
    near = np.zeros(int(bounds[-1]) + 2, np.int64)
    np.add.at(near, np.maximum(places - (window - block), bounds[rows]), 1)
    np.add.at(near, places + 1, -1)
    starts = window_starts(bounds, window)
    return starts[np.cumsum(near)[starts] > 0]


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", key: str = "doc_id", replace: bool = False) -> DataFrame:
    """key, n_words, n_removed, kept_sha256; with replace: the columns of docs, text (and n_chars, if any) renewed.

    A renewed text is the kept words joined by one space if any word went, else the text itself. Null and wordless
    texts have no words (digest of nothing; null stays null). The key is an integer; rows equal in key and text repeat
    each other, so all their windows go; rows equal in key only are judged each by its own text. Other columns may
    have any name.
    """
    spark, block, window = docs.sparkSession, (min_words + 1) // 2, min_words
    buckets = packed.buckets_of(spark)
    source = docs if replace else docs.select(key, text)
    names = source.columns
    dealt = source.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), packed.key_column(key).alias("doc"))
    dealt = dealt.select(packed.shard_column(F.col("doc"), buckets).alias("shard"), "doc", "row")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            keys, at, one = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            return packed.batch_of(packed.digests(keys, at, one, None, at % block == 0, buckets), packed.DIGEST_NAMES)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, bounds, (one,) in _hashed(ids, batch.column(1), (1,)):
                at = window_starts(bounds, block)
                rows = np.searchsorted(bounds, at, "right") - 1
                held.append((ids[i:j][rows], at - bounds[rows], window_hashes(one, at, block)))
                if sum(len(h[0]) for h in held) >= GROUP:
                    yield flush()
        if held:
            yield flush()

    def meet(wide: bool):
        def run(table: pa.Table) -> pa.Table:
            return pa.Table.from_batches([packed.batch_of(packed.meet(table, buckets, wide), packed.ANSWER_NAMES)])

        return run

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        hits, ids = packed.Places(right), left["doc"].to_numpy()
        found = []
        for i, j, bounds, (one, two) in _hashed(ids, pc.struct_field(left["row"], text), (1, 2)):
            rows, index = hits.of(ids[i:j])
            places = hits.at[index] + bounds[rows]
            own = places + block <= bounds[rows + 1]  # not a place of another text with this key
            at = _around(places[own], rows[own], bounds, block, window)
            rows = np.searchsorted(bounds, at, "right") - 1
            second = (window_hashes(two, at, window, 2) >> np.uint64(32)).astype(np.uint32)
            found.append((ids[i:j][rows], at - bounds[rows], window_hashes(one, at, window), second))
        if not found:
            return pa.Table.from_batches([packed.batch_of([], packed.DIGEST_NAMES)])
        keys, at, one, two = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.Table.from_batches([packed.batch_of(packed.digests(keys, at, one, two, np.ones(len(at), bool), buckets), packed.DIGEST_NAMES)])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        repeats, ids = packed.Places(right), left["doc"].to_numpy()
        column = pc.struct_field(left["row"], text)
        n_words, n_removed, digest, kept_texts = [], [], [], []
        for i, j, bounds, (two,) in _hashed(ids, column, (2,)):
            rows, index = repeats.of(ids[i:j])
            at, mark = repeats.at[index] + bounds[rows], repeats.mark[index] if len(index) else np.zeros(0, np.uint32)
            inside = at + window <= bounds[rows + 1]
            at, mark = at[inside], mark[inside]
            at = at[(window_hashes(two, at, window, 2) >> np.uint64(32)).astype(np.uint32) == mark]
            cover = np.zeros(len(two) + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + window, -1)
            keep = np.cumsum(cover[:-1]) == 0
            for k, value in enumerate(column.slice(i, j - i)):
                value = value.as_py()
                parts = (value or "").encode().split()
                mine = keep[bounds[k] : bounds[k + 1]]
                gone = len(parts) - int(mine.sum())
                kept = b" ".join(compress(parts, mine) if gone else parts)
                n_words.append(len(parts))
                n_removed.append(gone)
                digest.append(sha256(kept).hexdigest())
                if replace:
                    kept_texts.append(kept.decode() if gone else value)
        if not replace:
            columns = [pc.struct_field(left["row"], key), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())]
            return pa.Table.from_arrays(columns, ["doc", "n_words", "n_removed", "kept_sha256"])
        columns = []
        for name in names:
            old = pc.struct_field(left["row"], name)
            if name == text:
                old = pa.array(kept_texts, pa.string())
            elif name == "n_chars":
                old = pa.chunked_array([pc.utf8_length(pa.array(kept_texts, pa.string())).cast(old.type)])
            columns.append(old)
        return pa.Table.from_arrays(columns, [f"c{k}" for k in range(len(columns))])

    rows = f"bucket int, {packed.ENTRIES}, {packed.DIGESTS}"
    back = f"shard int, {packed.ENTRIES}"
    probes = source.select(packed.key_column(key).alias("doc"), F.col(text).alias("text")).mapInArrow(probe, rows)
    hits = probes.groupBy("bucket").applyInArrow(meet(False), back)
    windows = dealt.groupBy("shard").cogroup(hits.groupBy("shard")).applyInArrow(extend, rows)
    repeats = windows.groupBy("bucket").applyInArrow(meet(True), back)
    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    if not replace:
        out = f"doc {kinds[key]}, n_words long, n_removed long, kept_sha256 string"
        return dealt.groupBy("shard").cogroup(repeats.groupBy("shard")).applyInArrow(finish, out).withColumnRenamed("doc", key)
    out = ", ".join(f"c{k} {kinds[c]}" for k, c in enumerate(names))
    return dealt.groupBy("shard").cogroup(repeats.groupBy("shard")).applyInArrow(finish, out).toDF(*names)
