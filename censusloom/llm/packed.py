"""Digest tables in packed rows: equal digests meet in one bucket, and the answers go back to their documents.

A row holds all entries of one group of documents that fall into one bucket, as arrays. Within the group, entries with
equal digests are settled at once and only one of them travels (without asking for an answer), so a digest that a
third of all documents hold costs one entry per group. The number of buckets follows the session's shuffle partitions,
so a bucket's size follows the data per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

NULL_KEY = -(1 << 63)
#: docs, runs, at: the documents of the entries, how many each has, their places; mark: bits to know the place again;
#: one, two: digests; flags: which may answer others; lone_one, lone_two: digests that want no answer.
ENTRIES = "docs binary, runs binary, at binary, mark binary"
DIGESTS = "one binary, two binary, flags binary, lone_one binary, lone_two binary"
_BINARY = ["docs", "runs", "at", "mark", "one", "two", "flags", "lone_one", "lone_two"]


def buckets_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_column(name: str) -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_KEY))


def shard_column(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """What shard_column gives: XXH64 of a long with Spark's seed 42, modulo shards."""
    u = np.uint64
    p1, p2, p3, p4, p5 = map(u, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, n: (x << u(n)) | (x >> u(64 - n))
    h = (np.full(len(keys), 42 + 8, u) + p5) ^ (turn(keys.view(u) * p2, 31) * p1)
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> u(33))) * p2
    h = (h ^ (h >> u(29))) * p3
    return np.mod((h ^ (h >> u(32))).view(np.int64), shards)


def planes(values: np.ndarray) -> bytes:
    """Byte planes, so that high bytes that are all zero compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes()


def unplanes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def pack_places(keys: np.ndarray, at: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Entries sorted by document: documents, entries of each, places as differences."""
    if not len(keys):
        return b"", b"", b""
    new = np.flatnonzero(np.concatenate((np.ones(1, bool), keys[1:] != keys[:-1])))
    docs = keys[new]
    steps = np.diff(at, prepend=0)
    steps[new] = at[new]
    return planes(np.diff(docs, prepend=0)), planes(np.diff(new, append=len(keys)).astype(np.uint32)), planes(steps.astype(np.uint32))


def unpack_places(docs: bytes, runs: bytes, at: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, counts, steps = np.cumsum(unplanes(docs, np.int64)), unplanes(runs, np.uint32).astype(np.int64), unplanes(at, np.uint32).astype(np.int64)
    total = np.cumsum(steps)
    first = np.cumsum(counts) - counts
    return np.repeat(keys, counts), total - np.repeat(total[first] - steps[first], counts)


def split(by: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """The entries of each number below n, in their order."""
    order = np.argsort(by.astype(np.uint16 if n < 1 << 16 else np.int64), kind="stable")
    edges = np.searchsorted(by[order], np.arange(n + 1))
    for k in np.flatnonzero(np.diff(edges)):
        yield int(k), order[edges[k] : edges[k + 1]]


def _groups(one: np.ndarray, two: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal digests stand together, and the number of its group for each entry in that order."""
    order = np.argsort(one) if two is None else np.lexsort((two, one))
    a = one[order]
    new = np.concatenate((np.zeros(1, bool), a[1:] != a[:-1])) if len(a) else np.zeros(0, bool)
    if two is not None and len(a):
        b = two[order]
        new[1:] |= b[1:] != b[:-1]
    return order, np.cumsum(new)


def batch_of(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """(number, dict of binary columns) rows as a batch; columns that a row lacks are empty."""
    columns = [pa.array([r[0] for r in rows], pa.int32())]
    columns += [pa.array([r[1].get(n, b"") for r in rows], pa.binary()) for n in names[1:]]
    return pa.RecordBatch.from_arrays(columns, names)


DIGEST_NAMES = ["bucket", *_BINARY]
ANSWER_NAMES = ["shard", "docs", "runs", "at", "mark"]


def answers(keys: np.ndarray, at: np.ndarray, mark: np.ndarray, shards: int, base: int = 0) -> list[tuple]:
    """Rows of places, by the shard of their document. Entries are in the order of their documents."""
    rows = []
    for shard, own in split(shard_of(keys, shards), shards):
        own = own[np.lexsort((at[own], keys[own]))]
        docs, runs, places = pack_places(keys[own], at[own])
        rows.append((base + shard, {"docs": docs, "runs": runs, "at": places, "mark": mark[own].astype(np.uint32).tobytes() if len(mark) else b""}))
    return rows


def digests(keys: np.ndarray, at: np.ndarray, one: np.ndarray, two: np.ndarray | None, flags: np.ndarray, buckets: int) -> list[tuple]:
    """Rows of one group of documents: by bucket what must meet other groups, and as buckets + shard what is settled.

    one: 64 bits, of which the low half deals out and the high half (with two: all) is compared; two: 32 bits more.
    """
    order, group = _groups(one, two)
    many = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)
    settled = np.sort(order[many])
    rows = answers(keys[settled], at[settled], two[settled] if two is not None else np.zeros(0), buckets, buckets)
    single = np.sort(order[~many])
    first = order[many & np.concatenate((np.ones(1, bool), group[1:] != group[:-1]))] if len(group) else order
    held: dict[int, dict] = {}
    rest = (one >> np.uint64(32)).astype(np.uint32) if two is None else one
    bucket = ((one & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
    for k, part in split(bucket[single], buckets):
        own = single[part]
        docs, runs, places = pack_places(keys[own], at[own])
        held[k] = {"docs": docs, "runs": runs, "at": places, "one": rest[own].tobytes(), "flags": np.packbits(flags[own]).tobytes()}
        if two is not None:
            held[k]["two"] = two[own].tobytes()
    for k, part in split(bucket[first], buckets):
        own = first[part]
        held.setdefault(k, {})["lone_one"] = rest[own].tobytes()
        if two is not None:
            held[k]["lone_two"] = two[own].tobytes()
    return rows + list(held.items())


def meet(table: pa.Table, buckets: int, wide: bool) -> list[tuple]:
    """Rows of one bucket -> places whose digest another entry has too, at least one of them flagged."""
    columns = {n: table[n].to_pylist() for n in DIGEST_NAMES}
    if not columns["bucket"]:
        return []
    if columns["bucket"][0] >= buckets:  # settled before
        return [
            (b - buckets, {n: columns[n][i] for n in ANSWER_NAMES[1:]}) for i, b in enumerate(columns["bucket"])
        ]
    kind = np.uint64 if wide else np.uint32
    own = [np.frombuffer(x, kind) for x in columns["one"]]
    lone = [np.frombuffer(x, kind) for x in columns["lone_one"]]
    one = np.concatenate(own + lone)
    two = np.concatenate([np.frombuffer(x, np.uint32) for x in columns["two"] + columns["lone_two"]]) if wide else None
    sizes = np.array([len(x) for x in own], np.int64)
    mine = int(sizes.sum())
    flags = np.ones(len(one), bool)
    flags[:mine] = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(o)) for x, o in zip(columns["flags"], own, strict=True)]).astype(bool)
    order, group = _groups(one, two)
    if not len(group):
        return []
    hit = (np.bincount(group)[group] > 1) & (np.bincount(group, weights=flags[order])[group] > 0)
    found = np.sort(order[hit])
    found = found[found < mine]
    ends = np.cumsum(sizes)
    cuts = np.searchsorted(found, np.concatenate((np.zeros(1, np.int64), ends)))
    keys, at = [], []
    for i in np.flatnonzero(np.diff(cuts)):
        place = found[cuts[i] : cuts[i + 1]] - (ends[i] - sizes[i])
        docs, places = unpack_places(columns["docs"][i], columns["runs"][i], columns["at"][i])
        keys.append(docs[place])
        at.append(places[place])
    if not keys:
        return []
    return answers(np.concatenate(keys), np.concatenate(at), two[found] if wide else np.zeros(0), buckets)


class Places:
    """All places of the documents of one shard, to be looked up by document."""

    def __init__(self, table: pa.Table):
        got = [unpack_places(*x) for x in zip(*(table[n].to_pylist() for n in ("docs", "runs", "at")), strict=True)]
        marks = [np.frombuffer(x, np.uint32) for x in table["mark"].to_pylist()]
        keys = np.concatenate([g[0] for g in got]) if got else np.zeros(0, np.int64)
        at = np.concatenate([g[1] for g in got]) if got else np.zeros(0, np.int64)
        order = np.lexsort((at, keys))
        self.keys, self.at = keys[order], at[order]
        mark = np.concatenate(marks) if marks else np.zeros(0, np.uint32)
        self.mark = mark[order] if len(mark) == len(order) else None

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and index of each place that the given documents have."""
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        counts = high - low
        rows = np.repeat(np.arange(len(keys)), counts)
        return rows, np.arange(len(rows)) + np.repeat(low - (np.cumsum(counts) - counts), counts)
