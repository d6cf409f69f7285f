"""Exact n-gram Jaccard join with PartEnum signatures.

Two sets link when 100 * intersection >= 75 * union; their symmetric difference is then at most a third of either size.
The shingle domain is partitioned by a hash, into as many parts as the sizes of a band have; sets that may link across
the lower edge of their band are partitioned for that band too. With k = size / 3 differences at most k parts can
disagree, so of any k + 1 parts that are not empty one must agree: the enumerated subsets are the single parts, and a
signature is the shingles of one part. Each set gives its k + 1 signatures that are least frequent in the whole corpus
(by a counting sketch of fixed size; any order that all sets share finds all pairs). A set with fewer than k + 1 parts
that are not empty gives all of them, and its k + 1 least single shingles, in case its partner is such a set too.

Sets that share a signature form a group. Groups are settled in rounds. First every member is compared exactly with
the group's least member; links make components, and what is in one component needs no more comparison. Then members
outside their group's largest component are compared with members of other components, nearest first, until no pair
is left that could link. A parity sketch, whose distance never exceeds the sets' difference, rules pairs out before
their texts are fetched. So no link is lost, and groups of copies are never expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censusloom.llm import counting, packed
from censusloom.llm.components import components
from censusloom.llm.text import LOWER, SPACED, mix, slices, utf8, window_hashes, window_starts, word_hashes, words
from censusloom.plans.storage import settle

SHINGLE, PERCENT = 5, 75
#: Cells of the frequency sketch, of four bytes each. More cells for larger tables were measured: they cost disk and save no shuffle.
CELLS = 1 << 21
#: Bits of a parity sketch: four for each shingle, rounded up to a power of two, within these bounds.
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 17
#: Groups up to this size have all their pairs looked at, larger ones the pairs of members outside the largest component.
SMALL = 32
AT_ONCE, GROUP = 1 << 19, 1 << 20
#: Nearest candidates of a member that are compared in each later round; in the last round all.
NEAREST = (4, 64, None)
_SINGLE = np.uint64(0xD6E8FEB86659FD93)


def _by_row(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """An order by row and then hash: by one number, and only if two hashes share its bits by both."""
    if len(rows) and rows.max() < 1 << 20:
        key = rows.astype(np.uint64) << np.uint64(44) | hashes >> np.uint64(20)
        order = np.argsort(key)
        same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
        if (hashes[order[same]] == hashes[order[same + 1]]).all():
            return order
    return np.lexsort((hashes, rows))


def _sets(column, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, and for its rows the distinct shingle hashes with their rows, sorted."""
    buf, offs = utf8(column)
    buf = LOWER[buf]
    for i, j in slices(offs, AT_ONCE):
        part = buf[offs[i] : offs[j]]
        starts, ends, bounds = words(part, offs[i : j + 1] - offs[i], SPACED)
        one = word_hashes(part, starts, ends, 3)
        at = window_starts(bounds, size)
        rows, hashes = np.searchsorted(bounds, at, "right") - 1, window_hashes(one, at, size, 3)
        n = np.diff(bounds)
        short = np.flatnonzero((n > 0) & (n < size))
        if len(short):
            whole = mix(window_hashes(one, bounds[short], n[short], 3) + n[short].astype(np.uint64))
            rows, hashes = np.concatenate((rows, short)), np.concatenate((hashes, whole))
        order = _by_row(rows, hashes)
        rows, hashes = rows[order], hashes[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
        yield i, j, rows[new], hashes[new]


def _sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, firsts) if len(firsts) else np.zeros(0, values.dtype)


def _firsts(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def signatures(rows: np.ndarray, hashes: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, signature, wanted) of all parts that are not empty, for each row's band and then the band below.

    wanted is the number of signatures that the row needs: k + 1.
    """
    size = np.bincount(rows, minlength=n)
    wanted = size // 3 + 1
    band = np.frexp(size.astype(float))[1]  # size < 2 ** band
    for lower in (0, 1):
        mine = np.ones(len(rows), bool) if not lower else (-(-size * PERCENT // 100) < (1 << np.maximum(band - 1, 0)))[rows] & (band[rows] > 1)
        r, h = rows[mine], hashes[mine]
        parts = (np.int64(1) << (band - lower)).astype(np.uint64)[r]
        part = (mix(h) >> np.uint64(20)) % parts
        order = np.argsort(r.astype(np.uint64) << np.uint64(40) | part)
        r, h, part, parts = r[order], h[order], part[order], parts[order]
        first = _firsts(r, part)
        projected = _sums(mix(h + np.uint64(77)), first)
        yield r[first], mix(projected + mix(parts[first] * np.uint64(0x9E3779B97F4A7C15) + part[first])), wanted


def chosen(rows: np.ndarray, hashes: np.ndarray, n: int, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature): the rarest k + 1 of each row and band, or all and single shingles besides."""
    out = []
    cells = np.uint64(len(sketch) - 1)
    for r, s, wanted in signatures(rows, hashes, n):
        order = np.lexsort((s, r << 32 | sketch[(s & cells).astype(np.int64)].astype(np.int64)))
        r, s = r[order], s[order]
        count = np.bincount(r, minlength=n)
        rank = np.arange(len(r)) - (np.cumsum(count) - count)[r]
        out.append((r[rank < wanted[r]], s[rank < wanted[r]]))
        few = (count > 0) & (count < wanted)
        if few.any():  # rows are sorted, hashes too within a row
            size = np.bincount(rows, minlength=n)
            place = np.arange(len(rows)) - (np.cumsum(size) - size)[rows]
            single = few[rows] & (place < wanted[rows])
            out.append((rows[single], mix(hashes[single] + _SINGLE)))
    return np.concatenate([r for r, _ in out]), np.concatenate([s for _, s in out])


def _digests(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two order-free digests of each row's set."""
    size = np.bincount(rows, minlength=n)
    first = _firsts(rows)
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    own = rows[first]
    one[own], two[own] = _sums(mix(hashes), first), _sums(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), first)
    return size, one, two


def parity(hashes: np.ndarray) -> bytes:
    """A bit for each cell of a table: whether an odd number of shingles fall into it."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (4 * len(hashes) - 1).bit_length()))
    cells = (mix(hashes + np.uint64(5)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=bits) & 1).astype(bool), bitorder="little").tobytes()


class _Sketches:
    """Parity sketches of different sizes, to be compared in bulk: the larger is folded to the smaller's size."""

    def __init__(self, column):
        data = column.to_pylist()
        self.size = np.array([len(d) for d in data], np.int64)
        self.place = np.zeros(len(data), np.int64)
        self.own: dict[int, np.ndarray] = {}
        for size in np.unique(self.size):
            mine = np.flatnonzero(self.size == size)
            self.place[mine] = np.arange(len(mine))
            self.own[int(size)] = np.frombuffer(b"".join(data[k] for k in mine), np.uint64).reshape(len(mine), -1)

    def _at(self, rows: np.ndarray, size: int, to: int) -> np.ndarray:
        found = self.own[size][self.place[rows]]
        while size > to:
            half = found.shape[1] // 2
            found, size = found[:, :half] ^ found[:, half:], size // 2
        return found

    def apart(self, i: np.ndarray, j: np.ndarray, other: _Sketches | None = None) -> np.ndarray:
        """At most the number of shingles that rows i and rows j (of the other, if given) do not share."""
        other = other or self
        out = np.zeros(len(i), np.int64)
        a, b = self.size[i], other.size[j]
        for x, y in {(int(x), int(y)) for x, y in zip(*np.unique(np.stack((a, b)), axis=1), strict=True)}:
            mine = np.flatnonzero((a == x) & (b == y))
            for part in np.array_split(mine, max(1, len(mine) * min(x, y) >> 24)):  # some megabytes at a time
                left, right = self._at(i[part], x, min(x, y)), other._at(j[part], y, min(x, y))
                out[part] = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
        return out


def shingle_sets(df: DataFrame, size: int) -> DataFrame:
    """doc, n, one, two for every row, and each task's sketch of signature counts (segment not null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "n", "one", "two", *counting.NAMES]
        counted = np.zeros(CELLS, np.uint32)
        for batch in batches:
            for i, j, rows, hashes in _sets(batch.column(1), size):
                n, one, two = _digests(rows, hashes, j - i)
                for _, s, _ in signatures(rows, hashes, j - i):
                    np.add.at(counted, (s & np.uint64(len(counted) - 1)).astype(np.int64), 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i), pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                        pa.nulls(j - i, pa.int32()), pa.nulls(j - i, pa.binary()),
                    ],
                    names,
                )
        counts = counting.segments(counted)
        none = [pa.nulls(len(counts[0]), pa.int64())] * 4
        yield pa.RecordBatch.from_arrays([*none, *counts], names)

    return df.mapInArrow(run, f"doc long, n long, one long, two long, {counting.SCHEMA}")


def _meet(table: pa.Table) -> pa.Table:
    """Entries of one bucket -> (gid, doc) of all groups of two documents or more; equal groups once."""
    one = [np.frombuffer(x, np.uint32) for x in table["one"].to_pylist()]
    docs = [packed.unpack_places(d, r, a)[0] for d, r, a in zip(*(table[n].to_pylist() for n in ("docs", "runs", "at")), strict=True)]
    value, doc = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (one, docs))
    order = np.lexsort((doc, value))
    value, doc = value[order], doc[order]
    first = _firsts(value, doc)
    value, doc = value[first], doc[first]
    start = _firsts(value)
    size = np.diff(start, append=len(value))
    members = _sums(mix(doc.view(np.uint64)), start) + size.astype(np.uint64)
    others = _sums(mix(doc.view(np.uint64) ^ _SINGLE), start)
    big = np.flatnonzero(size > 1)
    pair = np.lexsort((others[big], members[big]))
    big = big[pair][_firsts(members[big][pair], others[big][pair])]
    taken = np.repeat(start[big] - (np.cumsum(size[big]) - size[big]), size[big]) + np.arange(size[big].sum())
    gid = np.repeat(members[big].view(np.int64), size[big])
    return pa.table({"gid": pa.array(gid, pa.int64()), "doc": pa.array(doc[taken], pa.int64())})


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _verify(pairs: DataFrame, texts: DataFrame, shards: int, size: int) -> DataFrame:
    """Of (u, v) pairs those that link, compared on their whole sets. A text travels once to each shard of partners."""

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        text = dict(zip(left["doc"].to_pylist(), left["text"].to_pylist(), strict=True))
        u, v, to = (right[n].to_numpy() for n in ("u", "v", "to"))
        order = np.lexsort((v, to, u))
        u, v, to = u[order], v[order], to[order]
        first = _firsts(u, to)
        rows = [(int(to[i]), int(u[i]), text[int(u[i])], v[i:j].tobytes()) for i, j in zip(first, [*first[1:], len(u)], strict=False)]
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.binary())
        return pa.Table.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["shard", "u", "text", "vs"])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        partners = [np.frombuffer(x, np.int64) for x in right["vs"].to_pylist()]
        needed = np.unique(np.concatenate(partners)) if partners else np.zeros(0, np.int64)
        own = left.filter(pa.array(np.isin(left["doc"].to_numpy(), needed)))
        ids, sets = own["doc"].to_pylist(), {}
        for i, j, rows, hashes in _sets(own["text"], size):
            edges = np.searchsorted(rows, np.arange(j - i + 1))
            sets.update((ids[i + k], hashes[edges[k] : edges[k + 1]]) for k in range(j - i))
        found, us = ([], []), right["u"].to_pylist()
        for i, j, rows, hashes in _sets(right["text"], size):
            edges = np.searchsorted(rows, np.arange(j - i + 1))
            for k in range(j - i):
                for v in partners[i + k].tolist():
                    if _linked(hashes[edges[k] : edges[k + 1]], sets[v]):
                        found[0].append(us[i + k])
                        found[1].append(v)
        return pa.table({"u": pa.array(found[0], pa.int64()), "v": pa.array(found[1], pa.int64())})

    dealt = pairs.select("u", "v", packed.shard_column(F.col("u"), shards).alias("shard"), packed.shard_column(F.col("v"), shards).alias("to"))
    needed = pairs.select(F.col("u").alias("doc")).unionByName(pairs.select(F.col("v").alias("doc"))).distinct()
    home = texts.select("shard", "doc", "text").join(needed, "doc", "left_semi").select("shard", "doc", "text").groupBy("shard")
    sent = home.cogroup(dealt.groupBy("shard")).applyInArrow(send, "shard int, u long, text string, vs binary")
    return home.cogroup(sent.groupBy("shard")).applyInArrow(compare, "u long, v long")


def _parities(size: int):
    """Size and parity sketch of a text's set."""

    @F.arrow_udf("n long, parity binary")
    def run(column: pa.Array) -> pa.Array:
        counts, out = [], []
        for i, j, rows, hashes in _sets(column, size):
            edges = np.searchsorted(rows, np.arange(j - i + 1))
            counts += np.diff(edges).tolist()
            out += [parity(hashes[edges[k] : edges[k + 1]]) for k in range(j - i)]
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(out, pa.binary())], ["n", "parity"])

    return run


def set_digests(size: int = SHINGLE):
    """n, one, two of a text's set, as shingle_sets has them."""

    @F.arrow_udf("n long, one long, two long")
    def run(column: pa.Array) -> pa.Array:
        parts = [_digests(rows, hashes, j - i) for i, j, rows, hashes in _sets(column, size)]
        n, one, two = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 3
        return pa.StructArray.from_arrays([pa.array(n.astype(np.int64)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], ["n", "one", "two"])

    return run


def _may_link(n: np.ndarray, other: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Whether sizes and a lower bound of the difference let two sets link."""
    sizes = 100 * np.minimum(n, other) >= PERCENT * np.maximum(n, other)
    return sizes & ((100 + PERCENT) * apart <= (100 - PERCENT) * (n + other))


@F.arrow_udf(T.BooleanType())
def _able(n: pa.Array, sketch: pa.Array, other_n: pa.Array, other_sketch: pa.Array) -> pa.Array:
    rows = np.arange(len(n))
    apart = _Sketches(sketch).apart(rows, rows, _Sketches(other_sketch))
    return pa.array(_may_link(n.to_numpy(), other_n.to_numpy(), apart))


def _small_pairs(table: pa.Table) -> pa.Table:
    """Of many small groups, all pairs of members in different components whose sizes let them link."""
    gid, rep, comp, n = (table[k].to_numpy() for k in ("gid", "rep", "comp", "n"))
    order = np.lexsort((n, gid))
    gid, rep, comp, n = gid[order], rep[order], comp[order], n[order]
    us, vs = [], []
    for step in range(1, SMALL):  # neighbours at a distance of 1, 2, ... of all groups at once
        i = np.flatnonzero(gid[:-step] == gid[step:]) if len(gid) > step else np.zeros(0, np.int64)
        if not len(i):
            break
        i = i[(comp[i] != comp[i + step]) & (100 * n[i] >= PERCENT * n[i + step])]
        us.append(rep[i])
        vs.append(rep[i + step])
    return _distinct_pairs(us, vs, [])


def _distinct_pairs(us: list[np.ndarray], vs: list[np.ndarray], more: list) -> pa.Table:
    u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
    pairs = np.unique(np.stack((np.minimum(u, v), np.maximum(u, v))), axis=1) if len(u) else np.zeros((2, 0), np.int64)
    return pa.table({"u": pa.array([*pairs[0].tolist(), *more], pa.int64()), "v": pa.array([*pairs[1].tolist(), *more], pa.int64())})


def _large_pairs(most: int | None):
    """Of large groups, pairs of members in different components that may link: each member outside the largest
    component with others, nearest first; (null, null) if some were put off."""

    def run(table: pa.Table) -> pa.Table:
        rep, comp, n = (table[k].to_numpy() for k in ("rep", "comp", "n"))
        sketches = _Sketches(table["parity"])
        order = np.argsort(n, kind="stable")
        rep, comp, n = rep[order], comp[order], n[order]
        us, vs, more = [], [], False
        names, index, count = np.unique(comp, return_inverse=True, return_counts=True)
        largest = np.lexsort((names, -count))[0]
        for i in np.flatnonzero(index != largest):
            low = int(np.searchsorted(n, -(-PERCENT * n[i] // 100), "left"))
            high = int(np.searchsorted(n, 100 * n[i] // PERCENT, "right"))
            j = low + np.flatnonzero(comp[low:high] != comp[i])
            apart = sketches.apart(np.full(len(j), order[i]), order[j])
            able = np.flatnonzero(_may_link(n[i], n[j], apart))
            if most is not None and len(able) > most:
                able, more = able[np.argsort(apart[able], kind="stable")[:most]], True
            us.append(np.full(len(able), rep[i]))
            vs.append(rep[j[able]])
        return _distinct_pairs(us, vs, [None] if more else [])

    return run


def _hooked(links: DataFrame) -> DataFrame:
    """(node, comp): a member of its component for every linked node, often the least; two steps towards components."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("up"))
    top = least.select(F.col("node").alias("up"), F.col("up").alias("comp"))
    return least.join(top, "up").select("node", "comp")


class _Linked:
    """Classes of equal sets and the links between them, found on texts alone.

    sets: doc, n, one, two of every row; classes: n, one, two, rep (the class's name), least (its least doc); member:
    doc, rep; links: (u, v) and comps: (node, component) of names. repeated: whether some doc has texts of several classes. Without
    such docs a class is named by its least doc, else by a number of its own.
    """

    def __init__(self, sets: DataFrame, classes: DataFrame, member: DataFrame, links: DataFrame, comps: DataFrame, repeated: bool):
        self.sets, self.classes, self.member, self.links, self.comps, self.repeated = sets, classes, member, links, comps, repeated


def jaccard_components(df: DataFrame, size: int = SHINGLE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_shingles, component_id: the least key that a document reaches over links, for every row.

    Null and wordless texts have the empty set and link with nothing: their own key is their component. The key is an
    integer. Rows that repeat a key with other texts keep their own sizes and links and share a component. Null keys
    are not linked and have a null component. Only key and text are read.
    """
    found = _linked_classes(df, size, text, key)
    classes, member, comps = found.classes, found.member, found.comps
    if found.repeated:  # Classes that share a key belong together.
        member = settle(member.distinct(), "distinct_members")
        first = member.groupBy("doc").agg(F.min("rep").alias("v"))
        shared = member.select("doc", F.col("rep").alias("u")).join(first, "doc").where("u <> v").select("u", "v")
        comps = settle(components(found.links.unionByName(shared)), "components")
        named = comps.join(classes.select(F.col("rep").alias("node"), "least"), "node").groupBy("component").agg(F.min("least").alias("least"))
        comps = comps.join(named, "component").select("node", F.col("least").alias("component"))
        alone = classes.select(F.col("rep").alias("node"), "least").join(comps, "node", "left")
        comps = alone.select("node", F.coalesce("component", "least").alias("component"))
    own = member.join(comps, member["rep"] == comps["node"], "left").groupBy("doc").agg(F.min(F.coalesce("component", "rep")).alias("component"))
    rows = found.sets.select("doc", "n").join(own, "doc", "left")
    return rows.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))


def linked_texts(df: DataFrame, size: int = SHINGLE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc, n, one, two, copies (rows), group: for each key and set (set_digests) the group of texts that links reach.

    A shared key alone links nothing. Rows without a key or a word are left out.
    """
    found = _linked_classes(df, size, text, key)
    rows = found.sets.where("n > 0 and doc is not null").groupBy("doc", "n", "one", "two").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.join(found.classes, ["n", "one", "two"])
    rows = rows.join(found.comps, rows["rep"] == found.comps["node"], "left")
    return rows.select("doc", "n", "one", "two", "copies", F.coalesce("component", "rep").alias("group"))


def first_of_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one row of each group of linked texts: that with the least key and, of its rows in the group, the least text.

    A shared key alone links nothing. Rows without a key or without words are linked with nothing and stay. The rows
    that go are about as many as the rows that stay, so the joins are merged at every size, with one plan.
    """
    groups = settle(linked_texts(docs, text=text, key=key), "linked_texts")
    groups = groups.join(groups.groupBy("group").agg(F.min("doc").alias("least"), F.sum("copies").alias("rows")), "group").where("rows > 1")
    groups = settle(groups.select(F.struct("doc", "n", "one", "two").alias("_own"), "group", "copies", F.expr("doc = least").alias("first")), "groups")
    own = F.struct(F.col(f"`{key}`").cast("long").alias("doc"), F.col("_set.n").alias("n"), F.col("_set.one").alias("one"), F.col("_set.two").alias("two"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), key, set_digests()(F.col(f"`{text}`")).alias("_set"))
    rows = rows.select("_row", own.alias("_own"))
    kept = rows.join(groups.where("not first").select("_own").hint("merge"), "_own", "left_anti")
    firsts = groups.where("first")
    again = firsts.groupBy("group").agg(F.sum("copies").alias("rows")).where("rows > 1")
    again = settle(firsts.join(again.select("group"), "group", "left_semi").select("_own", "group"), "again")
    if again.isEmpty():
        return kept.select("_row.*")
    least = kept.join(again, "_own").groupBy("group").agg(F.min(F.struct(F.col(f"_row.`{text}`").alias("text"), F.col("_row").alias("row"))).alias("_least"))
    return kept.join(again, "_own", "left_anti").select("_row.*").unionByName(least.select("_least.row.*"))


def _linked_classes(df: DataFrame, size: int, text: str, key: str) -> _Linked:
    spark = df.sparkSession
    buckets = packed.buckets_of(spark)
    docs = df.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    tables = settle(shingle_sets(docs, size), "shingle_sets")
    counts = np.minimum(counting.total(tables.where("segment is not null"), CELLS), np.iinfo(np.uint32).max)
    sketch = spark.sparkContext.broadcast(counts.astype(np.uint32))
    sets = tables.where("segment is null").drop(*counting.NAMES)
    able_sets = sets.where("n > 0 and doc is not null")
    digest = F.struct("n", "one", "two")
    several = settle(able_sets.groupBy("doc").agg(F.min(digest).alias("a"), F.max(digest).alias("b")).where("a <> b").select("doc"), "several")
    repeated = not several.isEmpty()
    name = F.monotonically_increasing_id() if repeated else F.col("least")
    classes = settle(able_sets.groupBy("n", "one", "two").agg(F.min("doc").alias("least")).withColumn("rep", name), "classes")
    member = settle(able_sets.join(classes, ["n", "one", "two"]).select("doc", "rep", "n"), "members")
    names = member
    marked = docs.where("doc is not null").withColumn("several", F.lit(False))
    if repeated:
        # Entries of a key with several texts go by the set's digest; a chance hit of another name is one more candidate.
        names = member.join(several, "doc", "left_anti").unionByName(classes.select(F.col("one").alias("doc"), "rep", "n"))
        known = several.select(F.col("doc").alias("_doc"))
        marked = docs.where("doc is not null").join(known, F.col("doc") == F.col("_doc"), "left")
        marked = marked.select("doc", "text", F.col("_doc").isNotNull().alias("several"))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            keys, values = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            rows = []
            bucket = ((values & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
            for k, own in packed.split(bucket, buckets):
                docs_, runs, at = packed.pack_places(keys[own], np.zeros(len(own), np.int64))
                rows.append((k, {"docs": docs_, "runs": runs, "at": at, "one": (values[own] >> np.uint64(32)).astype(np.uint32).tobytes()}))
            return packed.batch_of(rows, ["bucket", "docs", "runs", "at", "one"])

        seen: set[tuple[int, int]] = set()  # sets of this group of documents: copies give no signatures again
        for batch in batches:
            ids, by_set = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
            for i, j, rows, hashes in _sets(batch.column(1), size):
                _, one, two = _digests(rows, hashes, j - i)
                new = np.zeros(j - i, bool)
                for k, pair in enumerate(zip(one.tolist(), two.tolist(), strict=True)):
                    if pair not in seen:
                        seen.add(pair)
                        new[k] = True
                keep = new[rows]
                r, s = chosen(rows[keep], hashes[keep], j - i, sketch.value)
                order = np.argsort(r, kind="stable")
                names = np.where(by_set[i:j], one.view(np.int64), ids[i:j])
                held.append((names[r[order]], s[order]))
                if sum(len(h[0]) for h in held) >= GROUP:
                    yield flush()
                    seen.clear()
        if held:
            yield flush()

    entries = marked.mapInArrow(probe, "bucket int, docs binary, runs binary, at binary, one binary")
    met = entries.groupBy("bucket").applyInArrow(_meet, "gid long, doc long")
    # Dealt out by group once; members are then made distinct and compared with their group where they are.
    own = Window.partitionBy("gid")
    named = met.join(names, "doc").select("gid", "rep", "n").repartition("gid").distinct()
    named = named.withColumns({"c": F.min(F.struct("rep", "n")).over(own), "most": F.max("rep").over(own), "size": F.count(F.lit(1)).over(own)})
    named = named.where("c.rep < most").select("gid", "rep", "n", "size", F.col("c.rep").alias("centre"), F.col("c.n").alias("centre_n"))
    groups = settle(named, "groups")
    # One text of each class that has company. Its number follows the documents', so the join is merged at every size.
    company = groups.select("rep").distinct()
    if repeated:
        company = company.join(classes.withColumnRenamed("least", "doc"), "rep").hint("merge")
        texts = docs.select("doc", "text", set_digests(size)("text").alias("own")).select("doc", "text", "own.*").join(company, ["doc", "n", "one", "two"])
    else:
        texts = docs.join(company.hint("merge"), F.col("doc") == F.col("rep"))
    texts = texts.groupBy(F.col("rep").alias("doc")).agg(F.min("text").alias("text"))
    texts = texts.select(packed.shard_column(F.col("doc"), buckets).alias("shard"), "doc", "text", _parities(size)("text").alias("sketch"))
    texts = texts.select("shard", "doc", "text", "sketch.*")
    texts = settle(texts, "texts")
    sketches = texts.select(F.col("doc").alias("rep"), "n", "parity")

    def able(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sketches.toDF("u", "nu", "pu"), "u").join(sketches.toDF("v", "nv", "pv"), "v")
        return both.where(_able("nu", "pu", "nv", "pv")).select("u", "v")

    near = "100 * least(n, centre_n) >= 75 * greatest(n, centre_n)"
    pairs = groups.where("rep <> centre").where(near).select(F.col("centre").alias("u"), F.col("rep").alias("v")).distinct()
    known = settle(able(pairs), "pairs")
    links = settle(_verify(known, texts, buckets, size), "links")
    comps = _hooked(links)
    for most in NEAREST:
        placed = groups.join(comps, groups["rep"] == comps["node"], "left").select("gid", "rep", "n", "size", F.coalesce("comp", "rep").alias("comp"))
        placed = placed.repartition("gid").withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("gid", "comp")))
        largest = F.max(F.struct("same", "comp")).over(own)["comp"]
        placed = placed.withColumns({"low": F.min("comp").over(own), "high": F.max("comp").over(own), "largest": largest})
        open_ = settle(placed.where("low < high").select("gid", "rep", "comp", "n", "size", "largest"), "open_groups")
        # Large groups with one largest component are looked at together: their members are mostly the same.
        large = open_.where(F.col("size") > SMALL).select("largest", "rep", "comp", "n").distinct()
        found = large.join(sketches.select("rep", "parity"), "rep").groupBy("largest").applyInArrow(_large_pairs(most), "u long, v long")
        if most == NEAREST[0]:  # all pairs of small groups, once
            small = open_.where(F.col("size") <= SMALL).withColumn("bucket", F.pmod("gid", F.lit(buckets)))
            rest = small.groupBy("bucket").applyInArrow(_small_pairs, "u long, v long").distinct().join(known, ["u", "v"], "left_anti")
            found = found.unionByName(able(rest))
        found = settle(found.distinct(), "pairs")
        pairs = settle(found.where("u is not null").join(known, ["u", "v"], "left_anti"), "pairs")
        known = known.unionByName(pairs)
        links = settle(links.unionByName(_verify(pairs, texts, buckets, size)), "links")
        comps = components(links).withColumnRenamed("component", "comp")
        if found.where("u is null").isEmpty():
            break
        comps = settle(comps, "components")
    return _Linked(sets, classes, member.select("doc", "rep"), links, comps.withColumnRenamed("comp", "component"), repeated)
