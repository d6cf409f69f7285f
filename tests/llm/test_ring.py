from collections import Counter

from pyspark.sql import functions as F

from censusloom.llm.ring import fill, ring_nodes, shard


def brute(counts, shards, replicas, cells):
    """Key by key: home shard first, in ring order; then each key that found no room walks on clockwise."""
    nodes = ring_nodes(shards, replicas, cells)
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used, out, waiting = [0] * shards, {}, []

    def put(cell, rank, s):
        if used[s] < room[s]:
            out[cell, rank] = (s, used[s])
            used[s] += 1
            return True
        return False

    for cell in sorted(counts):
        at = next((i for i, (c, _) in enumerate(nodes) if c >= cell), 0)
        for rank in range(counts[cell]):
            if not put(cell, rank, nodes[at][1]):
                waiting.append((cell, rank, at))
    for cell, rank, at in waiting:
        while True:
            at = (at + 1) % len(nodes)
            if put(cell, rank, nodes[at][1]):
                break
    return out


def test_walk_over_cells_is_the_walk_over_keys():
    for shards, counts in ((3, {0: 5, 7: 1, 9: 30, 60: 2}), (8, {k: k % 5 for k in range(64)}), (2, {63: 9}), (4, {})):
        want = brute(counts, shards, 5, 64)
        got = {(c, r): (s, slot + r - a) for c, a, b, s, slot in fill(counts, shards, 5, 64) for r in range(a, b)}
        assert got == want


def test_even_gapless_and_stable(spark):
    rows = spark.range(5003).select(F.col("id").alias("doc_id"), F.lit("x").alias("other"))
    got = shard(rows, "doc_id", [F.col("doc_id")]).collect()
    assert len(got) == 5003 and sorted(r.doc_id for r in got) == list(range(5003))
    sizes = Counter(r._shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r._slot for r in got if r._shard == s) == list(range(n))
    again = {r.doc_id: r._shard for r in shard(rows.where("doc_id <> 17"), "doc_id", [F.col("doc_id")]).collect()}
    moved = sum(again.get(r.doc_id, r._shard) != r._shard for r in got)
    assert moved < 50  # one key less moves few others


def test_hot_null_and_empty_keys(spark):
    rows = spark.createDataFrame([(5, i) for i in range(40)] + [(None, i) for i in range(20)] + [(7, 7), (7, 7)], "doc_id long, n int")
    got = shard(rows, "doc_id", [F.col("n")]).collect()
    sizes = Counter(r._shard for r in got)
    assert len(got) == 62 and max(sizes.values()) - min(sizes.values()) <= 1
    assert len({(r._shard, r._slot) for r in got}) == 62
    assert shard(rows.where("false"), "doc_id", [F.col("n")]).collect() == []


def test_a_hot_key_is_ranked_in_parts(spark):
    """A third of all rows has no key: law and slots hold, and no window partition has more than a few of them."""
    rows = spark.range(9000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), F.col("id").alias("_hash"), F.lit("x").alias("_row"))
    got = shard(rows, "doc_id", [F.col("_hash")])
    assert got.columns == ["doc_id", "_hash", "_row", "_shard", "_slot"]
    found = got.collect()
    assert sorted(r._hash for r in found) == list(range(9000))
    sizes = Counter(r._shard for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len({(r._shard, r._slot) for r in found}) == 9000
    assert max(r._slot for r in found) == 1124
    from censusloom.llm import ring

    key, tie = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull()), F.xxhash64("_hash", F.lit(17))
    cell = F.shiftrightunsigned(key, 64 - ring.CELL_BITS).cast("int")
    parts = rows.groupBy(cell, ring._parts(rows, cell, key, tie)).count().collect()
    assert max(r["count"] for r in parts) < 3000 / ring.PARTS * 2


def test_how_many_rows_another_shard_moves(spark):
    """The new shard takes its ninth; the other rows that move are fewer than those that stay."""
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"))
    before = {r.doc_id: r._shard for r in shard(rows, "doc_id", [F.col("doc_id")], shards=8).collect()}
    after = {r.doc_id: r._shard for r in shard(rows, "doc_id", [F.col("doc_id")], shards=9).collect()}
    new = sum(s == 8 for s in after.values())
    moved = sum(before[k] != after[k] for k in before if after[k] != 8)
    assert new in (2222, 2223) and moved / len(before) < 0.25, moved
