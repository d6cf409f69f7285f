"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

The ring is cut into a fixed number of cells. A key lies in the cell of its hash; a cell belongs to the next virtual
node clockwise. Every shard may hold at most its even part of the rows (counts differ by one at most). Cells fill
their shards in ring order; keys that find their shard full continue clockwise to the next shard with room. As the
counts per cell say how many keys move on, the walk is over cells, a fixed number, never over rows.
"""

from __future__ import annotations

from bisect import bisect_left
from hashlib import md5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of the ring: 2 ** CELL_BITS. A fixed number, so the table of cells has a fixed size.
CELL_BITS = 14
#: Virtual nodes of each shard.
REPLICAS = 64
#: Part of all rows from which on a key is hot, and the parts of its cell.
HOT, PARTS = 1 / 256, 64


def _spot(label: str, cells: int) -> int:
    return int.from_bytes(md5(label.encode()).digest()[:8], "big") % cells


def ring_nodes(shards: int, replicas: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, in ring order; of nodes in one cell the first counts."""
    spots: dict[int, int] = {}
    for label, shard in sorted((f"{s}#{r}", s) for s in range(shards) for r in range(replicas)):
        spots.setdefault(_spot(label, cells), shard)
    return sorted(spots.items())


def fill(counts: dict, shards: int, replicas: int = REPLICAS, cells: int = 1 << CELL_BITS) -> list[tuple]:
    """(cell, first rank, rank after the last, shard, slot of the first): which keys of a cell go where.

    A cell is a number, or (number, part) for a cell that is cut into parts.
    """
    nodes = ring_nodes(shards, replicas, cells)
    places = [c for c, _ in nodes]
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    segments, waiting = [], []

    def put(cell: int, first: int, n: int, shard: int) -> int:
        taken = min(n, room[shard] - used[shard])
        if taken:
            segments.append((cell, first, first + taken, shard, used[shard]))
            used[shard] += taken
        return taken

    for cell in sorted(counts):
        node = bisect_left(places, cell[0] if isinstance(cell, tuple) else cell) % len(nodes)
        taken = put(cell, 0, counts[cell], nodes[node][1])
        if taken < counts[cell]:
            waiting.append((cell, taken, counts[cell] - taken, node))
    for cell, first, left, node in waiting:
        while left:
            node = (node + 1) % len(nodes)
            taken = put(cell, first, left, nodes[node][1])
            first, left = first + taken, left - taken
    return segments


def _parts(df: DataFrame, cell: Column, hashed: Column, tie: Column) -> Column:
    """0 for most rows; those of a hot key are spread over parts of its cell by a hash of their other columns.

    A key is hot if it holds more than HOT of all rows, so there are 1 / HOT hot keys at most. They are looked for in
    cells that hold so much, which is known from the cells' counts; most tables have none.
    """
    counts = df.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each cell
    least = HOT * sum(r["n"] for r in counts)
    full = [r["cell"] for r in counts if r["n"] > least]
    hot = []
    if full:
        keys = df.where(cell.isin(full)).groupBy(cell.alias("cell"), hashed.alias("hash")).agg(F.count(F.lit(1)).alias("n"))
        hot = sorted((r["cell"], r["hash"]) for r in keys.where(F.col("n") > F.lit(least)).collect())
    if not hot:
        return F.lit(0)
    first = F.create_map(*[F.lit(x) for k, (_, h) in enumerate(hot) for x in (h, 1 + k * PARTS)])
    return F.coalesce(F.element_at(first, hashed) + F.pmod(tie, F.lit(PARTS)).cast("int"), F.lit(0))


def shard(df: DataFrame, key: str, ties: list[Column], shards: int = 8, replicas: int = REPLICAS) -> DataFrame:
    """df with _shard int and _slot long (gapless from 0 in each shard); the law is that counts differ by one at most.

    Equal texts are not kept together, as counts could not be even then. Null keys hash like any other value; rows
    with one key lie in one cell, ordered by ties (identical rows in any order: they may change places). A key that
    holds a large part of all rows has its cell cut into parts by a hash of the ties, so no task ranks all its rows;
    rows that are equal in key and ties still meet. An empty table gives an empty result. The columns of df may have
    any name, except _shard and _slot, which are replaced. One more shard takes a ninth of the rows, and as bounds
    hold before and after, others move along the ring to fill the room.
    """
    spark, cells = df.sparkSession, 1 << CELL_BITS
    own = [c for c in df.columns if c not in ("_shard", "_slot")]
    hashed = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(key).isNull())
    cell = F.shiftrightunsigned(hashed, 64 - CELL_BITS).cast("int")
    part = _parts(df, cell, hashed, F.xxhash64(*ties, F.lit(17)))
    placed = df.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), hashed.alias("_hash"), cell.alias("_cell"), part.alias("_part"), F.struct(*ties).alias("_ties"))
    # A row for each cell, and PARTS for each of 1 / HOT hot keys at most.
    counts = {(r["_cell"], r["_part"]): r["n"] for r in placed.groupBy("_cell", "_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = [(*c, first, after, s, slot) for c, first, after, s, slot in fill(counts, shards, replicas)]
    segments = spark.createDataFrame(rows, "_cell int, _part int, _first long, _after long, _shard int, _slot0 long")
    order = Window.partitionBy("_cell", "_part").orderBy("_hash", "_ties")
    ranked = placed.withColumn("_rank", F.row_number().over(order) - F.lit(1))
    # At most two rows for a cell or part and one for a shard: a fixed size.
    found = ranked.join(F.broadcast(segments), ["_cell", "_part"]).where("_rank >= _first and _rank < _after")
    return found.select("_row.*", "_shard", F.expr("_slot0 + _rank - _first").alias("_slot"))
