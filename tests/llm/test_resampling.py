"""Weights, scores and ranks against plain Python."""

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

from censusloom.llm import resampling
from censusloom.llm.queries import op12_target_resampling
from censusloom.llm.resampling import ranked, resample, select

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(documents, targets, least=20, percent=10):
    raw, goal = Counter(), Counter()
    for _, text in documents:
        raw.update(zlib.crc32(w.encode()) % 10000 for w in words(text))
    for text in targets:
        goal.update(zlib.crc32(w.encode()) % 10000 for w in words(text))
    s, t = sum(raw.values()), sum(goal.values())
    gain = lambda b: math.floor(1000 * math.log((goal[b] + 1) * (s + 10000) / ((raw[b] + 1) * (t + 10000))))
    rows = []
    for key, text in documents:
        found = [gain(zlib.crc32(w.encode()) % 10000) for w in words(text)]
        h = int(sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(found) // len(found) if found else 0
        rows.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        row[4] = rank
    return sorted(map(tuple, rows), key=str)


def frames(spark, documents, targets):
    raw = spark.createDataFrame([(k, t, "x", 5, 6) for k, t in documents], "doc_id long, text string, rank string, score int, segment int")
    return raw, spark.createDataFrame([(t, 1) for t in targets], "text string, weight int")


def test_against_plain_python(spark):
    words_of = lambda k: " ".join(f"W{(k * 7 + j * j) % 97}" for j in range(k % 60))
    documents = [(k, words_of(k)) for k in range(400)] + [(9999, None), (None, words_of(55)), (10001, ""), (10002, "é" * 30 + " x" * 40 + " " + "y" * 300_000)]
    targets = ["w1 w2 W3 w4 w4", None, "", "w50 " * 30]
    raw, goal = frames(spark, documents, targets)
    got = resample(raw, goal)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(documents, targets)
    assert select(raw.where("doc_id is not null"), got).count() == got.where("rank is not null and doc_id is not null").count()


def test_empty_tables(spark):
    raw, goal = frames(spark, [], [])
    assert resample(raw, goal).collect() == []
    raw, goal = frames(spark, [(k, "a b c " * 10) for k in range(30)], [])
    assert sorted(r["rank"] for r in resample(raw, goal).where("rank is not null").collect()) == [1, 2, 3]


def test_ranks_are_whole_among_ties(spark):
    """A third of the rows share key and score: every rank occurs once, better scores first."""
    raw, goal = frames(spark, [(5, "b " * 20)] * 300 + [(k, "a " * 25) for k in range(600)], ["a a b"])
    got = resample(raw, goal, percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == list(range(1, 451))
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [(-r["score"], r["doc_id"]) for r in drawn] == sorted((-r["score"], r["doc_id"]) for r in got)[:450]


def test_segments_stay_even(spark):
    """One hot score falls into many segments, as runs and places part it."""
    scored = spark.range(4000).selectExpr("id as doc_id", "30L as n_features", "0L as weight", "if(id % 3 = 0, 7L, id) as score").repartition(8)
    rows = ranked(scored, scored, 4000).collect()
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["rank"])] == [r["doc_id"] for r in sorted(rows, key=lambda r: (-r["score"], r["doc_id"]))]
    assert sorted(r["rank"] for r in rows) == list(range(1, 4001))


def test_splitters_part_a_run_as_single_comparisons_do():
    import pyarrow as pa

    scores = [9, 9, 7, 7, 7, 2, 8, 8, 1]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, None, 3, 4, 5, 6, 1, 2, 3]), *[pa.array([0] * 9)] * 2, pa.array(scores), pa.array([0] * 6 + [1] * 3, pa.int32()), pa.array([0, 1, 2, 3, 4, 5, 0, 1, 2])],
        ["doc_id", "n_features", "weight", "score", "run", "place"],
    )
    splitters = sorted(resampling._key(*x) for x in [(8, 2, 1, 1), (7, 4, 0, 3), (2, 6, 0, 5)])
    (out,) = resampling._parted(splitters)(iter([batch]))
    keys = [resampling._key(*x) for x in zip(scores, batch.column(0).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
    assert out.column(6).to_pylist() == [sum(s <= k for s in splitters) for k in keys]


def test_whole_table(spark, sf_dir):
    documents = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    targets = [r[0] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    assert sorted((tuple(r) for r in op12_target_resampling(spark, sf_dir).collect()), key=str) == plain(documents, targets)
