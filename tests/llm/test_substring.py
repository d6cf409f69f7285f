import random
import re
from collections import Counter
from hashlib import sha256

from pyspark.sql import functions as F

from censusloom.llm.substring import remove_repeats


def brute(docs, size=35):
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in docs]
    seen = Counter(tuple(ws[i : i + size]) for _, ws in split for i in range(len(ws) - size + 1))
    out = []
    for d, ws in split:
        gone = set()
        for i in range(len(ws) - size + 1):
            if seen[tuple(ws[i : i + size])] > 1:
                gone |= set(range(i, i + size))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), sha256(kept.encode()).hexdigest(), kept))
    return out


def rows(seed, n):
    rng = random.Random(seed)
    text = lambda k: " ".join(rng.choice("abcdefghé") * rng.randrange(1, 3) for _ in range(k))
    shared = [text(k) for k in (35, 36, 40, 90, 34)]
    docs = []
    for d in range(n):
        parts = [text(rng.randrange(0, 60))] + [rng.choice(shared) for _ in range(rng.choice([0, 0, 1, 2]))] + [text(rng.randrange(50))]
        docs.append((d, rng.choice([" ", "\n", " \t "]).join(parts)))
    docs += [(n, "x " * 100), (n + 1, text(20000)), (n + 2, docs[0][1]), (n + 3, None), (n + 4, ""), (n + 5, " \n "), (n + 6, "y " * 35), (n + 7, "z " * 36)]
    return docs


def test_matches_brute_force(spark):
    for seed in range(3):
        docs = rows(seed, 60)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumn("shard", F.lit(3)).withColumn("docs", F.lit("x"))
        got = {tuple(r) for r in remove_repeats(df).collect()}
        assert got == {r[:4] for r in brute(docs)}


def test_small_window_replaces_text(spark):
    docs = [(1, "a b c d"), (2, "x b c d"), (3, "a a a a"), (4, "q r s")]
    df = spark.createDataFrame([(d, t, 9, "z") for d, t in docs], "doc_id long, text string, n_chars long, shard string")
    got = {r.doc_id: (r.text, r.n_chars, r.shard) for r in remove_repeats(df, min_words=3, replace=True).collect()}
    assert got == {d: (k, len(k), "z") for d, _, _, _, k in brute(docs, 3)}


def test_repeated_rows_and_empty(spark):
    long = " ".join(f"w{i}" for i in range(50))
    docs = [(1, long), (1, long), (1, long[::-1]), (None, long[::-1] + " z"), (None, "u v")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, remove_repeats(df).collect()), key=str) == sorted((r[:4] for r in brute(docs)), key=str)
    assert remove_repeats(df.where("false")).collect() == []
