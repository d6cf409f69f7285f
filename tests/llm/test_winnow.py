import random
import re

from pyspark.sql import functions as F

from censusloom.llm.queries import queries
from censusloom.llm.winnow import overlaps


def brute(docs, items, window=13):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    owners = {}
    for item, text in items:
        ws = split(text)
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            owners.setdefault(tuple(ws[i : i + n]), set()).add(str(item))
    sizes = {len(w) for w in owners}
    out = set()
    for doc, text in docs:
        ws, hit, found = split(text), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                if own := owners.get(tuple(ws[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= own
        out.add((doc, len(ws), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(ws)))
    return out


def got(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("size", F.lit("clash")).withColumn("at", F.lit(1))
    i = spark.createDataFrame(items, "item_id long, text string")
    return [(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in overlaps(d, i).collect()]


def test_matches_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["a", "b", "Ça", "d9", "e"]
    text = lambda n: rng.choice([" ", "-"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([4, 12, 13, 14, 30, 40]))) for k in range(12)] + [(12, None), (13, ""), (14, "A b"), (15, "?!")]
    docs = [(k, text(rng.choice([0, 1, 12, 13, 60, 200]))) for k in range(40)]
    for k in range(40, 80):
        item = items[rng.randrange(12)][1].split("-" if "-" in items[0][1] else " ")
        docs.append((k, " ".join(["zz"] * rng.randrange(30) + item[rng.randrange(3) :] + ["yy"] * rng.randrange(200))))
    docs += [(80, None), (81, "zz " * 3000 + items[3][1] + " yy" * 10), (82, items[5][1].upper()), (83, items[5][1].upper())]
    for chosen in (items, [i for i in items if len((i[1] or "").split()) != 2]):
        result = got(spark, docs, chosen)
        assert len(result) == len(docs)
        assert set(result) == brute(docs, chosen)


def test_empty_and_repeated(spark):
    docs = [(1, "one two three"), (1, "one two three"), (1, "other words"), (None, "one two three")]
    items = [(7, "two three"), (7, "two three"), (8, "two three")]
    assert sorted(got(spark, docs, items), key=str) == sorted(brute(docs, items), key=str)
    assert {r[2] for r in got(spark, docs, [])} == {0}
    assert got(spark, [], items) == []


def test_hits_stay_with_their_own_text(spark):
    item = " ".join(f"i{k}" for k in range(13))
    far = " ".join(["zz"] * 500) + " " + item
    for key in (None, 1):
        docs = [(key, far), (key, ""), (key, None), (key, "short"), (key, item + " short"), (2, "other")]
        assert set(got(spark, docs, [(7, item), (8, "yy")])) == brute(docs, [(7, item), (8, "yy")])


def test_every_row_has_its_answer(spark, tmp_path):
    docs = [(1, "one two three"), (1, "one two three"), (1, "other"), (None, "one two three"), (None, "one two three"), (2, None), (2, None), (2, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, "two three")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in queries()["op4_decontamination"](spark, str(tmp_path)).collect()]
    assert sorted(rows, key=str) == sorted([(1, 3, 2, True)] * 2 + [(1, 1, 0, False)] + [(None, 3, 2, True)] * 2 + [(2, 0, 0, False)] * 3, key=str)


def test_every_long_shared_span_shares_a_fingerprint():
    import numpy as np

    from censusloom.llm.winnow import winnow

    rng = np.random.default_rng(4)
    span = rng.integers(1, 1 << 60, 13).astype(np.uint64)
    for _ in range(200):
        sides = []
        for _ in range(2):
            before, after = (rng.integers(1, 1 << 60, rng.integers(0, 30)).astype(np.uint64) for _ in range(2))
            ws = np.concatenate((before, span, after))
            sides.append(set(winnow(ws, np.array([0, len(ws)]), 13, 7)[1].tolist()))
        assert sides[0] & sides[1]
    flat = np.full(40, 7, np.uint64)  # ties: all of them are kept
    assert len(winnow(flat, np.array([0, 40]), 13, 7)[0]) == 34
