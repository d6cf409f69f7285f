import random
import re

import numpy as np
from pyspark.sql import functions as F

from censusloom.llm.components import components
from censusloom.llm.partenum import jaccard_components, linked_texts


def sets_of(docs):
    out = []
    for _, t in docs:
        ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} or ({tuple(ws)} if ws else set()))
    return out


def brute(docs):
    sets, up = sets_of(docs), list(range(len(docs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * union:
                a, b = sorted((top(i), top(j)), key=lambda k: docs[k][0])
                up[b] = a
    return {(d, len(s), docs[top(i)][0]) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))}


def make(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    passage, line = text(60), text(9)
    docs = []
    for n in (2, 4, 5, 6, 7, 8, 9, 12, 30, 60, 63, 64, 100, 130, 300, 700):
        base = text(n)
        docs.append(list(base))
        for _ in range(rng.randrange(2, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, n // 25))):
                k = rng.randrange(len(copy))
                copy[k : k + rng.randrange(2)] = text(rng.randrange(1, 3))
            docs.append(copy)
            docs.append(copy[: max(1, int(len(copy) * rng.choice([0.7, 0.75, 0.76, 0.8, 0.9])))])
    for _ in range(60):
        docs.append(text(rng.randrange(10, 40)) + passage + text(rng.randrange(40)))
        docs.append(line + text(rng.randrange(5, 80)))
    base = text(110)
    for _ in range(80):  # a cloud of edits of one text
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        docs.append(copy)
    docs += [["Same", "Words"], ["same", "words"], [], ["q"] * 50, ["q"] * 70]
    rng.shuffle(docs)
    return [(3 * i + 1, " ".join(d)) for i, d in enumerate(docs)] + [(10_000, None), (10_001, docs[0] and " ".join(docs[0]))]


def test_matches_brute_force(spark):
    for seed in range(3):
        docs = make(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6).withColumn("rep", F.lit(1)).withColumn("n", F.lit("x"))
        assert {tuple(r) for r in jaccard_components(df).collect()} == brute(docs)


def test_empty_null_and_repeated(spark):
    docs = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "x y"), (3, None), (None, "a b c d e f"), (4, "x y"), (2, "A B c d e f")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(map(tuple, jaccard_components(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 1, 1), (3, 0, 3), (None, 2, None), (4, 1, 1), (2, 2, 1)], key=str)
    assert jaccard_components(df.where("false")).collect() == []


def test_links_of_a_text_whose_key_has_another(spark):
    rng = random.Random(8)
    text = lambda: [f"w{rng.randrange(3000)}" for _ in range(60)]
    a, b, c = text(), text(), text()
    near = lambda t: " ".join([*t[:-1], "new"])
    a, b, c = sorted((a, b, c))  # the least text of the key is not the one that the others are near to
    docs = [(1, " ".join(a)), (1, " ".join(b)), (4, " ".join(c)), (9, near(c))] + [(k, " ".join(b)) for k in (5, 6, 7)] + [(8, near(b)), (10, near(a))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {(r.doc_id, r.component_id) for r in jaccard_components(df).collect()} == {(k, 1) for k in (1, 5, 6, 7, 8, 10)} | {(4, 4), (9, 4)}
    groups = {}
    for r in linked_texts(df).collect():
        groups.setdefault(r.group, []).append(r.doc)
    assert sorted(map(sorted, groups.values())) == [[1, 5, 6, 7, 8], [1, 10], [4, 9]]


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    up = {}
    for a, b in pairs:
        up.setdefault(a, a), up.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(up[a], up[b])
            changed |= up[a] != low or up[b] != low
            up[a] = up[b] = low
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert {k: v for k, v in got.items()} == {k: v for k, v in up.items() if k in got}
    assert all(k in got for a, b in pairs if a != b for k in (a, b))
