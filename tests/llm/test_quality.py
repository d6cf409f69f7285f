import random

import numpy as np
from pyspark.sql import functions as F

from censusloom.llm.quality import best_cut, nth_largest, resample


def make(seed=1, n=900):
    rng = random.Random(seed)
    common, rare = [f"w{i}" for i in range(60)], [f"r{i}" for i in range(4000)]
    docs, labels, bad = [], [], set()
    for d in range(n):
        ws = [rng.choice(common) if rng.random() < 0.8 else rng.choice(rare) for _ in range(rng.randrange(8, 120))]
        kind = rng.random()
        if kind < 0.15:
            for _ in range(3):
                ws.insert(rng.randrange(len(ws)), rng.choice(["vile", "nasty"]))
        elif kind < 0.3:
            ws = [w + "%%%" for w in ws]
        if kind < 0.3:
            bad.add(d)
        docs.append((d, " ".join(ws)))
        if rng.random() < 0.6:
            labels.append((d, int(not 0.15 <= kind < 0.3), int(kind < 0.15)))
    return docs, labels, bad


def test_bad_documents_go(spark):
    docs, labels, bad = make()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("weight", F.lit("x"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    fitted = resample(df, lab)
    rows = fitted.decisions().collect()
    kept = {r.doc_id for r in rows if r.keep}
    assert len(rows) == len(docs)
    assert len(kept & bad) < 0.05 * len(bad) and len(kept - bad) > 0.95 * (len(docs) - len(bad))
    got = fitted.keep(df)
    assert got.columns == df.columns and {r.doc_id for r in got.collect()} == kept


def test_null_repeated_and_empty(spark):
    docs, labels, _ = make(2, 300)
    docs += [(1000, None), (1001, ""), (None, "w1 w2"), (5, docs[5][1]), (1002, "w1 " * 30000)]
    labels += [(1000, 1, 0), (None, 1, 0), (7, None, 0), (8, 1, None), (5, 1, 1), (5, 1, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = resample(df, lab).decisions().collect()
    assert len(rows) == len(docs)
    assert {r.log_weight for r in rows if r.doc_id in (1000, 1001)} == {0.0}
    assert len({(r.log_weight, r.keep) for r in rows if r.doc_id == 5}) == 1
    assert all(r.keep for r in resample(df, lab.where("false")).decisions().collect())
    assert resample(df.where("false"), lab).decisions().collect() == []


def test_cut_and_selection(spark):
    assert best_cut(np.array([0.1, 0.2, 0.8, 0.9]), np.array([False, False, True, True])) == 0.5
    assert best_cut(np.array([1.0]), np.array([True])) == -np.inf
    values = np.random.default_rng(0).standard_normal(3000).round(2)
    rows = spark.createDataFrame([(float(v),) for v in values], "v double")
    for n in (1, 2, 77, 1500, 3000):
        assert nth_largest(rows, "v", n, bins=7, enough=3) == np.sort(values)[-n]
