import zlib

import numpy as np

from censusloom.llm.langid import Network, fit, predict_language


def test_gradients_match_differences():
    network = Network(3, hidden=3, seed=1)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    rng = np.random.default_rng(0)
    batch, label = rng.integers(97, 101, (4, 6)).astype(np.uint8), rng.integers(0, 3, 4)

    def loss():
        states = {}
        for way, times in (("f", range(6)), ("b", range(5, -1, -1))):
            state = np.zeros((4, 3))
            for t in times:
                state = network._cell(way, batch[:, t], state)[0]
                states[way, t] = state
        return -np.mean([np.log(network._softmax(states["f", t], states["b", t])[np.arange(4), label]) for t in range(6)])

    grads = network._gradients(batch, label)
    for name, weights in network.weights.items():
        for _ in range(12):
            at = tuple(rng.integers(0, s) for s in weights.shape)
            if name.startswith("in_"):
                at = (int(batch.ravel()[rng.integers(24)]), at[1])
            before = weights[at]
            weights[at] = before + 1e-5
            up = loss()
            weights[at] = before - 1e-5
            down = loss()
            weights[at] = before
            assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-4


def test_segments_are_read_one_by_one():
    network = Network(2, hidden=4, seed=2)
    texts = [b"hello world, this is a text", b"", b"x", bytes(range(256)) * 3]
    buf, offs = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = network.totals(buf, offs, segment=10)
    for k, text in enumerate(texts):
        want = np.zeros(2)
        for a in range(0, len(text), 10):
            piece = np.frombuffer(text[a : a + 10], np.uint8)
            f, b, fs, bs = np.zeros((1, 4), np.float32), np.zeros((1, 4), np.float32), [], []
            for t in range(len(piece)):
                f = network._cell("f", piece[t : t + 1], f)[0]
                fs.append(f)
            for t in reversed(range(len(piece))):
                b = network._cell("b", piece[t : t + 1], b)[0]
                bs.append(b)
            for x, y in zip(fs, reversed(bs), strict=True):
                want += network._softmax(x, y)[0]
        assert np.allclose(got[k], want, atol=1e-3)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r for r in predict_language(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert set(rows) == set(truth)
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [d for d, r in rows.items() if r.held_out]
    assert np.mean([rows[d].lang_pred == truth[d] for d in held]) > 0.95


def test_unreadable_repeated_and_empty(spark):
    docs = [(k, t * 20, lang, "x") for k, (t, lang) in enumerate([("the cat and the dog ", "en"), ("der hund und die katze ", "de")] * 20)]
    docs += [(90, None, "en", "x"), (91, "123 !? ", "en", "x"), (92, "", None, "x"), (93, "the dog", None, "x"), (93, "the dog", None, "x"), (None, "die katze", "de", "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, score string")
    rows = predict_language(df).collect()
    assert len(rows) == len(docs)
    by = {r.doc_id: r for r in rows}
    assert {by[k].lang_pred for k in (90, 91, 92)} == {"und"} and by[90].score == 0
    assert by[93].lang_pred == "en" and by[None].held_out
    assert {r.lang_pred for r in predict_language(df.withColumn("lang", df.lang.substr(0, 0)).where("lang is null")).collect()} == {"und"}
    assert predict_language(df.where("false")).collect() == []
    assert fit([]) == ([], None)


def test_sample_is_the_least_hashes_of_each_label(spark, monkeypatch):
    from pyspark.sql import functions as F

    from censusloom.llm import langid

    monkeypatch.setattr(langid, "PASSAGES", 5)
    rows = [(k, f"text {k} of words", "en" if k % 3 else "de") for k in range(600)] + [(7, "same", "fr")] * 300 + [(k, "123", "it") for k in range(900, 990)]
    rows += [(k, "solo parole" if k in (995, 996) else "1", "it") for k in range(990, 1100)] + [(None, "x", "en"), (1, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.sample(df, "text", "lang", "doc_id")
    hashes = {r[0]: r[1] for r in df.where("doc_id is not null").select("doc_id", F.xxhash64("doc_id")).distinct().collect()}
    want = []
    for label in ("de", "en", "fr", "it"):
        own = {(hashes[k], t) for k, t, lab in rows if lab == label and k is not None and t and zlib.crc32(str(k).encode()) % 5 and any(c.isalpha() for c in t)}
        want += [(label, t.encode()) for _, t in sorted(own)[:5]]
    assert got == sorted(want)
