import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from censusloom.llm import simhash
from censusloom.llm.simhash import edited_likeness, fingerprints, near_counts, near_pairs
from censusloom.llm.text import SPACED, mix, word_hashes


def rows(seed=1, n=120):
    rng = random.Random(seed)
    text = lambda: " ".join(rng.choice(["añ", "b", "世界", "dd", "e😀"]) for _ in range(rng.randrange(40)))
    docs = [(3 * d, text()) for d in range(n)]
    docs[5], docs[9], docs[11] = (15, None), (27, ""), (33, docs[4][1])
    return docs


def expected(docs):
    docs = sorted(((d, t or "") for d, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (d, t) in enumerate(docs):
        q = len(t) // 4
        out.append((d, len(t), t, t[: len(t) - q] + docs[(k + 1) % len(docs)][1][:q], docs[(k + 1) % len(docs)][1]))
    return out


def test_edited_and_next(spark):
    for docs in (rows(), [(1, "a b c d")], [*rows(2, 12), (None, "x y z"), (None, "q" * 9), (0, "again 0")]):
        df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("bin", F.lit("clash"))
        got = sorted(edited_likeness(df).collect(), key=str)
        want = expected(docs)
        prints = lambda texts: fingerprints(pa.array(texts))
        own, changed, following = (prints([w[k] for w in want]) for k in (2, 3, 4))
        near = lambda a, b: 1 - bin((int(a) ^ int(b)) & (2**64 - 1)).count("1") / 64
        hexed = lambda v: f"{int(v) & (2**64 - 1):016x}"
        rest = [
            (w[0], w[1], sha256(w[3].encode()).hexdigest(), hexed(a), hexed(b), near(a, b), near(a, c))
            for w, a, b, c in zip(want, own, changed, following, strict=True)
        ]
        assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(rest, key=str)
    assert edited_likeness(df.where("false")).collect() == []


def test_fingerprint_is_the_signed_vote():
    texts = ["a b a b c", "x", "", None, "long " * 50000]
    got = fingerprints(pa.array(texts))
    assert got[2] == got[3] == 0 and len(set(got.tolist())) == 4
    assert fingerprints(pa.array(["a  B a\\tb C".replace("\\t", "\t")]))[0] == got[0]


def vote(text):
    """The signed vote in plain Python: each pair of words, or a lone word, votes for its set bits and against the others."""
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split(b" ") if w]
    digest = [int(word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]), 9)[0]) for w in words]
    terms = digest if len(words) == 1 else [int(mix(np.array([(3 * a + b) % 2**64], np.uint64))[0]) for a, b in zip(digest, digest[1:], strict=False)]
    sums = [0] * 64
    for term in terms:
        for bit in range(64):
            sums[bit] += 1 if term >> bit & 1 else -1
    value = sum(1 << bit for bit in range(64) if sums[bit] > 0)
    return value - 2**64 if value >> 63 else value


def test_fingerprint_equals_a_vote_in_plain_python(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["Ab", "b", "世界", "dd", "e", "x" * 200]) for _ in range(rng.randrange(60))) for _ in range(80)]
    texts += ["", None, "one", "  two  ", "a a", "a a a a b"]
    want = [vote(t) for t in texts]
    assert fingerprints(pa.array(texts)).tolist() == want
    monkeypatch.setattr(simhash, "AT_ONCE", 300)
    assert fingerprints(pa.array(texts)).tolist() == want
    assert SPACED[ord("A")] and not SPACED[ord(" ")]


def test_a_hot_block_is_counted_in_units(spark, monkeypatch):
    """Hundreds of different fingerprints agree in most blocks: counts as by all pairs, and no row for a pair."""
    rng = np.random.default_rng(4)
    base = int(rng.integers(-(2**62), 2**62))
    values = sorted({base ^ int(rng.integers(0, 1 << 9)) for _ in range(400)} | {int(v) for v in rng.integers(-(2**63), 2**63 - 1, 100)})
    df = spark.createDataFrame([(v,) for v in [*values, *values[:50], None]], "print long")
    want = {v: n for v in values if (n := sum(bin((v ^ w) & (2**64 - 1)).count("1") <= 3 for w in values) - 1)}
    for block in (simhash.BLOCK, 32):
        monkeypatch.setattr(simhash, "BLOCK", block)
        got = near_counts(df)
        assert {r["print"]: r["n_near"] for r in got.collect()} == want
        assert {r["print"] for r in got.collect()} <= set(values) and max(want.values()) > 30


def test_all_near_fingerprints(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**63), 2**63 - 1, 40)
    values = list(base)
    for v in base:
        for k in range(6):
            flips = rng.choice(64, k, replace=False)
            values.append(int(np.int64(v) ^ np.bitwise_or.reduce([np.int64(0)] + [np.uint64(1 << int(f)).astype(np.int64) for f in flips])))
    values = sorted({int(v) for v in values})
    df = spark.createDataFrame([(v,) for v in [*values, values[0], None]], "print long")
    for radius in (1, 3):
        want = {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if bin((a ^ b) & (2**64 - 1)).count("1") <= radius}
        assert {tuple(r) for r in near_pairs(df, radius).collect()} == want and want
