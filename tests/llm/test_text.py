"""Word digests: crafted words that a polynomial modulo 2**64 confuses, and long texts."""

import resource

import numpy as np
import pytest

from censusloom.llm import text as module
from censusloom.llm.text import SPACED, utf8, window_hashes, window_starts, word_hashes, words

BOTH = "abba"
while len(BOTH) < 2048:
    BOTH += BOTH.translate(str.maketrans("ab", "ba"))
OTHER = BOTH.translate(str.maketrans("ab", "ba"))


def hashes(texts, seed=1):
    import pyarrow as pa

    buf, offs = utf8(pa.array(texts))
    starts, ends, bounds = words(buf, offs, SPACED)
    return word_hashes(buf, starts, ends, seed), bounds


@pytest.mark.parametrize("seed", [1, 2, 3, 5, 9])
def test_crafted_words_are_told_apart(seed):
    found, _ = hashes([BOTH, OTHER, BOTH[:1024], OTHER[:1024], BOTH], seed)
    assert len(set(found.tolist())) == 4 and found[0] == found[4]


def test_digests_do_not_depend_on_the_neighbours(monkeypatch):
    rng = np.random.default_rng(1)
    listed = ["x" * int(n) for n in rng.integers(1, 300, 400)] + [f"w{k}" for k in range(3000)]
    text = " ".join(listed)
    whole, bounds = hashes([text])
    single = np.concatenate([hashes([w])[0] for w in listed])
    assert (whole == single).all()
    at = window_starts(bounds, 5)
    want = window_hashes(whole, at, 5)
    monkeypatch.setattr(module, "SUMMED", 256)
    assert (hashes([text])[0] == whole).all() and (window_hashes(whole, at, 5) == want).all()
    back = at[::-1].copy()
    assert (window_hashes(whole, back, 5) == want[::-1]).all()


def test_op2_op4_op10_tell_crafted_words_apart(spark):
    from censusloom.llm.partenum import jaccard_components
    from censusloom.llm.substring import remove_repeats
    from censusloom.llm.winnow import overlaps

    tail = lambda k: [f"{k}t{j}" for j in range(4)]
    windows = [" ".join([w] * 35) for w in (BOTH[:1024], OTHER[:1024])]
    docs = spark.createDataFrame([(k, w) for k, w in enumerate(windows)], "doc_id long, text string")
    assert [r["n_removed"] for r in remove_repeats(docs).collect()] == [0, 0]
    assert {r["component_id"] for r in jaccard_components(docs).collect()} == {0, 1}
    items = spark.createDataFrame([(7, " ".join([BOTH[:1024], *tail("i")]))], "item_id long, text string")
    docs = spark.createDataFrame([(k, " ".join([w, *tail("i")])) for k, w in enumerate((BOTH[:1024], OTHER[:1024]))], "doc_id long, text string")
    assert {r["doc_id"]: r["n_hit"] for r in overlaps(docs, items).collect()} == {0: 5, 1: 0}


def test_a_long_text_needs_no_tables_of_its_length():
    """32 MB of words: the peak grows by the arrays of words, not by tables for every byte."""
    import pyarrow as pa

    text = pa.array(["word0123 " * (32 << 17)])
    buf, offs = utf8(text)
    starts, ends, _ = words(buf, offs, SPACED)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    word_hashes(buf, starts, ends)
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 250
