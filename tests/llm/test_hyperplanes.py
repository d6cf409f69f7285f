"""Links and components against all pairs, by brute force."""

import math

import numpy as np
import pytest

from censusloom.llm import hyperplanes
from censusloom.llm.hyperplanes import Scheme, near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, class string, unit int"


def usable(v, label):
    return label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, threshold=0.93):
    n = len(rows)
    links = [set() for _ in range(n)]
    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i][:3], rows[j][:3]
            if usable(a, la) and usable(b, lb) and la == lb and len(a) == len(b):
                a, b = (np.array(x, np.float32).astype(np.float64) for x in (a, b))
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(keys) if keys else None
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return sorted(out, key=str)


def result(spark, rows):
    df = spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v], lab, "x", 1) for k, v, lab in rows], SCHEMA)
    return sorted((tuple(r) for r in near_duplicates(df).collect()), key=str)


def clouds(rng, groups, size, spread, dims=16):
    for _ in range(groups):
        centre = rng.standard_normal(dims)
        for _ in range(size):
            yield centre + spread * rng.standard_normal(dims)


def test_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    vectors = [*clouds(rng, 30, 6, 0.15), *clouds(rng, 8, 10, 0.05), *rng.standard_normal((60, 16))]
    vectors += [vectors[0]] * 5 + [vectors[1] * 4.0]
    rows = [(1000 - k, v, k % 2) for k, v in enumerate(vectors)]
    want, got = brute(rows), result(spark, rows)
    pairs, found = sum(r[1] for r in want), sum(r[1] for r in got)
    assert found >= 0.99 * pairs and [r[0] for r in want] == [r[0] for r in got]
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert got == want  # no pair of these rows is missed


def test_unusable_vectors_link_with_nothing(spark):
    v, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(1, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, v, None), (6, None, 1), (7, None, 1), (8, [], 1), (9, [], 1), (10, [0.0, -0.0, 0.0], 1)]
    rows += [(11, [0.0, 0.0, 0.0], 1), (12, [1.0, nan, 3.0], 1), (13, [inf, 2.0, 3.0], 1), (14, [1.0, None, 3.0], 1), (15, [1.0, 2.0, 3.0, 0.0], 1), (16, [-1.0, -2.0, -3.0], 1)]
    got = {r[0]: r[1:] for r in result(spark, rows)}
    assert got[1] == (1, 1, True) and got[2] == (1, 1, False) and all(got[k] == (0, k, True) for k in range(3, 17))
    assert result(spark, rows) == brute(rows)


def test_repeated_and_null_keys(spark):
    v, w = [1.0, 0.0], [0.0, 1.0]
    rows = [(7, v, 1), (7, v, 1), (7, w, 1), (None, v, 1), (None, w, 1), (None, [1.0, 1.0], 1), (9, [1e-30, 0.0], 1), (8, [0.0, -0.0], 1), (3, [0.0, 5.0], 1)]
    got = result(spark, rows)
    assert (None, 0, None, True) in got
    assert sorted(r for r in got if r[0] == 7) == [(7, 2, 3, False), (7, 3, 7, True), (7, 3, 7, True)]
    assert sorted((r[1:] for r in got if r[0] is None), key=str) == [(0, None, True), (2, 3, False), (3, 7, False)]


def test_empty_table(spark):
    assert result(spark, []) == []


def test_hot_bucket_in_blocks_and_a_hot_copy(spark, monkeypatch):
    """Many different near copies fall into one bucket: blocks of it give the same as all pairs."""
    monkeypatch.setattr(hyperplanes, "BLOCK", 16)
    monkeypatch.setattr(hyperplanes, "ENTRIES", 256)
    rng = np.random.default_rng(5)
    vectors = [*clouds(rng, 1, 90, 0.06), *rng.standard_normal((50, 16))]
    rows = [(k, v, 1) for k, v in enumerate(vectors)] + [(500 + k, vectors[100], 1) for k in range(70)]
    assert result(spark, rows) == brute(rows)


def test_chance_of_a_miss_follows_the_scheme():
    rng = np.random.default_rng(8)
    for rows in (100, 1_000_000):
        scheme = Scheme(rows, 0.93)
        a = rng.standard_normal((4000, 32))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = rng.standard_normal((4000, 32))
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b = 0.93 * a + math.sqrt(1 - 0.93**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
        x, y = scheme.signatures(a), scheme.signatures(b)
        apart = np.bitwise_count(x ^ y).astype(int).sum(axis=1)
        met = (x == y).any(axis=1) & (apart <= scheme.most)
        assert met.mean() > 0.995
        assert (np.bitwise_count(x ^ np.roll(x, 1, axis=0)).astype(int).sum(axis=1) <= scheme.most).mean() < 0.001


@pytest.mark.parametrize("rows,signs", [(0, 8), (128 << 8, 8), (1 << 30, 23)])
def test_keys_grow_with_the_rows(rows, signs):
    assert Scheme(rows, 0.93).signs == signs
