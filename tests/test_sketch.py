"""The quantile sketch and limits that follow the data."""

from __future__ import annotations

import math
import random

import pytest
from conftest import as_dict

from censusloom.functions.sketch import ACCURACY, merge, quantile_sketch, quantiles
from censusloom.operators.quality import relative_bounds

SCHEMA = "g string, population double"


@pytest.fixture(scope="module")
def values():
    rng = random.Random(2)
    return [("a", rng.lognormvariate(3, 2)) for _ in range(3000)] + [("b", float(k + 1)) for k in range(500)] + [("b", 0.0), ("b", None), ("b", -4.0)]


def test_quantiles_are_within_the_accuracy(make, values):
    got = quantiles(quantile_sketch(make.frame(values, SCHEMA), "population", ["g"]), (0.01, 0.5, 0.99, 1.0), ["g"]).collect()
    for row in got:
        own = sorted(v for g, v in values if g == row["g"] and v and v > 0)
        for k, q in enumerate((0.01, 0.5, 0.99, 1.0)):
            exact = own[math.ceil(len(own) * q) - 1]
            assert row[f"q{k}"] == pytest.approx(exact, rel=ACCURACY * 1.001), (row["g"], q)


def test_sketches_of_parts_add_up(make, values):
    whole = quantile_sketch(make.frame(values, SCHEMA), "population", ["g"])
    parts = [quantile_sketch(make.frame(values[k::3], SCHEMA), "population", ["g"]) for k in range(3)]
    keys = ["g", "bucket"]
    assert as_dict(merge(parts, ["g"]), keys, "n") == as_dict(whole, keys, "n")


def test_an_empty_table_has_no_quantiles(make):
    assert quantiles(quantile_sketch(make.frame([], SCHEMA), "population", ["g"]), (0.5,), ["g"]).collect() == []
    assert [r.q0 for r in quantiles(quantile_sketch(make.frame([], SCHEMA), "population"), (0.5,)).collect()] == [None]


@pytest.mark.parametrize("size", [1e-3, 1.0, 1e6])
def test_bounds_hold_at_every_size_and_find_an_outlier(make, size):
    cells = [("75", size * (1 + k % 40)) for k in range(400)] + [("13", size * 3.0)] * 50
    assert as_dict(relative_bounds(make.frame(cells, SCHEMA), "g"), "g", "ok") == {"75": True, "13": True}
    high = make.frame([*cells, ("75", size * 40 * 25)], SCHEMA)
    assert as_dict(relative_bounds(high, "g"), "g", "ok") == {"75": False, "13": True}
    for bad in (0.0, -1.0, None):
        assert as_dict(relative_bounds(make.frame([*cells, ("13", bad)], SCHEMA), "g"), "g", "ok") == {"75": True, "13": False}
