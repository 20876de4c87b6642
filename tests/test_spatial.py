"""Spatial joins against brute force, and on a page of a hundred thousand boxes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from figmine.operators.spatial import overlapping_pairs, without_nested

SCHEMA = "page long, x0 double, y0 double, x1 double, y1 double"


def brute_pairs(rows):
    rows = [r for r in rows if None not in r and np.isfinite(r[1:]).all() and r[1] <= r[3] and r[2] <= r[4]]
    return sorted((a[0], a[1:], b[1:]) for a in rows for b in rows if a[0] == b[0] and a[1:] < b[1:] and min(a[3], b[3]) > max(a[1], b[1]) and min(a[4], b[4]) > max(a[2], b[2]))


def brute_nested(rows):
    sound = [r for r in rows if None not in r and np.isfinite(r[1:]).all() and r[1] <= r[3] and r[2] <= r[4]]
    inside = lambda a, b: a[0] == b[0] and b[1] < a[1] and b[2] < a[2] and b[3] > a[3] and b[4] > a[4]
    return sorted((repr(a) for a in rows if a not in sound or not any(inside(a, b) for b in sound)))


def random_rows(seed, n):
    r = np.random.default_rng(seed)
    side = 2.0 ** r.integers(-3, 9, (n, 2)) * r.choice([1.0, 0.7, 0.0], (n, 2), p=[0.5, 0.4, 0.1])
    low = np.round(r.uniform(-300, 300, (n, 2)) * 4) / 4
    rows = [(int(p), *map(float, a), *map(float, a + s)) for p, a, s in zip(r.integers(0, 3, n), low, side, strict=True)]
    return rows + rows[:5]


@pytest.mark.parametrize("few", [0, 10**9])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_like_brute_force(spark, seed, few):
    rows = random_rows(seed, 250)
    df = spark.createDataFrame(rows, SCHEMA)
    got = overlapping_pairs(df, ["page"], few=few).collect()
    assert sorted((r["page"], tuple(r["a"]), tuple(r["b"])) for r in got) == brute_pairs(rows)
    assert sorted(repr(tuple(r)) for r in without_nested(df, ["page"], few=few).collect()) == brute_nested(rows)


@pytest.mark.parametrize("few", [0, 256])
def test_odd_boxes(spark, few):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 0.0, 0.0, 10.0, 10.0), (1, 2.0, 2.0, 3.0, 3.0), (1, 10.0, 0.0, 20.0, 10.0), (1, 5.0, 5.0, 5.0, 5.0), (1, 4.0, 4.0, 3.0, 3.0),
        (1, None, 0.0, 1.0, 1.0), (1, nan, 0.0, 1.0, 1.0), (1, -inf, 0.0, 1.0, inf), (None, 0.0, 0.0, 10.0, 10.0), (None, 1.0, 1.0, 2.0, 2.0),
        (2, -1e300, -1e300, 1e300, 1e300), (2, 1e-300, 0.0, 1.0, 1.0), (2, -1.7e308, 0.0, 1.7e308, 1.0), (1, 0.0, 0.0, 10.0, 10.0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = overlapping_pairs(df, ["page"], few=few).collect()
    assert sorted((r["page"], tuple(r["a"]), tuple(r["b"])) for r in got) == brute_pairs(rows)
    assert sorted(repr(tuple(r)) for r in without_nested(df, ["page"], few=few).collect()) == brute_nested(rows)
    assert overlapping_pairs(df.limit(0), ["page"]).count() == without_nested(df.limit(0), ["page"]).count() == 0


def test_other_columns_stay(spark):
    df = spark.createDataFrame([("a", 1, 0, 0, 9, 9, "out"), ("a", 1, 1, 1, 2, 2, "in"), ("b", 1, 1, 1, 2, 2, "alone")], "doc string, page int, l int, t int, r int, b int, grid string")
    kept = without_nested(df, ["doc", "page"], ("l", "t", "r", "b"), few=0)
    assert kept.columns == df.columns
    assert sorted(r["grid"] for r in kept.collect()) == ["alone", "out"]


def test_a_hot_page(spark):
    """100,000 boxes of one page: a lattice of small ones in which each meets its eight neighbours, below one that holds all."""
    n = 316
    i, j = F.col("id") % n, F.floor(F.col("id") / n)
    small = spark.range(n * n).select(F.lit(7).cast("long").alias("page"), (i * 2.0).alias("x0"), (j * 2.0).alias("y0"), (i * 2.0 + 3).alias("x1"), (j * 2.0 + 3).alias("y1"))
    page = small.unionByName(spark.createDataFrame([(7, -1.0, -1.0, 2.0 * n + 9, 2.0 * n + 9), (8, 0.0, 0.0, 3.0, 3.0)], SCHEMA))
    neighbours = n * (n - 1) * 2 + (n - 1) ** 2 * 2
    assert overlapping_pairs(page, ["page"]).count() == neighbours + n * n
    assert sorted(r["x0"] for r in without_nested(page, ["page"]).collect()) == [-1.0, 0.0]
