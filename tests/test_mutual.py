"""X5 by nearest neighbours against all pairs of rows."""

import math

import numpy as np
import pandas as pd
import pytest

from newsfeat.operators.mutual import UNIT, knn_mutual_information


def psi(n):
    return -0.57721566490153286 + math.fsum(1 / j for j in range(1, int(n)))


def whole(v):
    s = v.std()
    power = 10.0 ** (math.floor(math.log10(s)) - 5) if s else 1.0
    return np.floor((v - v.min()) / (round(s / power) * power if s else 1.0) * UNIT).astype(np.int64)


def brute(x, y, k):
    x, y = whole(np.asarray(x, float)), whole(np.asarray(y, float))
    total = 0.0
    for a, b in zip(x, y):
        dx, dy = abs(x - a), abs(y - b)
        d = np.maximum(dx, dy)
        r = np.sort(d)[k]
        nx, ny = (((v < r) | (v == 0)).sum() for v in (dx, dy))
        total += psi((d == 0).sum() if r == 0 else k) - psi(nx) - psi(ny)
    return max(0.0, psi(len(x)) + total / len(x))


def data(kind, n, rng):
    if kind == "smooth":
        x = rng.normal(size=n)
        return x, x + rng.normal(size=n)
    if kind == "tied":
        x = rng.integers(0, 12, n).astype(float)
        return x, np.where(rng.random(n) < 0.4, 0.0, x * 3 + rng.integers(0, 5, n))
    if kind == "heavy":  # a dense cluster, far outliers, a value that a third of the rows hold
        x = np.exp(rng.normal(size=n) * 4)
        x[: n // 3] = 1.0
        return x, np.exp(rng.normal(size=n) * 3) * np.sqrt(x)
    return np.full(n, 7.0), rng.normal(size=n)  # constant x


@pytest.mark.parametrize("kind", ["smooth", "tied", "heavy", "constant"])
def test_equals_all_pairs(spark, kind):
    n = 2000
    x, y = data(kind, n, np.random.default_rng(11))
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).repartition(5)
    got = knn_mutual_information(df, ["x"], "y").first()["x"]
    assert got == pytest.approx(brute(x, y, 3), abs=1e-9)


def test_known_value_of_a_normal_pair(spark):
    rng = np.random.default_rng(3)
    x, e = rng.normal(size=(2, 4000))
    rho = 0.9
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": rho * x + math.sqrt(1 - rho * rho) * e, "z": e}))
    row = knn_mutual_information(df, ["x", "z"], "y").first()
    assert row["x"] == pytest.approx(-0.5 * math.log(1 - rho * rho), abs=0.06)
    assert row["x"] > row["z"] > 0


def test_odd_rows(spark):
    rows = [(1.0, 2.0), (None, 1.0), (float("nan"), 3.0), (2.0, None), (float("inf"), 1.0), (3.0, 4.0), (5.0, 5.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    assert knn_mutual_information(df, ["x"], "y").first()["x"] is None  # three rows only
    got = knn_mutual_information(df, ["x"], "y", k=1).first()["x"]
    assert got == pytest.approx(brute([1.0, 3.0, 5.0], [2.0, 4.0, 5.0], 1), abs=1e-9)
    assert knn_mutual_information(df.limit(0), ["x"], "y").first()["x"] is None
    same = spark.createDataFrame([(1, 1)] * 20, "x int, y int")
    assert knn_mutual_information(same, ["x"], "y").first()["x"] == 0.0


def test_exploded_cells_are_not_broadcast(spark):
    """The cells stand once for every side of a box; by their file's size they looked small (F1)."""
    from newsfeat.operators import mutual as Mu
    df = spark.range(3000).selectExpr("cast(id * 7919 % 3001 as double) x", "cast(id * 104729 % 2999 as double) y")
    radii = Mu._radii(Mu.materialize(Mu._whole_cells(df, ["x"], "y")), 3)
    plan = radii._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan and radii.count() == 3000
