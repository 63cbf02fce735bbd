"""Distributed ordered positions against pandas, including a hot group."""

import numpy as np
import pytest
import pandas as pd

from newsfeat.operators.ranking import (average_ranks, cumulative_within, exact_quantiles,
                                        row_number_within, value_cells)


def _frame(spark, n=4000, seed=3):
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 30, n))  # group 0 holds ~40 % of rows
    pdf = pd.DataFrame({"g": g, "k": rng.permutation(n).astype(float), "w": rng.integers(1, 5, n)})
    return pdf, spark.createDataFrame(pdf).repartition(6)


def test_row_number_within_matches_pandas(spark):
    pdf, df = _frame(spark)
    out = row_number_within(df, ["g"], ["k"], rn="rn", size="sz", num_partitions=7).toPandas()
    exp = pdf.sort_values(["g", "k"]).copy()
    exp["rn_e"] = exp.groupby("g").cumcount() + 1
    exp["sz_e"] = exp.groupby("g")["k"].transform("size")
    m = out.merge(exp, on=["g", "k"])
    assert len(m) == len(pdf)
    assert (m.rn == m.rn_e).all() and (m.sz == m.sz_e).all()


def test_cumulative_within_matches_pandas(spark):
    pdf, df = _frame(spark, seed=5)
    out = cumulative_within(df, ["g"], ["k"], "w", cum="c", total="t", num_partitions=5).toPandas()
    exp = pdf.sort_values(["g", "k"]).copy()
    exp["c_e"] = exp.groupby("g")["w"].cumsum()
    exp["t_e"] = exp.groupby("g")["w"].transform("sum")
    m = out.merge(exp, on=["g", "k"])
    assert len(m) == len(pdf) and (m.c == m.c_e).all() and (m.t == m.t_e).all()


def test_cumulative_within_hot_and_null_groups(spark):
    """A hot group over several partitions, a null group, double weights."""
    rng = np.random.default_rng(11)
    n = 600
    g = np.where(rng.random(n) < 0.5, "hot", rng.choice(["a", "b", "c", None], n))
    pdf = pd.DataFrame({"g": g, "k": rng.permutation(n).astype(float), "w": rng.random(n)})
    df = spark.createDataFrame(pdf, "g string, k double, w double")
    out = cumulative_within(df, ["g"], ["k"], "w", cum="c", total="t", num_partitions=3).toPandas()
    exp = pdf.assign(g=pdf.g.fillna("<null>")).sort_values(["g", "k"])
    exp["c_e"] = exp.groupby("g")["w"].cumsum()
    exp["t_e"] = exp.groupby("g")["w"].transform("sum")
    m = out.assign(g=out.g.fillna("<null>")).merge(exp, on=["g", "k"])
    assert len(m) == n
    assert np.allclose(m.c, m.c_e) and np.allclose(m.t, m.t_e)


def test_average_ranks_with_ties(spark):
    vals = [3.0, 1.0, 3.0, 2.0, 3.0, 5.0, 1.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = average_ranks(value_cells(df, "v"), (), "_v", "_w", "rank").toPandas().set_index("_v")["rank"]
    # scipy.stats.rankdata(vals): 1 -> 1.5, 2 -> 3, 3 -> 5, 5 -> 7
    assert r.to_dict() == {1.0: 1.5, 2.0: 3.0, 3.0: 5.0, 5.0: 7.0}


def test_exact_quantiles_linear(spark):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 50, 501).astype(float)
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(x)], "x double, g int")
    q = exact_quantiles(df, "x", [0.25, 0.5, 0.75], ["a", "b", "c"]).collect()[0]
    e = np.quantile(x, [0.25, 0.5, 0.75])
    assert np.allclose([q.a, q.b, q.c], e)
    qg = exact_quantiles(df, "x", [0.1], ["p"], group_cols=["g"]).toPandas().set_index("g")["p"]
    for g in range(3):
        assert np.isclose(qg[g], np.quantile(x[np.arange(501) % 3 == g], 0.1))


def test_exact_quantiles_per_group(spark):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=700), 3)
    df = spark.createDataFrame([(float(v), int(i % 4)) for i, v in enumerate(x)], "x double, g int")
    probs = [0.1, 0.25, 0.5, 0.9]
    q = exact_quantiles(df, "x", probs, ["a", "b", "c", "d"], group_cols=["g"]).toPandas()
    for g in range(4):
        e = np.quantile(x[np.arange(700) % 4 == g], probs)
        assert np.allclose(q.set_index("g").loc[g, list("abcd")].astype(float), e)


def _brute_kendall(x, y):
    n = len(x)
    s = sum(np.sign(y[j] - y[i]) for i in range(n) for j in range(n) if x[i] < x[j])
    _, tx = np.unique(x, return_counts=True)
    _, ty = np.unique(y, return_counts=True)
    n0 = n * (n - 1) / 2
    return s / np.sqrt((n0 - (tx * (tx - 1) / 2).sum()) * (n0 - (ty * (ty - 1) / 2).sum()))


def test_rank_correlations(spark):
    from newsfeat.operators import stats
    rng = np.random.default_rng(4)
    x = rng.integers(0, 300, 400).astype(float)
    y = rng.integers(0, 40, 400).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    tau = stats.kendall_tau_b(df, "x", "y").first()[0]
    rho = stats.spearman(df, "x", "y").first()[0]
    rx = pd.Series(x).rank().to_numpy()
    ry = pd.Series(y).rank().to_numpy()
    assert np.isclose(tau, _brute_kendall(x, y))
    assert np.isclose(rho, np.corrcoef(rx, ry)[0, 1])
