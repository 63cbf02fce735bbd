"""Samples by a hash cut and quantiles inside sketch brackets."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsfeat.operators import ranking, sampling
from newsfeat.sources.tables import read_table

SF = "/root/testdata/sf0.01"


def by_hash(rows, n, seed):
    return sorted(rows, key=lambda r: (r is not None, hashlib.md5(f"{r}{seed}".encode()).hexdigest(), r or ""))[:n]


@pytest.mark.parametrize("n", [0, 1, 40, 399, 400, 1000])
def test_seeded_sample_equals_a_sort(spark, n):
    keys = [f"k{i}" for i in range(300)] + ["hot"] * 98 + [None] * 2
    df = spark.createDataFrame([(k, i, {"a": i}) for i, k in enumerate(keys)], "uri string, v int, m map<string,int>").repartition(5)
    out = sampling.seeded_sample(df, n, seed=3)
    assert out.columns == df.columns
    got = [r["uri"] for r in out.select("uri").collect()]
    assert sorted(map(str, got)) == sorted(map(str, by_hash(keys, n, 3)))


@pytest.mark.parametrize("n", [0, 1, 5, 150, 299, 5000])
def test_first_rows_equal_a_sort(spark, n):
    values = [None] * 3 + [7] * 200 + list(range(100))
    df = spark.createDataFrame([(v, str(i)) for i, v in enumerate(values)], "v int, t string").repartition(6)
    got = [r["v"] for r in sampling.first_rows(df, n, "v").collect()]
    want = sorted(values, key=lambda v: (v is not None, v))[:n]
    assert sorted(map(str, got)) == sorted(map(str, want))
    again = sampling.first_rows(df, n, "v").select("t").collect()
    assert sorted(again) == sorted(sampling.first_rows(df.repartition(2), n, "v").select("t").collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_samples_gather_nothing(spark):
    o = read_table(spark, SF, "orders")
    for df in (sampling.seeded_sample(o, 5000, key="o_orderkey"), sampling.first_rows(o, 5000, "o_orderkey")):
        text = plan(df)
        assert not any(x in text for x in ("TakeOrderedAndProject", "GlobalLimit", "CollectLimit"))
        assert df.count() == 5000


def frames(rng):
    yield "ties", np.repeat(rng.integers(0, 9, 400), 100).astype(float)
    yield "spread", rng.normal(size=40_000)
    yield "skew", np.concatenate([np.zeros(30_000), rng.exponential(size=10_000)])
    yield "small", rng.normal(size=7)
    yield "one", np.array([3.5])


def test_bracketed_quantiles_are_exact(spark, monkeypatch):
    rng = np.random.default_rng(4)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    rows = [(g, float(v)) for g, x in frames(rng) for v in x] + [("none", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6).cache()
    for accuracy in (5000, 50):
        monkeypatch.setattr(ranking, "SKETCH_ACCURACY", accuracy)
        out = {r["g"]: r for r in ranking.exact_quantiles(df, "v", probs, names, ["g"], "n").collect()}
        assert set(out) == {"ties", "spread", "skew", "small", "one", None}
        for g in out:
            x = np.array([v for k, v in rows if k == g and v is not None])
            assert out[g]["n"] == len(x) and np.allclose([out[g][c] for c in names], np.quantile(x, probs), rtol=1e-12)
        x = np.array([v for _, v in rows if v is not None])
        whole = ranking.exact_quantiles(df, "v", probs, names).first()
        assert np.allclose([whole[c] for c in names], np.quantile(x, probs), rtol=1e-12)
    df.unpersist()


def test_brackets_keep_few_cells(spark):
    df = spark.range(200_000).select(F.xxhash64("id").alias("v"))
    cells = ranking.bracketed_cells(df, "v", [0.25, 0.5, 0.75])
    assert cells.agg(F.sum("_w")).first()[0] == 200_000
    assert cells.count() < 3 * 8 * 200_000 / ranking.SKETCH_ACCURACY


def test_quantiles_that_a_sketch_misses_are_counted(spark, monkeypatch):
    """NaN has no place in the sketch's order; the counts show it."""
    rows = [(float("nan") if i % 3 == 0 else float(i),) for i in range(9000)]
    df = spark.createDataFrame(rows, "v double").repartition(4)
    got = ranking.exact_quantiles(df, "v", [0.25, 0.5]).first()
    x = sorted(i for i in range(9000) if i % 3)
    at = lambda p: x[int(np.floor(p * 8999))] + (p * 8999 % 1) * (x[int(np.ceil(p * 8999))] - x[int(np.floor(p * 8999))])
    assert np.allclose([got["q25"], got["q50"]], [at(0.25), at(0.5)])
    true = ranking.bracketed_cells
    wrong = lambda d, v, p, g=(): true(d.where(F.col("v") > 100), v, [0.99], g).unionByName(  # noqa: E731  brackets elsewhere
        d.where("v <= 100").select(F.lit(None).cast("double").alias("_v"), F.lit(1).alias("_beside"), F.lit(1).cast("long").alias("_w")))
    monkeypatch.setattr(ranking, "bracketed_cells", wrong)
    df = spark.range(9000).select(F.col("id").cast("double").alias("v"))
    assert ranking.exact_quantiles(df, "v", [0.5]).first()["q50"] == 4499.5


def test_feature_chain_tokenises_once(spark):
    from newsfeat.plans import featurize as Fz
    from newsfeat.sources.tables import articles

    df = Fz.feature_table(articles(spark, SF).withColumn("topic", F.col("categoryLabels")))
    shown = df._jdf.queryExecution().optimizedPlan().toString()
    assert shown.count("regexp_extract_all(text") + shown.count("regexp_extract_all(body") <= 1
