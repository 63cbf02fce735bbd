"""Shapley walks against closed forms and all subsets."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsfeat.operators import attribution as At
from newsfeat.operators import model as Mdl

COLS = ["a", "b", "c", "d"]


def table(n, seed):
    rng = np.random.default_rng(seed)
    return pd.DataFrame(rng.normal(size=(n, 4)), columns=COLS).assign(key=np.arange(n) % 50)


def make_crooked():
    def outputs(rows):
        r = rows[COLS].to_numpy()
        return np.column_stack([r[:, 0] * r[:, 1] + np.maximum(r[:, 2], r[:, 3]), np.sin(r).sum(axis=1)])
    return outputs  # local, so that it travels to the tasks by value


crooked = make_crooked()


def by_subsets(x, ground, k):
    """The definition: every subset of the other columns, every background row."""
    def f(own):
        mixed = ground.copy()
        mixed[:, list(own)] = x[list(own)]
        return crooked(pd.DataFrame(mixed, columns=COLS))[:, k].mean()
    out = []
    for i in range(4):
        others = [j for j in range(4) if j != i]
        out.append(sum(math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 * (f([*s, i]) - f(s))
                       for m in range(4) for s in itertools.combinations(others, m)))
    return out


def contributions(row):
    per = {a["feature"]: a["contribution"] for a in row["attributions"]}
    assert [a["contribution"] for a in row["attributions"]] == sorted(per.values(), reverse=True)
    return per


def test_all_permutations_equal_the_definition(spark):
    pdf, ground = table(60, 1), table(3, 2)
    got = At.sampled_shapley(spark.createDataFrame(pdf).repartition(4), COLS, lambda f=crooked: f, spark.createDataFrame(ground),
                             ["key", *COLS]).collect()
    assert len(got) == 60
    for row in got:
        x = np.array([row[c] for c in COLS])
        k = int(crooked(pd.DataFrame([x], columns=COLS))[0].argmax())
        per = contributions(row)
        assert row["output_index"] == k and row["approximation_error"] == 0
        assert [per[c] for c in COLS] == pytest.approx(by_subsets(x, ground[COLS].to_numpy(), k), abs=1e-9)


def test_sampled_walks_add_up_and_say_how_far_they_are(spark):
    pdf, ground = table(200, 3), table(4, 4)
    frames = spark.createDataFrame(pdf), spark.createDataFrame(ground)
    few, more = (At.sampled_shapley(frames[0], COLS, lambda f=crooked: f, frames[1], ["a", "b", "c", "d"], pairs=p, output=0)
                 .collect() for p in (5, 11))  # 4! = 24 is more than 2 * 11
    base = crooked(ground)[:, 0].mean()
    for rows in (few, more):
        for r in rows:
            assert r["baseline_output"] == pytest.approx(base)
            assert sum(contributions(r).values()) == pytest.approx(r["instance_output"] - base, abs=1e-9)
    errors = [r["approximation_error"] for r in more]
    off = [max(abs(contributions(r)[c] - t) for c, t in zip(COLS, by_subsets(np.array([r[c] for c in COLS]),
                                                                          ground[COLS].to_numpy(), 0))) for r in more]
    assert np.mean(off) < 3 * np.mean(errors) and np.mean(errors) < np.mean([r["approximation_error"] for r in few])


def test_linear_model_equals_its_closed_form(spark):
    pdf, ground = table(40, 5), table(6, 6)
    w = np.array([2.0, -1.0, 0.0, 3.0])
    got = At.sampled_shapley(spark.createDataFrame(pdf), COLS, lambda: lambda r: r[COLS].to_numpy() @ w,
                             spark.createDataFrame(ground), COLS, pairs=6).collect()
    for r in got:
        per = contributions(r)
        assert [per[c] for c in COLS] == pytest.approx(list(w * (np.array([r[c] for c in COLS]) - ground[COLS].mean().to_numpy())), abs=1e-9)


def test_classifier_margin_equals_its_closed_form(spark):
    words = [["good news", "bad day"][i % 2] + f" w{i % 5}" for i in range(60)]
    df = spark.createDataFrame([(f"u{i}", words[i], float(i % 7), "AB"[i % 2]) for i in range(60)],
                               "uri string, body string, size double, topic string")
    spec = Mdl.FeatureSpec(text=["body"], numeric=["size"], num_features=64)
    model = Mdl.train_classifier(df, spec, "topic", 0.01)
    ground = df.orderBy("uri").limit(4)
    got = At.classifier_shapley(model, df, spec, ground, probability=False).collect()
    linear = {r["id"]: {a["feature"]: a["contribution"] for a in r["attributions"]}
              for r in Mdl.linear_attributions(model, df, spec).collect()}
    # of the background rows the same coefficients' products, by the class of the explained row
    from pyspark.ml.functions import vector_to_array
    feats = At.scorer(model).transform(ground).select(vector_to_array("features").alias("f")).toPandas()["f"]
    mean = np.mean([np.asarray(f) for f in feats], axis=0) * model.stages[-1].coefficientMatrix.toArray()
    for r in got:
        per, k = contributions(r), r["output_index"]
        assert per["body"] == pytest.approx(linear[r["id"]]["body"] - mean[k, :64].sum(), abs=1e-9)
        assert per["size"] == pytest.approx(linear[r["id"]]["size"] - mean[k, 64:].sum(), abs=1e-9)
    chance = At.classifier_shapley(model, df, spec, ground).collect()
    scores = {r["id"]: r["scores"] for r in Mdl.prediction_table(model, df, "topic").collect()}
    for r in chance:
        assert r["instance_output"] == pytest.approx(max(scores[r["id"]]), abs=1e-9)
        assert sum(contributions(r).values()) == pytest.approx(r["instance_output"] - r["baseline_output"], abs=1e-9)


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, 1.0, None), ("k", 2.0, 5), ("k", 2.0, 5)], "key string, a double, b int")

    def predict(rows):
        return rows["a"].to_numpy() * 2 + rows["b"].fillna(0).to_numpy()

    ground = df.where("b is not null").limit(1)
    got = At.sampled_shapley(df, ["a", "b"], lambda: predict, ground, ["key"]).collect()
    assert sorted((str(r["key"]), contributions(r)["a"], contributions(r)["b"]) for r in got) == \
        [("None", -2.0, -5.0), ("k", 0.0, 0.0), ("k", 0.0, 0.0)]
    assert At.sampled_shapley(df.limit(0), ["a", "b"], lambda: predict, ground, ["key"]).count() == 0
    with pytest.raises(ValueError):
        At.sampled_shapley(df, ["a", "b"], lambda: predict, df.limit(0), ["key"])
    with pytest.raises(ValueError):
        At.sampled_shapley(df, ["a", "b"], lambda: predict, spark.range(1001).select(F.lit(1.0).alias("a"), F.lit(1).alias("b")), ["key"])


def test_all_orders_ask_each_subset_once():
    """Three columns have 8 subsets; 6 orders of 4 steps asked 24 times for a background row (F2)."""
    paired, exact = At.walks(3, 2, 32)
    asked = []

    def value(own, b):
        asked.append((tuple(own), b))
        return np.array([float(own @ [1.0, 2.0, 4.0]) * (b + 1)])

    per, start, _error = At.contributions(value, 3, paired, exact)
    assert exact and len(asked) == len(set(asked)) == 16
    assert per.tolist() == [[1.5, 3.0, 6.0]] and start.tolist() == [0.0]


def test_texts_are_encoded_once(spark, monkeypatch):
    """The passes of the estimators read a table of vectors, and the parts go to the
    tasks as positions and values (F3, F8 to F11)."""
    rows = [(f"u{i}", ["good news", "bad day", "", None][i % 4], float(i % 7), "AB"[i % 2], ["TRAIN", "VALIDATE"][i % 5 == 0]) for i in range(60)]
    df = spark.createDataFrame(rows, "uri string, body string, size double, topic string, split string").fillna("", ["body"])
    spec = Mdl.FeatureSpec(text=["body"], numeric=["size"], num_features=64)
    _model, encoded = Mdl.fit_features(df, spec, "topic")
    plan = encoded._jdf.queryExecution().optimizedPlan().toString()
    assert "body__tf" in plan and "body__tok" not in plan
    seen = spark.sparkContext.accumulator(0)

    def counted(c):
        seen.add(1)
        return c

    once = df.withColumn("body", F.udf(counted, "string")("body"))
    Mdl.train_with_validation(once, spec, "topic", grid=(0.0, 0.1), max_iter=5)
    assert seen.value <= 2 * df.count()  # every row was encoded once for each of seven passes and more
    sparse = df.selectExpr("array(1.0D, 0.0D, 2.0D) v").limit(1)
    from pyspark.ml.functions import array_to_vector
    parts = sparse.select(*Mdl.sparse_parts(array_to_vector("v"))).toPandas()
    assert Mdl.dense_rows(parts, 3).tolist() == [[1.0, 0.0, 2.0]]
