"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate, run locally)."""

import json

import pytest

import __spark_entry__ as E
from conftest import SF
from oracle_compare import compare

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck_con, name):
    issues, _n, _t = compare(spark, duck_con, name, QUERIES[name], SQL[name], SF)
    assert not issues, issues


#: What must hold for each row of the queries that no SQL expresses; the
#: training-data operators have tests of their own.
INVARIANTS = {
    "s11_request_json_lines": lambda r: "title" in r and "ingest_seq" not in r and "value" not in r,
    "n8_feature_table": lambda r: r["body_pre"] and "ingest_seq" not in r and r["magnitude"] >= 0,
    "p26_scoring_request": lambda r: "ingest_seq" not in json.loads(r["instance"]) and len(json.loads(r["instance"])) > 30,
    "m1_topic_model_test_metrics": lambda r: r["value"] >= 0,
    "m1_language_model_metrics": lambda r: r["value"] < 0.3 if r["metric"] == "logLoss" else r["value"] > 0.95,
    "m2_validation_grid": lambda r: r["validate_log_loss"] > 0,
    "m10_topic_batch_scores": lambda r: r["class"] is not None and 0 <= r["score"] <= 1,
    "m13_attributions": lambda r: len(r["attributions"]) == 3,
    "m13_shapley_topics": lambda r: abs(sum(a["contribution"] for a in r["attributions"])
                                        - r["instance_output"] + r["baseline_output"]) < 1e-9 and r["approximation_error"] < 0.1,
    "m1_embedding_model_metrics": lambda r: r["value"] >= 0,
    "x9_p_values": lambda r: all(0 <= v <= 1 for k, v in r.items() if k.endswith("_p")),
}
OWN = sorted(n for n in set(QUERIES) - set(SQL) if n != "pipeline" and not n.startswith("op"))


@pytest.mark.parametrize("name", OWN)
def test_query_without_oracle_keeps_its_invariant(spark, name):
    rows = [r.asDict() for r in QUERIES[name](spark, SF).collect()]
    assert rows and all(INVARIANTS[name](r) for r in rows)


def test_batch_scores_are_distributions(spark):
    df = QUERIES["m10_topic_batch_scores"](spark, SF).toPandas()
    per = df.groupby("id")
    assert (per.size() == df["class"].nunique()).all() and ((per["score"].sum() - 1).abs() < 1e-9).all()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"topic", "split", "n"}
