"""Learned lexicons on small tables."""

import math

import pytest

from newsfeat.operators.learned import best_cut, induce_lexicon, score_by_lexicon


def test_lexicon_of_planted_words_and_its_scores(spark):
    rows = [(i, "Vile vile words here" if i % 4 == 0 else "kind words here", int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame(rows + [(999, "vile", None)], "doc_id long, text string, bad int")
    lexicon = induce_lexicon(docs, "bad")
    per = {r["word"]: r for r in lexicon.collect()}
    assert set(per) == {"vile", "kind"} and per["vile"]["n_positive"] == 100
    a, p, n = 1000.0 * 100 / 1200, 100.0, 0.0  # by the formula, by hand
    odds = math.log((p + a) / (300 + 1000 - p - a)) - math.log((n + a) / (900 + 1000 - n - a))
    assert per["vile"]["log_odds"] == pytest.approx(odds)
    assert per["vile"]["z"] == pytest.approx(odds / math.sqrt(1 / (p + a) + 1 / (n + a)))
    odd = spark.createDataFrame([(1, "VILE vile words"), (1, "kind"), (2, None), (3, ""), (None, "vile"), (4, "none of it")],
                                "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS _n")
    got = {r["doc_id"]: r for r in score_by_lexicon(odd, lexicon).collect()}
    v, k = per["vile"]["log_odds"], per["kind"]["log_odds"]
    assert (got[1]["n_words"], got[1]["n_hits"]) == (4, 3) and got[1]["score"] == pytest.approx((2 * v + k) / 3)
    assert got[1]["magnitude"] == pytest.approx(2 * v - k)
    assert [(got[i]["n_words"], got[i]["n_hits"], got[i]["score"]) for i in (2, 3, 4)] == [(0, 0, 0.0), (0, 0, 0.0), (3, 0, 0.0)]
    assert got[None]["score"] == pytest.approx(v) and len(got) == 5


def test_tables_without_anything_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b", 1), (2, None, 0)], "doc_id long, text string, bad int")
    assert induce_lexicon(docs, "bad").count() == 0  # no word of the other class
    assert induce_lexicon(docs.limit(0), "bad").count() == 0
    assert score_by_lexicon(docs.limit(0), spark.createDataFrame([("a", 1.0)], "word string, log_odds double")).count() == 0


def test_best_cut_of_scores(spark):
    scores = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 1), (0.5, 0), (0.4, 0), (0.4, None), (None, 1), (9.0, 3)],
                                   "score double, bad int")
    assert best_cut(scores, "bad").first().asDict() == pytest.approx({"cut": 0.8, "recall": 2 / 3, "false_alarms": 0.0})
    assert best_cut(scores.where("bad = 1"), "bad").count() == 0 and best_cut(scores.limit(0), "bad").count() == 0


def test_scores_shuffle_sums_only(spark):
    """Every word of every document was shuffled twice; now a row a document and task is."""
    docs = spark.createDataFrame([(i, "vile word " * 30 + f"own{i}") for i in range(50)], "doc_id long, text string")
    scored = score_by_lexicon(docs, spark.createDataFrame([("vile", 1.0)], "word string, log_odds double"))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(_id" in plan and "hashpartitioning(_w" not in plan
    assert {tuple(r) for r in scored.select("n_words", "n_hits", "score", "magnitude").collect()} == {(61, 30, 1.0, 30.0)}
