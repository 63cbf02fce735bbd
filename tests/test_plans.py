"""Plan-shape checks over the registered queries."""

import pytest

import __spark_entry__ as E
from conftest import SF

QUERIES = E.queries()
# training / streaming queries run jobs while they are built; their plans are
# checked through the operators they share with the other queries
HEAVY = {"m1_topic_model_test_metrics", "m10_topic_batch_scores", "m13_attributions", "q1_incremental_scoring",
         "m1_embedding_model_metrics", "m2_validation_grid", "m10_score_invariants"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - HEAVY))
def test_no_pairwise_joins(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_pruning_reaches_the_scan(spark, tmp_path):
    from newsfeat.operators import prepare as P
    from newsfeat.sources.tables import articles

    path = str(tmp_path / "articles")
    articles(spark, SF).write.parquet(path)
    df = P.prepare_articles(spark.read.parquet(path), scale=False, keep=[]).select("uri", "topic")
    plan = _plan(df)
    assert "body" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_text_features_do_not_shuffle(spark):
    from newsfeat.operators import scorers as Sc
    from newsfeat.sources.tables import read_table

    d = read_table(spark, SF, "documents")
    df = Sc.analyze_entities(Sc.project_categories(Sc.moderation_map(Sc.sentiment_lexicon(d, "text"), "text")),
                             "text")
    assert "Exchange" not in _plan(df)


def test_training_set_positions_stay_narrow(spark):
    """V1 / D7 positions are computed on the key columns: no range exchange
    and no materialised positions table carries the article body; the whole
    rows meet the labels in one equi-join."""
    from newsfeat.queries import common as C

    df = C.balanced(spark, SF)
    plan = _plan(df)
    scans = [line for line in plan.split("\n")
             if "FileScan parquet" in line and ("positions-" in line or "cells-" in line)]
    assert scans
    for line in scans:
        assert "body" not in line.split("ReadSchema:")[1]
    assert "body" in df.columns
    assert df.count() == QUERIES["balanced_rows"](spark, SF).count()


def test_whole_articles_cross_one_join_only(spark):
    """The wide rows need no shuffle or sort of their own below the join with
    the labels: the text is hashed once at most."""
    from newsfeat.queries import common as C

    plan = _plan(C.split_articles(spark, SF))
    assert "SortAggregate" not in plan and "min_by" not in plan
