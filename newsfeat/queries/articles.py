"""Preparation, de-duplication, split and balancing queries (P, F, D, V, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfeat.operators import prepare as prep
from newsfeat.queries import sql as S
from newsfeat.queries.common import articles, balanced, prepared, split_articles
from newsfeat.queries.registry import query


@query("prep_topic_counts", S.with_(S.PREPARED_UNSCALED, """
SELECT topic, count(*) AS n FROM prepared_unscaled GROUP BY topic"""))
def prep_topic_counts(spark, sf_dir):
    """Minimum slice: prepare, then A3 value counts of the topic label."""
    df = prep.prepare_articles(articles(spark, sf_dir), scale=False, keep=[])
    return df.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("prepared_rows", S.with_(S.PREPARED, """
SELECT uri, ingest_seq, title, date_column, year, month, year_month, authors, topic, sharesFacebook,
       round(shares_scaled, 9) AS shares_scaled
FROM prepared"""))
def prepared_rows(spark, sf_dir):
    """The whole prepared table."""
    return prepared(spark, sf_dir).select(
        "uri", "ingest_seq", "title", "date_column", "year", "month", "year_month", "authors", "topic",
        "sharesFacebook", F.round("shares_scaled", 9).alias("shares_scaled"))


@query("split_counts", S.with_(S.SPLIT, """
SELECT topic, split, count(*) AS n FROM split_articles GROUP BY topic, split"""))
def split_counts(spark, sf_dir):
    """V1 then A4: rows per (topic, split)."""
    return split_articles(spark, sf_dir).groupBy("topic", "split").agg(F.count(F.lit(1)).alias("n"))


@query("split_rows", S.with_(S.SPLIT, "SELECT uri, topic, date_column, split FROM split_articles"))
def split_rows(spark, sf_dir):
    """V1 row by row: the split label of every prepared article."""
    return split_articles(spark, sf_dir).select("uri", "topic", "date_column", "split")


@query("balanced_counts", S.with_(S.BALANCED, """
SELECT topic, split, count(*) AS n FROM balanced GROUP BY topic, split"""))
def balanced_counts(spark, sf_dir):
    """Flagship: rows per (topic, split) after V1, D7 and G1."""
    return balanced(spark, sf_dir).groupBy("topic", "split").agg(F.count(F.lit(1)).alias("n"))


@query("balanced_rows", S.with_(S.BALANCED, "SELECT uri, topic, split FROM balanced"))
def balanced_rows(spark, sf_dir):
    """D7 row by row: which TRAIN rows the seeded balanced sample keeps."""
    return balanced(spark, sf_dir).select("uri", "topic", "split")
