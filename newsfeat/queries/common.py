"""Shared Spark inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsfeat.operators.prepare import prepare_articles
from newsfeat.plans import training_set as TS
from newsfeat.sources.tables import articles, read_table


def table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    return read_table(spark, sf_dir, name, partitions)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_articles(articles(spark, sf_dir))


def split_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared articles with the V1 split and the scaled shares."""
    return TS.split_articles(articles(spark, sf_dir))


def balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TS.balanced_articles(articles(spark, sf_dir))
