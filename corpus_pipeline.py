"""The corpus pipeline over ``documents``: quality rules, toxicity, MinHash
near-duplicates, personal data, packing.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and read again as
the next one's ``docs``.  Models are fitted on the stage's own input, with the
label table of ``sf_dir``.  All stages but the last return the columns of
``docs``; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsfeat.llm import hyperminhash, packing, pii, quality, toxicity
from newsfeat.llm.tables import read, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.good_documents(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    return toxicity.clean_documents(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: of those linked by
    a similarity of at least 0.8 on five-word shingles the one with the
    smallest id."""
    return hyperminhash.deduplicated(docs, words=5, percent=80)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts give way to their kind in brackets."""
    return pii.masked_documents(docs, pii.fit(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in windows of 2048 ids."""
    return packing.packed(docs)


STAGES = [("quality", quality_stage), ("toxicity", toxicity_stage), ("near_dedup", near_dedup_stage),
          ("pii", pii_stage), ("packing", packing_stage)]

#: No SQL: the models, the sketches and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
