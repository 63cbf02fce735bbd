"""Driver tables and the ``articles`` fixture view.

``read_table`` is a plain Parquet scan; Catalyst prunes columns and pushes
filters into it.
``articles_from_documents`` derives the article rows used by
the preparation operators from the ``documents`` table (see FIXTURES.md §5):
it is a pure projection, so it stays inside the scan's codegen stage.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """Parquet scan of a driver table, dealt anew to ``partitions`` tasks if
    the caller asks for that (a file of one row group is one task)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df if partitions is None else df.repartition(partitions)


# The article fixture of FIXTURES.md §5, one SQL expression per
# output column, valid in both Spark SQL and DuckDB.
ARTICLE_FIXTURE_COLUMNS = [
    ("uri", "concat('a', cast(doc_id - (CASE WHEN doc_id % 10 = 9 THEN 1 ELSE 0 END) AS string))"),
    ("ingest_seq", "doc_id"),
    ("title", "concat('title ', cast(doc_id AS string))"),
    ("body", "text"),
    ("date", "CASE WHEN doc_id % 97 = 0 THEN 'not-a-date' "
             "ELSE cast(date '2022-12-01' + cast(doc_id % 450 AS int) AS string) END"),
    ("dateTime", "CASE WHEN doc_id % 97 = 0 THEN '' "
                 "ELSE concat(cast(date '2022-12-01' + cast(doc_id % 450 AS int) AS string), 'T', "
                 "lpad(cast(doc_id % 24 AS string), 2, '0'), ':00:00Z') END"),
    ("lang", "lang"),
    ("sourceTitle", "source"),
    ("authors", "CASE WHEN doc_id % 13 = 0 THEN '' WHEN doc_id % 13 = 1 THEN ' ' "
                "ELSE concat('author ', cast(doc_id % 23 AS string)) END"),
    ("categoryLabels", "CASE WHEN doc_id % 11 = 0 THEN '' "
                       "WHEN doc_id % 11 = 1 THEN 'dmoz/Society; news/Politics' "
                       "WHEN doc_id % 11 IN (2, 3, 4, 5) THEN 'news/Politics; news/Business' "
                       "WHEN doc_id % 11 IN (6, 7, 8) THEN 'news/Sports' "
                       "ELSE 'news/Business; dmoz/Finance' END"),
    ("sharesFacebook", "CASE WHEN doc_id % 3 = 0 THEN 0 ELSE (n_chars * 31) % 500 END"),
    ("importanceRank", "cast((doc_id * 7919) % 1000000 AS bigint)"),
    ("alexaGlobalRank", "cast((doc_id * 104729) % 500000 AS bigint)"),
    ("alexaCountryRank", "CASE WHEN doc_id % 17 = 0 THEN NULL ELSE cast((doc_id * 31) % 1000 AS bigint) END"),
]

ARTICLE_FIXTURE_SQL = (
    "SELECT\n  "
    + ",\n  ".join(f"{expr} AS {name}" for name, expr in ARTICLE_FIXTURE_COLUMNS)
    + "\nFROM documents"
)


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """The ``articles`` view (flat article rows) over a ``documents`` frame."""
    return documents.selectExpr(*[f"{expr} AS {name}" for name, expr in ARTICLE_FIXTURE_COLUMNS])


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_from_documents(read_table(spark, sf_dir, "documents"))


# The flat article row (FIXTURES.md §2): 24 declared columns.
def _flat_schema():
    from pyspark.sql import types as T

    s, l_ = T.StringType(), T.LongType()
    fields = [("uri", s), ("url", s), ("title", s), ("body", s), ("date", s), ("time", s), ("dateTime", s),
              ("dateTimePub", s), ("lang", s), ("isDuplicate", T.BooleanType()), ("dataType", s),
              ("sentiment", T.DoubleType()), ("eventUri", s), ("relevance", l_), ("image", s), ("authors", s),
              ("sharesFacebook", l_), ("sourceTitle", s), ("sourceLocationLabel", s), ("categoryLabels", s),
              ("categoryWeights", s), ("importanceRank", l_), ("alexaGlobalRank", l_), ("alexaCountryRank", l_)]
    return T.StructType([T.StructField(n, t) for n, t in fields])


FLAT_SCHEMA = _flat_schema()
