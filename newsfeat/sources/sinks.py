"""Sinks and stage control.

Writes are Spark's file commit protocol (task attempts write to temporary
paths, the job commits once), so a lost executor never leaves half a table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.functions.columns import drop_exact
from newsfeat.sources.articles import path_exists


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Whole-output overwrite (no index exists in Spark)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_pipe_csv(df: DataFrame, path: str) -> str:
    """``|``-separated, header, every field quoted (quoted newlines
    survive); nested columns must be flattened first."""
    (df.write.mode("overwrite").option("sep", "|").option("header", True).option("quoteAll", True)
     .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


def read_pipe_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read S6 output back; ``schema=None`` detects types (``inferSchema``),
    as the warehouse load does."""
    r = (spark.read.option("sep", "|").option("header", True).option("multiLine", True)
         .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def load_table(df: DataFrame, table: str, drop: str | None = "DATE", location: str | None = None) -> int:
    """Truncate and replace a table (guarded exact-case drop of ``drop``,
    trap T16); returns the rows loaded.  The table lives at ``location``
    (default: ``<warehouse>/<table>``); an explicit location lets the load
    replace files left by an earlier session whose catalog is gone."""
    spark = df.sparkSession
    out = drop_exact(df, drop) if drop else df
    if location is None:
        location = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}"
    out.write.mode("overwrite").option("path", location).saveAsTable(table)
    return spark.table(table).count()


def table_slice(spark: SparkSession, table: str, split: str | None = "TEST", n: int = 10,
                order: str = "uri", exclude: list[str] | None = None) -> DataFrame:
    """``SELECT * EXCEPT(...) FROM t WHERE split = ... LIMIT n`` with an
    explicit order so the slice is deterministic."""
    t = spark.table(table)
    if split is not None:
        t = t.where(F.col("split") == split)
    if exclude:
        t = t.select(*[F.col(f"`{c}`") for c in t.columns if c not in set(exclude)])
    return t.orderBy(order).limit(n)


def table_columns(spark: SparkSession, table: str) -> DataFrame:
    """Column names (and types) of a table, from the catalog."""
    cols = spark.catalog.listColumns(table)
    return spark.createDataFrame([(c.name, c.dataType) for c in cols], "column_name string, data_type string")


def run_stage(spark: SparkSession, out_path: str, build: Callable[[], DataFrame], overwrite: bool = False,
              partition_by: list[str] | None = None) -> DataFrame:
    """Idempotent stage.  When ``out_path`` holds a committed output
    (``_SUCCESS``) and ``overwrite`` is false the stage is skipped and the
    output read back; otherwise the stage runs and writes it."""
    if not overwrite and path_exists(spark, f"{out_path}/_SUCCESS"):
        return spark.read.parquet(out_path)
    write_parquet(build(), out_path, partition_by)
    return spark.read.parquet(out_path)


def write_json_lines(instances: DataFrame, path: str) -> str:
    """One JSON object per line; ``instances`` has them as its one string
    column."""
    instances.write.mode("overwrite").text(path)
    return path


def columns_as_rows(df: DataFrame) -> DataFrame:
    """S12 as a table: each row of ``df`` turned into ``(column, value)``
    rows (``stack``), values as strings."""
    cols = df.columns
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, value)")


YEAR_PARTITION = "date_year"


def write_by_year(df: DataFrame, path: str, src: str = "date", partitions: int | None = None) -> str:
    """F1 layout: dates parsed once, a folder for each year (rows without a
    valid date in one of their own), clustered by date inside it.  A year with
    any share of the rows is several files, since the date splits it."""
    from newsfeat.operators.prepare import parse_date

    dated = parse_date(df, src).withColumn(YEAR_PARTITION, F.year("date_column"))
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dated.repartitionByRange(n, YEAR_PARTITION, "date_column").sortWithinPartitions(YEAR_PARTITION, "date_column") \
        .write.mode("overwrite").partitionBy(YEAR_PARTITION).parquet(path)
    return path


def read_year(spark: SparkSession, path: str, year: int, first: str | None = None, last: str | None = None) -> DataFrame:
    """F1 on that layout: the rows of ``year``, and of the dates from ``first``
    to ``last`` if given.  The year chooses folders, the dates row groups; how a
    date was written in the source plays no part."""
    df = spark.read.parquet(path).where(F.col(YEAR_PARTITION) == F.lit(year))
    if first is not None:
        df = df.where(F.col("date_column") >= F.lit(first).cast("date"))
    if last is not None:
        df = df.where(F.col("date_column") <= F.lit(last).cast("date"))
    return df.drop(YEAR_PARTITION)
