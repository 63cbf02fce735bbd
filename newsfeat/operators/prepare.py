"""Article preparation: parse dates, keep one year, de-duplicate, clean, label.

Each step is a ``DataFrame -> DataFrame`` function built from Catalyst
expressions, so the whole chain is one plan: the year filter reaches the
scan, projections fuse into one codegen stage and the only shuffle is the
de-duplication, which aggregates map-side (``min_by``) so that a uri with a
huge number of copies is collapsed before it leaves its task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfeat.operators.ranking import exact_quantiles


class InputMissing(Exception):
    """Raised when a stage input does not exist (S3)."""


# ---------------------------------------------------------------- dates

def parse_date(df: DataFrame, src: str = "date", out: str = "date_column") -> DataFrame:
    """Lenient date parse; values that are not dates become null, and so do
    partial ones (a year, a year and a month)."""
    whole = F.col(src).cast("string").rlike(r"^\s*[+-]?\d{4,7}-\d{1,2}-\d{1,2}")
    return df.withColumn(out, F.when(whole, F.expr(f"try_cast(`{src}` AS date)")))


def add_year_month(df: DataFrame, date_col: str = "date_column") -> DataFrame:
    """``year``, ``month`` and the unpadded ``year_month`` key
    (``2023-1``); all null when the date is null (trap T6)."""
    d = F.col(date_col)
    return (df.withColumn("year", F.year(d)).withColumn("month", F.month(d))
            .withColumn("year_month", F.concat_ws("-", F.year(d).cast("string"), F.month(d).cast("string")))
            .withColumn("year_month", F.when(d.isNotNull(), F.col("year_month"))))


def filter_year(df: DataFrame, year: int = 2023, date_col: str = "date_column") -> DataFrame:
    """keep one calendar year; unparsable dates fall out.  The test is on
    the parsed date alone: the raw text of a valid date may begin with blanks
    or a sign."""
    return df.where(F.year(F.col(date_col)) == F.lit(year))


# ---------------------------------------------------------- de-duplication

def dedupe_first(df: DataFrame, key: str = "uri", order: str = "ingest_seq") -> DataFrame:
    """One row per ``key``, the first in ``order`` (file order).

    ``min_by`` is a partial aggregate: every task keeps one row per key before
    the shuffle, so a key with millions of copies costs one row per task.
    """
    cols = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(order)).alias("_first")
    return df.groupBy(key).agg(first).select(key, *[F.col(f"_first.{c}").alias(c) for c in cols]) \
        .select(*df.columns)


def duplicate_groups(df: DataFrame, key: str = "uri") -> DataFrame:
    """All members of keys that occur more than once, with the group size.

    Counting is a partial aggregate; the members come back through a
    left-semi join, which AQE splits when one key is skewed.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("dup_count")).where(F.col("dup_count") > 1)
    return df.join(counts, key, "inner")


# ---------------------------------------------------------------- cleaning

def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def empty_to_null(df: DataFrame, columns: Sequence[str] | None = None,
                  blanks: Sequence[str] = ("",)) -> DataFrame:
    """Exact ``''`` (or any of ``blanks``) becomes null on the given (all
    string) columns."""
    cols = set(columns if columns is not None else string_columns(df))
    return df.select(*[
        (F.when(F.col(c).isin(*blanks), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
         if c in cols else F.col(c))
        for c in df.columns])


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """drop rows where any of ``subset`` is null."""
    return df.dropna(how="any", subset=list(subset))


# ---------------------------------------------------------------- topic label

def first_token(c: Column | str, sep: str = ";") -> Column:
    """P5: first element of a ``sep``-separated list (whole value when absent)."""
    return F.split_part(F.col(c) if isinstance(c, str) else c, F.lit(sep), F.lit(1))


def add_topic(df: DataFrame, src: str = "categoryLabels", prefix: str = "news",
              strip: str = "news/", out: str = "topic") -> DataFrame:
    """P5 + F2 + P6: first category label, kept when it starts with
    ``prefix``; every occurrence of ``strip`` is removed."""
    first = first_token(src)
    return (df.where(first.startswith(prefix))
            .withColumn(out, F.replace(first, F.lit(strip), F.lit(""))))


# ---------------------------------------------------------------- scaling

def robust_fit(df: DataFrame, col: str) -> DataFrame:
    """X1 fit: one row ``(median, iqr)`` from exact linear quantiles; a zero
    range is replaced by 1 (scikit-learn behaviour).  Nulls are ignored."""
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    iqr = F.col("q75") - F.col("q25")
    return q.select(F.col("q50").alias("center"),
                    F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))


def robust_apply(df: DataFrame, fit: DataFrame, col: str, out: str) -> DataFrame:
    """X1 apply: ``(x - center) / scale``; the one-row fit enters as a scalar
    subquery (computed once, no join)."""
    f = fit.select(F.struct("center", "scale").alias("f")).scalar()
    return df.withColumn(out, (F.col(col) - f.getField("center")) / f.getField("scale"))


# ---------------------------------------------------------------- the whole preparation

PREPARE_INPUTS = ["uri", "ingest_seq", "date", "categoryLabels", "authors", "sharesFacebook"]


def prepared_rows(articles: DataFrame, year: int = 2023, first_only: bool = True) -> DataFrame:
    """The preparation without scaling: date parts, one year, first row per
    uri, ``''`` -> null, rows without labels or authors dropped, topic label.
    ``first_only=False`` leaves out the first-row step; what remains looks at
    one row at a time."""
    df = filter_year(parse_date(articles), year)
    df = add_year_month(df)
    if first_only:
        df = dedupe_first(df, "uri", "ingest_seq")
    return add_topic(drop_missing(empty_to_null(df), ["categoryLabels", "authors"]))


def prepare_articles(articles: DataFrame, year: int = 2023, scale: bool = True,
                     fit: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """The preparation stage: ``prepared_rows`` and robust-scaled shares
    (fitted on the prepared rows unless ``fit`` is given).

    ``keep`` narrows the carried columns to the inputs of the stage plus the
    listed ones, so the scan reads only those (the de-duplication carries
    whole rows, which Catalyst cannot prune by itself)."""
    if keep is not None:
        cols = [c for c in articles.columns if c in set(PREPARE_INPUTS) | set(keep)]
        articles = articles.select(*cols)
    df = prepared_rows(articles, year)
    if scale:
        if fit is None:
            # fit on the narrow preparation inputs: the de-duplication keeps
            # the same row per uri whatever columns it carries, so the values
            # are the same and the wide rows are shuffled once, not twice
            narrow = articles.select(*[c for c in articles.columns if c in PREPARE_INPUTS])
            fit = robust_fit(prepare_articles(narrow, year=year, scale=False), "sharesFacebook")
        df = robust_apply(df, fit, "sharesFacebook", "shares_scaled")
    return df
