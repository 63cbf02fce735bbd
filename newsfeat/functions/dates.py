"""Calendar column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfeat.operators.ranking import row_number_within

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_iso_utc(c: Column | str) -> Column:
    """``2023-12-18T08:47:11Z`` -> timestamp (wall clock of the string);
    anything else -> null."""
    return F.try_to_timestamp(_c(c), F.lit(ISO_UTC))


def hour_of_iso(c: Column | str) -> Column:
    """P10 on an ISO-8601 ``Z`` string."""
    return F.hour(parse_iso_utc(c))


def day_name(c: Column | str) -> Column:
    """English day name (``Monday`` ...)."""
    return F.date_format(_c(c), "EEEE")


def is_weekend(c: Column | str) -> Column:
    """Saturday or Sunday (``weekday`` is Monday = 0)."""
    return F.weekday(_c(c)) >= 5


def category_codes(df: DataFrame, col: str, out: str) -> DataFrame:
    """Codes of the distinct non-null values in alphabetical order
    (0-based), null -> -1.  The distinct values are numbered with the
    distributed row-number helper and joined back (broadcast chosen by AQE
    from the measured size of the value table)."""
    vals = df.select(col).where(F.col(col).isNotNull()).distinct()
    codes = row_number_within(vals, [], [F.col(col)], rn="_code", size=None)
    codes = codes.select(col, (F.col("_code") - 1).alias(out))
    return (df.join(codes, df[col].eqNullSafe(codes[col]), "left").drop(codes[col])
            .withColumn(out, F.coalesce(F.col(out), F.lit(-1).cast("long"))))


def calendar_features(df: DataFrame, date_col: str, time_col: str, holidays: DataFrame | None = None) -> DataFrame:
    """P10-P15 together: hour, day name, weekend / holiday flags as integers
    (P14) and day-name codes (P15).  Without a holiday calendar the flag is
    the constant placeholder (P13); with one (a ``date`` column) days found
    in it are flagged."""
    out = (df.withColumn("hour", F.hour(_c(time_col)))
           .withColumn("day", day_name(date_col))
           .withColumn("is_weekend", is_weekend(date_col).cast("int")))
    if holidays is None:
        out = out.withColumn("is_holiday", F.lit(False).cast("int"))
    else:
        h = holidays.select(F.col("date").cast("date").alias("__hday")).distinct()
        out = (out.join(h, F.to_date(_c(date_col)) == F.col("__hday"), "left")
               .withColumn("is_holiday", F.col("__hday").isNotNull().cast("int")).drop("__hday"))
    out = category_codes(out, "day", "day_code")
    return out.withColumn("day_code", F.col("day_code").cast("int"))
