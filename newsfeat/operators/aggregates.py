"""Aggregations, top-k, pivots, histograms and profiles.

All of them are a single ``agg`` (partial + final aggregation chosen by
Catalyst) or a ``groupBy`` on bounded keys; quantiles go through the
cell-based ``exact_quantiles`` so that no group is gathered in one buffer.
Results are small DataFrames; nothing is collected here.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfeat.operators.ranking import exact_quantiles, value_cells

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------- counts

def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """A1."""
    return df.agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """A3: counts per value, nulls excluded (order with ``orderBy`` if needed)."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))


def group_counts(df: DataFrame, cols: Sequence[str], name: str = "count") -> DataFrame:
    """Counts per combination of keys."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: one pass computing ``count_if(c is null)`` for every column,
    turned into ``(column, nulls)`` rows with ``stack``."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, nulls)")


def missing_or_empty(df: DataFrame, col: str, blanks: Sequence[str] = ("", " "), name: str = "missing") -> DataFrame:
    """Rows where ``col`` is null or one of ``blanks``."""
    c = F.col(col)
    return df.agg(F.count_if(c.isNull() | c.isin(*blanks)).alias(name))


def zero_positive_counts(df: DataFrame, col: str) -> DataFrame:
    """``count_if(x = 0)`` and ``count_if(x > 0)``."""
    c = F.col(col)
    return df.agg(F.count_if(c == 0).alias("zero"), F.count_if(c > 0).alias("positive"))


def included_excluded(df: DataFrame, pred: Column, total: DataFrame | None = None) -> DataFrame:
    """Rows passing ``pred`` and the rest of ``total`` (defaults to ``df``)."""
    inc = df.agg(F.count_if(pred).alias("included"))
    tot = (total if total is not None else df).agg(F.count(F.lit(1))).scalar()
    return inc.select("included", (tot - F.col("included")).alias("excluded"))


def min_max(df: DataFrame, col: str, group_cols: Sequence[str] = (), lo: str = "min", hi: str = "max") -> DataFrame:
    """A5 / A6."""
    return df.groupBy(*group_cols).agg(F.min(col).alias(lo), F.max(col).alias(hi))


def min_group_size(df: DataFrame, group: str, name: str = "min_size") -> DataFrame:
    """Aggregate over an aggregate."""
    return group_counts(df, [group], "_c").agg(F.min("_c").alias(name))


def group_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """A10: exact median and non-null count per group."""
    q = exact_quantiles(df, value, [0.5], ["median"], group_cols=[group], count_name="count")
    return q.select(group, "median", "count")


def group_mean(df: DataFrame, group: Column | str, value: str, name: str = "mean") -> DataFrame:
    """A11."""
    return df.groupBy(group).agg(F.avg(value).alias(name))


def length_stats(df: DataFrame, col: str) -> DataFrame:
    """Total and mean character length (nulls ignored)."""
    n = F.length(F.col(col))
    return df.agg(F.sum(n).cast("long").alias("total_chars"), F.avg(n).alias("mean_chars"),
                  F.count(n).alias("documents"))


def top_k(df: DataFrame, key: str, k: int, name: str = "count") -> DataFrame:
    """The ``k`` most frequent non-null values (ties by value)."""
    return value_counts(df, key, name).orderBy(F.desc(name), F.asc(key)).limit(k)


def mode(df: DataFrame, key: str) -> DataFrame:
    """Most frequent value and its frequency."""
    return top_k(df, key, 1, "freq").select(F.col(key).alias("top"), "freq")


# ----------------------------------------------------------------- descriptions

def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value) rows for numeric columns, one ``stack`` projection."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, value)")


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std (n-1), min, 25/50/75 % (exact, linear), max for
    every numeric column; one row per column.  The columns are stacked so
    one aggregation and one quantile pass serve them all."""
    cols = list(cols or numeric_columns(df))
    long = _long_values(df, cols)
    basic = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], group_cols=["column"])
    return basic.join(q, "column", "left")


def describe_strings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A14 (non-numeric part): count, unique, top, freq per column."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, value)").where(F.col("value").isNotNull())
    cells = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_f"))
    # top = most frequent value, ties broken by the smallest value; min_by on
    # a composite key is a partial aggregate over the (distinct) cells
    per = cells.groupBy("column").agg(
        F.sum("_f").cast("long").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by(F.struct(F.col("value"), F.col("_f")),
                 F.struct((-F.col("_f")).alias("a"), F.col("value").alias("b"))).alias("_t"))
    return per.select("column", "count", "unique", F.col("_t.value").alias("top"),
                      F.col("_t._f").alias("freq"))


def describe_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A14 (include all): numeric and other columns in one table; what does
    not apply to a column is null."""
    numeric = [c for c in cols if c in set(numeric_columns(df))]
    return describe_numeric(df, numeric).unionByName(
        describe_strings(df, [c for c in cols if c not in numeric]), allowMissingColumns=True)


# ----------------------------------------------------------------- pivots and bins

def pivot_counts(df: DataFrame, rows: str, cols: str, values: Sequence[str], cap: int | None = None) -> DataFrame:
    """A15 (+ A16 when ``cap``): sizes of (rows x cols) with 0 for empty
    cells.  ``values`` fixes the output columns and saves the distinct pass."""
    p = df.groupBy(rows).pivot(cols, list(values)).agg(F.count(F.lit(1))).fillna(0, subset=list(values))
    for v in values:
        p = p.withColumn(v, F.col(v).cast("long"))
        if cap is not None:
            p = p.withColumn(v, F.least(F.col(v), F.lit(cap).cast("long")))
    return p


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between min and max, last bin closed on the
    right (numpy), empty ones included; a column without values has none.  Two
    aggregations: the range (one row), then counts per bin."""
    x = F.col(col).cast("double")
    ends = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    rng = ends.select(F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"))).scalar()  # one-row subquery
    out = (df.where(F.col(col).isNotNull())
           .withColumn("_lo", rng.getField("lo")).withColumn("_hi", rng.getField("hi")))
    width = (F.col("_hi") - F.col("_lo"))
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("_lo")) / width * F.lit(bins)).cast("int"), F.lit(bins - 1)))
    found = out.withColumn("bin", b).groupBy("bin").agg(F.count(F.lit(1)).alias("_n"))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    out = ends.where(F.col("_lo").isNotNull()).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))) \
        .join(found, "bin", "left").withColumn("count", F.coalesce("_n", F.lit(0).cast("long")))
    return out.select("bin", (F.col("_lo") + F.col("bin") * step).alias("lower"),
                      (F.col("_lo") + (F.col("bin") + 1) * step).alias("upper"), "count")


def kde_curve(df: DataFrame, col: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density on ``points`` grid points spanning the
    data range, Scott bandwidth ``std * n^(-1/5)`` (scipy ``gaussian_kde``).
    Works on distinct-value cells; each cell emits its contribution to every
    grid point (``posexplode`` of a generated array) and a partial
    aggregation sums them."""
    cells = value_cells(df, F.col(col).cast("double"), (), "_v", "_w")
    st = df.where(F.col(col).isNotNull()).agg(
        F.min(F.col(col).cast("double")).alias("_lo"), F.max(F.col(col).cast("double")).alias("_hi"),
        F.stddev_samp(F.col(col).cast("double")).alias("_sd"), F.count(F.lit(1)).alias("_n"))
    st = st.withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
    st = st.select(F.struct("_lo", "_hi", "_h", "_n").alias("s")).scalar()  # one-row subquery
    step = (F.col("_hi") - F.col("_lo")) / F.lit(points - 1)
    grid = F.transform(F.sequence(F.lit(0), F.lit(points - 1)),
                       lambda i: F.col("_w") * F.exp(-F.pow(F.try_divide(F.col("_lo") + i * step - F.col("_v"), F.col("_h")), F.lit(2)) / 2))
    with_st = cells.select("_v", "_w", *[st.getField(f).alias(f) for f in ("_lo", "_hi", "_h", "_n")])
    contrib = with_st.select("_lo", "_hi", "_h", "_n", F.posexplode(grid).alias("point", "_k"))
    norm = F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi))
    return (contrib.groupBy("point", "_lo", "_hi", "_h", "_n").agg(F.sum("_k").alias("_s"))
            .select("point", (F.col("_lo") + F.col("point") * step).alias("x"),
                    F.try_divide(F.col("_s"), norm).alias("density")))


def profile(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Per column type, missing count, distinct count (exact, or
    HyperLogLog with ``approx``), most frequent value and its frequency (ties
    by value) and, for numeric columns, min / mean / std / max and quartiles.
    One stacked pass for each of counts, values and quartiles, grouped by
    column."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    num = set(numeric_columns(df))
    parts = ", ".join(
        f"'{c}', CAST(`{c}` AS STRING), {f'CAST(`{c}` AS DOUBLE)' if c in num else 'CAST(NULL AS DOUBLE)'}"
        for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {parts}) AS (column, sval, dval)")
    agg = long.groupBy("column").agg(
        F.count_if(F.col("sval").isNull()).alias("missing"),
        (F.approx_count_distinct("sval") if approx else F.count_distinct("sval")).alias("distinct"),
        F.min("dval").alias("min"), F.avg("dval").alias("mean"), F.stddev_samp("dval").alias("std"),
        F.max("dval").alias("max"))
    quartiles = exact_quantiles(long, "dval", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], group_cols=["column"])
    agg = agg.join(describe_strings(df, cols).select("column", "top", "freq"), "column", "left") \
        .join(quartiles, "column", "left")
    tmap = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return agg.withColumn("type", tmap[F.col("column")])
