"""Mergeable column profiles and exact top values.

``column_sketches`` makes one row for each column: counts, moments, range, a
HyperLogLog sketch of the distinct values, a KLL sketch of the numbers and a
frequent-items sketch.  The rows are an ordinary table: kept beside the data they
describe, those of new data are merged into them (``merged_sketches``) and the
old data is not read again.

``top_values`` gives the most frequent values with exact counts: a second pass
counts only the values that the frequent-items sketch names, and a bound of the
sketch tells whether a value it does not name could belong to them.  Columns for
which it could (nearly all values equally rare) are counted by 128-bit hashes, so
that long texts are not shuffled for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsfeat.operators.aggregates import numeric_columns
from newsfeat.operators.ranking import materialize

#: Sizes of the sketches: standard error of the distinct count (1.04 / sqrt(2**14)),
#: normalised rank error of a quantile, values tracked for each column.
HLL_BITS = 14
DISTINCT_ERROR = 0.0082
KLL_K = 1000
RANK_ERROR = 0.005
TRACKED = 1024
#: A value that the frequent-items sketch does not name occurs at most in this
#: part of the rows, times ``1 / TRACKED``.
UNTRACKED = 3.5


def _stacked(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, sval, dval)`` rows, one projection."""
    num = set(numeric_columns(df))
    parts = ", ".join(f"'{c}', CAST(`{c}` AS STRING), {f'CAST(`{c}` AS DOUBLE)' if c in num else 'CAST(NULL AS DOUBLE)'}"
                      for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {parts}) AS (column, sval, dval)")


def column_sketches(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A row for each column, one pass with partial aggregation; a table
    without rows gives none."""
    return _stacked(df, list(cols or df.columns)).groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("sval").isNull()).alias("missing"),
        F.count("dval").alias("numbers"), F.min("dval").alias("min"), F.max("dval").alias("max"),
        F.avg("dval").alias("mean"), (F.var_pop("dval") * F.count("dval")).alias("squares"),
        F.hll_sketch_agg("sval", F.lit(HLL_BITS)).alias("distinct_sketch"),
        F.kll_sketch_agg_double("dval", F.lit(KLL_K)).alias("quantile_sketch"),
        F.expr(f"approx_top_k_accumulate(xxhash64(sval), {TRACKED})").alias("frequent"))


def merged_sketches(*tables: DataFrame) -> DataFrame:
    """The sketches of all rows that ``tables`` describe together."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    n, mean = F.col("numbers"), F.col("mean")
    total, weighted = F.sum("numbers"), F.sum(n * mean)
    # between the parts' means and the joint one
    between = F.sum(n * mean * mean) - weighted * F.try_divide(weighted, total)
    return every.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("missing").alias("missing"), total.alias("numbers"), F.min("min").alias("min"),
        F.max("max").alias("max"), F.try_divide(weighted, total).alias("mean"),
        (F.sum("squares") + F.greatest(between, F.lit(0.0))).alias("squares"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"))


def sketch_report(sketches: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``(column, rows, missing, distinct, min, max, mean, std, p25, ...)``:
    distinct counts with a standard error of ``DISTINCT_ERROR``, quantiles with a
    rank error of ``RANK_ERROR``; the rest is exact."""
    # the union with itself estimates by registers alone, so that parts merged and the whole agree
    distinct = F.hll_sketch_estimate(F.hll_union("distinct_sketch", "distinct_sketch"))
    some = F.col("numbers") > 0
    return sketches.select(
        "column", "rows", "missing", distinct.alias("distinct"), "min", "max", "mean",
        F.when(F.col("numbers") > 1, F.sqrt(F.col("squares") / (F.col("numbers") - 1))).alias("std"),
        *[F.when(some, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(p)))).alias(f"p{round(100 * p)}")
          for p in probs])


def _first_k(counted: DataFrame, k: int) -> DataFrame:
    """Spark keeps ``k`` rows a column in every task before they meet."""
    order = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _by_hashes(values: DataFrame, k: int) -> DataFrame:
    """Exact counts through 128-bit hashes; texts move only for the values that
    tie with or beat the ``k``-th count, and at most ``k`` from a task for
    values that occur once."""
    h = [F.xxhash64("value").alias("h1"), F.xxhash64(F.lit(1), F.reverse("value")).alias("h2")]
    cells = materialize(values.select("column", *h).groupBy("column", "h1", "h2").agg(F.count(F.lit(1)).alias("count")), "hash_counts")
    order = Window.partitionBy("column").orderBy(F.desc("count"))
    kth = cells.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k) \
        .groupBy("column").agg(F.min("count").alias("kth"))
    wanted = cells.join(kth, "column").where(F.col("count") >= F.col("kth")).drop("kth")
    found = values.select("column", "value", *h).join(wanted, ["column", "h1", "h2"]).select("column", "value", "count")
    several = found.where("count > 1").distinct()
    return _first_k(several.unionByName(found.where("count = 1")), k)


def top_values(df: DataFrame, cols: Sequence[str], k: int = 5, sketches: DataFrame | None = None) -> DataFrame:
    """``(column, rank, value, count)``, the ``k`` most frequent non-null
    values of each column as strings, ties by value; ``sketches`` of the same
    rows save the first pass."""
    cols = list(cols)
    sketches = materialize(column_sketches(df, cols) if sketches is None else sketches, "sketches")
    named = sketches.select("column", F.explode(F.expr(f"approx_top_k_estimate(frequent, {TRACKED})")).alias("i")) \
        .select("column", F.col("i.item").alias("h"))
    values = _stacked(df, cols).where(F.col("sval").isNotNull()).select("column", F.col("sval").alias("value"))
    # at most TRACKED rows for each column are shipped
    counted = values.withColumn("h", F.xxhash64("value")).join(F.broadcast(named), ["column", "h"]) \
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    top = materialize(_first_k(counted, k), "top_values")
    # proven if the k-th count exceeds what an unnamed value can have, or if all rows are counted
    size = sketches.select("column", (F.col("rows") - F.col("missing")).alias("filled"))
    seen = counted.groupBy("column").agg(F.sum("count").alias("seen"))
    state = top.groupBy("column").agg(F.count(F.lit(1)).alias("found"), F.min("count").alias("kth")).join(size, "column", "right") \
        .join(seen, "column", "left")
    unsure = state.where((F.col("filled") > 0) & (F.coalesce("seen", F.lit(0)) < F.col("filled"))
                         & ~F.coalesce((F.col("found") == k) & (F.col("kth") > F.col("filled") * UNTRACKED / TRACKED), F.lit(False)))
    names = [r[0] for r in unsure.select("column").collect()]  # a row a column at most
    if names:
        top = top.where(~F.col("column").isin(names)).unionByName(_by_hashes(values.where(F.col("column").isin(names)), k))
    return top.select("column", F.col("rank").cast("int").alias("rank"), "value", F.col("count").cast("long").alias("count"))
