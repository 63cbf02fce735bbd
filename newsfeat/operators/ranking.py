"""Distributed ordered positions: row numbers, running totals, exact quantiles.

Spark's ``row_number() over (partition by g order by k)`` sends each group to a
single task; a group holding a third of the rows then runs in one task.  The
helpers below never do that:

* The data is **range-partitioned** on ``(group, order)`` keys, so one hot group
  spreads over many partitions (the order key splits it); a ``repartitionByRange``
  with an explicit partition count is not coalesced by AQE.
* Each partition knows the local position of a row (``monotonically_increasing_id``
  after a sort inside the partition) or its local running sum (a window inside
  the partition, over aggregated cells).
* A **small** table of per-(partition, group) totals gives every partition the
  offset of its first row inside the group.  It has at most
  ``partitions + groups`` rows and is joined back.
* The range-partitioned frame is **materialised** (written as a table under
  the session's ``spark.checkpoint.dir``) before it feeds both the totals and
  the join.  Two independently planned range exchanges would sample different
  bounds, and partition ids must agree between the branches; the checkpoint
  also keeps the positions fixed if an executor is lost afterwards.

All order keys passed in must form a total order inside a group (add a unique
column such as ``uri`` as the last key) so that results are deterministic and
stable under task retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str

def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def materialize(df: DataFrame, name: str = "positions") -> DataFrame:
    """Cut the lineage: write ``df`` as a Parquet table under the shared
    ``spark.checkpoint.dir`` and read it back.  One job; the files are
    committed atomically and survive executor loss, and every later branch
    reads the same rows."""
    from newsfeat.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def default_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    conf = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(conf, spark.sparkContext.defaultParallelism)


def _join_offsets(r: DataFrame, stats: DataFrame, group_cols: Sequence[str],
                  broadcast: bool) -> DataFrame:
    ren = {g: f"__g{i}" for i, g in enumerate(group_cols)}
    s = stats.select(F.col("_pid").alias("__pid"),
                     *[F.col(g).alias(a) for g, a in ren.items()],
                     *[c for c in stats.columns if c != "_pid" and c not in ren])
    if broadcast:
        s = F.broadcast(s)
    cond = r["_pid"] == s["__pid"]
    for g, a in ren.items():
        cond = cond & r[g].eqNullSafe(s[a])
    return r.join(s, cond, "inner").drop("__pid", *ren.values())


def row_number_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[ColumnOrName],
                      rn: str = "_rn", size: str | None = "_n", num_partitions: int | None = None) -> DataFrame:
    """Add ``rn`` = exact 1-based row number inside each group following
    ``order_cols`` (and ``size`` = group size), distributed over all tasks.

    Without groups the offsets table has a row for each partition and is
    broadcast; otherwise the join is left to AQE, which goes by measured size.
    """
    group_cols = list(group_cols)
    keys = [_col(g) for g in group_cols] + [_col(o) for o in order_cols]
    n = num_partitions or default_partitions(df)
    r = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    r = materialize(r)
    stats = r.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    by_group = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
    before = by_group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    if size:
        stats = stats.withColumn("_gsize", F.sum("_c").over(by_group))
    out = _join_offsets(r, stats, group_cols, broadcast=not group_cols)
    out = out.withColumn(rn, F.col("_off") + F.col("_mid") - F.col("_m0") + F.lit(1))
    if size:
        out = out.withColumnRenamed("_gsize", size)
    return out.drop("_pid", "_mid", "_c", "_m0", "_off")


def cumulative_within(cells: DataFrame, group_cols: Sequence[str], order_cols: Sequence[ColumnOrName],
                      weight: str | Sequence[str], cum: str | Sequence[str] = "_cum",
                      total: str | Sequence[str] | None = "_total",
                      num_partitions: int | None = None) -> DataFrame:
    """Running (inclusive) sums of ``weight`` column(s) inside each group in
    ``order_cols`` order, plus the group totals.  Meant for aggregated cells
    (one row per distinct value): the exchanges move only the cells, never the
    raw rows.  One plan for every size: cells are range-partitioned and written
    with their partition's number, a window sums inside each (partition,
    group), and the totals of the partitions before are added."""
    weights = [weight] if isinstance(weight, str) else list(weight)
    cums = [cum] if isinstance(cum, str) else list(cum)
    totals = None if total is None else ([total] if isinstance(total, str) else list(total))
    group_cols = list(group_cols)
    keys = [_col(g) for g in group_cols] + [_col(o) for o in order_cols]
    n = num_partitions or default_partitions(cells)
    r = materialize(cells.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()), "cells")
    stats = r.groupBy("_pid", *group_cols).agg(*[F.sum(w).alias(f"_ps{i}") for i, w in enumerate(weights)])
    by_group = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
    before = by_group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    for i in range(len(weights)):
        stats = stats.withColumn(f"_off{i}", F.coalesce(F.sum(f"_ps{i}").over(before), F.lit(0)))
        if totals:
            stats = stats.withColumn(f"_gtotal{i}", F.sum(f"_ps{i}").over(by_group))
    here = Window.partitionBy("_pid", *group_cols).orderBy(*[_col(o) for o in order_cols]) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = r.withColumns({f"_lcum{i}": F.sum(w).over(here) for i, w in enumerate(weights)})
    out = _join_offsets(r, stats, group_cols, broadcast=not group_cols)
    for i in range(len(weights)):
        out = out.withColumn(cums[i], F.col(f"_off{i}") + F.col(f"_lcum{i}"))
        if totals:
            out = out.withColumnRenamed(f"_gtotal{i}", totals[i])
        out = out.drop(f"_lcum{i}", f"_ps{i}", f"_off{i}")
    return out.drop("_pid")


def value_cells(df: DataFrame, value: ColumnOrName, group_cols: Sequence[str] = (),
                name: str = "_v", weight: str = "_w") -> DataFrame:
    """Distinct (group, value) cells with their row counts; nulls dropped.
    The aggregation is partial (map-side), so hot values collapse early."""
    v = _col(value)
    return (df.select(*group_cols, v.alias(name)).where(F.col(name).isNotNull())
            .groupBy(*group_cols, name).agg(F.count(F.lit(1)).alias(weight)))


def average_ranks(cells: DataFrame, group_cols: Sequence[str] = (), value: str = "_v",
                  weight: str = "_w", out: str = "_rank") -> DataFrame:
    """Average (tie-corrected) 1-based rank of each distinct value, as
    ``scipy.stats.rankdata(method='average')`` / SQL ``rank`` with ties averaged."""
    c = cumulative_within(cells, group_cols, [value], weight, cum="_cum", total="_total")
    return c.withColumn(out, F.col("_cum") - (F.col(weight) - F.lit(1)) / F.lit(2.0)).drop("_cum")


#: Rank error of the quantile sketch, as a part of a group's rows; of smaller
#: groups all values are kept.
SKETCH_ACCURACY = 1000


def bracketed_cells(df: DataFrame, value: ColumnOrName, probs: Sequence[float],
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Cells ``(group, _v, _beside, _w)`` that keep the order statistics of
    ``probs``: a mergeable sketch brackets each of them by two values, one
    counting pass keeps the values inside the brackets and sums up the rows of
    each gap between them in one cell (``_beside`` 1, behind the bracket below
    it).  About ``4 / SKETCH_ACCURACY`` of the rows of a group lie inside a
    bracket, so hardly anything is sorted or written."""
    group_cols = list(group_cols)
    vals = df.select(*group_cols, _col(value).alias("_v")).where(F.col("_v").isNotNull())
    slack = 2 / SKETCH_ACCURACY
    ends = [F.lit(min(1.0, max(0.0, p + d))) for p in probs for d in (-slack, slack)]
    n = F.count(F.lit(1))
    sketched = F.percentile_approx("_v", F.array(*ends), F.lit(SKETCH_ACCURACY))
    whole = F.array(*[F.min("_v"), F.max("_v")] * len(probs))
    # ranks are rounded to whole rows, which matters in small groups
    ends = materialize(vals.groupBy(*group_cols).agg(F.when(n <= SKETCH_ACCURACY, whole).otherwise(sketched).alias("_e")),
                       "brackets")
    if group_cols:
        named = ends.select("_e", *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group_cols)])
        same = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group_cols)]
        vals = vals.join(named, same).select(*group_cols, "_v", "_e")
    else:
        vals = vals.withColumn("_e", ends.select("_e").scalar())
    v, lo, hi = F.col("_v"), [F.col("_e")[2 * i] for i in range(len(probs))], [F.col("_e")[2 * i + 1] for i in range(len(probs))]
    inside = F.lit(False)
    for a, b in zip(lo, hi):
        inside = inside | ((v >= a) & (v <= b))
    below = [F.when(v > b, b) for b in hi]
    gap = F.greatest(*below) if len(below) > 1 else below[0]
    return vals.select(*group_cols, F.when(inside, v).otherwise(gap).alias("_v"), (~inside).cast("int").alias("_beside")) \
        .groupBy(*group_cols, "_v", "_beside").agg(F.count(F.lit(1)).alias("_w"))


def _order_statistics(cells: DataFrame, probs: Sequence[float], names: Sequence[str],
                      group_cols: Sequence[str]) -> DataFrame:
    """Per group the rows, and for each quantile its place and the values at
    the whole places below and above; null where these are in no kept cell."""
    c = cumulative_within(cells, group_cols, ["_v", "_beside"], "_w", cum="_cum", total="_total")
    c = c.withColumn("_start", F.col("_cum") - F.col("_w"))
    aggs = [F.max("_total").alias("_total")]
    kept = F.col("_beside") == 0
    for p, nm in zip(probs, names):
        pos = (F.col("_total") - 1) * F.lit(float(p))
        c = c.withColumn(f"_{nm}_pos", pos)
        for end, place in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            c = c.withColumn(f"_{nm}_{end}", F.when(kept & (F.col("_start") <= place) & (place < F.col("_cum")), F.col("_v")))
        aggs += [F.max(f"_{nm}_{x}").alias(f"_{nm}_{x}") for x in ("lo", "hi", "pos")]
    return materialize(c.groupBy(*group_cols).agg(*aggs), "quantiles")


def exact_quantiles(df: DataFrame, value: ColumnOrName, probs: Sequence[float],
                    names: Sequence[str] | None = None, group_cols: Sequence[str] = (),
                    count_name: str | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (numpy/pandas ``linear``, SQL
    ``quantile_cont``) per group; a group without values has no row, an
    ungrouped column without values a row of nulls.

    A sketch brackets the order statistics, and they are selected exactly among
    the cells inside the brackets (``bracketed_cells``).  Should a sketch miss
    one, which is seen from the counts, the distinct values of all groups are
    counted instead."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    group_cols = list(group_cols)
    g = _order_statistics(bracketed_cells(df, value, probs, group_cols), probs, names, group_cols)
    missed = F.lit(False)
    for nm in names:
        missed = missed | F.col(f"_{nm}_lo").isNull() | F.col(f"_{nm}_hi").isNull()
    if not g.where(F.col("_total").isNotNull() & missed).isEmpty():
        cells = value_cells(df, value, group_cols).withColumn("_beside", F.lit(0))
        g = _order_statistics(cells, probs, names, group_cols)
    if count_name:
        g = g.withColumnRenamed("_total", count_name)
    for nm in names:
        lo, hi, pos = F.col(f"_{nm}_lo"), F.col(f"_{nm}_hi"), F.col(f"_{nm}_pos")
        g = g.withColumn(nm, lo.cast("double") + (hi.cast("double") - lo.cast("double")) * (pos - F.floor(pos)))
        g = g.drop(f"_{nm}_lo", f"_{nm}_hi", f"_{nm}_pos")
    return g.drop("_total")
