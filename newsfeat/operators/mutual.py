"""Mutual information by nearest neighbours, without a pair of rows.

The estimator of Kraskov, Stögbauer and Grassberger in its form for data with
ties (Gao et al. 2017): the distance ``r`` of a row to its ``k``-th nearest
other row in the plane (maximum norm, both columns scaled to unit variance),
then the rows nearer than ``r`` in x alone and in y alone.  Where ``k`` others
are equal to the row, ``r`` is 0 and the equal rows are counted instead, so
ties need no noise.

Rows are aggregated to cells of equal values, whole numbers of ``2**-30``
standard deviations, so that all comparisons are exact.

1. *Bound.*  Cells are range-partitioned by their Morton number; the ``k``
   cells before and behind bound a cell's ``r`` by some ``d``.
2. *Search.*  The square of half side ``d`` touches at most four boxes of side
   ``2**s > 2 d``; it is joined with the cells in them, and only the ``k``
   nearest leave the join's task.  Both sides are shuffled: the cells stand there
   once for every side of a box, which the planner's estimate does not count, so
   that it would take them for small enough to be gathered and broadcast.
3. *Counts* of the rows between two values are differences of running totals
   over the ordered values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsfeat.operators.ranking import cumulative_within, default_partitions, materialize
from newsfeat.operators.stats import one_row, stacked_pair_cells

#: Whole numbers to a standard deviation.
UNIT = 2.0 ** 30
#: Boxes have sides of 2 to a multiple of this.
STEP = 2
_LOW = 31


def digamma(n: Column) -> Column:
    """Digamma of a whole number from 1: the asymptotic series from 8 on."""
    x = n.cast("double")
    z = x + 8
    q = 1 / (z * z)
    series = F.log(z) - 0.5 / z - q * (1 / 12 - q * (1 / 120 - q * (1 / 252 - q * (1 / 240 - q / 132))))
    for i in range(8):
        series = series - 1 / (x + i)
    return series


def _six_digits(v: Column) -> Column:
    """A spread to six digits, so that it does not hang on the order of summation; 1 for 0."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(v)) - 5)
    return F.when(v > 0, F.round(v / power) * power).otherwise(F.lit(1.0))


def _spread_bits(v: Column) -> Column:
    """The low 31 bits of ``v``, with a zero bit between any two."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def _morton(x: Column, y: Column) -> Column:
    low = F.lit((1 << _LOW) - 1)
    halves = [[F.shiftright(v, _LOW), v.bitwiseAND(low)] for v in (x, y)]
    return F.struct(*[F.shiftleft(_spread_bits(a), 1).bitwiseOR(_spread_bits(b)).alias(n)
                      for n, a, b in zip(("hi", "lo"), *halves)])


def _whole_cells(df: DataFrame, xs: list[str], y: str) -> DataFrame:
    """``(_var, _x, _y, _n, _rows, _wide)``: cells in whole numbers from the
    least value on, rows and width of the column pair."""
    cells = stacked_pair_cells(df, xs, y).where(~F.isnan("_x") & ~F.isnan("_y")
                                               & (F.abs("_x") < float("inf")) & (F.abs("_y") < float("inf")))
    cells = materialize(cells, "pair_cells")
    n = F.col("_n").cast("double")
    mean = cells.groupBy("_var").agg(*[(F.sum(n * F.col(c)) / F.sum(n)).alias(f"_m{c}") for c in ("_x", "_y")])
    about = cells.join(mean, "_var").groupBy("_var").agg(
        F.sum("_n").alias("_rows"),
        *[F.min(c).alias(f"_0{c}") for c in ("_x", "_y")],
        *[_six_digits(F.sqrt(F.sum(n * F.pow(F.col(c) - F.col(f"_m{c}"), 2)) / F.sum(n))).alias(f"_s{c}")
          for c in ("_x", "_y")])
    whole = [F.floor((F.col(c) - F.col(f"_0{c}")) / F.col(f"_s{c}") * UNIT).cast("long").alias(c) for c in ("_x", "_y")]
    return cells.join(about, "_var").select("_var", *whole, "_n", "_rows").groupBy("_var", "_x", "_y").agg(
        F.sum("_n").alias("_n"), F.first("_rows").alias("_rows"))


def _distance(x: Column, y: Column) -> Column:
    return F.greatest(F.abs(x - F.col("_x")), F.abs(y - F.col("_y")))


def _bounded(cells: DataFrame, k: int) -> DataFrame:
    """Cells with ``_d``, not less than the distance of the ``k``-th other row."""
    z = cells.withColumn("_z", _morton(F.col("_x"), F.col("_y")))
    z = materialize(z.repartitionByRange(default_partitions(cells), "_var", "_z")
                    .withColumn("_pid", F.spark_partition_id()), "morton")
    wide = z.groupBy("_var").agg(F.greatest(F.max("_x"), F.max("_y")).alias("_wide"))
    w = Window.partitionBy("_pid", "_var").orderBy("_z")
    near = [f(F.struct("_x", "_y"), j).over(w) for f in (F.lag, F.lead) for j in range(1, k + 1)]
    z = z.withColumn("_near", F.array_compact(F.array(*near)))
    steps = F.sort_array(F.transform("_near", lambda o: _distance(o["_x"], o["_y"])))
    found = F.try_element_at(steps, (F.lit(k + 1) - F.col("_n")).cast("int"))
    return z.where(F.col("_n") <= k).join(wide, "_var").select(
        "_var", "_x", "_y", "_n", F.coalesce(found, F.col("_wide")).alias("_d"))


def _radii(cells: DataFrame, k: int) -> DataFrame:
    """``(_var, _x, _y, _r)`` for the cells of at most ``k`` rows."""
    side = F.ceil(F.log2(F.lit(2) * F.col("_d") + 1) / STEP).cast("int") * STEP
    asked = materialize(_bounded(cells, k).withColumn("_s", side), "squares")
    levels = [r[0] for r in asked.select("_s").distinct().collect()]  # at most 32
    if not levels:
        return asked.select("_var", "_x", "_y", F.col("_d").alias("_r"))

    def box(v: Column) -> Column:
        return F.call_function("shiftright", v, F.col("_s"))

    squares = asked.select("_var", "_x", "_y", "_n", "_d", "_s", F.explode(F.sequence(
        box(F.col("_x") - F.col("_d")), box(F.col("_x") + F.col("_d")))).alias("_bx"))
    squares = squares.select("*", F.explode(F.sequence(
        box(F.col("_y") - F.col("_d")), box(F.col("_y") + F.col("_d")))).alias("_by"))
    held = cells.select("_var", F.col("_x").alias("_ox"), F.col("_y").alias("_oy"), F.col("_n").alias("_on"),
                        F.explode(F.array(*[F.lit(s) for s in levels])).alias("_s"))
    held = held.select("*", box(F.col("_ox")).alias("_bx"), box(F.col("_oy")).alias("_by"))
    far = _distance(F.col("_ox"), F.col("_oy"))
    pairs = squares.join(held.hint("merge"), ["_var", "_s", "_bx", "_by"]).where((far <= F.col("_d")) & (far > 0))
    key = ["_var", "_x", "_y", "_n"]
    nearest = Window.partitionBy(*key).orderBy("_r", "_ox", "_oy")
    top = pairs.select(*key, far.alias("_r"), "_ox", "_oy", "_on") \
        .withColumn("_place", F.row_number().over(nearest)).where(F.col("_place") <= k)
    rows = F.sum("_on").over(nearest.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("_n") - 1
    return top.withColumn("_others", rows).where(F.col("_others") >= k).groupBy("_var", "_x", "_y").agg(
        F.min("_r").alias("_r"))


def _strictly_nearer(cells: DataFrame) -> DataFrame:
    """Cells with ``_nx`` and ``_ny``: the rows nearer than ``_r`` in one
    column, or equal in it where ``_r`` is 0, the row itself included."""
    reach = F.greatest(F.col("_r") - 1, F.lit(0))
    key = F.struct("_x", "_y")
    ends = [F.struct(F.lit(c).alias("_dim"), (F.col(c) + end).alias("_v"), F.lit(sign).alias("_sign"))
            for c in ("_x", "_y") for end, sign in ((reach, 1), (-reach - 1, -1))]
    asked = cells.select("_var", key.alias("_cell"), F.explode(F.array(*ends)).alias("_e")) \
        .select("_var", "_e.*", "_cell", F.lit(0).cast("long").alias("_w"))
    held = cells.select("_var", F.explode(F.array(*[F.struct(F.lit(c).alias("_dim"), F.col(c).alias("_v")) for c in ("_x", "_y")]))
                        .alias("_e"), "_n").groupBy("_var", "_e").agg(F.sum("_n").alias("_w")) \
        .select("_var", "_e.*", F.lit(0).alias("_sign"), F.lit(None).cast("struct<_x:long,_y:long>").alias("_cell"), "_w")
    run = cumulative_within(held.unionByName(asked), ["_var", "_dim"], ["_v", F.col("_sign") != 0, "_cell", "_sign"], "_w",
                            cum="_c", total=None)
    amount = F.col("_sign") * F.col("_c")
    return run.where(F.col("_sign") != 0).groupBy("_var", "_cell").agg(
        *[F.sum(F.when(F.col("_dim") == c, amount)).alias(n) for c, n in (("_x", "_nx"), ("_y", "_ny"))]) \
        .select("_var", "_cell.*", "_nx", "_ny")


def knn_mutual_information(df: DataFrame, xs: list[str], y: str, k: int = 3) -> DataFrame:
    """X5 for several x columns at once: one row, one column per x, in nats,
    not below 0; null for a pair with at most ``k`` rows.

    Rows in which x or y is null or not finite are left out for that x; values
    nearer than ``2**-30`` standard deviations can count as equal; a constant
    column has no information."""
    cells = materialize(_whole_cells(df, xs, y), "whole_cells")
    cells = cells.where(F.col("_rows") > k)
    radii = _radii(cells, k)
    at = materialize(cells.join(radii, ["_var", "_x", "_y"], "left").withColumn("_r", F.coalesce("_r", F.lit(0).cast("long"))),
                     "radii")
    equal = F.when(F.col("_r") == 0, F.col("_n")).otherwise(F.lit(k))
    gain = digamma(equal) - digamma(F.col("_nx")) - digamma(F.col("_ny"))
    per = at.join(_strictly_nearer(at), ["_var", "_x", "_y"]).groupBy("_var").agg(
        F.greatest(F.lit(0.0), F.first(digamma(F.col("_rows"))) + F.sum(F.col("_n") * gain) / F.first("_rows")).alias("_mi"))
    return one_row(per, xs, "_mi")
