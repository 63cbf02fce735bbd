"""Statistics suite: correlations, variance and rank tests.

Every statistic is computed from aggregated *cells* — ``(group, value)`` or
``(x, y)`` with a count — so hot values collapse map-side and ranks are
exact without a global sort in one task (see ``ranking``).  Results are
one-row DataFrames; p-values are applied to that row by an Arrow UDF.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfeat.functions import distributions as D
from newsfeat.operators.ranking import average_ranks, cumulative_within, materialize


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------- correlations

def pearson(df: DataFrame, x: str, y: str, name: str = "pearson") -> DataFrame:
    """Pearson r over pairs where both values are present; null if one of
    them is constant or there are no pairs."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    both = a.isNotNull() & b.isNotNull()
    spread = F.stddev_pop(F.when(both, a)) * F.stddev_pop(F.when(both, b))
    return df.agg(F.try_divide(F.covar_pop(a, b), spread).alias(name))


def stacked_pair_cells(df: DataFrame, xs: list[str], y: str) -> DataFrame:
    """``(_var, _x, _y, _n)`` cells for several x columns against one y,
    stacked so that one pass of every later step serves all of them."""
    pairs = ", ".join(f"'{x}', CAST(`{x}` AS DOUBLE)" for x in xs)
    long = df.selectExpr(f"stack({len(xs)}, {pairs}) AS (_var, _x)", f"CAST(`{y}` AS DOUBLE) AS _y")
    return (long.where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
            .groupBy("_var", "_x", "_y").agg(F.count(F.lit(1)).alias("_n")))


def one_row(per_var: DataFrame, xs: list[str], value: str) -> DataFrame:
    """(_var, value) rows -> one row with a column per variable."""
    return per_var.groupBy().pivot("_var", list(xs)).agg(F.first(value))


def spearman_many(df: DataFrame, xs: list[str], y: str) -> DataFrame:
    """X3 for several x columns at once: one row, one column per x.

    The pair cells ``(x, y, n)`` are written once.  x ranks come from the x
    marginal and are attached to the cells; the cells are then aggregated to
    the y marginal carrying ``sum(n * rank_x)`` per y, so ranking y yields
    every term of the weighted Pearson sums without joining the y ranks back
    onto the cells (``sum(n * rx * ry) = sum_y ry * sum(n * rx)``)."""
    cells = materialize(stacked_pair_cells(df, xs, y), "pair_cells")
    mx = cells.groupBy("_var", "_x").agg(F.sum("_n").alias("_w"))
    rx = average_ranks(mx, ["_var"], "_x", "_w", "_rx").select("_var", "_x", "_w", "_rx")
    W = F.col("_w").cast("double")
    sx = rx.groupBy("_var").agg(F.sum(W * F.col("_rx")).alias("sa"),
                                F.sum(W * F.col("_rx") * F.col("_rx")).alias("saa"))
    my = (cells.join(rx.select("_var", "_x", "_rx"), ["_var", "_x"])
          .groupBy("_var", "_y").agg(F.sum("_n").alias("_w"),
                                     F.sum(F.col("_n").cast("double") * F.col("_rx")).alias("_srx")))
    ry = average_ranks(my, ["_var"], "_y", "_w", "_ry")
    B = F.col("_ry")
    sy = ry.groupBy("_var").agg(F.sum(W).alias("n"), F.sum(W * B).alias("sb"), F.sum(W * B * B).alias("sbb"),
                                F.sum(B * F.col("_srx")).alias("sab"))
    s_ = sy.join(sx, "_var")
    cov = F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")
    va = F.col("saa") - F.col("sa") * F.col("sa") / F.col("n")
    vb = F.col("sbb") - F.col("sb") * F.col("sb") / F.col("n")
    return one_row(s_.select("_var", F.try_divide(cov, F.sqrt(F.greatest(va * vb, F.lit(0.0)))).alias("_rho")), xs, "_rho")


def spearman(df: DataFrame, x: str, y: str, name: str = "spearman") -> DataFrame:
    """Pearson correlation of average ranks (pairs with a null dropped,
    trap T12).  Ranks come from the marginal cells; the correlation is a
    weighted sum over the (x, y) cells, never over re-joined raw rows."""
    return spearman_many(df, [x], y).withColumnRenamed(x, name)


def kendall_many(df: DataFrame, xs: list[str], y: str) -> DataFrame:
    """X4 for several x columns at once (see ``kendall_tau_b``); the pair
    cells are written once and read by every later step."""
    cells = materialize(stacked_pair_cells(df, xs, y), "pair_cells")
    xd = cells.select("_var", "_x").distinct().withColumn("_one", F.lit(1))
    xr = cumulative_within(xd, ["_var"], ["_x"], "_one", cum="_r", total="_dx").select("_var", "_x", (F.col("_r") - 1).alias("_r"), "_dx")
    c = cells.join(xr, ["_var", "_x"])
    levels = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.log2(F.col("_dx").cast("double"))).cast("int") - 1))
    lv = (c.withColumn("_lvl", F.explode(levels))
          .withColumn("_block", F.expr("shiftright(_r, _lvl + 1)"))
          .withColumn("_half", F.expr("shiftright(_r, _lvl) & 1"))
          .withColumn("_lw", F.when(F.col("_half") == 0, F.col("_n")).otherwise(F.lit(0)))
          .withColumn("_tie", F.lit(1) - F.col("_half")))
    cum = cumulative_within(lv, ["_var", "_lvl", "_block"], ["_y", "_tie", "_x"], "_lw", cum="_below_incl",
                            total="_left_total")
    # at a right-half row (half = 1, ordered before left rows of equal y) the
    # running left weight counts only left cells with y' < y; summed over the
    # right rows, the left weight at equal y is a product of two sums per y
    n, half = F.col("_n").cast("double"), F.col("_half")
    strict = cum.where(half == 1).groupBy("_var").agg(
        F.sum(n * (2 * F.col("_below_incl") - F.col("_left_total"))).alias("_s"))
    at_y = cum.groupBy("_var", "_lvl", "_block", "_y").agg(F.sum(n * half).alias("_right"), F.sum(n * (1 - half)).alias("_left"))
    ties = at_y.groupBy("_var").agg(F.sum(F.col("_right") * F.col("_left")).alias("_e"))
    S = strict.join(ties, "_var").select("_var", (F.col("_s") + F.col("_e")).alias("_S"))
    tot = cells.groupBy("_var").agg(F.sum("_n").cast("double").alias("_tot_n"))
    tx = cells.groupBy("_var", "_x").agg(F.sum("_n").cast("double").alias("_t")).groupBy("_var").agg(
        F.sum(F.col("_t") * (F.col("_t") - 1) / 2).alias("_n1"))
    ty = cells.groupBy("_var", "_y").agg(F.sum("_n").cast("double").alias("_t")).groupBy("_var").agg(
        F.sum(F.col("_t") * (F.col("_t") - 1) / 2).alias("_n2"))
    n0 = F.col("_tot_n") * (F.col("_tot_n") - 1) / 2
    per = (tot.join(S, "_var", "left").join(tx, "_var").join(ty, "_var")
           .select("_var", F.try_divide(F.coalesce(F.col("_S"), F.lit(0.0)),
                                         F.sqrt((n0 - F.col("_n1")) * (n0 - F.col("_n2")))).alias("_tau")))
    return one_row(per, xs, "_tau")


def kendall_tau_b(df: DataFrame, x: str, y: str, name: str = "kendall") -> DataFrame:
    """Kendall tau-b, exact, in O(cells * log distinct(x)) without pairs.

    Give every distinct x its dense rank ``r``.  Any two cells with
    different x are separated at exactly one bit level ``L``: they share the
    block ``r >> (L+1)`` and sit in different halves ``(r >> L) & 1``.  So
    ``S = concordant - discordant`` is, summed over levels and blocks, the
    right-half cells' weight times (left-half weight below y minus left-half
    weight above y).  One ``cumulative_within`` over the cells replicated per
    level (grouped by (level, block), ordered by y with right-half rows first
    on equal y) gives "left weight strictly below y" for every right-half
    cell.  Ties in x never split; ties in y contribute 0.
    ``tau_b = S / sqrt((n0 - n1) (n0 - n2))``.
    """
    return kendall_many(df, [x], y).withColumnRenamed(x, name)


def binned_mutual_information(df: DataFrame, x: str, y: str, bins: int = 10, name: str = "mutual_info") -> DataFrame:
    """X5 (re-aimed): plug-in mutual information in nats over equal-width
    bins of x and y, ``sum p_xy ln(p_xy / (p_x p_y))``; pairs with a null
    dropped.  One aggregation for the ranges, one for the bin cells."""
    base = (df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
            .where(F.col("_x").isNotNull() & F.col("_y").isNotNull()))
    rng = base.agg(F.min("_x").alias("_x0"), F.max("_x").alias("_x1"),
                   F.min("_y").alias("_y0"), F.max("_y").alias("_y1"), F.count(F.lit(1)).alias("_tot_n"))

    def binof(v, lo, hi):
        w = F.col(hi) - F.col(lo)
        return F.when(w == 0, F.lit(0)).otherwise(
            F.least(F.floor((F.col(v) - F.col(lo)) / w * F.lit(bins)).cast("int"), F.lit(bins - 1)))

    r = rng.select(F.struct(*rng.columns).alias("r")).scalar()  # one-row subquery
    base = base.select("_x", "_y", *[r.getField(c).alias(c) for c in rng.columns])
    b = base.select(binof("_x", "_x0", "_x1").alias("_bx"), binof("_y", "_y0", "_y1").alias("_by"), "_tot_n")
    cells = b.groupBy("_bx", "_by", "_tot_n").agg(F.count(F.lit(1)).alias("_nxy"))
    px = cells.groupBy("_bx").agg(F.sum("_nxy").alias("_nx"))
    py = cells.groupBy("_by").agg(F.sum("_nxy").alias("_ny"))
    j = cells.join(px, "_bx").join(py, "_by")
    term = (F.col("_nxy") / F.col("_tot_n")) * F.log((F.col("_nxy") * F.col("_tot_n")) / (F.col("_nx") * F.col("_ny")))
    return j.agg(F.sum(term).alias(name))


# ----------------------------------------------------------------- group tests

def anova_oneway(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way ANOVA F over groups (nulls dropped).  Per-group count,
    mean and (stable) sample variance in one aggregation; SSW from the
    variances and SSB from the group means around the grand mean."""
    g = (df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
         .groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.avg(F.col(value).cast("double")).alias("_m"),
                             F.coalesce(F.var_samp(F.col(value).cast("double")), F.lit(0.0)).alias("_v")))
    tot = g.agg(F.sum("_n").alias("_tot_n"), (F.sum(F.col("_n") * F.col("_m")) / F.sum("_n")).alias("_gm"),
                F.count(F.lit(1)).alias("_k"))
    t = tot.select(F.struct(*tot.columns).alias("t")).scalar()  # one-row subquery
    j = g.select("*", *[t.getField(c).alias(c) for c in tot.columns])
    s = j.groupBy("_tot_n", "_k").agg(
        F.sum(F.col("_n") * F.pow(F.col("_m") - F.col("_gm"), 2)).alias("_ssb"),
        F.sum((F.col("_n") - 1) * F.col("_v")).alias("_ssw"))
    f = F.try_divide(F.try_divide(F.col("_ssb"), F.col("_k") - 1),
                     F.try_divide(F.col("_ssw"), F.col("_tot_n") - F.col("_k")))
    return s.select(f.alias("f_stat"), (F.col("_k") - 1).cast("long").alias("df_between"),
                    (F.col("_tot_n") - F.col("_k")).cast("long").alias("df_within"))


def kruskal_wallis(df: DataFrame, group: str, value: str) -> DataFrame:
    """Kruskal-Wallis H with tie correction.  Average ranks of the
    distinct values (two-level, distributed) are joined to the
    (group, value) cells, never to raw rows; rank sums per group follow."""
    cells = materialize(df.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"))
                        .where(F.col("_g").isNotNull() & F.col("_v").isNotNull())
                        .groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_n")), "group_cells")
    marg = cells.groupBy("_v").agg(F.sum("_n").alias("_w"))
    ranks = average_ranks(marg, (), "_v", "_w", "_rank")
    j = cells.join(ranks.select("_v", "_rank", "_w"), "_v")
    per = j.groupBy("_g").agg(F.sum(F.col("_n") * F.col("_rank")).alias("_R"), F.sum("_n").alias("_ng"))
    ssum = per.agg(F.sum(F.col("_R") * F.col("_R") / F.col("_ng")).alias("_s"), F.sum("_ng").alias("_tot_n"),
                   F.count(F.lit(1)).alias("_k"))
    ties = marg.agg(F.sum(F.pow(F.col("_w").cast("double"), 3) - F.col("_w")).alias("_t"))
    N = F.col("_tot_n").cast("double")
    h = F.try_divide(F.try_divide(F.lit(12.0), N * (N + 1)) * F.col("_s") - 3 * (N + 1),
                     F.lit(1.0) - F.try_divide(F.col("_t"), N * N * N - N))
    return ssum.withColumn("_t", ties.scalar()).select(h.alias("h_stat"),
                                                        (F.col("_k") - 1).cast("long").alias("dof"))


def welch_t(df: DataFrame, flag: Column, value: str) -> DataFrame:
    """Welch two-sample t statistic and Welch-Satterthwaite degrees of
    freedom, ``flag`` true vs false, in one pass of conditional aggregates."""
    v = F.col(value).cast("double")
    s = df.where(v.isNotNull() & flag.isNotNull()).agg(
        F.count_if(flag).alias("n1"), F.avg(F.when(flag, v)).alias("m1"), F.var_samp(F.when(flag, v)).alias("v1"),
        F.count_if(~flag).alias("n2"), F.avg(F.when(~flag, v)).alias("m2"), F.var_samp(F.when(~flag, v)).alias("v2"))
    a, b = F.try_divide("v1", "n1"), F.try_divide("v2", "n2")
    t = F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(a + b))
    dof = F.try_divide((a + b) * (a + b), F.try_divide(a * a, F.col("n1") - 1) + F.try_divide(b * b, F.col("n2") - 1))
    return s.select(t.alias("t_stat"), dof.alias("dof"), "n1", "n2")


# ----------------------------------------------------------------- p-values

def with_p_value(df: DataFrame, kind: str, stat: str, dof1: str, dof2: str | None = None,
                 out: str = "p_value", alpha: float | None = None) -> DataFrame:
    """Upper-tail p-value of a one-row statistic, evaluated by an Arrow
    UDF on that row (``kind`` in f, chi2, t2 for a two-sided t)."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def _p(s: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
        vals = []
        for a, b, c in zip(s, d1, d2):
            if a is None or b is None or (isinstance(a, float) and math.isnan(a)):
                vals.append(float("nan"))
            elif kind == "f":
                vals.append(D.f_sf(float(a), float(b), float(c)))
            elif kind == "chi2":
                vals.append(D.chi2_sf(float(a), float(b)))
            elif kind == "t2":
                vals.append(2.0 * D.t_sf(abs(float(a)), float(b)))
            else:
                raise ValueError(kind)
        return pd.Series(vals, dtype="float64")

    d2col = F.col(dof2).cast("double") if dof2 else F.lit(0.0)
    out_df = df.withColumn(out, _p(F.col(stat).cast("double"), F.col(dof1).cast("double"), d2col))
    if alpha is not None:
        out_df = out_df.withColumn("significant", F.col(out) < F.lit(alpha))
    return out_df
