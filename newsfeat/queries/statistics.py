"""Statistics queries (X1-X10, V2) with DuckDB oracles.  Statistics are
rounded to 9 decimals on both sides."""

from __future__ import annotations


from pyspark.sql import functions as F

from newsfeat.functions import dates as Dt
from newsfeat.operators import prepare as prep
from newsfeat.operators import stats as X
from newsfeat.operators.mutual import knn_mutual_information
from newsfeat.operators.ranking import average_ranks, value_cells
from newsfeat.queries import sql as S
from newsfeat.queries.common import table
from newsfeat.queries.exploration import RANK_COLS, unscaled
from newsfeat.queries.registry import query

R = 9


def _round_all(df):
    return df.select(*[F.round(F.col(c), R).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _per_column(fn, df, cols, target):
    """One-row frame with one statistic column per input column."""
    parts = [fn(df, c, target) for c in cols]
    first = parts[0].select(F.col(_stat_name(fn)).alias(cols[0]))
    return first.select("*", *[p.scalar().alias(c) for p, c in zip(parts[1:], cols[1:])])


def _stat_name(fn):
    return {"pearson": "pearson", "spearman": "spearman", "kendall_tau_b": "kendall",
            "binned_mutual_information": "mutual_info"}[fn.__name__]


# ----------------------------------------------------------------- X1

@query("x1_robust_fit", S.with_(S.PREPARED_UNSCALED, f"""
SELECT round(q50, {R}) AS center, round(CASE WHEN q75 - q25 = 0 THEN 1 ELSE q75 - q25 END, {R}) AS scale FROM (
  SELECT quantile_cont(sharesFacebook, 0.25) AS q25, quantile_cont(sharesFacebook, 0.5) AS q50,
         quantile_cont(sharesFacebook, 0.75) AS q75 FROM prepared_unscaled)"""))
def x1_robust_fit(spark, sf_dir):
    return _round_all(prep.robust_fit(unscaled(spark, sf_dir), "sharesFacebook"))


@query("x1_robust_scale_orders", f"""
SELECT o_orderkey, round((o_totalprice - q50) / CASE WHEN q75 - q25 = 0 THEN 1 ELSE q75 - q25 END, {R}) AS price_scaled
FROM orders, (SELECT quantile_cont(o_totalprice, 0.25) AS q25, quantile_cont(o_totalprice, 0.5) AS q50,
                     quantile_cont(o_totalprice, 0.75) AS q75 FROM orders)""")
def x1_robust_scale_orders(spark, sf_dir):
    """X1 at scale: fit on ``orders.o_totalprice`` (15k distinct values at
    sf0.01) and apply to every order."""
    o = table(spark, sf_dir, "orders")
    fit = prep.robust_fit(o, "o_totalprice")
    return _round_all(prep.robust_apply(o, fit, "o_totalprice", "price_scaled").select("o_orderkey", "price_scaled"))


# ----------------------------------------------------------------- X2-X5

def _pairs_sql(src, x, y):
    return (f"(SELECT cast({x} AS DOUBLE) AS x, cast({y} AS DOUBLE) AS y FROM {src} "
            f"WHERE {x} IS NOT NULL AND {y} IS NOT NULL)")


def _spearman_sql(src, x, y):
    return f"""(SELECT corr(rx, ry) FROM (
    SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
           rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
    FROM {_pairs_sql(src, x, y)}))"""


def _kendall_sql(src, x, y):
    p = _pairs_sql(src, x, y)
    return f"""(SELECT s / sqrt((n0 - n1) * (n0 - n2)) FROM
    (SELECT sum(a.n * b.n * sign(b.y - a.y)) AS s
       FROM (SELECT x, y, count(*) AS n FROM {p} GROUP BY x, y) a
       JOIN (SELECT x, y, count(*) AS n FROM {p} GROUP BY x, y) b ON a.x < b.x),
    (SELECT count(*) * (count(*) - 1) / 2.0 AS n0 FROM {p}),
    (SELECT sum(t * (t - 1) / 2.0) AS n1 FROM (SELECT count(*) AS t FROM {p} GROUP BY x)),
    (SELECT sum(t * (t - 1) / 2.0) AS n2 FROM (SELECT count(*) AS t FROM {p} GROUP BY y)))"""


def _mi_sql(src, x, y, bins=10):
    p = _pairs_sql(src, x, y)
    b = lambda v, lo, hi: (f"CASE WHEN {hi} = {lo} THEN 0 ELSE least(cast(floor(({v} - {lo}) / ({hi} - {lo}) * {bins}) "
                           f"AS INTEGER), {bins - 1}) END")
    return f"""(SELECT sum(nxy / N * ln(nxy * N / (nx * ny))) FROM (
    SELECT xb, yb, count(*) AS nxy, any_value(N) AS N FROM (
      SELECT {b('x', 'x0', 'x1')} AS xb, {b('y', 'y0', 'y1')} AS yb, N
      FROM {p}, (SELECT min(x) x0, max(x) x1, min(y) y0, max(y) y1, count(*) N FROM {p})) GROUP BY xb, yb) c
    JOIN (SELECT xb, count(*) AS nx FROM (SELECT {b('x', 'x0', 'x1')} AS xb FROM {p}, (SELECT min(x) x0, max(x) x1 FROM {p})) GROUP BY xb) USING (xb)
    JOIN (SELECT yb, count(*) AS ny FROM (SELECT {b('y', 'y0', 'y1')} AS yb FROM {p}, (SELECT min(y) y0, max(y) y1 FROM {p})) GROUP BY yb) USING (yb))"""


def _row_sql(fn, cols, target, src="prepared_unscaled"):
    return "SELECT " + ", ".join(f"round({fn(src, c, target)}, {R}) AS {c}" for c in cols)


@query("x2_pearson", S.with_(S.PREPARED_UNSCALED, "SELECT " + ", ".join(
    f"round(corr({c}, sharesFacebook), {R}) AS {c}" for c in RANK_COLS) + " FROM prepared_unscaled"))
def x2_pearson(spark, sf_dir):
    return _round_all(_per_column(X.pearson, unscaled(spark, sf_dir), RANK_COLS, "sharesFacebook"))


@query("x3_spearman", S.with_(S.PREPARED_UNSCALED, _row_sql(_spearman_sql, RANK_COLS, "sharesFacebook")))
def x3_spearman(spark, sf_dir):
    return _round_all(X.spearman_many(unscaled(spark, sf_dir), RANK_COLS, "sharesFacebook"))


@query("x3_spearman_lineitem", "SELECT " + ", ".join(
    f"round({_spearman_sql('lineitem', c, 'l_extendedprice')}, {R}) AS {c}" for c in ["l_quantity", "l_discount"]))
def x3_spearman_lineitem(spark, sf_dir):
    """X3 at scale on ``lineitem`` (quantity has 50 distinct values: ties)."""
    li = table(spark, sf_dir, "lineitem")
    return _round_all(X.spearman_many(li, ["l_quantity", "l_discount"], "l_extendedprice"))


@query("x4_kendall", S.with_(S.PREPARED_UNSCALED, _row_sql(_kendall_sql, RANK_COLS, "sharesFacebook")))
def x4_kendall(spark, sf_dir):
    return _round_all(X.kendall_many(unscaled(spark, sf_dir), RANK_COLS, "sharesFacebook"))


@query("x5_mutual_info", S.with_(S.PREPARED_UNSCALED, _row_sql(_mi_sql, RANK_COLS, "sharesFacebook")))
def x5_mutual_info(spark, sf_dir):
    return _round_all(_per_column(X.binned_mutual_information, unscaled(spark, sf_dir), RANK_COLS, "sharesFacebook"))


@query("x5_mutual_info_lineitem", "SELECT " + f"round({_mi_sql('lineitem', 'l_quantity', 'l_extendedprice')}, {R}) AS l_quantity")
def x5_mutual_info_lineitem(spark, sf_dir):
    """X5 at scale: binned MI of quantity and price on ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    return _round_all(X.binned_mutual_information(li, "l_quantity", "l_extendedprice").withColumnRenamed(
        "mutual_info", "l_quantity"))


def _knn_sql(src, x, y, k=3):
    """All pairs of rows; digamma of a whole number from a table of harmonic sums."""
    def unit(c):
        power = f"pow(10.0, floor(log10(s{c})) - 5)"
        return f"cast(floor(({c} - {c}0) / CASE WHEN s{c} > 0 THEN round(s{c} / {power}) * {power} ELSE 1 END * 1073741824.0) AS BIGINT)"
    p = _pairs_sql(src, x, y)
    return f"""(SELECT CASE WHEN any_value(tot) > {k} THEN greatest(0, any_value(a.g) + avg(b.g - c.g - d.g)) END FROM (
      SELECT i, any_value(tot) AS tot, any_value(CASE WHEN r = 0 THEN same ELSE {k} END) AS kk,
             count(*) FILTER (WHERE dx < r OR dx = 0) AS nx, count(*) FILTER (WHERE dy < r OR dy = 0) AS ny FROM (
        SELECT i, dx, dy, tot, count(*) FILTER (WHERE greatest(dx, dy) = 0) OVER (PARTITION BY i) AS same,
               nth_value(greatest(dx, dy), {k + 1}) OVER (PARTITION BY i ORDER BY greatest(dx, dy)
                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS r FROM (
          SELECT u.i, abs(u.x - v.x) AS dx, abs(u.y - v.y) AS dy, u.tot FROM _W u, _W v)) GROUP BY i) e
    JOIN _H a ON a.n = tot JOIN _H b ON b.n = kk JOIN _H c ON c.n = nx JOIN _H d ON d.n = ny)""".replace(
        "_W", f"(SELECT row_number() OVER () AS i, {unit('x')} AS x, {unit('y')} AS y, tot FROM {p}, "
              f"(SELECT min(x) AS x0, min(y) AS y0, stddev_pop(x) AS sx, stddev_pop(y) AS sy, count(*) AS tot FROM {p}))").replace(
        "_H", "(SELECT n, -0.57721566490153286 + sum(CASE WHEN n > 1 THEN 1.0::DOUBLE / (n - 1) ELSE 0 END) OVER (ORDER BY n) AS g "
              "FROM (SELECT unnest(range(1, 100000)) AS n))")


@query("x5_knn_mutual_info", S.with_(S.PREPARED_UNSCALED, _row_sql(_knn_sql, RANK_COLS, "sharesFacebook")))
def x5_knn_mutual_info(spark, sf_dir):
    """X5 by nearest neighbours, as the survey's operator: ranks against shares."""
    return _round_all(knn_mutual_information(unscaled(spark, sf_dir), RANK_COLS, "sharesFacebook"))


@query("x5_knn_mutual_info_part", "SELECT " + f"round({_knn_sql('part', 'p_size', 'p_retailprice')}, {R}) AS p_size")
def x5_knn_mutual_info_part(spark, sf_dir):
    """X5 of few distinct values against a price."""
    return _round_all(knn_mutual_information(table(spark, sf_dir, "part"), ["p_size"], "p_retailprice"))


# ----------------------------------------------------------------- X6-X8

def _anova_sql(src, g, x):
    return f"""
SELECT round((ssb / (k - 1)) / (ssw / (tot_n - k)), {R}) AS f_stat, cast(k - 1 AS BIGINT) AS df_between,
       cast(tot_n - k AS BIGINT) AS df_within FROM
 (SELECT sum(n * pow(m - gm, 2)) AS ssb, any_value(tot_n) AS tot_n, any_value(k) AS k FROM
   (SELECT {g} AS g, count(*) AS n, avg(cast({x} AS DOUBLE)) AS m FROM {src} WHERE {x} IS NOT NULL AND {g} IS NOT NULL GROUP BY 1),
   (SELECT count(*) AS tot_n, avg(cast({x} AS DOUBLE)) AS gm, count(DISTINCT {g}) AS k FROM {src} WHERE {x} IS NOT NULL AND {g} IS NOT NULL)),
 (SELECT sum(pow(cast({x} AS DOUBLE) - m, 2)) AS ssw FROM {src}
    JOIN (SELECT {g} AS g, avg(cast({x} AS DOUBLE)) AS m FROM {src} WHERE {x} IS NOT NULL GROUP BY 1) ON {g} = g
  WHERE {x} IS NOT NULL)"""


@query("x6_anova", S.with_(S.PREPARED_UNSCALED, _anova_sql("prepared_unscaled", "topic", "sharesFacebook")))
def x6_anova(spark, sf_dir):
    return _round_all(X.anova_oneway(unscaled(spark, sf_dir), "topic", "sharesFacebook"))


@query("x6_anova_orders", _anova_sql("orders", "o_orderpriority", "o_totalprice"))
def x6_anova_orders(spark, sf_dir):
    """X6 at scale: price across order priorities."""
    return _round_all(X.anova_oneway(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice"))


def _kruskal_sql(src, g, x):
    return f"""
SELECT round((12.0 / (N * (N + 1)) * s - 3 * (N + 1)) / (1 - t / (N * N * N - N)), {R}) AS h_stat,
       cast(k - 1 AS BIGINT) AS dof FROM
 (SELECT sum(R * R / ng) AS s, sum(ng) AS N, count(*) AS k FROM
   (SELECT g, sum(r) AS R, count(*) AS ng FROM
     (SELECT {g} AS g, rank() OVER (ORDER BY cast({x} AS DOUBLE)) + (count(*) OVER (PARTITION BY cast({x} AS DOUBLE)) - 1) / 2.0 AS r
      FROM {src} WHERE {x} IS NOT NULL AND {g} IS NOT NULL) GROUP BY g)),
 (SELECT sum(pow(c, 3) - c) AS t FROM (SELECT count(*) AS c FROM {src} WHERE {x} IS NOT NULL AND {g} IS NOT NULL GROUP BY cast({x} AS DOUBLE)))"""


@query("x7_kruskal", S.with_(S.PREPARED_UNSCALED, _kruskal_sql("prepared_unscaled", "topic", "sharesFacebook")))
def x7_kruskal(spark, sf_dir):
    return _round_all(X.kruskal_wallis(unscaled(spark, sf_dir), "topic", "sharesFacebook"))


@query("x7_kruskal_lineitem", _kruskal_sql("lineitem", "l_returnflag", "l_quantity"))
def x7_kruskal_lineitem(spark, sf_dir):
    """X7 at scale: quantity (heavily tied) across return flags."""
    return _round_all(X.kruskal_wallis(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity"))


def _welch_sql(src, flag, x):
    return f"""
SELECT round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), {R}) AS t_stat,
       round(pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)), {R}) AS dof, n1, n2
FROM (SELECT count(*) FILTER (WHERE {flag}) AS n1, avg(cast({x} AS DOUBLE)) FILTER (WHERE {flag}) AS m1,
             var_samp(cast({x} AS DOUBLE)) FILTER (WHERE {flag}) AS v1,
             count(*) FILTER (WHERE NOT ({flag})) AS n2, avg(cast({x} AS DOUBLE)) FILTER (WHERE NOT ({flag})) AS m2,
             var_samp(cast({x} AS DOUBLE)) FILTER (WHERE NOT ({flag})) AS v2
      FROM {src} WHERE {x} IS NOT NULL)"""


@query("x8_welch_weekend", S.with_(S.PREPARED_UNSCALED, _welch_sql("prepared_unscaled", "isodow(date_column) >= 6",
                                                                   "sharesFacebook")))
def x8_welch_weekend(spark, sf_dir):
    return _round_all(X.welch_t(unscaled(spark, sf_dir), Dt.is_weekend("date_column"), "sharesFacebook"))


@query("x8_welch_events", _welch_sql("events", "isodow(ts) >= 6", "value"))
def x8_welch_events(spark, sf_dir):
    """X8 at scale: event value on weekends vs weekdays."""
    return _round_all(X.welch_t(table(spark, sf_dir, "events"), Dt.is_weekend("ts"), "value"))


@query("x_constant_column", """
SELECT CAST(NULL AS DOUBLE) AS pearson, CAST(NULL AS DOUBLE) AS spearman, CAST(NULL AS DOUBLE) AS kendall,
       CAST(NULL AS DOUBLE) AS f_stat, CAST(NULL AS DOUBLE) AS h_stat, CAST(NULL AS DOUBLE) AS t_stat""")
def x_constant_column(spark, sf_dir):
    """X2-X4 and X6-X8 where they are undefined: a constant column, one group."""
    e = table(spark, sf_dir, "events").withColumn("one", F.lit(1.0)).withColumn("all", F.lit("all"))
    return X.pearson(e, "one", "value").select(
        "pearson", X.spearman(e, "one", "value").scalar().alias("spearman"),
        X.kendall_tau_b(e, "one", "user_id").scalar().alias("kendall"),
        X.anova_oneway(e, "all", "value").select("f_stat").scalar().alias("f_stat"),
        X.kruskal_wallis(e, "event_type", "one").select("h_stat").scalar().alias("h_stat"),
        X.welch_t(e, F.col("user_id") % 2 == 0, "one").select("t_stat").scalar().alias("t_stat"))


# ----------------------------------------------------------------- X9 (no SQL equivalent of the tails)

@query("x9_p_values")
def x9_p_values(spark, sf_dir):
    """P-values of X6 (F), X7 (chi-squared) and X8 (two-sided t) on
    the prepared articles, with the 5 % decision of the t-test."""
    df = unscaled(spark, sf_dir)
    a = X.with_p_value(X.anova_oneway(df, "topic", "sharesFacebook"), "f", "f_stat", "df_between", "df_within",
                       out="anova_p").select("anova_p")
    k = X.with_p_value(X.kruskal_wallis(df, "topic", "sharesFacebook"), "chi2", "h_stat", "dof",
                       out="kruskal_p").select("kruskal_p")
    t = X.with_p_value(X.welch_t(df, Dt.is_weekend("date_column"), "sharesFacebook"), "t2", "t_stat", "dof",
                       out="welch_p", alpha=0.05).select("welch_p", "significant")
    return t.select(a.scalar().alias("anova_p"), k.scalar().alias("kruskal_p"), "welch_p", "significant")


@query("x9_closed_forms", S.with_(S.PREPARED_UNSCALED, f"""
SELECT round(pow(1 + 2 * f_stat / df_within, -df_within / 2.0), 6) AS anova_p, round(exp(-h_stat / 2), 6) AS kruskal_p
FROM ({_anova_sql("prepared_unscaled", "topic", "sharesFacebook")}), ({_kruskal_sql("prepared_unscaled", "topic", "sharesFacebook")})
WHERE df_between = 2 AND dof = 2"""))
def x9_closed_forms(spark, sf_dir):
    """X9 on the three topics of the fixture: with two degrees of freedom both
    tails have closed forms."""
    p = x9_p_values(spark, sf_dir)
    return p.select(F.round("anova_p", 6).alias("anova_p"), F.round("kruskal_p", 6).alias("kruskal_p"))


# ----------------------------------------------------------------- X10, V2

@query("x10_calendar_corr", S.with_(S.PREPARED_UNSCALED, f"""
, _f AS (SELECT sharesFacebook, hour(try_strptime(dateTime, '%Y-%m-%dT%H:%M:%SZ')) AS hour,
                dense_rank() OVER (ORDER BY dayname(date_column)) - 1 AS day_encoded,
                CASE WHEN isodow(date_column) >= 6 THEN 1 ELSE 0 END AS is_weekend_encoded FROM prepared_unscaled)
SELECT round(corr(hour, sharesFacebook), {R}) AS hour, round(corr(day_encoded, sharesFacebook), {R}) AS day_encoded,
       round(corr(is_weekend_encoded, sharesFacebook), {R}) AS is_weekend_encoded FROM _f"""))
def x10_calendar_corr(spark, sf_dir):
    df = unscaled(spark, sf_dir).withColumn("hour", Dt.hour_of_iso("dateTime"))
    df = df.withColumn("day", Dt.day_name("date_column"))
    df = Dt.category_codes(df, "day", "day_encoded")
    df = df.withColumn("is_weekend_encoded", Dt.is_weekend("date_column").cast("int"))
    y = F.col("sharesFacebook").cast("double")
    return _round_all(df.agg(*[F.corr(F.col(c).cast("double"), y).alias(c)
                               for c in ["hour", "day_encoded", "is_weekend_encoded"]]))


@query("v2_average_ranks_part", """
SELECT p_size, count(*) AS n, min(r) AS avg_rank FROM (
  SELECT p_size, rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2.0 AS r FROM part)
GROUP BY p_size""")
def v2_average_ranks_part(spark, sf_dir):
    """V2: tie-averaged ranks of ``part.p_size`` (50 values, many ties)."""
    cells = value_cells(table(spark, sf_dir, "part"), "p_size", (), "_v", "_w")
    r = average_ranks(cells, (), "_v", "_w", "avg_rank")
    return r.select(F.col("_v").alias("p_size"), F.col("_w").alias("n"), "avg_rank")


@query("v2_average_ranks_orders", """
SELECT o_totalprice, count(*) AS n, min(r) AS avg_rank FROM (
  SELECT o_totalprice, rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0 AS r
  FROM orders) GROUP BY o_totalprice""")
def v2_average_ranks_orders(spark, sf_dir):
    """V2 at scale: ranks of ``orders.o_totalprice`` (almost all distinct)."""
    cells = value_cells(table(spark, sf_dir, "orders"), "o_totalprice", (), "_v", "_w")
    r = average_ranks(cells, (), "_v", "_w", "avg_rank")
    return r.select(F.col("_v").alias("o_totalprice"), F.col("_w").alias("n"), "avg_rank")
