"""Exploration queries: counts, ranges, top-k, pivots, histograms, profiles,
samples and filters over the prepared articles (A, O, D, F, G, P families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfeat.functions import dates as Dt
from newsfeat.operators import aggregates as A
from newsfeat.operators import prepare as prep
from newsfeat.operators import profiles as Pf
from newsfeat.operators import sampling as Smp
from newsfeat.operators.ranking import materialize, row_number_within
from newsfeat.queries import sql as S
from newsfeat.queries.common import articles, prepared, split_articles, table
from newsfeat.queries.registry import query

R = 9
RANK_COLS = ["importanceRank", "alexaGlobalRank", "alexaCountryRank"]


def unscaled(spark, sf_dir):
    return prep.prepare_articles(articles(spark, sf_dir), scale=False)


def year_rows(spark, sf_dir):
    """Rows of the year before de-duplication (exploration notebook frame)."""
    return prep.filter_year(prep.parse_date(articles(spark, sf_dir)), 2023)


Y2023 = f"""{S.ARTICLES},
y2023 AS (SELECT *, try_cast(date AS DATE) AS date_column FROM articles WHERE year(try_cast(date AS DATE)) = 2023)"""


# ----------------------------------------------------------------- counts

@query("a1_row_count", S.with_(S.PREPARED_UNSCALED, "SELECT count(*) AS n FROM prepared_unscaled"))
def a1_row_count(spark, sf_dir):
    return A.row_count(unscaled(spark, sf_dir))


_A2_COLS = ["uri", "title", "body", "date", "dateTime", "lang", "sourceTitle", "authors", "categoryLabels",
            "sharesFacebook", "importanceRank", "alexaGlobalRank", "alexaCountryRank"]
_A2_SQL = S.with_(S.ARTICLES + ",\n_e AS (SELECT * REPLACE (" + ", ".join(
    f"nullif({c}, '') AS {c}" for c in S.ARTICLE_STRING_COLS) + ") FROM articles)",
    "\nUNION ALL\n".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM _e"
                         for c in _A2_COLS))


@query("a2_null_counts", _A2_SQL)
def a2_null_counts(spark, sf_dir):
    """P22 over every string column, then A2 null counts per column."""
    return A.null_counts(prep.empty_to_null(articles(spark, sf_dir)), _A2_COLS)


@query("a3_source_counts", S.with_(S.PREPARED_UNSCALED, """
SELECT sourceTitle, count(*) AS "count" FROM prepared_unscaled WHERE sourceTitle IS NOT NULL GROUP BY sourceTitle"""))
def a3_source_counts(spark, sf_dir):
    return A.value_counts(unscaled(spark, sf_dir), "sourceTitle")


@query("a5_date_range", S.with_(S.ARTICLES, """
SELECT min(try_cast(date AS DATE)) AS min_date, max(try_cast(date AS DATE)) AS max_date FROM articles"""))
def a5_date_range(spark, sf_dir):
    return A.min_max(prep.parse_date(articles(spark, sf_dir)), "date_column", (), "min_date", "max_date")


@query("a6_split_date_range", S.with_(S.SPLIT, """
SELECT topic, split, min(date_column) AS min_date, max(date_column) AS max_date FROM split_articles
GROUP BY topic, split"""))
def a6_split_date_range(spark, sf_dir):
    return A.min_max(split_articles(spark, sf_dir), "date_column", ["topic", "split"], "min_date", "max_date")


@query("a6_orders_date_range", """
SELECT o_orderpriority, o_orderstatus, min(o_orderdate) AS min_date, max(o_orderdate) AS max_date
FROM orders GROUP BY o_orderpriority, o_orderstatus""")
def a6_orders_date_range(spark, sf_dir):
    """A6 at scale: date range per (priority, status) of ``orders``."""
    return A.min_max(table(spark, sf_dir, "orders"), "o_orderdate", ["o_orderpriority", "o_orderstatus"],
                     "min_date", "max_date")


@query("a7_zero_positive", S.with_(S.PREPARED_UNSCALED, """
SELECT count(*) FILTER (WHERE sharesFacebook = 0) AS zero, count(*) FILTER (WHERE sharesFacebook > 0) AS positive
FROM prepared_unscaled"""))
def a7_zero_positive(spark, sf_dir):
    return A.zero_positive_counts(unscaled(spark, sf_dir), "sharesFacebook")


@query("a8_missing_authors", S.with_(Y2023, """
SELECT count(*) FILTER (WHERE authors IS NULL OR authors IN ('', ' ')) AS missing FROM y2023"""))
def a8_missing_authors(spark, sf_dir):
    return A.missing_or_empty(year_rows(spark, sf_dir), "authors")


@query("a9_min_train_class", S.with_(S.SPLIT, """
SELECT min(c) AS min_size FROM (SELECT topic, count(*) AS c FROM split_articles WHERE split = 'TRAIN' GROUP BY topic)"""))
def a9_min_train_class(spark, sf_dir):
    return A.min_group_size(split_articles(spark, sf_dir).where(F.col("split") == "TRAIN"), "topic")


@query("a10_topic_median", S.with_(S.PREPARED_UNSCALED, """
SELECT topic, quantile_cont(sharesFacebook, 0.5) AS median, count(sharesFacebook) AS "count"
FROM prepared_unscaled GROUP BY topic"""), round_cols=['median'])
def a10_topic_median(spark, sf_dir):
    return A.group_median(unscaled(spark, sf_dir), "topic", "sharesFacebook")


@query("a10_orders_median", """
SELECT o_orderpriority, quantile_cont(o_totalprice, 0.5) AS median, count(o_totalprice) AS "count"
FROM orders GROUP BY o_orderpriority""", round_cols=['median'])
def a10_orders_median(spark, sf_dir):
    """A10 at scale: exact median price per priority on ``orders``."""
    return A.group_median(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")


@query("o4_top_topics_by_median", S.with_(S.PREPARED_UNSCALED, """
SELECT topic, quantile_cont(sharesFacebook, 0.5) AS median, count(sharesFacebook) AS "count"
FROM prepared_unscaled GROUP BY topic ORDER BY median DESC, topic LIMIT 30"""), round_cols=['median'])
def o4_top_topics_by_median(spark, sf_dir):
    m = A.group_median(unscaled(spark, sf_dir), "topic", "sharesFacebook")
    return m.orderBy(F.desc("median"), F.asc("topic")).limit(30)


@query("a11_mean_by_hour", S.with_(S.PREPARED_UNSCALED, """
SELECT cast(hour(try_strptime(dateTime, '%Y-%m-%dT%H:%M:%SZ')) AS INTEGER) AS hour,
       avg(sharesFacebook) AS mean
FROM prepared_unscaled GROUP BY 1"""), round_cols=['mean'])
def a11_mean_by_hour(spark, sf_dir):
    df = unscaled(spark, sf_dir).withColumn("hour", Dt.hour_of_iso("dateTime"))
    return A.group_mean(df, "hour", "sharesFacebook")


@query("a11_mean_by_day", S.with_(S.PREPARED_UNSCALED, """
SELECT dayname(date_column) AS day, avg(sharesFacebook) AS mean FROM prepared_unscaled GROUP BY 1"""), round_cols=['mean'])
def a11_mean_by_day(spark, sf_dir):
    df = unscaled(spark, sf_dir).withColumn("day", Dt.day_name("date_column"))
    return A.group_mean(df, "day", "sharesFacebook")


@query("a12_length_stats", S.with_(S.PREPARED_UNSCALED, """
SELECT cast(sum(length(body)) AS BIGINT) AS total_chars, avg(length(body)) AS mean_chars,
       count(length(body)) AS documents FROM prepared_unscaled"""), round_cols=['mean_chars'])
def a12_length_stats(spark, sf_dir):
    return A.length_stats(unscaled(spark, sf_dir), "body")


def _describe_sql(src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS "count", avg({c}) AS mean,
  stddev_samp({c}) AS std, cast(min({c}) AS DOUBLE) AS "min", cast(max({c}) AS DOUBLE) AS "max",
  quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75
FROM {src}""")
    return "\nUNION ALL\n".join(parts)


@query("a13_describe_ranks", S.with_(S.PREPARED_UNSCALED, _describe_sql("prepared_unscaled", RANK_COLS)), round_cols=['mean', 'std', 'min', 'max', 'p25', 'p50', 'p75'])
def a13_describe_ranks(spark, sf_dir):
    return A.describe_numeric(unscaled(spark, sf_dir), RANK_COLS)


_LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a13_describe_lineitem", _describe_sql("lineitem", _LI_COLS), round_cols=['mean', 'std', 'min', 'max', 'p25', 'p50', 'p75'])
def a13_describe_lineitem(spark, sf_dir):
    """A13 at scale over four ``lineitem`` measures."""
    return A.describe_numeric(table(spark, sf_dir, "lineitem"), _LI_COLS)


_STR_COLS = ["sourceTitle", "authors", "topic", "lang"]


def _describe_str_sql(src, cols):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", * FROM (
  SELECT cast(sum(f) AS BIGINT) AS "count", count(*) AS "unique", arg_min(v, (-f, v)) AS top, arg_min(f, (-f, v)) AS freq
  FROM (SELECT cast({c} AS VARCHAR) AS v, count(*) AS f FROM {src} WHERE {c} IS NOT NULL GROUP BY 1))""")
    return "\nUNION ALL\n".join(parts)


@query("a14_describe_strings", S.with_(S.PREPARED_UNSCALED, _describe_str_sql("prepared_unscaled", _STR_COLS)))
def a14_describe_strings(spark, sf_dir):
    return A.describe_strings(unscaled(spark, sf_dir), _STR_COLS)


_ALL_NUMBERS = ["mean", "std", "min", "max", "p25", "p50", "p75"]


@query("a14_describe_all", S.with_(S.PREPARED_UNSCALED, f"""
SELECT *, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq
FROM ({_describe_sql("prepared_unscaled", RANK_COLS)})
UNION ALL BY NAME
SELECT "column", "count", "unique", top, freq FROM ({_describe_str_sql("prepared_unscaled", _STR_COLS)})"""),
       round_cols=_ALL_NUMBERS)
def a14_describe_all(spark, sf_dir):
    """A13 + A14 in one table."""
    return A.describe_all(unscaled(spark, sf_dir), RANK_COLS + _STR_COLS)


LANGS = ["de", "en", "es", "fr"]


@query("a15_topic_lang_pivot", S.with_(S.PREPARED_UNSCALED, "SELECT topic, " + ", ".join(
    f"count(*) FILTER (WHERE lang = '{v}') AS {v}" for v in LANGS) + " FROM prepared_unscaled GROUP BY topic"))
def a15_topic_lang_pivot(spark, sf_dir):
    return A.pivot_counts(unscaled(spark, sf_dir), "topic", "lang", LANGS)


@query("a16_capped_pivot", S.with_(S.PREPARED_UNSCALED, "SELECT topic, " + ", ".join(
    f"least(count(*) FILTER (WHERE lang = '{v}'), 50) AS {v}" for v in LANGS)
    + " FROM prepared_unscaled GROUP BY topic"))
def a16_capped_pivot(spark, sf_dir):
    return A.pivot_counts(unscaled(spark, sf_dir), "topic", "lang", LANGS, cap=50)


_SEGS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("a15_customer_nation_pivot", """
SELECT c_nationkey, """ + ", ".join(f"count(*) FILTER (WHERE c_mktsegment = '{v}') AS {v}" for v in _SEGS)
       + " FROM customer GROUP BY c_nationkey")
def a15_customer_nation_pivot(spark, sf_dir):
    """A15 at scale: customers per (nation x market segment)."""
    return A.pivot_counts(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment", _SEGS)


@query("a17_included_excluded", S.with_(Y2023, """
SELECT count(*) FILTER (WHERE starts_with(split_part(coalesce(nullif(categoryLabels, ''), ''), ';', 1), 'news')) AS included,
       count(*) - count(*) FILTER (WHERE starts_with(split_part(coalesce(nullif(categoryLabels, ''), ''), ';', 1), 'news')) AS excluded
FROM y2023"""))
def a17_included_excluded(spark, sf_dir):
    df = year_rows(spark, sf_dir)
    pred = prep.first_token(F.coalesce(F.col("categoryLabels"), F.lit(""))).startswith("news")
    return A.included_excluded(df, pred)


def _hist_sql(src, c, bins):
    return f"""
SELECT CAST(b.range AS INTEGER) AS bin, e._lo + b.range * (e._hi - e._lo) / {bins} AS lower,
       e._lo + (b.range + 1) * (e._hi - e._lo) / {bins} AS upper, count(f.bin) AS "count"
FROM range(0, {bins}) b CROSS JOIN (SELECT cast(min({c}) AS DOUBLE) AS _lo, cast(max({c}) AS DOUBLE) AS _hi FROM {src}) e
LEFT JOIN (SELECT CASE WHEN _hi = _lo THEN 0 ELSE least(cast(floor((cast({c} AS DOUBLE) - _lo) / (_hi - _lo) * {bins}) AS INTEGER), {bins - 1}) END AS bin, _lo, _hi
      FROM {src}, (SELECT cast(min({c}) AS DOUBLE) AS _lo, cast(max({c}) AS DOUBLE) AS _hi FROM {src})
      WHERE {c} IS NOT NULL) f ON f.bin = b.range
GROUP BY b.range, e._lo, e._hi"""


@query("a18_histogram_importance", S.with_(S.PREPARED_UNSCALED, _hist_sql("prepared_unscaled", "importanceRank", 30)), round_cols=['lower', 'upper'])
def a18_histogram_importance(spark, sf_dir):
    return A.histogram(unscaled(spark, sf_dir), "importanceRank", 30)


@query("a18_histogram_events", _hist_sql("events", "value", 20), round_cols=['lower', 'upper'])
def a18_histogram_events(spark, sf_dir):
    """A18 at scale: 20 bins of ``events.value``."""
    return A.histogram(table(spark, sf_dir, "events"), "value", 20)


def _kde_sql(src, c, points=200):
    return f"""
, _cells AS (SELECT cast({c} AS DOUBLE) AS v, count(*) AS w FROM {src} WHERE {c} IS NOT NULL GROUP BY 1),
_st AS (SELECT min(cast({c} AS DOUBLE)) AS lo, max(cast({c} AS DOUBLE)) AS hi,
               stddev_samp(cast({c} AS DOUBLE)) * pow(count(*), -0.2) AS h, count(*) AS n
        FROM {src} WHERE {c} IS NOT NULL),
_g AS (SELECT cast(range AS INTEGER) AS point FROM range(0, {points}))
SELECT point, lo + point * (hi - lo) / {points - 1} AS x,
       round(sum(w * exp(-pow((lo + point * (hi - lo) / {points - 1} - v) / h, 2) / 2)) / (n * h * sqrt(2 * pi())), 12) AS density
FROM _g, _cells, _st GROUP BY point, lo, hi, h, n"""


@query("a19_kde_shares", S.with_(S.PREPARED_UNSCALED + _kde_sql("prepared_unscaled", "sharesFacebook"), ""), round_cols=['x', 'density'])
def a19_kde_shares(spark, sf_dir):
    k = A.kde_curve(unscaled(spark, sf_dir), "sharesFacebook", 200)
    return k.withColumn("density", F.round("density", 12))


_PROF_COLS = ["sourceTitle", "lang", "topic", "sharesFacebook", "alexaCountryRank"]


def _profile_sql(src, cols, num):
    parts = []
    for c in cols:
        d = f"cast({c} AS DOUBLE)" if c in num else "cast(NULL AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS missing,
  count(DISTINCT cast({c} AS VARCHAR)) AS "distinct", min({d}) AS "min", avg({d}) AS mean, max({d}) AS "max",
  stddev_samp({d}) AS std, quantile_cont({d}, 0.25) AS p25, quantile_cont({d}, 0.5) AS p50, quantile_cont({d}, 0.75) AS p75,
  (SELECT arg_min(v, (-f, v)) FROM (SELECT cast({c} AS VARCHAR) AS v, count(*) AS f FROM {src} WHERE {c} IS NOT NULL GROUP BY 1)) AS top,
  (SELECT max(f) FROM (SELECT count(*) AS f FROM {src} WHERE {c} IS NOT NULL GROUP BY {c})) AS freq,
  '{ {"sharesFacebook": "bigint", "alexaCountryRank": "bigint"}.get(c, "string") }' AS type FROM {src}""")
    return "\nUNION ALL\n".join(parts)


@query("a20_profile", S.with_(S.PREPARED_UNSCALED, _profile_sql(
    "prepared_unscaled", _PROF_COLS, {"sharesFacebook", "alexaCountryRank"})), round_cols=['min', 'mean', 'max', 'std', 'p25', 'p50', 'p75'])
def a20_profile(spark, sf_dir):
    return A.profile(unscaled(spark, sf_dir), _PROF_COLS)


_TOP_COLS = ["lang", "sourceTitle", "authors", "categoryLabels", "sharesFacebook", "uri", "body"]


def _top_values_sql(src, cols, k):
    return "\nUNION ALL\n".join(f"""SELECT * FROM (SELECT '{c}' AS "column",
  cast(row_number() OVER (ORDER BY count(*) DESC, cast({c} AS VARCHAR)) AS INTEGER) AS rank,
  cast({c} AS VARCHAR) AS value, count(*) AS count
  FROM {src} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rank <= {k}""" for c in cols)


@query("a20_top_values", S.with_(S.ARTICLES, _top_values_sql("articles", _TOP_COLS, 5)))
def a20_top_values(spark, sf_dir):
    """Five top values of each column, of texts and keys too."""
    return Pf.top_values(articles(spark, sf_dir), _TOP_COLS, 5)


_SKETCHED = ["sourceTitle", "authors", "sharesFacebook", "importanceRank", "alexaCountryRank", "uri"]


def _sketch_sql(src, cols, num):
    parts = []
    for c in cols:
        d = f"cast({c} AS DOUBLE)" if c in num else "cast(NULL AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS missing,
  round(min({d}), {R}) AS "min", round(max({d}), {R}) AS "max", round(avg({d}), {R}) AS mean, round(stddev_samp({d}), {R}) AS std,
  true AS distinct_near, true AS median_near, true AS same_as_whole FROM {src}""")
    return "\nUNION ALL\n".join(parts)


@query("a20_profile_merged", S.with_(S.ARTICLES, _sketch_sql("articles", _SKETCHED, {
    "sharesFacebook", "importanceRank", "alexaCountryRank"})))
def a20_profile_merged(spark, sf_dir):
    """A20 as stored sketches: those of two halves of the articles, written and
    merged.  The estimates are held against exact counts (four standard errors,
    twice the rank error) and against the sketches of the whole."""
    a = articles(spark, sf_dir)
    halves = [materialize(Pf.column_sketches(a.where(F.col("ingest_seq") % 2 == k), _SKETCHED), "sketches") for k in (0, 1)]
    report = Pf.sketch_report(Pf.merged_sketches(*halves))
    whole = Pf.sketch_report(Pf.column_sketches(a, _SKETCHED)).select("column", F.col("distinct").alias("whole"))
    values = Pf._stacked(a, _SKETCHED)
    exact = values.groupBy("column").agg(F.count_distinct("sval").alias("exact"))
    rank = values.join(report.select("column", "p50"), "column").groupBy("column").agg(
        F.avg((F.col("dval") < F.col("p50")).cast("double")).alias("below"), F.avg((F.col("dval") <= F.col("p50")).cast("double")).alias("upto"))
    out = report.join(whole, "column").join(exact, "column").join(rank, "column")
    near = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 4 * Pf.DISTINCT_ERROR)
    median = (F.col("below") <= 0.5 + 2 * Pf.RANK_ERROR) & (F.col("upto") >= 0.5 - 2 * Pf.RANK_ERROR)
    return out.select("column", "rows", "missing", *[F.round(c, R).alias(c) for c in ("min", "max", "mean", "std")],
                      near.alias("distinct_near"), F.coalesce(median, F.lit(True)).alias("median_near"),
                      (F.col("distinct") == F.col("whole")).alias("same_as_whole"))


@query("a23_daily_topic_series", S.with_(S.PREPARED_UNSCALED, """
SELECT topic, date_column, count(*) AS "count" FROM prepared_unscaled GROUP BY topic, date_column"""))
def a23_daily_topic_series(spark, sf_dir):
    return A.group_counts(unscaled(spark, sf_dir), ["topic", "date_column"])


# ----------------------------------------------------------------- top-k, mode

@query("o3_top_authors", S.with_(Y2023, """
SELECT authors, count(*) AS "count" FROM y2023 WHERE authors NOT IN ('', ' ')
GROUP BY authors ORDER BY "count" DESC, authors LIMIT 15"""))
def o3_top_authors(spark, sf_dir):
    df = prep.empty_to_null(year_rows(spark, sf_dir), ["authors"], blanks=("", " "))
    return A.top_k(df, "authors", 15)


@query("o5_mode_source", S.with_(S.PREPARED_UNSCALED, """
SELECT sourceTitle AS top, count(*) AS freq FROM prepared_unscaled WHERE sourceTitle IS NOT NULL
GROUP BY sourceTitle ORDER BY freq DESC, sourceTitle LIMIT 1"""))
def o5_mode_source(spark, sf_dir):
    return A.mode(unscaled(spark, sf_dir), "sourceTitle")


# ----------------------------------------------------------------- duplicates, samples, limits

@query("d2_duplicate_groups", S.with_(S.ARTICLES, """
SELECT uri, ingest_seq, dup_count FROM articles JOIN (
  SELECT uri, count(*) AS dup_count FROM articles GROUP BY uri HAVING count(*) > 1) USING (uri)"""))
def d2_duplicate_groups(spark, sf_dir):
    return prep.duplicate_groups(articles(spark, sf_dir), "uri").select("uri", "ingest_seq", "dup_count")


@query("d3_seeded_sample", S.with_(S.PREPARED_UNSCALED, """
SELECT uri, topic FROM prepared_unscaled ORDER BY md5(concat(uri, '7')), uri LIMIT 25"""))
def d3_seeded_sample(spark, sf_dir):
    return Smp.seeded_sample(unscaled(spark, sf_dir), 25, seed=7, key="uri").select("uri", "topic")


@query("d3_seeded_sample_large", """
SELECT o_orderkey FROM orders ORDER BY md5(concat(cast(o_orderkey AS VARCHAR), '11')), o_orderkey
LIMIT (SELECT count(*) // 3 FROM orders)""")
def d3_seeded_sample_large(spark, sf_dir):
    """D3 with n large (a third of ``orders``): exact seeded sample through
    distributed row numbers instead of a single-task top-k."""
    o = table(spark, sf_dir, "orders")
    n = o.count() // 3
    return Smp.seeded_sample(o, n, seed=11, key="o_orderkey").select("o_orderkey")


@query("d4_unseeded_sample", S.with_(S.PREPARED_UNSCALED, """
SELECT least(25, count(*)) AS n, least(25, count(*)) AS known FROM prepared_unscaled"""))
def d4_unseeded_sample(spark, sf_dir):
    """A sample without a seed: so many rows, all of the prepared ones."""
    rows = unscaled(spark, sf_dir).select("uri")
    some = Smp.seeded_sample(rows, 25, seed=None, key="uri")
    known = rows.distinct().withColumn("_known", F.lit(1))
    return some.join(known, "uri", "left").agg(F.count("*").alias("n"), F.count("_known").alias("known"))


@query("o2_ordered_series", S.with_(S.PREPARED_UNSCALED, """
SELECT topic, date_column, count(*) AS "count", row_number() OVER (ORDER BY topic, date_column) AS place
FROM prepared_unscaled GROUP BY topic, date_column"""))
def o2_ordered_series(spark, sf_dir):
    """A23 in the order of O2: the place of each (topic, date)."""
    daily = A.group_counts(unscaled(spark, sf_dir), ["topic", "date_column"])
    return row_number_within(daily, [], ["topic", "date_column"], rn="place", size=None)


@query("d5_first_rows", S.with_(S.ARTICLES, """
SELECT uri, ingest_seq FROM articles ORDER BY ingest_seq LIMIT 10"""))
def d5_first_rows(spark, sf_dir):
    return Smp.first_rows(articles(spark, sf_dir), 10, "ingest_seq").select("uri", "ingest_seq")


@query("d6_first_nonempty", S.with_(S.PREPARED_UNSCALED, """
SELECT uri, ingest_seq FROM prepared_unscaled WHERE coalesce(body, '') <> '' ORDER BY ingest_seq LIMIT 10"""))
def d6_first_nonempty(spark, sf_dir):
    return Smp.first_nonempty(unscaled(spark, sf_dir), "body", 10, "ingest_seq").select("uri", "ingest_seq")


# ----------------------------------------------------------------- filters

@query("f4_drop_missing_rank", S.with_(S.PREPARED_UNSCALED, """
SELECT count(*) AS n FROM prepared_unscaled WHERE alexaCountryRank IS NOT NULL"""))
def f4_drop_missing_rank(spark, sf_dir):
    return A.row_count(prep.drop_missing(unscaled(spark, sf_dir), ["alexaCountryRank"]))


@query("f6_lang_not_in", S.with_(S.PREPARED_UNSCALED, """
SELECT lang, count(*) AS "count" FROM prepared_unscaled WHERE lang NOT IN ('en', 'fr') GROUP BY lang"""))
def f6_lang_not_in(spark, sf_dir):
    df = unscaled(spark, sf_dir).where(~F.col("lang").isin("en", "fr"))
    return A.value_counts(df, "lang")


@query("f7_contains_separator", S.with_(Y2023, """
SELECT count(*) FILTER (WHERE coalesce(contains(nullif(categoryLabels, ''), ';'), false)) AS with_sep,
       count(*) FILTER (WHERE NOT coalesce(contains(nullif(categoryLabels, ''), ';'), false)) AS without_sep
FROM y2023"""))
def f7_contains_separator(spark, sf_dir):
    df = prep.empty_to_null(year_rows(spark, sf_dir), ["categoryLabels"])
    has = F.coalesce(F.col("categoryLabels").contains(";"), F.lit(False))
    return df.agg(F.count_if(has).alias("with_sep"), F.count_if(~has).alias("without_sep"))


@query("f8_present_authors", S.with_(Y2023, """
SELECT count(*) AS n FROM y2023 WHERE authors IS NOT NULL AND authors <> ''"""))
def f8_present_authors(spark, sf_dir):
    df = year_rows(spark, sf_dir)
    return A.row_count(df.where(F.col("authors").isNotNull() & (F.col("authors") != "")))


@query("f9_weekend_masks", S.with_(S.PREPARED_UNSCALED, """
SELECT count(*) FILTER (WHERE isodow(date_column) >= 6) AS weekend,
       count(*) FILTER (WHERE NOT isodow(date_column) >= 6) AS other_days FROM prepared_unscaled"""))
def f9_weekend_masks(spark, sf_dir):
    wk = Dt.is_weekend("date_column")
    return unscaled(spark, sf_dir).agg(F.count_if(wk).alias("weekend"), F.count_if(~wk).alias("other_days"))


@query("g2_distinct_topics", S.with_(S.PREPARED_UNSCALED, "SELECT DISTINCT topic FROM prepared_unscaled"))
def g2_distinct_topics(spark, sf_dir):
    return unscaled(spark, sf_dir).select("topic").distinct()


@query("g1_union_splits", S.with_(S.SPLIT, """
SELECT split, count(*) AS n FROM (
  SELECT uri, split FROM split_articles WHERE split = 'TRAIN'
  UNION ALL SELECT uri, split FROM split_articles WHERE split <> 'TRAIN') GROUP BY split"""))
def g1_union_splits(spark, sf_dir):
    s = split_articles(spark, sf_dir).select("uri", "split")
    u = s.where(F.col("split") == "TRAIN").unionByName(s.where(F.col("split") != "TRAIN"))
    return A.group_counts(u, ["split"], "n")


# ----------------------------------------------------------------- calendar features

@query("p10_calendar_features", """
SELECT event_id, cast(hour(ts) AS INTEGER) AS hour, dayname(ts) AS day,
       cast(isodow(ts) >= 6 AS INTEGER) AS is_weekend, 0 AS is_holiday,
       cast(CASE dayname(ts) WHEN 'Friday' THEN 0 WHEN 'Monday' THEN 1 WHEN 'Saturday' THEN 2
            WHEN 'Sunday' THEN 3 WHEN 'Thursday' THEN 4 WHEN 'Tuesday' THEN 5 ELSE 6 END AS INTEGER) AS day_code
FROM events""")
def p10_calendar_features(spark, sf_dir):
    """P10-P15 on ``events.ts``: hour, day name, weekend and holiday flags
    as integers, day-name codes in alphabetical order (all seven names
    occur, so the code table is the fixed alphabetical list)."""
    ev = table(spark, sf_dir, "events")
    df = Dt.calendar_features(ev, "ts", "ts")
    return df.select("event_id", "hour", "day", "is_weekend", "is_holiday", "day_code")


@query("p15_source_codes", S.with_(S.PREPARED_UNSCALED, """
SELECT uri, coalesce(code, -1) AS source_code FROM prepared_unscaled LEFT JOIN (
  SELECT sourceTitle, cast(row_number() OVER (ORDER BY sourceTitle) - 1 AS BIGINT) AS code
  FROM (SELECT DISTINCT sourceTitle FROM prepared_unscaled WHERE sourceTitle IS NOT NULL)) USING (sourceTitle)"""))
def p15_source_codes(spark, sf_dir):
    df = unscaled(spark, sf_dir)
    return Dt.category_codes(df, "sourceTitle", "source_code").select("uri", "source_code")


# ----------------------------------------------------------------- fills and alignment

@query("p21_fill_authors", S.with_(Y2023, """
SELECT authors, count(*) AS "count" FROM (SELECT coalesce(nullif(authors, ''), 'X') AS authors FROM y2023)
GROUP BY authors"""))
def p21_fill_authors(spark, sf_dir):
    """P22 then P21: empty authors become null, nulls are filled with 'X';
    counts per author value."""
    df = prep.empty_to_null(year_rows(spark, sf_dir), ["authors"]).fillna("X", subset=["authors"])
    return A.value_counts(df, "authors")


@query("j2_align_labels", S.with_(S.PREPARED_UNSCALED, """
SELECT uri, title, doc_id, quality, toxic
FROM (SELECT uri, title, ingest_seq FROM prepared_unscaled) p FULL OUTER JOIN labels l ON p.ingest_seq = l.doc_id"""))
def j2_align_labels(spark, sf_dir):
    """A second frame (``labels``, which covers only some documents)
    aligned to the article frame on the document key — a full outer join
    on the business key instead of positional concatenation (trap T11);
    rows without a partner get nulls on the other side."""
    p = unscaled(spark, sf_dir).select("uri", "title", "ingest_seq")
    lab = table(spark, sf_dir, "labels")
    return p.join(lab, p["ingest_seq"] == lab["doc_id"], "full_outer").select(
        "uri", "title", "doc_id", "quality", "toxic")
