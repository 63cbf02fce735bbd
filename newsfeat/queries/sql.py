"""DuckDB oracle building blocks: the article fixture and the prepared /
split / balanced article tables as CTEs, written independently of the Spark
code so the two implementations check each other."""

from newsfeat.sources.tables import ARTICLE_FIXTURE_SQL

ARTICLE_STRING_COLS = ["uri", "title", "body", "date", "dateTime", "lang", "sourceTitle",
                       "authors", "categoryLabels"]

_nulls = ", ".join(f"nullif({c}, '') AS {c}" for c in ARTICLE_STRING_COLS)

ARTICLES = f"articles AS ({ARTICLE_FIXTURE_SQL})"

PREPARED_UNSCALED = f"""{ARTICLES},
_y AS (SELECT *, try_cast(date AS DATE) AS date_column FROM articles),
_y2 AS (SELECT *, cast(year(date_column) AS INTEGER) AS year, cast(month(date_column) AS INTEGER) AS month,
        CASE WHEN date_column IS NULL THEN NULL
             ELSE concat(cast(year(date_column) AS VARCHAR), '-', cast(month(date_column) AS VARCHAR)) END AS year_month
        FROM _y WHERE year(date_column) = 2023),
_d AS (SELECT * FROM _y2 QUALIFY row_number() OVER (PARTITION BY uri ORDER BY ingest_seq) = 1),
_n AS (SELECT * REPLACE ({_nulls}) FROM _d),
prepared_unscaled AS (
  SELECT *, replace(split_part(categoryLabels, ';', 1), 'news/', '') AS topic FROM _n
  WHERE categoryLabels IS NOT NULL AND authors IS NOT NULL
    AND starts_with(split_part(categoryLabels, ';', 1), 'news'))"""

PREPARED = f"""{PREPARED_UNSCALED},
_q AS (SELECT quantile_cont(sharesFacebook, 0.25) AS q25, quantile_cont(sharesFacebook, 0.5) AS q50,
              quantile_cont(sharesFacebook, 0.75) AS q75 FROM prepared_unscaled),
prepared AS (
  SELECT prepared_unscaled.*,
         (sharesFacebook - q50) / CASE WHEN q75 - q25 = 0 THEN 1 ELSE q75 - q25 END AS shares_scaled
  FROM prepared_unscaled, _q)"""

SPLIT = f"""{PREPARED},
_s AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY date_column, uri) AS _rn,
              count(*) OVER (PARTITION BY topic) AS _cnt FROM prepared),
split_articles AS (
  SELECT * EXCLUDE (_rn, _cnt),
         CASE WHEN _rn <= (95 * _cnt) // 100 THEN 'TRAIN'
              WHEN _rn <= (95 * _cnt) // 100 + (_cnt - (95 * _cnt) // 100) // 2 THEN 'VALIDATE'
              ELSE 'TEST' END AS split
  FROM _s)"""

BALANCED = f"""{SPLIT},
_tr AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY md5(concat(uri, '42')), uri) AS _rn,
               count(*) OVER (PARTITION BY topic) AS _cnt FROM split_articles WHERE split = 'TRAIN'),
_k AS (SELECT min(_cnt) AS _kk FROM _tr),
balanced AS (
  SELECT _tr.* EXCLUDE (_rn, _cnt) FROM _tr, _k WHERE _rn <= _kk
  UNION ALL BY NAME
  SELECT * FROM split_articles WHERE split IN ('VALIDATE', 'TEST'))"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def rounded(sql: str, cols, digits: int = 9) -> str:
    """Wrap an oracle query so the listed double columns are rounded."""
    rep = ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n)"
