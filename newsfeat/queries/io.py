"""Source and sink queries (S1-S12): round trips through files the cluster
can see (under ``spark.checkpoint.dir``), compared with the rows they came
from."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.functions import columns as Cols
from newsfeat.functions import text as Tx
from newsfeat.operators import prepare as prep
from newsfeat.operators import sampling as Smp
from newsfeat.queries import sql as S
from newsfeat.queries.common import articles, split_articles
from newsfeat.queries.exploration import unscaled
from newsfeat.queries.registry import query
from newsfeat.queries.text import _sentiment_sql, preprocess_sql
from newsfeat.session import scratch_path
from newsfeat.sources import articles as Src
from newsfeat.sources import sinks as Snk
from newsfeat.sources.tables import table_path


def export_articles(flat: DataFrame, path: str, bundle: int = 100) -> str:
    """Write flat article rows back into the nested export layout: bundles of
    ``bundle`` consecutive articles, one JSON document per bundle folder.
    Each bundle is bounded, so ``collect_list`` never gathers more than
    ``bundle`` rows."""
    a = F.struct(
        F.col("uri"), F.col("title"), F.col("body"), F.col("date"), F.col("dateTime"), F.col("lang"),
        F.transform(F.split(F.col("authors"), ", "), lambda n: F.struct(n.alias("name"))).alias("authors"),
        F.struct(F.col("sharesFacebook").alias("facebook")).alias("shares"),
        F.struct(F.col("sourceTitle").alias("title"),
                 F.struct(F.col("importanceRank").alias("importanceRank"),
                          F.col("alexaGlobalRank").alias("alexaGlobalRank"),
                          F.col("alexaCountryRank").alias("alexaCountryRank")).alias("ranking")).alias("source"),
        F.transform(F.split(F.col("categoryLabels"), "; "), lambda c: F.struct(c.alias("label"))).alias("categories"))
    docs = (flat.withColumn("_bundle", F.floor(F.col("ingest_seq") / bundle))
            .groupBy("_bundle")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("ingest_seq").alias("k"), a.alias("a")))).alias("_items"))
            .select("_bundle", F.struct(F.struct(F.transform("_items", lambda i: i["a"]).alias("results"))
                                        .alias("articles")).alias("doc")))
    docs.select("_bundle", "doc.*").write.mode("overwrite").partitionBy("_bundle").json(path)
    return path


_S1_COLS = ["uri", "title", "body", "date", "dateTime", "lang", "authors", "categoryLabels", "sharesFacebook",
            "sourceTitle", "importanceRank", "alexaGlobalRank"]


@query("s1_json_export_scan", S.with_(S.ARTICLES, "SELECT " + ", ".join(_S1_COLS)
                                      + ", coalesce(alexaCountryRank, 0) AS alexaCountryRank FROM articles"))
def s1_json_export_scan(spark, sf_dir):
    """S1 + P1-P4: every article exported as nested JSON documents in
    several folders, scanned back with the declared schema and flattened
    (missing ranks become 0, the reference default)."""
    path = export_articles(articles(spark, sf_dir), scratch_path(spark, "exports"))
    return Src.read_article_exports(spark, path).select(*_S1_COLS, "alexaCountryRank")


_S6_COLS = ["uri", "title", "body", "authors", "topic", "sharesFacebook", "date_column"]


@query("s6_pipe_csv_roundtrip", S.with_(S.PREPARED_UNSCALED, "SELECT " + ", ".join(_S6_COLS)
                                        + " FROM prepared_unscaled"))
def s6_pipe_csv_roundtrip(spark, sf_dir):
    """The prepared rows (texts with newlines and quotes) written as
    quoted ``|`` CSV and read back with the same schema."""
    df = unscaled(spark, sf_dir).select(*_S6_COLS)
    path = Snk.write_pipe_csv(df, scratch_path(spark, "csv"))
    return Snk.read_pipe_csv(spark, path, df.schema)


@contextmanager
def _loaded(spark, sf_dir):
    """The split articles loaded into a table of its own (unique name, files
    under the checkpoint folder), so concurrent callers never collide.  The
    name leaves the catalog again; a frame made of the table keeps its files."""
    import uuid

    name = f"newsfeat_split_articles_{uuid.uuid4().hex[:8]}"
    Snk.load_table(split_articles(spark, sf_dir).drop("ingest_seq"), name, location=scratch_path(spark, name))
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")


@query("s7_warehouse_load", S.with_(S.SPLIT, "SELECT split, count(*) AS rows_loaded FROM split_articles GROUP BY split"))
def s7_warehouse_load(spark, sf_dir):
    """Truncate-and-load of the split articles into a managed table;
    rows loaded per split read back from the table."""
    with _loaded(spark, sf_dir) as t:
        return spark.table(t).groupBy("split").agg(F.count(F.lit(1)).alias("rows_loaded"))


@query("s7_csv_type_detection", S.with_(S.PREPARED_UNSCALED, """
SELECT topic, CAST(sum(sharesFacebook) AS BIGINT) AS shares, min(date_column) AS first_day, max(ingest_seq) AS last_seq
FROM prepared_unscaled GROUP BY topic"""))
def s7_csv_type_detection(spark, sf_dir):
    """S6 + S7: the pipe CSV read back without a schema; numbers and dates
    are detected."""
    df = unscaled(spark, sf_dir).select("uri", "ingest_seq", "title", "body", "topic", "sharesFacebook", "date_column")
    back = Snk.read_pipe_csv(spark, Snk.write_pipe_csv(df, scratch_path(spark, "csv")))
    return back.groupBy("topic").agg(F.sum("sharesFacebook").alias("shares"), F.min("date_column").alias("first_day"),
                                     F.max("ingest_seq").cast("long").alias("last_seq"))


@query("s8_test_slice", S.with_(S.SPLIT, """
SELECT uri, title, topic FROM split_articles WHERE split = 'TEST' ORDER BY uri LIMIT 10"""))
def s8_test_slice(spark, sf_dir):
    """``WHERE split = 'TEST' LIMIT 10`` on the loaded table (ordered)."""
    with _loaded(spark, sf_dir) as t:
        return Snk.table_slice(spark, t, "TEST", 10, "uri").select("uri", "title", "topic")


_NOT_FEATURES = ", ".join(f"'{c}'" for c in [*Cols.OMIT_COLUMNS, "topic", "split"])


@query("s9_table_columns", f"""
SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS data_type,
       column_name NOT IN ({_NOT_FEATURES}) AS is_feature
FROM (DESCRIBE {S.with_(S.SPLIT, "SELECT * EXCLUDE (ingest_seq) FROM split_articles")})""")
def s9_table_columns(spark, sf_dir):
    """The loaded table's columns from the catalog, with the feature
    list of P24 marked."""
    with _loaded(spark, sf_dir) as t:
        cols = Snk.table_columns(spark, t)
        feats = Cols.feature_columns(spark.table(t).columns, Cols.OMIT_COLUMNS, "topic")
        return cols.withColumn("is_feature", F.col("column_name").isin(*feats))


@query("s5_parquet_roundtrip", S.with_(S.SPLIT, "SELECT uri, topic, split FROM split_articles"))
def s5_parquet_roundtrip(spark, sf_dir):
    """S5 + S2: the split articles written as Parquet by split and read as an
    input."""
    rows = split_articles(spark, sf_dir).select("uri", "topic", "split")
    return Src.read_parquet_input(spark, Snk.write_parquet(rows, scratch_path(spark, "split"), ["split"]))


@query("s3_missing_input", """
SELECT 'documents' AS input, true AS found, count(*) AS n FROM documents
UNION ALL SELECT 'absent', false, 0""")
def s3_missing_input(spark, sf_dir):
    """S3: an input that is there, and one that is not and is skipped."""
    there = Src.read_parquet_input(spark, table_path(sf_dir, "documents"), on_missing="skip")
    gone = Src.read_parquet_input(spark, table_path(sf_dir, "absent"), on_missing="skip")
    count = lambda name, df: df.agg(F.lit(name).alias("input"), F.lit(True).alias("found"), F.count("*").alias("n"))
    missing = there.limit(1).select(F.lit("absent").alias("input"), F.lit(gone is not None).alias("found"),
                                    F.lit(0).cast("long").alias("n"))
    return count("documents", there).unionByName(missing)


@query("s10_idempotent_stage", S.with_(S.PREPARED_UNSCALED, "SELECT uri, topic FROM prepared_unscaled"))
def s10_idempotent_stage(spark, sf_dir):
    """A stage that has run is not run again: the second, which would
    write nothing, finds the first one's rows."""
    path = scratch_path(spark, "stage")
    rows = unscaled(spark, sf_dir).select("uri", "topic")
    Snk.run_stage(spark, path, lambda: rows)
    return Snk.run_stage(spark, path, lambda: rows.where(F.lit(False)))


def _request(spark, sf_dir):
    """All articles as a request in JSON lines, its values strings."""
    path = scratch_path(spark, "request")
    a = articles(spark, sf_dir)
    a.drop("ingest_seq").select(*[F.col(c).cast("string").alias(c) for c in a.columns if c != "ingest_seq"]).write.json(path)
    return Src.read_request_input(spark, path)


@query("s4_request_input", S.with_(S.PREPARED_UNSCALED, """
SELECT uri, title, topic, sharesFacebook, importanceRank FROM prepared_unscaled"""))
def s4_request_input(spark, sf_dir):
    """JSON lines of strings, cast, in file order, prepared."""
    return prep.prepare_articles(_request(spark, sf_dir), scale=False).select(
        "uri", "title", "topic", "sharesFacebook", "importanceRank")


@query("n8_inference", S.with_(S.PREPARED, f"""
, _r AS (SELECT * FROM prepared ORDER BY md5(concat(uri, '9')), uri LIMIT 40),
_b AS (SELECT title, shares_scaled, {preprocess_sql('body', Tx.load_stop_words('italian'))} AS body_pre FROM _r)
SELECT title, body_pre, round(score, 9) AS score, round(shares_scaled, 9) AS shares_scaled
FROM (SELECT *, {_sentiment_sql('body_pre')} FROM _b WHERE coalesce(body_pre, '') <> '')"""))
def n8_inference(spark, sf_dir):
    """The inference chain: request, preparation with a saved fit, seeded
    sample, features, JSON instances (read back)."""
    from newsfeat.plans import featurize as Fz

    saved = Snk.write_parquet(prep.robust_fit(unscaled(spark, sf_dir), "sharesFacebook"), scratch_path(spark, "fit"))
    inst = Fz.inference_instances(_request(spark, sf_dir), spark.read.parquet(saved), 40, seed=9)
    row = F.from_json("instance", "title string, body_pre string, score double, shares_scaled double").alias("i")
    return inst.select(row).select("i.title", "i.body_pre", F.round("i.score", 9).alias("score"),
                                   F.round("i.shares_scaled", 9).alias("shares_scaled"))


@query("s11_request_json_lines")
def s11_request_json_lines(spark, sf_dir):
    """Scoring instances written as JSON lines and read back."""
    from newsfeat.plans import featurize as Fz

    feats = Fz.feature_table(split_articles(spark, sf_dir))
    inst = Fz.scoring_instances(feats.where(F.col("split") == "TEST"))
    path = Snk.write_json_lines(inst.select("instance"), scratch_path(spark, "jsonl"))
    return spark.read.json(path)


_S12_COLS = ["uri", "title", "lang", "sourceTitle", "topic", "year_month"]


@query("s12_sample_row_columns", S.with_(S.PREPARED_UNSCALED, f"""
SELECT "column", value FROM (
  UNPIVOT (SELECT {', '.join(f'cast({c} AS VARCHAR) AS {c}' for c in _S12_COLS)} FROM prepared_unscaled
           ORDER BY md5(concat(uri, '5')), uri LIMIT 1)
  ON {', '.join(_S12_COLS)} INTO NAME "column" VALUE value)"""))
def s12_sample_row_columns(spark, sf_dir):
    """One seeded random row shown column by column."""
    row = Smp.seeded_sample(unscaled(spark, sf_dir), 1, seed=5, key="uri").select(*_S12_COLS)
    return Snk.columns_as_rows(row)


@query("f1_year_partitions", S.with_(S.ARTICLES, """
SELECT uri, ingest_seq, date, try_cast(date AS DATE) AS date_column FROM articles
WHERE year(try_cast(date AS DATE)) = 2023 AND try_cast(date AS DATE) <= DATE '2023-09-30'"""))
def f1_year_partitions(spark, sf_dir):
    """F1 on the layout by year: folders of other years are not read."""
    path = Snk.write_by_year(articles(spark, sf_dir), scratch_path(spark, "by_year"))
    return Snk.read_year(spark, path, 2023, last="2023-09-30").select("uri", "ingest_seq", "date", "date_column")
