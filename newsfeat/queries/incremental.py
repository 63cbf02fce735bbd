"""Q1: incremental scoring over export files arriving in three batches; the
final table must equal the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfeat.operators import prepare as prep
from newsfeat.queries import sql as S
from newsfeat.queries.common import articles
from newsfeat.queries.io import export_articles
from newsfeat.queries.registry import query
from newsfeat.functions import text as Tx
from newsfeat.queries.text import _sentiment_sql, preprocess_sql
from newsfeat.session import scratch_path
from newsfeat.streaming import incremental as Inc

R = 9


@query("q1_incremental_scoring", S.with_(S.PREPARED, f"""
SELECT uri, title, topic, round(shares_scaled, {R}) AS shares_scaled, round(score, {R}) AS score,
       round(magnitude, {R}) AS magnitude FROM (
  SELECT uri, title, topic, shares_scaled, {_sentiment_sql('body_pre')}
  FROM (SELECT *, {preprocess_sql('body', Tx.load_stop_words('italian'))} AS body_pre FROM prepared)
  WHERE coalesce(body_pre, '') <> '')"""))
def q1_incremental_scoring(spark, sf_dir):
    """Every article exported as JSON files in three arrival batches; a
    streaming query (available-now trigger) runs after each batch and
    writes scored, de-duplicated rows.  The scaler fit is the batch fit."""
    a = articles(spark, sf_dir)
    center, scale = Inc.scale_literals(prep.robust_fit(prep.prepare_articles(a, scale=False), "sharesFacebook"))
    root = scratch_path(spark, "q1")
    source, sink, ckpt = f"{root}/source", f"{root}/sink", f"{root}/checkpoint"
    last = a.agg(F.max("ingest_seq")).first()[0]
    for k in range(3):  # the copies of a uri may arrive in different batches
        export_articles(a.where((F.col("ingest_seq") > last * k // 3 - (k == 0)) & (F.col("ingest_seq") <= last * (k + 1) // 3)),
                        f"{source}/batch{k}")
        Inc.run_incremental_scoring(spark, source, sink, ckpt, center, scale)
    out = spark.read.parquet(sink)
    return out.select("uri", "title", "topic", *[F.round(c, R).alias(c) for c in ["shares_scaled", "score", "magnitude"]])
