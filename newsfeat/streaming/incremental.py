"""Incremental scoring of arriving articles (Q1) on Structured Streaming.

Two streaming queries, the second run by each micro-batch of the first:

* *arrivals*: ``readStream`` of export files (declared schema); the first copy of
  every uri in a micro-batch, by file order, is written to the micro-batch's own
  folder under the checkpoint (a partial aggregate: a uri with very many copies
  costs a row a task);
* *new uris*: a stream over those folders, which hold a uri once, through
  ``dropDuplicates``.  The state holds every uri of the year seen so far.  It lives
  in the RocksDB state store and is partitioned by uri: a micro-batch looks up its
  own uris only, nothing of the sink is read, however old it is, and no Python runs
  for a uri.  The first copy counts also if a later step drops it, as in the batch
  chain.  What is new goes through the same column functions as the batch chain to
  the ``foreachBatch`` sink;
* a micro-batch re-run after a failure keeps the folder that it has finished, and
  starts from the state of the batch before and overwrites its own partition of the
  sink.

Fits (robust scaler, models) come from a saved batch fit: they are plain
numbers / models, never recomputed from a stream.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.functions import text as Tx
from newsfeat.operators import prepare as prep
from newsfeat.operators import scorers as Sc
from newsfeat.sources.articles import EXPORT_SCHEMA, FLAT_COLUMNS, flatten_articles


def article_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming S1 + P1-P4 over a folder of export files."""
    r = (spark.readStream.schema(EXPORT_SCHEMA).option("multiLine", True)
         .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.json(path)
    exploded = raw.select(F.col("_metadata.file_path").alias("_file"),
                          F.posexplode(F.col("articles.results")).alias("_pos", "a"))
    flat = flatten_articles(exploded, "a")
    return (flat.withColumn("ingest_seq", F.struct(F.col("_file").alias("file"), F.col("_pos").alias("pos")))
            .select(*FLAT_COLUMNS, "ingest_seq"))


def scale_literals(fit: DataFrame) -> tuple[float, float]:
    """The one-row scaler fit as two numbers (model-sized, not data-sized)."""
    row = fit.select("center", "scale").first()
    return float(row["center"]), float(row["scale"])


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_copies(batch: DataFrame, year: int) -> DataFrame:
    """D1 over a micro-batch: of all rows of ``year`` the first copy of each uri
    (null is a uri) by file order."""
    kept = prep.filter_year(prep.parse_date(batch), year)
    rest = [c for c in FLAT_COLUMNS if c != "uri"]
    first = kept.groupBy("uri").agg(F.min_by(F.struct(*rest, "ingest_seq"), "ingest_seq").alias("r"))
    return first.select("uri", "r.*").select(*FLAT_COLUMNS, "ingest_seq")


def _is_complete(spark: SparkSession, path: str) -> bool:
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def score_articles(batch: DataFrame, center: float, scale: float, year: int) -> DataFrame:
    """The batch feature chain on rows that are the only ones of their uri:
    preparation (with the saved scaler), tokens, sentiment, moderation,
    entities."""
    df = prep.prepared_rows(batch, year, first_only=False)
    df = df.withColumn("shares_scaled", (F.col("sharesFacebook") - F.lit(center)) / F.lit(scale))
    df = Sc.skip_empty_once(Tx.preprocess_text(df, "body", "body_pre"), "body_pre")
    df = Sc.project_categories(Sc.sentiment_and_moderation(df, "body_pre"))
    return Sc.regex_entity_features(df, "body_pre").drop("ingest_seq")


def run_incremental_scoring(spark: SparkSession, source: str, sink: str, checkpoint: str,
                            center: float, scale: float, year: int = 2023,
                            max_files_per_trigger: int | None = None) -> list[dict]:
    """Process every export file not yet seen (``Trigger.AvailableNow``)
    and write the newly scored, de-duplicated articles to ``sink``, a folder a
    micro-batch (``batch_id``) and month.  Returns the progress of the
    micro-batches that look up the uris.  ``checkpoint`` holds both queries'
    checkpoints and the first copies of every micro-batch."""
    arrived, progress = f"{checkpoint}/first_copies", []

    def score(batch: DataFrame, batch_id: int) -> None:
        scored = score_articles(batch, center, scale, year).withColumn("batch_id", F.lit(batch_id))
        scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("batch_id", "year_month").parquet(sink)

    def arrive(batch: DataFrame, batch_id: int) -> None:
        path = f"{arrived}/arrival={batch_id}"
        if not _is_complete(spark, path):
            first_copies(batch, year).write.mode("overwrite").parquet(path)
        stored = spark.read.parquet(path).schema
        new = spark.readStream.schema(stored).parquet(arrived).dropDuplicates(["uri"])
        progress.extend(_run(new.select(*stored.names), score, f"{checkpoint}/new_uris"))

    given = spark.conf.get(STATE_STORE, None)
    if given is None or given.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, ROCKSDB)  # state beyond an executor's heap
    try:
        _run(article_stream(spark, source, max_files_per_trigger), arrive, f"{checkpoint}/arrivals")
        return progress
    finally:
        if given is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, given)


def _run(stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str) -> list[dict]:
    """Runs a streaming query on all there is; the progress of its micro-batches."""
    q = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return [p if isinstance(p, dict) else json.loads(p.json) for p in q.recentProgress]


def drop_duplicates_within_watermark(stream: DataFrame, delay: str = "30 days") -> DataFrame:
    """The Spark-native alternative: event-time watermark on ``dateTime``
    and ``dropDuplicatesWithinWatermark(['uri'])``; state is bounded by the
    watermark, but among copies inside one micro-batch any may be kept."""
    ts = F.try_to_timestamp(F.col("dateTime"), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return (stream.withColumn("event_time", ts).where(F.col("event_time").isNotNull())
            .withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["uri"]))
