"""Composed plans: the feature chain (N8) and the scoring request.

Stages are ``DataFrame -> DataFrame`` functions, so the chain is a single
logical plan; Catalyst fuses all the per-row scorers into one projection
over the prepared rows.  Only the final result is written (see ``sinks``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.functions import columns as Cols
from newsfeat.functions import text as Tx
from newsfeat.operators import scorers as Sc
from newsfeat.operators.prepare import prepare_articles
from newsfeat.operators.sampling import seeded_sample


MOST_INSTANCES = 1_000


def feature_table(articles: DataFrame, text: str = "body") -> DataFrame:
    """N1 tokens -> N4 sentiment -> N5 moderation (P19 names) -> N6
    entities, all on the tokenised text -> P20 conformance.  Documents without
    tokens are skipped; the file order is no feature and goes."""
    df = Sc.skip_empty_once(Tx.preprocess_text(articles, text, "body_pre"), "body_pre")
    df = Sc.project_categories(Sc.sentiment_and_moderation(df, "body_pre"))
    df = Sc.regex_entity_features(df, "body_pre")
    return Cols.conform(df.drop("ingest_seq"))


def scoring_instances(features: DataFrame, target: str = "topic") -> DataFrame:
    """P18 (star-except of target, split and the omit list) + P16 (ids as
    strings) + P26 (one JSON object per row)."""
    req = Cols.select_except(features, [target, "split", *Cols.REQUEST_OMIT, "DATE_count"])
    req = Cols.cast_to_string(req, [c for c in ["relevance", "importanceRank", "alexaGlobalRank", "month"]
                                    if c in req.columns])
    return Cols.to_instances(req)


def inference_instances(articles: DataFrame, fit: DataFrame, n: int, seed: int = 42, year: int = 2023) -> DataFrame:
    """The inference chain on the rows of a request (``read_request_input``):
    preparation with a saved scaler fit, a seeded sample of ``n``, the
    features, and one JSON instance per row."""
    sample = seeded_sample(prepare_articles(articles, year=year, fit=fit), n, seed=seed, key="uri")
    return scoring_instances(feature_table(sample))


def instances_document(instances: DataFrame, n: int = 10, col: str = "instance") -> DataFrame:
    """One ``{"instances": [...]}`` request body holding the first ``n``
    instances (an online request is small by nature).  Larger sets go out as
    JSON lines (``sinks.write_json_lines``)."""
    if n > MOST_INSTANCES:
        raise ValueError(f"one request holds at most {MOST_INSTANCES} instances")
    first = instances.orderBy(col).limit(n)
    return first.agg(F.concat(F.lit('{"instances": ['), F.concat_ws(", ", F.sort_array(F.collect_list(col))),
                              F.lit("]}")).alias("request"))
