"""The training-set plan: prepare -> V1 time split -> X1 scaling -> D7 balance + G1.

Positions inside a label (V1, D7) need range-partitioned, materialised rows.
Carrying whole articles through them would shuffle and write the body text
twice more after the de-duplication.  Instead the positions are computed on
the narrow key columns of the prepared rows (the scan reads only those), and
the whole rows meet the final labels in one equi-join: the text crosses that
shuffle alone and is never written in between.  The join key is ``(uri, ingest_seq)`` compared null-safely:
after the ``'' -> null`` cleaning a ``uri`` may be null, and the pair stays
unique after the de-duplication in every case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.operators.prepare import prepare_articles, prepared_rows, robust_apply, robust_fit
from newsfeat.operators.ranking import materialize
from newsfeat.operators.split import balanced_training_set, time_split

# Columns the positions and the scaler need (plus the key).
LABEL_COLUMNS = ["uri", "ingest_seq", "topic", "date_column", "sharesFacebook"]
KEY = ["uri", "ingest_seq"]


def split_labels(articles: DataFrame, year: int = 2023) -> DataFrame:
    """V1 on the narrow prepared rows: ``LABEL_COLUMNS`` + ``split``."""
    keys = prepare_articles(articles, year=year, scale=False, keep=[]).select(*LABEL_COLUMNS)
    # the labels feed the scaler fit, the balancing and the final join:
    # written once (narrow), the position offsets are not recomputed by each
    return materialize(time_split(keys), "labels")


def _attach(articles: DataFrame, labels: DataFrame, year: int) -> DataFrame:
    # the labels name the surviving rows, so the wide rows need only the
    # row-local steps: no shuffle or sort of the text below the join
    whole = prepared_rows(articles, year, first_only=False)
    lab = labels.select(*[F.col(k).alias(f"_l_{k}") for k in KEY], "split")
    cond = None
    for k in KEY:
        c = whole[k].eqNullSafe(lab[f"_l_{k}"])
        cond = c if cond is None else cond & c
    return whole.join(lab, cond, "inner").select(*whole.columns, "split")


def split_articles(articles: DataFrame, year: int = 2023, scaled: str = "shares_scaled") -> DataFrame:
    """Prepared articles with the V1 split and robust-scaled shares (the
    scaler is fitted on the prepared rows of the year)."""
    labels = split_labels(articles, year)
    fit = robust_fit(labels, "sharesFacebook")
    return robust_apply(_attach(articles, labels, year), fit, "sharesFacebook", scaled)


def balanced_articles(articles: DataFrame, year: int = 2023, seed: int = 42,
                      scaled: str = "shares_scaled") -> DataFrame:
    """D7 + G1: balanced TRAIN rows and all VALIDATE and TEST rows, whole
    articles; the balancing draws on the narrow labels."""
    labels = split_labels(articles, year)
    fit = robust_fit(labels, "sharesFacebook")
    kept = balanced_training_set(labels.select(*KEY, "topic", "split"), seed=seed)
    return robust_apply(_attach(articles, kept, year), fit, "sharesFacebook", scaled)
