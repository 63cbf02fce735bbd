"""Time-ordered split (V1) and balanced down-sampling.

Both need positions inside a label group.  Labels are few and large, so a
``row_number() over (partition by topic ...)`` would run each label in one
task; ``row_number_within`` spreads every label over range partitions and
adds exact offsets instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.operators.ranking import row_number_within


def train_count(n):
    """``int(0.95 * n)`` as exact integer arithmetic (trap T14)."""
    return F.floor((n * F.lit(95)) / F.lit(100)).cast("long")


def time_split(df: DataFrame, label: str = "topic", date_col: str = "date_column",
               tie: str = "uri", out: str = "split", train_pct: int = 95) -> DataFrame:
    """V1: per label ordered by date (ties by ``tie``): the first
    ``floor(train_pct% * n)`` rows are TRAIN, the next ``(n - train) div 2``
    VALIDATE, the rest TEST."""
    r = row_number_within(df, [label], [F.col(date_col), F.col(tie)], rn="_rn", size="_n")
    n = F.col("_n")
    t1 = F.floor((n * F.lit(train_pct)) / F.lit(100)).cast("long")
    t2 = t1 + F.floor((n - t1) / F.lit(2)).cast("long")
    rn = F.col("_rn")
    return (r.withColumn(out, F.when(rn <= t1, "TRAIN").when(rn <= t2, "VALIDATE").otherwise("TEST"))
            .drop("_rn", "_n"))


def hash_order(key: str, seed: int | str) -> F.Column:
    """Seeded pseudo-random order that does not depend on partitioning and
    is reproducible in any SQL engine with ``md5``."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))


def balance_classes(df: DataFrame, label: str = "topic", key: str = "uri", seed: int = 42) -> DataFrame:
    """From every label keep ``k`` rows, ``k`` = size of the smallest
    label; rows are chosen by a seeded hash order (ties by ``key``)."""
    r = row_number_within(df, [label], [hash_order(key, seed), F.col(key)], rn="_rn", size=None)
    # smallest label size, a scalar subquery over a partial-aggregate count
    k = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).agg(F.min("_n")).scalar()
    return r.where(F.col("_rn") <= k).drop("_rn")


def balanced_training_set(split_df: DataFrame, label: str = "topic", key: str = "uri",
                          seed: int = 42, split_col: str = "split") -> DataFrame:
    """D7 + G1: balanced TRAIN rows followed by all VALIDATE and TEST rows."""
    train = balance_classes(split_df.where(F.col(split_col) == "TRAIN"), label, key, seed)
    rest = split_df.where(F.col(split_col).isin("VALIDATE", "TEST"))
    return train.unionByName(rest, allowMissingColumns=True)
