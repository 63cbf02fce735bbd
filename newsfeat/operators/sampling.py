"""Seeded samples and first-n rows (D3-D6) of any size.

Order keys are explicit (Spark has no file order): a seeded ``md5`` hash
gives a sample that does not depend on partitioning and that any SQL engine
reproduces.  No plan gathers the rows taken: a cut is found from counts, the
rows below it stay where they are, and only the rows at the cut are numbered, in
range partitions.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfeat.operators.ranking import default_partitions, materialize, row_number_within
from newsfeat.operators.split import hash_order

#: Leading bits of the hash that are counted: one row for each of their values.
CUT_BITS = 12


def _edge(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of a small part of a table.  Rows of equal order
    are told apart by their contents, equal ones by chance: they spread over
    the partitions, however many there are."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = df.withColumns({f"__o{i}": c for i, c in enumerate(order)}) \
        .withColumn("__h", F.xxhash64(*plain)).withColumn("__r", F.rand(7))
    keys = [*(f"__o{i}" for i in range(len(order))), "__h", "__r"]
    return row_number_within(spread, [], keys, rn="__n", size=None).where(F.col("__n") <= n).select(*df.columns)


def seeded_sample(df: DataFrame, n: int, seed: int | None = 42, key: str = "uri") -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the first by a seeded hash of
    ``key``, then by ``key`` (trap T5: never raises when ``n`` exceeds the
    rows).  ``seed=None`` is the unseeded form (D4): a fresh seed per call.

    The leading ``CUT_BITS`` bits of the hash are counted over all rows (one
    narrow aggregate, its few rows on the driver); values below the one in
    which row ``n`` lies are taken whole, and of that value's rows, one in
    ``2**CUT_BITS``, the rest is taken in order."""
    order = hash_order(key, secrets.randbits(31) if seed is None else seed)
    digits = (CUT_BITS + 3) // 4
    # null keys come first, as in an ascending sort
    bucket = F.coalesce(F.conv(F.substring(order, 1, digits), 16, 10).cast("int"), F.lit(-1))
    counts = sorted(map(tuple, df.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()))
    before = 0
    for b, size in counts:
        if before + size > n:
            return df.where(bucket < b).unionByName(_edge(df.where(bucket == b), [order, F.col(key)], n - before))
        before += size
    return df


def first_rows(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first ``n`` rows in ``order`` (any sortable column, null
    first).  Ranges of the order column are counted; the rows below the range
    in which row ``n`` lies are taken whole, and of that range the rest."""
    at = F.struct(F.col(order).alias("o"))
    keys = df.select(at.alias("k")).withColumn("r", F.rand(7))  # equal values spread over several ranges
    ranges = materialize(
        keys.repartitionByRange(max(default_partitions(df), 64), "k", "r").withColumn("p", F.spark_partition_id())
        .groupBy("p").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")), "ranges")
    before = 0
    for p, size in sorted(map(tuple, ranges.select("p", "n").collect())):
        if before + size > n:
            lo, hi = (ranges.where(F.col("p") == p).select(c).scalar() for c in ("lo", "hi"))
            sure = df.where(at < lo)  # ranges before this one may end with its first value
            return sure.unionByName(_edge(df.where((at >= lo) & (at <= hi)), [F.col(order)], n - sure.count()))
        before += size
    return df


def first_nonempty(df: DataFrame, text_col: str, n: int, order: str) -> DataFrame:
    """F10 (skip null and empty text, trap T7) then D5."""
    return first_rows(df.where(F.coalesce(F.col(text_col), F.lit("")) != ""), n, order)
