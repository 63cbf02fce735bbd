"""Sources mixed to target weights by weighted sampling without replacement.

1. A document's size is its number of words.  Its quality weight falls with the
   share of digits and signs among its characters.
2. Sources get targets by weight; a target stops at ``most`` times its source's
   size, and what is over goes to the others.  With sources in order of
   (limit / weight) the common level of the others is the largest of
   ``(words to share - limits before) / (weights from here on)``, so running
   sums and one maximum give it, without rounds.
3. Every document draws an exponential key, ``-ln(u) / quality`` with ``u`` from
   a digest of its id (Efraimidis and Spirakis): taking the lowest keys first
   samples by quality without replacement, and reruns agree.
4. Whole passes over a source come first.  The rest of its budget is filled in
   the order of keys: running sums of sizes name the document at which the
   budget ends; those before it are taken whole, and of that one as many words as
   are left.  Only this cut, a row for each source, goes back to the documents.

Sizes and keys are made in one scan and written as a narrow table; texts are
never shuffled.  Running sums are taken in range partitions, so a source may
hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.hashing import IS_WORD, as_bytes, blocks
from newsfeat.llm.tables import written
from newsfeat.operators.ranking import cumulative_within, row_number_within

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: How strongly digits and signs lower a document's quality weight.
JUNK_FACTOR = 10.0
SEED = "mix"
JUNK = "0123456789#*$%&|<>=+~^{}[]\\/@_`"

_JUNK = np.zeros(256, bool)
_JUNK[list(JUNK.encode())] = True
_HEAD = np.ones(256, bool)
_HEAD[0x80:0xC0] = False  # later bytes of a longer character


def text_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, characters, and digits and signs of each text."""
    words, chars, junk = (np.zeros(len(texts), np.int64) for _ in range(3))
    for lo, hi in blocks(texts):
        data = np.frombuffer(b"\n".join(texts[lo:hi]) + b"\n", np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts[lo:hi]), np.int64, hi - lo) + 1)
        last = IS_WORD[data].astype(np.int8)
        last[:-1] &= 1 - last[1:]
        for out, flags in ((words, last), (chars, _HEAD[data]), (junk, _JUNK[data])):
            total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
            out[lo:hi] = total[ends] - total[np.concatenate([[0], ends[:-1]])]
        chars[lo:hi] -= 1  # the line feed behind each text
    return words, chars, junk


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = text_counts(as_bytes(batch.column("text")))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *map(pa.array, counts)],
                                         names=["doc", "source", "size", "chars", "junk"])


def _keyed(counted: DataFrame, seed: str) -> DataFrame:
    """With ``key``, 52 bits of a digest of the id as a number between 0 and 1,
    its logarithm scaled by the quality weight, and ``tie``, the id."""
    quality = 1.0 / (1.0 + F.lit(JUNK_FACTOR) * F.col("junk") / F.greatest("chars", F.lit(1)))
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc").cast("string"), F.lit(""))).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    return counted.withColumn("key", -F.log(u) / quality) \
        .withColumn("tie", F.coalesce("doc", F.lit(-(1 << 63)))).drop("chars", "junk")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: str = SEED) -> DataFrame:
    """``(doc, source, size, key, tie)`` of every row, by one scan."""
    one = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(source_col).cast("string").alias("source"),
                      F.col(text_col).alias("text"))
    return _keyed(one.mapInArrow(_counted, "doc long, source string, size long, chars long, junk long"), seed)


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` of ``sources (source, source_size)``:
    ``share`` times all sizes dealt by weight, the weights repeating over the
    sources by code point, null last; no target above ``most`` times its
    source's size."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = row_number_within(sources, [], [F.col("source").asc_nulls_last()], rn="rank", size=None) \
        .withColumn("rank", F.col("rank") - 1).withColumn("weight", weight) \
        .withColumn("limit", F.col("source_size") * F.lit(float(most))) \
        .withColumn("ratio", F.col("limit") / F.col("weight"))
    sums = written(cumulative_within(ranked, [], ["ratio", "rank"], ["limit", "weight", "source_size"],
                                     ["limits", "weights", "sizes"], ["all_limits", "all_weights", "all_sizes"]), "levels")
    before = F.col("limits") - F.col("limit")
    left = F.col("all_weights") - (F.col("weights") - F.col("weight"))
    level = sums.agg(F.max((F.lit(float(share)) * F.col("all_sizes") - before) / left)).scalar()
    return sums.select("source", "source_size", F.least("limit", level * F.col("weight")).alias("target"))


def planned(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """A row for each source: its target, how many whole passes it gets, and
    the cut ``(key, tie, size)`` at which the rest of its budget ends, with the
    words that are left for it, for each of its rows if several are equal."""
    goal = written(targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
    goal = goal.withColumn("budget", F.floor(F.col("target") + 0.5)) \
        .withColumn("passes", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))) \
        .withColumn("rest", F.col("budget") - F.col("passes") * F.col("source_size"))
    cells = sizes.where("size > 0").groupBy("source", "key", "tie", "size").agg(F.count("*").alias("n")) \
        .withColumn("words", F.col("size") * F.col("n"))
    sums = cumulative_within(cells, ["source"], ["key", "tie", "size"], "words", cum="upto", total=None)
    by = goal.select(F.col("source").alias("_source"), "rest")
    ends = sums.join(by, sums["source"].eqNullSafe(by["_source"])) \
        .where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest"))) \
        .select(F.col("source").alias("_source"), F.struct("key", "tie", "size").alias("cut"),
                F.expr("(rest - (upto - words)) div n").alias("part"))
    return written(goal.join(ends, goal["source"].eqNullSafe(ends["_source"]), "left").drop("_source"), "mix_plan")


def _taken(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """``sizes`` with its source's plan and the words taken of every row."""
    p = plan.withColumnRenamed("source", "_source")
    here = F.struct("key", "tie", "size")
    rest = F.when(here < F.col("cut"), F.col("size")).when(here == F.col("cut"), F.col("part")).otherwise(F.lit(0))
    return sizes.join(p, sizes["source"].eqNullSafe(p["_source"])).drop("_source") \
        .withColumn("rest_words", F.when(F.col("size") > 0, rest).otherwise(F.lit(0)).cast("long")) \
        .withColumn("taken", F.col("passes") * F.col("size") + F.col("rest_words"))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """``(id_col, size, source_size, target, taken, source)``, a row for each
    row of ``docs``: its words, its source's words and target, and how many of
    its words the mix takes, repeats counted.

    Defined results: a null or wordless text has size 0 and gives nothing; rows
    without a source are one source, the last; a null id draws the key of the
    empty id; rows of one id draw one key, and if they are equal and the budget
    ends at them, they share its rest evenly, rounded down; equal keys are
    ordered by id, then size; an empty table gives no rows.  Other columns are
    not read."""
    sizes = written(sized(docs, id_col, text_col, source_col, seed), "sizes")
    return _taken(sizes, planned(sizes, weights, share, most)).select(
        F.col("doc").alias(id_col), "size", "source_size", "target", "taken", F.col("source").alias(source_col))


def _first_words(text: bytes, n: int) -> bytes:
    """A text up to the end of its ``n``-th word."""
    word = np.concatenate([IS_WORD[np.frombuffer(text, np.uint8)], [0]])
    ends = np.flatnonzero((word[:-1] == 1) & (word[1:] == 0))
    return text if n >= len(ends) else text[:ends[n - 1] + 1]


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        part = batch.column("part_words").to_pylist()
        texts = as_bytes(batch.column("text"))
        cut = [t if n is None else _first_words(t, n) for t, n in zip(texts, part)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cut, pa.binary()).cast(pa.string())],
                                         names=["doc", "source", "pass", "text"])


def drawn_texts(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                seed: str = SEED) -> DataFrame:
    """The mix itself: ``(id_col, source_col, pass, text)``, a row for each
    pass over a document; in the last one the document at which a budget ends is
    cut behind its last taken word.  The plan of the sources is joined to the
    documents, whose texts are read again and not shuffled but for that join."""
    plan = planned(written(sized(docs, id_col, text_col, source_col, seed), "sizes"), weights, share, most)
    one = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(source_col).cast("string").alias("source"),
                      F.col(text_col).alias("text"))

    def with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = text_counts(as_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, counts)],
                                             names=["doc", "source", "text", "size", "chars", "junk"])

    counted = one.mapInArrow(with_text, "doc long, source string, text string, size long, chars long, junk long")
    rows = _taken(_keyed(counted, seed), plan).where("taken > 0")
    last = F.when(F.col("rest_words") > 0, F.col("passes") + 1).otherwise(F.col("passes"))
    each = rows.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), last)))
    part = F.when((F.col("pass") > F.col("passes")) & (F.col("rest_words") < F.col("size")), F.col("rest_words"))
    return each.select("doc", "source", "pass", "text", part.alias("part_words")) \
        .mapInArrow(_drawn, "doc long, source string, pass long, text string") \
        .withColumnsRenamed({"doc": id_col, "source": source_col})
