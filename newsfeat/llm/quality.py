"""Quality rules and a verdict by log-likelihood ratio of hashed n-grams.

Words and signs of a text, and pairs of neighbours, are hashed to ``BUCKETS``
features; a word said twice in a row is one feature, whatever the word.  Two multinomials are counted: over trusted documents (all
those labelled good) and over the whole raw corpus.  A document's
score is the mean of log(trusted / raw) over its features, so that length plays
no part.  The threshold is fitted on all labelled documents: of all cuts the one
with the smallest cost, a good document lost counting ``GOOD_COST`` times a bad
one kept; every document is then decided by ``score >= threshold``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.hashing import BYTE_VALUES, IS_WORD, U64, WORD_OR_SIGN, Block, as_bytes, blocks, mix, window_hash
from newsfeat.llm.tables import dropped, labelled, written
from newsfeat.operators.ranking import cumulative_within

BUCKETS = 1 << 16
WINDOW = 8
GOOD_COST = 20

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_IN_WORD = IS_WORD.astype(np.int64)
_IN_WORD[0x80:0xC0] = 0  # later bytes of a longer character

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _dup_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    lines = [x for x in lines if x.strip()]
    return len(lines) - len(set(lines))


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The five base counts of each text."""
    out: dict[str, list] = {c: [] for c in BASE}
    for lo, hi in blocks(texts):
        b = Block(texts[lo:hi], IS_WORD, BYTE_VALUES)
        out["n_words"].append(np.bincount(b.doc, minlength=b.n))
        out["word_chars"].append(b.count(_IN_WORD[b.data]))
        out["n_symbols"].append(b.count(_SYMBOL[b.data]))
        out["n_dup_lines"].append(np.fromiter(map(_dup_lines, texts[lo:hi]), np.int64, b.n))
        seen = np.zeros(len(b.doc) + 1, np.int64)
        whole = window_hash(b.hash, WINDOW)
        if len(whole):
            first = np.flatnonzero(b.doc[:len(whole)] == b.doc[WINDOW - 1:])  # windows within one text
            key = mix(whole[first] + mix(b.doc[first].astype(np.uint64) + U64(1)))
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            twice = np.zeros(len(key), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            start = first[twice]
            np.add.at(seen, start, 1)
            np.add.at(seen, start + WINDOW, -1)
        out["n_repeat_words"].append(np.bincount(b.doc, weights=np.cumsum(seen)[:-1] > 0, minlength=b.n).astype(np.int64))
    return {c: np.concatenate(x) if x else np.empty(0, np.int64) for c, x in out.items()}


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """``(text, bucket, texts)`` of the n-grams of each block of texts."""
    for lo, hi in blocks(texts):
        b = Block(texts[lo:hi], WORD_OR_SIGN, BYTE_VALUES)
        pair = b.doc[1:] == b.doc[:-1]
        left, right = b.hash[:-1][pair], b.hash[1:][pair]
        two = mix(np.where(left == right, U64(0), left * U64(0xD6E8FEB86659FD93) + right))
        bucket = np.concatenate([b.hash, two]) >> U64(48)
        yield np.concatenate([b.doc, b.doc[1:][pair]]), bucket.astype(np.int64), b.n


@dataclass
class QualityModel:
    ratio: np.ndarray  #: log(trusted / raw) of each bucket
    threshold: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The mean ratio of each text's features; 0 without any."""
        out = [np.empty(0)]
        for doc, bucket, n in features(texts):
            total = np.bincount(doc, weights=self.ratio[bucket], minlength=n)
            out.append(total / np.maximum(1, np.bincount(doc, minlength=n)))
        return np.concatenate(out)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The feature counts of a partition: one row for each bucket it has."""
    n = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _doc, bucket, _n in features(as_bytes(batch.column("text"))):
            n += np.bincount(bucket, minlength=BUCKETS)
    full = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(n[full])], names=["bucket", "n"])


def _bucket_counts(texts: DataFrame) -> np.ndarray:
    """Of each bucket its features in all ``texts``; only sums reach the driver."""
    counts = texts.select("text").mapInArrow(_counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS)
    out[counts["bucket"].to_numpy(int)] = counts["n"]
    return out


def _labelled(batches: Iterator[pa.RecordBatch], model: QualityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = as_bytes(batch.column("text"))
        yield pa.RecordBatch.from_arrays([pa.array(model.scores(texts)), pa.array(~_base_failed(base_counts(texts))),
                                          batch.column("_label")], names=["score", "passes", "label"])


def _base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < 20) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"])


def best_threshold(seen: DataFrame) -> float:
    """The cut of least cost in rows ``(score, label)``, in the middle of its
    gap; without documents of both labels the cut that keeps all.  Costs are
    running totals over the distinct scores; one row reaches the driver."""
    good = F.col("label") == 1
    # equal scores are never parted
    cells = seen.groupBy("score").agg(F.sum(good.cast("long")).alias("good"), F.sum((~good).cast("long")).alias("other"),
                                      F.sum((F.col("label") == 0).cast("long")).alias("bad"))
    c = cumulative_within(cells, [], ["score"], ["good", "other", "bad"], ["_good", "_other", "_bad"],
                          ["goods", "others", "bads"])
    # the cut before a cell rejects all cells below it
    cost = GOOD_COST * (F.col("_good") - F.col("good")) + F.col("others") - (F.col("_other") - F.col("other"))
    best = c.where((F.col("goods") > 0) & (F.col("bads") > 0)).withColumn("cost", cost).orderBy("cost", "score").first()
    below = best and c.where(F.col("score") < best["score"]).agg(F.max("score")).first()[0]
    return float("-inf") if below is None else (below + best["score"]) / 2


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> QualityModel:
    """Counts the raw corpus over all of ``docs`` and the trusted one over all
    that are labelled good; only bucket sums and the cut reach the driver.  An
    empty corpus gives ratios of 0."""
    seen = written(labelled(docs, labels, label_col, id_col, text_col), "quality_labelled")
    raw = _bucket_counts(docs.select(F.col(text_col).alias("text")))
    trusted = _bucket_counts(seen.where("_label = 1"))
    ratio = np.zeros(BUCKETS)
    if trusted.any():
        ratio = np.log((trusted + 1) / (trusted.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    model = QualityModel(ratio, float("-inf"))
    scored = written(seen.mapInArrow(lambda it: _labelled(it, model), "score double, passes boolean, label int"), "quality_scores")
    dropped(seen)
    model.threshold = best_threshold(scored.where("passes"))
    return model


def _judged(batches: Iterator[pa.RecordBatch], model: QualityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = as_bytes(batch.column("text"))
        counts, score = base_counts(texts), model.scores(texts)
        failed = _base_failed(counts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_doc"), *(pa.array(counts[c], pa.int64()) for c in BASE), pa.array(failed), pa.array(score),
             pa.array(~failed & (score >= model.threshold))], names=["doc", *BASE, "base_failed", "score", "kept"])


def judged(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, base counts, base_failed, score, kept)``, a row for each row
    of ``docs``, without a shuffle.  Defined results: a null text has no words,
    and a text of fewer than 20 words fails; ids, null or repeated, are passed
    through; an empty table gives no rows; other columns are not read."""
    one = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("text"))
    schema = "doc long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, score double, kept boolean"
    return one.mapInArrow(lambda it: _judged(it, model), schema).withColumnRenamed("doc", id_col)


def good_documents(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with the same columns."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(text_col))
            yield batch.filter(pa.array(~_base_failed(base_counts(texts)) & (model.scores(texts) >= model.threshold)))

    return docs.mapInArrow(keep, docs.schema)
