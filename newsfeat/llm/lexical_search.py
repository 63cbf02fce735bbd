"""Ranked lexical search over a length-stratified index.

A document's score depends on its length through the normaliser ``m`` alone.
Documents of one ``m`` are a stratum; within it a term's postings are grouped by
``tf``, so that an impact ``(10**9 * tf) div (1000 * tf + 8 * m)`` is computed
once for each run of postings, not once for each posting.

*Index.*  One scan of the texts counts every document's terms and keeps the
counts of the terms asked for; these narrow rows are range-partitioned by ``m``
(a stratum of any size spreads over several partitions by a hash of the id) and
become rows of the index, each a whole stratum or a piece of one: the ids, and
``(term, tf)`` runs of places.  The index is a written table.

*Search.*  Items go to the index in blocks of bounded size.  A task bounds the
score that a stratum can give to an item by the largest tf of its terms there,
visits the strata from the highest bound downwards, and stops when the bound is
below the score of the k-th best document that it knows.  Of each task at most k
documents an item leave; their ranks are taken over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsfeat.llm.hashing import BYTE_VALUES_LOWER, Block, as_bytes, blocks
from newsfeat.llm.tables import written

#: 1 for the bytes of a term: ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+``.
IS_TERM = np.zeros(256, np.uint8)
for _lo, _hi in ((48, 57), (65, 90), (97, 122), (128, 255)):
    IS_TERM[_lo:_hi + 1] = 1

#: Documents of a stratum, and their postings, in one row of the index; a
#: stratum with more has several rows.
PIECE_DOCS = 4096
PIECE_POSTINGS = 1 << 18
#: (item, term) pairs that are searched for at once: they are collected and
#: shipped to the tasks, 16 bytes each.
BLOCK_TERMS = 1 << 20
#: Strata that are visited before the first bound is compared.
FIRST_VISITS = 8

_FORWARD = "doc long, n long, terms array<int>, tfs array<int>"
_STRATA = "m long, docs array<long>, term array<int>, tf array<int>, size array<int>, places array<int>"


def term_counts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """``(text, term hash, texts)`` of the terms of each block of texts."""
    for lo, hi in blocks(texts):
        b = Block(texts[lo:hi], IS_TERM, BYTE_VALUES_LOWER)
        yield b.doc, b.hash.view(np.int64), b.n


# --------------------------------------------------------------------- index

def _forward(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Documents with a term: how many they have, and the counts of the terms
    of ``vocabulary`` (sorted hashes) by their place in it."""
    size = max(1, len(vocabulary))
    for batch in batches:
        ids, at = batch.column("doc"), 0
        for doc, term, n in term_counts(as_bytes(batch.column("text"))):
            lengths = np.bincount(doc, minlength=n)
            full = np.flatnonzero(lengths)
            place = np.searchsorted(vocabulary, term).clip(max=size - 1)
            known = vocabulary[place] == term if len(vocabulary) else np.zeros(len(term), bool)
            pair, tf = np.unique(doc[known] * size + place[known], return_counts=True)
            ends = np.searchsorted(pair // size, full, "right")
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, n).take(pa.array(full)), pa.array(lengths[full]),
                 pa.ListArray.from_arrays(offsets, pa.array((pair % size).astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32)))],
                names=["doc", "n", "terms", "tfs"])
            at += n


def _document_counts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(size, np.int64)
    for batch in batches:
        total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
    full = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["term", "df"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Runs of rows of one ``m``, of bounded size each."""
    held: list[pa.RecordBatch] = []
    m = docs = postings = None
    for batch in batches:
        values = batch.column("m").to_numpy()
        load = np.diff(batch.column("terms").offsets.to_numpy())
        at = 0
        while at < len(values):
            if held and (values[at] != m or docs >= PIECE_DOCS or postings >= PIECE_POSTINGS):
                yield m, held
                held = []
            if not held:
                m, docs, postings = int(values[at]), 0, 0
            other = np.flatnonzero(values[at:] != m)
            upto = min(len(values) if not len(other) else at + int(other[0]), at + PIECE_DOCS - docs)
            over = np.flatnonzero(postings + np.cumsum(load[at:upto]) >= PIECE_POSTINGS)
            if len(over):
                upto = at + int(over[0]) + 1
            held.append(batch.slice(at, upto - at))
            docs, postings = docs + upto - at, postings + int(load[at:upto].sum())
            at = upto
    if held:
        yield m, held


def _strata(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for m, held in _pieces(batches):
        rows = pa.Table.from_batches(held).combine_chunks()
        terms = rows.column("terms").combine_chunks()
        load = np.diff(terms.offsets.to_numpy())
        term = terms.flatten().to_numpy()
        tf = rows.column("tfs").combine_chunks().flatten().to_numpy()
        place = np.repeat(np.arange(len(load), dtype=np.int32), load)
        order = np.lexsort((place, tf, term))
        term, tf, place = term[order], tf[order], place[order]
        new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])) if len(term) else \
            np.empty(0, np.int64)
        size = np.diff(np.append(new, len(term)))
        one = lambda x: pa.array([x], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([m], pa.int64()), pa.array([rows.column("doc").to_pylist()], pa.list_(pa.int64())),
             one(term[new]), one(tf[new]), one(size), one(place)],
            names=["m", "docs", "term", "tf", "size", "places"])


@dataclass
class LengthIndex:
    strata: DataFrame  #: the index rows
    vocabulary: np.ndarray  #: sorted hashes of the indexed terms
    weight: np.ndarray  #: of each of them
    documents: int  #: with at least one term
    terms: int  #: of all documents, repeats counted


def build_index(docs: DataFrame, vocabulary: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> LengthIndex:
    """The index of every row of ``docs`` for the terms of ``vocabulary``
    (sorted hashes, at most ``BLOCK_TERMS``).  Lengths, and with them the
    strata, count all terms; postings are kept for the vocabulary."""
    one = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    forward = written(one.mapInArrow(lambda it: _forward(it, vocabulary), _FORWARD), "forward")
    count, total = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    size = len(vocabulary)
    seen = forward.select("terms").mapInArrow(lambda it: _document_counts(it, size), "term long, df long") \
        .groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(size, np.int64)
    for term, n in seen:
        df[term] = n
    weight = np.floor(1000 * np.log((2 * count + 2) / (2 * df + 1))).astype(np.int64)
    # the product may leave 64 bits where the quotient does not
    m = F.expr(f"{100 - 75} + (cast(n as decimal(20,0)) * {75 * count}) div cast({max(1, total)} as decimal(20,0))")
    strata = forward.where("size(terms) > 0").select(m.cast("long").alias("m"), "doc", "terms", "tfs") \
        .withColumn("spread", F.xxhash64("doc", "terms"))
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    strata = strata.repartitionByRange(n, "m", "spread").sortWithinPartitions("m", "spread") \
        .select("m", "doc", "terms", "tfs").mapInArrow(_strata, _STRATA)
    return LengthIndex(written(strata, "strata"), vocabulary, weight, count, total)


# -------------------------------------------------------------------- search

class _Best:
    """The k best documents of an item so far: (score, id), null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    def floor(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = (np.concatenate(x) for x in ((self.score, score), (self.id, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score))[:self.k]
        self.score, self.id, self.null = score[order], doc[order], null[order]


class _Strata:
    """A batch of index rows, its runs ordered by term."""

    def __init__(self, batch: pa.RecordBatch, weight: np.ndarray):
        flat = lambda c: batch.column(c).flatten().to_numpy()
        counts = lambda c: np.diff(batch.column(c).offsets.to_numpy())
        m, docs = batch.column("m").to_numpy(), batch.column("docs").flatten()
        self.ids, self.null = docs.fill_null(0).to_numpy(), docs.is_null().to_numpy(zero_copy_only=False)
        self.n = len(m)
        first_doc = np.concatenate([[0], np.cumsum(counts("docs"))])
        piece = np.repeat(np.arange(self.n), counts("term"))
        term, tf, size = flat("term"), flat("tf").astype(np.int64), flat("size").astype(np.int64)
        place = flat("places") + np.repeat(first_doc[:-1], counts("places"))
        start = np.cumsum(size) - size
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[piece]) * weight[term]  # once for each run
        order = np.lexsort((tf, piece, term))
        self.piece, self.term, self.impact = piece[order], term[order], impact[order]
        self.start, self.size, self.place = start[order], size[order], place
        self.top = np.concatenate([(self.term[1:] != self.term[:-1]) | (self.piece[1:] != self.piece[:-1]), [True]]) \
            if len(term) else np.empty(0, bool)
        self.total = np.zeros(len(self.ids), np.int64)

    def runs_of(self, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of an item's terms and what each posting of them adds."""
        lo, hi = np.searchsorted(self.term, terms), np.searchsorted(self.term, terms, "right")
        runs = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)]) if len(terms) else np.empty(0, np.int64)
        return runs, self.impact[runs] * np.repeat(times, hi - lo)

    def search(self, terms: np.ndarray, times: np.ndarray, best: _Best) -> int:
        """Adds the documents of the batch to ``best``; returns how many strata
        were visited."""
        runs, gain = self.runs_of(terms, times)
        bound = np.zeros(self.n, np.int64)
        top = self.top[runs]
        np.add.at(bound, self.piece[runs][top], gain[top])
        order = np.argsort(-bound, kind="stable")
        visited, step = 0, FIRST_VISITS
        while visited < len(order):
            # equal to the floor may still win by its id
            group = order[visited:visited + step]
            group = group[bound[group] >= max(1, best.floor())]
            if not len(group):
                break
            self._visit(group, runs, gain, best)
            visited, step = visited + len(group), step * 2
        return visited

    def _visit(self, group: np.ndarray, runs: np.ndarray, gain: np.ndarray, best: _Best) -> None:
        wanted = np.zeros(self.n, bool)
        wanted[group] = True
        here = wanted[self.piece[runs]]
        runs, gain = runs[here], gain[here]
        size = self.size[runs]
        at = np.repeat(self.start[runs] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        docs = self.place[at]
        np.add.at(self.total, docs, np.repeat(gain, size))
        docs = np.unique(docs)
        score = self.total[docs]
        self.total[docs] = 0
        least = best.floor()
        if len(score) > best.k:  # equal scores at the end all stay
            least = max(least, int(np.partition(score, len(score) - best.k)[len(score) - best.k]))
        good = score >= max(1, least)
        best.add(score[good], self.ids[docs[good]], self.null[docs[good]])


def _searched(batches: Iterator[pa.RecordBatch], items: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray,
              k: int) -> Iterator[pa.RecordBatch]:
    """The k best documents of a task for each item: ``(item, score, doc)``."""
    best = [_Best(k) for _ in items]
    for batch in batches:
        strata = _Strata(batch, weight)
        for (terms, times), b in zip(items, best):
            strata.search(terms, times, b)
    number = np.repeat(np.arange(len(items)), [len(b.score) for b in best])
    join = lambda name, kind: np.concatenate([getattr(b, name) for b in best] + [np.empty(0, kind)])
    yield pa.RecordBatch.from_arrays(
        [pa.array(number, pa.int64()), pa.array(join("score", np.int64)),
         pa.array(join("id", np.int64), mask=join("null", bool))], names=["item", "score", "doc"])


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct term hashes of each item and how often it has them."""
    for batch in batches:
        terms, times = [], []
        for doc, term, n in term_counts(as_bytes(batch.column("text"))):
            first = np.searchsorted(doc, np.arange(n + 1))
            for a, b in zip(first, first[1:]):
                t, c = np.unique(term[a:b], return_counts=True)
                terms.append(t), times.append(c)
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), pa.array(terms, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64())),
             pa.array([len(t) for t in terms], pa.int64())], names=["item", "terms", "times", "n"])


def _ranked_block(spark: SparkSession, docs: DataFrame, block: list, k: int, id_col: str, text_col: str) -> DataFrame:
    vocabulary = np.unique(np.concatenate([np.array(r["terms"], np.int64) for r in block]))
    index = build_index(docs, vocabulary, id_col, text_col)
    items = [(np.searchsorted(vocabulary, np.array(r["terms"], np.int64)), np.array(r["times"], np.int64)) for r in block]
    weight = index.weight
    found = index.strata.mapInArrow(lambda it: _searched(it, items, weight, k), "item long, score long, doc long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(block)], "item long, item_id long")
    return top.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int"), F.col("doc").alias("doc_id"), "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` highest-scoring rows of
    ``docs`` for each row of ``items``, equal scores by id.

    Defined results: a null or termless text is no document, and as an item it
    has no result; documents of one id are ranked each, those without an id
    behind the others of their score; items of one id are searched for each;
    empty tables give no rows.  Other columns are not read."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")) \
        .mapInArrow(_item_terms, "item long, terms array<long>, times array<long>, n long").where("n > 0")
    asked = written(asked, "items")
    n_blocks = -(-(asked.agg(F.sum("n")).first()[0] or 0) // BLOCK_TERMS)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for number in range(n_blocks):  # each holds about BLOCK_TERMS pairs, and single items whole
        block = asked.where(F.pmod(F.xxhash64("item", "terms"), F.lit(n_blocks)) == number).collect()
        if block:
            found = _ranked_block(spark, docs, block, k, id_col, text_col)
            out = found if n_blocks == 1 else out.unionByName(written(found, "ranked"))
    return out.withColumnsRenamed({"item_id": item_col, "doc_id": id_col}) if item_col != id_col else out
