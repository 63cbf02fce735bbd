"""Toxicity grades by cumulative-link ordinal regression.

Features of a text: its words and their beginnings of 4, 5 and 6 bytes (A-Z
lower-cased), hashed.  Those that the labelled texts show to go with toxic
texts are found by a two-proportion test, and of these those are selected that explain
toxic texts which the ones before do not: a rare word that only copies of a few
toxic texts share explains nothing new.  The grades to learn are 0 for
texts labelled clean, and 1, 2 or 3 for toxic ones by thirds of the evidence
that *other* labelled texts give against them: the sum of the log-odds of all
candidate features, counted without the text's own fold.  A grade says how
strongly labels elsewhere call such words toxic; it is no input of the model.

The regression has one weight vector for all grades and ordered thresholds:
``P(grade > k) = sigmoid(w . x - threshold_k)``.  ``x`` holds a 0/1 value for
each selected feature and nothing else.  The output
is the expected grade; a text is toxic if a grade above 0 is likelier than not.

Every labelled text counts, and there may be as many as documents: the texts
and their features stay in tables, and what reaches the driver is bounded by
the number of buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsfeat.llm import hyperminhash
from newsfeat.llm.hyperminhash import registers
from newsfeat.llm.hashing import BYTE_VALUES_LOWER, U64, WORD_OR_SIGN, Block, as_bytes, blocks, mix, window_hash
from newsfeat.llm.tables import bits, dropped, labelled, marked, written
from newsfeat.operators.ranking import exact_quantiles, row_number_within
from newsfeat.session import scratch_path

BUCKET_BITS = 22
#: Keys whose counts a partition holds before it adds up equal ones.
HELD = 1 << 22
GRADES = 4
BEGINNINGS = (4, 5, 6)
#: Share of equal registers from which labelled texts count as copies.
COPY = 0.7
#: Texts of one lowest hash that are compared in one piece; larger groups go in
#: rounds of so many first ones, the others dealt to tasks.
PIECE = 1000
#: Features that are selected from before their texts are counted again.
FRONT = 20
#: Texts up to which the gradient is summed on the driver text by text, and
#: entries of the cells of equal texts up to which it is summed there cell by
#: cell; of more by tasks.  Only the rounding of the sums differs.
DRIVER_ROWS = 20_000
DRIVER_ENTRIES = 500_000
#: Standard errors that a feature's share among toxic texts must exceed.
LEAST_Z = 5.0
LEAST_TOXIC = 4
#: A clean text with a feature outweighs so many toxic ones.
CLEAN_COST = 10
#: Share of the toxic texts above which a feature that no clean one has is
#: selected even if others explain its texts.
COMMON = 0.02
RIDGE = 1e-6
#: Standard deviation of a weight around the log-odds of its feature alone.
SPREAD = 2.0
#: Parts of the labelled texts; a text's evidence is counted in the others.
FOLDS = 5


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each block ``(text of each word, its 4 buckets, words per text)``."""
    signs = np.where(WORD_OR_SIGN == 1, 1, 0).astype(np.uint8)
    for lo, hi in blocks(texts):
        b = Block(texts[lo:hi], signs, BYTE_VALUES_LOWER)
        hashes = [b.hash] + [mix(b.range_hash(b.start, np.minimum(b.start + k, b.end)) + U64(k)) for k in BEGINNINGS]
        yield b.doc, np.stack(hashes, axis=1) >> U64(64 - BUCKET_BITS), np.bincount(b.doc, minlength=b.n)


@dataclass
class ToxicityModel:
    bucket: np.ndarray  #: selected buckets, sorted
    weight: np.ndarray  #: of each selected bucket
    threshold: np.ndarray  #: GRADES - 1 values, ascending

    def vectors(self, texts: list[bytes]) -> Iterator[list[np.ndarray]]:
        """Per block the selected features of each text."""
        for doc, bucket, n_words in features(texts):
            n = len(n_words)
            place = np.searchsorted(self.bucket, bucket).clip(0, max(0, len(self.bucket) - 1))
            hit = self.bucket[place] == bucket if len(self.bucket) else np.zeros(bucket.shape, bool)
            at, k = np.nonzero(hit)
            pairs = np.unique(doc[at] * (len(self.bucket) + 1) + place[at, k])
            owner = pairs // (len(self.bucket) + 1)
            yield np.split(pairs % (len(self.bucket) + 1), np.searchsorted(owner, np.arange(1, n)))

    def exceeds(self, texts: list[bytes]) -> np.ndarray:
        """``P(grade > k)`` of each text, a column for each k."""
        out = [np.empty((0, GRADES - 1))]
        for found in self.vectors(texts):
            score = np.array([self.weight[f].sum() for f in found])
            out.append(_sigmoid(score[:, None] - self.threshold))
        return np.concatenate(out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _slopes(row: np.ndarray, col: np.ndarray, value: np.ndarray, n_features: int, grade: np.ndarray, times: np.ndarray,
            total: float, weight: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """The slope of the log-likelihood in each weight and threshold, summed
    over the rows, each of them taken ``times``, and divided by ``total``."""
    rows = np.arange(len(grade))
    score = np.bincount(row, weights=value * weight[col], minlength=len(grade))
    more = _sigmoid(score[:, None] - threshold)  # P(grade > k)
    edge = np.concatenate([np.ones((len(grade), 1)), more, np.zeros((len(grade), 1))], axis=1)
    p = np.maximum(edge[rows, grade] - edge[rows, grade + 1], 1e-12)
    slope = edge * (1 - edge)
    d_upper, d_lower = times * (slope[rows, grade] / p), times * (slope[rows, grade + 1] / p)
    d_score = (d_upper - d_lower) / total
    d_weight = np.bincount(col, weights=value * d_score[row], minlength=n_features)
    return np.concatenate([d_weight, [(d_lower[grade == j].sum() - d_upper[grade == j + 1].sum()) / total
                                      for j in range(GRADES - 1)]])


def _ascent(slopes: Callable[[np.ndarray, np.ndarray], np.ndarray], n_features: int, of_grade: np.ndarray, steps: int,
            centre: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Gradient ascent with momentum on the mean log-likelihood, of which
    ``slopes`` gives the slopes; ``of_grade`` the rows of each grade."""
    total = of_grade.sum()
    mean, pull = (0.0, RIDGE) if centre is None else (centre, 1 / (SPREAD ** 2 * total))
    above = (np.cumsum(of_grade[::-1])[::-1][1:] / total).clip(1e-3, 1 - 1e-3)
    low = -np.log(above / (1 - above))
    # ordered by construction: the first threshold, then positive steps
    gap = np.log(np.maximum(np.diff(low), 0.05))
    state = np.concatenate([np.full(n_features, 4.0), low[:1], gap])
    speed = np.zeros_like(state)
    size = np.zeros_like(state)
    for step in range(1, steps + 1):
        w, first, gap = state[:n_features], state[n_features], state[n_features + 1:]
        slope = slopes(w, np.concatenate([[first], first + np.cumsum(np.exp(gap))]))
        d_weight, d_threshold = slope[:n_features], slope[n_features:]
        later = np.cumsum(d_threshold[::-1])[::-1]
        grad = np.concatenate([d_weight - pull * (w - mean), later[:1], later[1:] * np.exp(gap)])
        speed = 0.9 * speed + 0.1 * grad
        size = 0.99 * size + 0.01 * grad * grad
        state = state + 0.1 * (speed / (1 - 0.9 ** step)) / (np.sqrt(size / (1 - 0.99 ** step)) + 1e-8)
    first, gap = state[n_features], state[n_features + 1:]
    return state[:n_features], np.concatenate([[first], first + np.cumsum(np.exp(gap))])


def fit_ordinal(row: np.ndarray, col: np.ndarray, value: np.ndarray, n_features: int, grade: np.ndarray, steps: int = 1500,
                centre: np.ndarray | None = None, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of a cumulative-link model on sparse
    rows, by gradient ascent with momentum on the mean log-likelihood, ridge on
    the weights; with ``centre`` a Gaussian prior of deviation ``SPREAD``
    around it, which decides what rows with the same features leave open;
    with ``times`` each row counts so often."""
    times = np.ones(len(grade)) if times is None else times
    return _ascent(lambda *at: _slopes(row, col, value, n_features, grade, times, times.sum(), *at), n_features,
                   np.bincount(grade, weights=times, minlength=GRADES), steps, centre)


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of each entry of the lists ``x``."""
    size = batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(batch.num_rows), size), batch.column("x").flatten().to_numpy(zero_copy_only=False)


def _cell_slopes(batches: Iterator[pa.RecordBatch], n_features: int, total: float, weight: np.ndarray,
                 threshold: np.ndarray) -> Iterator[pa.RecordBatch]:
    out = np.zeros(n_features + GRADES - 1)
    for batch in batches:
        row, col = _entries(batch)
        out += _slopes(row, col, np.ones(len(col)), n_features, batch.column("grade").to_numpy(),
                       batch.column("times").to_numpy(), total, weight, threshold)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out))), pa.array(out)], names=["at", "slope"])


def _fit_lists(x: list[list[int]], n_features: int, grade: list[int], times: list[int], centre: np.ndarray,
               steps: int) -> tuple[np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(x)), [len(f) for f in x])
    col = np.array([i for f in x for i in f], int)
    return fit_ordinal(row, col, np.ones(len(col)), n_features, np.array(grade, int), steps, centre, np.array(times, float))


def fit_texts(texts: DataFrame, n_features: int, centre: np.ndarray, steps: int = 1500) -> tuple[np.ndarray, np.ndarray]:
    """``fit_ordinal`` on a table of texts ``(at, x, grade)``: place, selected
    features and grade.  More than ``DRIVER_ROWS`` texts are counted to cells
    of equal ``x`` and ``grade``; the driver gets at most ``DRIVER_ENTRIES``
    entries of them, or else only the sums of each step."""
    of_grade = np.zeros(GRADES)
    for grade, times in texts.groupBy("grade").count().collect():
        of_grade[grade] = times
    total = of_grade.sum()
    if total <= DRIVER_ROWS:
        all_ = sorted(texts.select("at", "x", "grade").collect())
        return _fit_lists([r["x"] for r in all_], n_features, [r["grade"] for r in all_], [1] * len(all_), centre, steps)
    cells = written(texts.groupBy("x", "grade").agg(F.count("*").alias("times")), "toxic_cells")
    if cells.agg(F.sum(1 + F.size("x"))).first()[0] <= DRIVER_ENTRIES:
        all_ = sorted(cells.select("x", "grade", "times").collect())
        return _fit_lists([r["x"] for r in all_], n_features, [r["grade"] for r in all_], [r["times"] for r in all_], centre, steps)

    def slopes(weight: np.ndarray, threshold: np.ndarray) -> np.ndarray:
        parts = cells.mapInArrow(lambda it: _cell_slopes(it, n_features, total, weight, threshold), "at long, slope double") \
            .groupBy("at").agg(F.sum("slope").alias("slope")).toPandas()
        return parts.sort_values("at")["slope"].to_numpy()

    return _ascent(slopes, n_features, of_grade, steps, centre)


def _odds(t: np.ndarray, c: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log-odds of features in ``t`` of the toxic and ``c`` of the clean texts,
    half a text added to each side."""
    return np.log((t + 0.5) / (n_toxic + 1)) - np.log((c + 0.5) / (n_clean + 1))


def log_odds(row: np.ndarray, col: np.ndarray, n_features: int, toxic: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Of each feature, toxic against clean among the texts ``used``."""
    t, c = (np.bincount(col[(used & side)[row]], minlength=n_features) for side in (toxic, ~toxic))
    return _odds(t, c, (toxic & used).sum(), (~toxic & used).sum())


def _against(row: np.ndarray, col: np.ndarray, fold: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Of each text the sum of its features' log-odds, those of its fold."""
    return np.bincount(row, weights=odds[fold[row], col], minlength=len(fold)).astype(float)  # whole numbers if there are none


def evidence(row: np.ndarray, col: np.ndarray, n_features: int, toxic: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Of each text the sum of its features' log-odds in the other folds."""
    return _against(row, col, fold, np.array([log_odds(row, col, n_features, toxic, fold != f) for f in range(fold.max() + 1)]))


def _masks(batches: Iterator[pa.RecordBatch], front: np.ndarray, chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of the texts without a chosen feature, which of ``front`` they have."""
    order = np.argsort(front)
    for batch in batches:
        row, col = _entries(batch)
        open_ = np.ones(batch.num_rows, bool)
        open_[row[np.isin(col, chosen)]] = False
        place = np.searchsorted(front[order], col).clip(0, len(front) - 1)
        hit = front[order][place] == col
        mask = np.zeros(batch.num_rows, np.int64)
        np.bitwise_or.at(mask, row[hit], np.int64(1) << order[place[hit]])
        yield pa.RecordBatch.from_arrays([pa.array(mask[open_])], names=["mask"])


def _open_counts(batches: Iterator[pa.RecordBatch], n_features: int, chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per partition, in how many texts without a chosen feature each one occurs."""
    n = np.zeros(n_features, np.int64)
    for batch in batches:
        row, col = _entries(batch)
        open_ = np.ones(batch.num_rows, bool)
        open_[row[np.isin(col, chosen)]] = False
        n += np.bincount(col[open_[row]], minlength=n_features)
    full = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(n[full])], names=["at", "n"])


def covering(sets: DataFrame, share: np.ndarray, clean: np.ndarray, n_toxic: int) -> np.ndarray:
    """Features selected one by one: the one next that the most toxic texts
    without a selected feature have, less its cost in clean texts, as long as
    these are ``LEAST_TOXIC`` (equal ones go by their order); and the common
    ones that no clean text has.  ``sets`` holds the features ``x`` of each
    toxic text, ``share`` and ``clean`` the toxic and clean texts of each.

    Gains only fall.  So the ``FRONT`` best features are selected from, with
    the number of texts for each set of them (at most ``2 ** FRONT``), until
    one of the others could be the next; then all are counted again."""
    cost = CLEAN_COST * clean
    gain, chosen = share - cost, np.empty(0, np.int64)
    while True:
        able = np.flatnonzero(gain >= LEAST_TOXIC)
        able = able[np.lexsort((able, -gain[able]))]
        if not len(able):
            break
        front, behind = able[:FRONT], able[FRONT:FRONT + 1]
        counted = sets.mapInArrow(lambda it, f=front, c=chosen: _masks(it, f, c), "mask long") \
            .groupBy("mask").agg(F.count("*").alias("n")).toPandas()
        mask, n = counted["mask"].to_numpy(np.int64), counted["n"].to_numpy(np.int64)
        has = (mask[:, None] >> np.arange(len(front))) & 1 > 0
        while True:
            left = n @ has - cost[front]
            at = np.lexsort((front, -left))[0]
            if left[at] < LEAST_TOXIC or any((gain[b], -b) > (left[at], -front[at]) for b in behind):
                break
            chosen = np.append(chosen, front[at])
            n, has = n[~has[:, at]], has[~has[:, at]]
        counted = sets.mapInArrow(lambda it, c=chosen: _open_counts(it, len(cost), c), "at long, n long") \
            .groupBy("at").agg(F.sum("n").alias("n")).toPandas()
        gain = -cost
        gain[counted["at"].to_numpy(int)] += counted["n"].to_numpy(np.int64)
    common = (cost == 0) & (share >= max(2 * LEAST_TOXIC, COMMON * n_toxic))
    return np.union1d(chosen, np.flatnonzero(common))


def _lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the lowest hash of 4 neighbouring words (of its words, if a text
    has fewer; null without words), and a sketch of all of them."""
    signs = np.where(WORD_OR_SIGN == 1, 1, 0).astype(np.uint8)
    for batch in batches:
        low: list[int | None] = []
        sketch: list[bytes | None] = []
        texts = as_bytes(batch.column("text"))
        for lo, hi in blocks(texts):
            b = Block(texts[lo:hi], signs, BYTE_VALUES_LOWER)
            whole = window_hash(b.hash, 4)
            first = np.searchsorted(b.doc, np.arange(b.n + 1))
            for s, e in zip(first[:-1], first[1:]):
                own = np.unique(whole[s:e - 3] if e - s > 3 else b.hash[s:e])
                low.append(int(own[0].astype(np.int64)) if len(own) else None)
                sketch.append(registers(own).tobytes() if len(own) else None)
        yield pa.RecordBatch.from_arrays([batch.column("_doc").cast(pa.int64()), batch.column("text"), batch.column("_label"),
                                          pa.array(low, pa.int64()), pa.array(sketch, pa.binary())],
                                         names=["_doc", "text", "_label", "low", "sketch"])


def _unlike(batches: Iterator[pa.RecordBatch], grows: bool) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``low`` and ``part`` those that resemble none kept
    before them in their group: all such ones, or with ``grows`` false the
    first ones that are ``old``, which are not returned."""
    group, kept, n = None, np.empty((64, hyperminhash.BUCKETS), np.uint16), 0
    for batch in batches:
        good = np.zeros(batch.num_rows, bool)
        keys = zip(batch.column("low").to_pylist(), batch.column("part").to_pylist())
        for i, (key, old, sketch) in enumerate(zip(keys, batch.column("old").to_pylist(), batch.column("sketch").to_pylist())):
            own = np.frombuffer(sketch, np.uint16)
            if key != group:
                group, n = key, 0
            if not old:
                good[i] = not n or np.count_nonzero(kept[:n] == own, axis=1).max() < COPY * hyperminhash.BUCKETS
            if old or (grows and good[i]):
                if n == len(kept):
                    kept = np.concatenate([kept, np.empty_like(kept)])
                kept[n] = own
                n += 1
        yield batch.filter(pa.array(good))


def originals(rows: DataFrame) -> DataFrame:
    """``_row`` of the rows ``(low, _doc, _hash, _row, sketch)`` that resemble
    none before them, of those that stay and have their lowest hash.  The first
    ``PIECE`` of each hash are compared in one task; in a larger group the
    others are then compared with those that stayed, dealt to many tasks, and
    what resembles none goes on."""
    spark, path, order = rows.sparkSession, scratch_path(rows.sparkSession, "originals"), ["_doc", "_hash", "_row"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", part long, old boolean"
    ahead = Window.partitionBy("low").orderBy(*order)
    spent: list[DataFrame] = []
    while True:
        numbered = rows.withColumn("n", F.row_number().over(ahead))
        first = numbered.where(F.col("n") <= PIECE).drop("n").withColumns({"part": F.lit(0).cast("long"), "old": F.lit(False)})
        stay = first.repartition("low").sortWithinPartitions("low", *order).mapInArrow(lambda it: _unlike(it, True), schema)
        stay = written(stay.select("low", "_row", "sketch"), "stay")
        stay.select("_row").write.mode("append").parquet(path)
        large = rows.groupBy("low").agg(F.ceil(F.count("*") / PIECE).alias("parts")).where("parts > 1")
        if large.isEmpty():
            for table in (stay, *spent):
                dropped(table)
            return spark.read.schema("_row long").parquet(path)
        last = numbered.where(F.col("n") == PIECE).select("low", F.struct(*order).alias("last")).join(large, "low")
        after = rows.join(last, "low").where(F.struct(*order) > F.col("last"))
        after = after.select(*rows.columns, F.pmod(F.xxhash64("_row"), "parts").alias("part"), F.lit(False).alias("old"))
        copies = stay.join(large, "low").select("low", *(F.lit(0).cast("long").alias(c) for c in order), "sketch",
                                                F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                                                F.lit(True).alias("old"))
        new = after.unionByName(copies).repartition("low", "part").sortWithinPartitions("low", "part", F.desc("old")) \
            .mapInArrow(lambda it: _unlike(it, False), schema)
        new = written(new.select(*rows.columns), "unlike")
        for table in (stay, *spent):
            dropped(table)
        rows, spent = new, [new]


def _without_copies(texts: DataFrame) -> DataFrame:
    """``(_row, _doc, _label, text)`` of labelled texts, without those that
    resemble one before them (by id, then by a hash of the text) with the same
    lowest hash; texts without words all stay.  Sketches alone are compared."""
    texts = texts.mapInArrow(_lowest, "_doc long, text string, _label int, low long, sketch binary")
    # numbers in a table stay what they are
    texts = written(texts.withColumn("_row", F.monotonically_increasing_id()), "toxic_labelled")
    stay = originals(texts.where("low is not null").select("low", "_doc", F.xxhash64("text").alias("_hash"), "_row", "sketch"))
    columns = ["_row", "_doc", "_label", "text"]
    stay = written(bits(stay, F.col("_row") + 1), "original_bits")
    out = texts.where("low is null").select(*columns).unionByName(marked(texts.select(*columns), F.col("_row") + 1, stay))
    out = written(out, "toxic_texts")
    dropped(texts)
    return out


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition, in how many toxic and clean texts each bucket occurs."""
    key, count = np.empty(0, U64), np.empty(0, np.int64)
    held: list[np.ndarray] = []
    size = 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        both, at = np.unique(np.concatenate([key, *held]), return_inverse=True)
        weight = np.concatenate([count, np.ones(size, np.int64)])
        return both, np.bincount(at, weights=weight, minlength=len(both)).astype(np.int64)

    for batch in batches:
        toxic = batch.column("_label").to_numpy() > 0
        at = 0
        for doc, bucket, n_words in features(as_bytes(batch.column("text"))):
            one = np.unique((doc[:, None].astype(np.uint64) << U64(BUCKET_BITS)) | bucket)
            of = toxic[at:at + len(n_words)][(one >> U64(BUCKET_BITS)).astype(np.int64)]
            held.append((one & U64((1 << BUCKET_BITS) - 1)) * U64(2) + of)
            size += len(one)
            at += len(n_words)
            if size > HELD:
                key, count = added()
                held, size = [], 0
    key, count = added()
    yield pa.RecordBatch.from_arrays([pa.array((key // U64(2)).astype(np.int64)), pa.array((key % U64(2)).astype(np.int64)),
                                      pa.array(count)], names=["bucket", "toxic", "n"])


def _candidates(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [f.tolist() for x in model.vectors(as_bytes(batch.column("text"))) for f in x]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("_doc"), pa.array(found, pa.list_(pa.int64())),
             pa.array(batch.column("_label").to_numpy() > 0)], names=["_row", "_doc", "x", "toxic"])


def _selected(batches: Iterator[pa.RecordBatch], chosen: np.ndarray, odds: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The selected features of each text, and the evidence against toxic ones."""
    for batch in batches:
        row, col = _entries(batch)
        against = _against(row, col, batch.column("fold").to_numpy(), odds)
        inside = np.isin(col, chosen)
        first = np.searchsorted(row[inside], np.arange(batch.num_rows + 1)).astype(np.int32)
        x = pa.ListArray.from_arrays(pa.array(first), pa.array(np.searchsorted(chosen, col[inside]).astype(np.int64)))
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([batch.column("at"), x, pa.array(against, mask=~toxic)], names=["at", "x", "against"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> ToxicityModel:
    """Fitted on all labelled documents; the driver gets the candidate features
    that pass the test, and their counts.  Without texts of both labels the
    model finds nothing toxic."""
    # copies of a text would make its rare words look toxic: one of them stays
    texts = _without_copies(labelled(docs, labels, label_col, id_col, text_col))
    size = texts.groupBy((F.col("_label") > 0).alias("toxic")).count().collect()
    n_toxic = sum(r["count"] for r in size if r["toxic"])
    n_clean = sum(r["count"] for r in size if not r["toxic"])
    nothing = ToxicityModel(np.empty(0, U64), np.zeros(0), 30.0 + np.arange(GRADES - 1))
    if not n_toxic or not n_clean:
        return nothing
    shares = texts.mapInArrow(_presence, "bucket long, toxic long, n long").groupBy("bucket").agg(
        F.sum(F.col("n") * F.col("toxic")).alias("t"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("c"))
    share_t, share_c = (F.col("t") + 0.5) / (n_toxic + 1), (F.col("c") + 0.5) / (n_clean + 1)
    pooled = (F.col("t") + F.col("c") + 1) / (n_toxic + n_clean + 2)
    z = (share_t - share_c) / F.sqrt(pooled * (1 - pooled) * (1 / n_toxic + 1 / n_clean))
    passing = shares.where(F.col("t") >= LEAST_TOXIC).withColumn("z", z).where(F.col("z") >= LEAST_Z).select("bucket").toPandas()
    found = np.sort(passing["bucket"].to_numpy(np.uint64))

    # one pass over the texts: their candidate features, with folds in the order of their ids
    candidates = ToxicityModel(found, np.zeros(len(found)), nothing.threshold)
    rows = written(texts.mapInArrow(lambda it: _candidates(it, candidates), "_row long, _doc long, x array<long>, toxic boolean"),
                   "toxic_found")
    dropped(texts)
    rows = row_number_within(rows, [], ["_doc", "_row"], rn="at", size=None)
    rows = written(rows.select("at", ((F.col("at") - 1) % FOLDS).cast("int").alias("fold"), "toxic", "x"), "toxic_rows")
    each = [(F.col("fold") == f) & (F.col("toxic") == (side == 1)) for side in (1, 0) for f in range(FOLDS)]
    sizes = np.array(rows.agg(*(F.count_if(e) for e in each)).first()).reshape(2, FOLDS)
    counted = rows.select("fold", "toxic", F.explode("x").alias("f")).groupBy("f").agg(
        *(F.count_if(e).alias(str(i)) for i, e in enumerate(each))).toPandas()
    has = np.zeros((2, FOLDS, len(found)), np.int64)
    has[:, :, counted["f"].to_numpy(int)] = counted.drop(columns="f").to_numpy(np.int64).T.reshape(2, FOLDS, -1)
    (t, c), (of_t, of_c) = has.sum(axis=1), sizes.sum(axis=1)
    odds = np.array([_odds(t - has[0, f], c - has[1, f], of_t - sizes[0, f], of_c - sizes[1, f]) for f in range(FOLDS)])
    chosen = covering(rows.where("toxic").select("x"), t, c, n_toxic)
    seen = written(rows.mapInArrow(lambda it: _selected(it, chosen, odds), "at long, x array<long>, against double"), "toxic_selected")
    third = exact_quantiles(seen, "against", [1 / 3, 2 / 3], ["one", "two"]).first()
    above = sum(((F.col("against") > third[q]).cast("int") for q in ("one", "two")), F.lit(1))
    grades = seen.select("at", "x", F.coalesce(above, F.lit(0)).alias("grade"))
    weight, threshold = fit_texts(grades, len(chosen), _odds(t[chosen], c[chosen], of_t, of_c))
    return ToxicityModel(found[chosen], weight, threshold)


def _graded(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = model.exceeds(as_bytes(batch.column("text")))
        grade = (p >= 0.5).sum(axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_doc"), pa.array(p.sum(axis=1)), pa.array(grade, pa.int32()), pa.array(p[:, 0]),
             pa.array(grade > 0), pa.array(grade == 0)],
            names=["doc", "severity", "grade", "p_toxic", "toxic", "kept"])


def graded(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, severity, grade, p_toxic, toxic, kept)``, a row for each row
    of ``docs``, without a shuffle: expected grade (0 to 3), the median grade,
    the probability of any grade above 0, and the decision (``kept`` is not
    toxic).  Defined results: a null or wordless text has no features and is
    as clean as the model's thresholds say; ids, null or repeated, are passed
    through; an empty table gives no rows; other columns are not read."""
    one = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("text"))
    schema = "doc long, severity double, grade int, p_toxic double, toxic boolean, kept boolean"
    return one.mapInArrow(lambda it: _graded(it, model), schema).withColumnRenamed("doc", id_col)


def clean_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with the same columns."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.exceeds(as_bytes(batch.column(text_col)))[:, 0] < 0.5))

    return docs.mapInArrow(keep, docs.schema)
