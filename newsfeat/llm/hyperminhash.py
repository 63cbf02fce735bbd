"""Near-duplicate texts by HyperMinHash sketches.

1. Every text becomes its set of hashed word shingles, the set a fingerprint
   and a sketch: the hash space is divided into ``BUCKETS`` equal buckets and
   the smallest hash of each is kept as a 16-bit register, 6 bits for its
   number of leading zeros and the first 10 bits behind them.  A bucket without
   hashes borrows the register of a bucket with some, chosen by a fixed table
   of priorities, so that short texts compare like long ones.
2. Texts with equal sets are one class; all that follows is done once a class.
   A class is named by its first row, so that an id with several texts is in as
   many classes.
3. Bands of ``ROWS`` registers are hashed.  In each band bucket every class is
   paired with the smallest one: linear in the bucket, whatever its size.
4. The share of equal registers, corrected for registers that agree by chance,
   estimates the Jaccard similarity.  Pairs whose estimate lies more than
   ``SIGMAS`` standard errors under the threshold are left.
5. The other pairs are confirmed on their full sets, in whole numbers.
6. Classes of a bucket that these links have not joined yet are compared by
   their sketches in pieces of bounded size.  Of the pairs whose estimate
   passes, a forest leaves each piece; its trees over all buckets are the
   clusters in which links may be missing.
7. The classes of a cluster are compared on their full sets, again in pieces:
   pairs of one component are left, a link found joins two components at once,
   and at most one link for each class leaves a piece.

Two sets of a similarity s share a band with a probability of
``1 - (1 - s**ROWS)**(BUCKETS // ROWS)``: at 0.8 all but 3 in a million.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.components import connected_components
from newsfeat.llm.hashing import BYTE_VALUES_LOWER, IS_WORD, U64, Block, as_bytes, blocks, mix, window_hash
from newsfeat.llm.tables import written

BUCKET_BITS = 8
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
ROWS = 6
SIGMAS = 5.0
#: Classes of a band bucket that are compared by their sketches in one piece,
#: and classes of a cluster compared on their sets; larger ones are dealt to
#: pieces that compare two parts each.
SKETCH_PIECE = 1024
SET_PIECE = 256

_EDGES = (np.arange(BUCKETS, dtype=np.uint64) << U64(64 - BUCKET_BITS))
#: Which bucket an empty one borrows from: the one with the lowest priority.
_PRIORITY = np.random.Generator(np.random.PCG64(11)).permuted(
    np.tile(np.arange(BUCKETS, dtype=np.int16), (BUCKETS, 1)), axis=1)


# ------------------------------------------------------------------ shingles

def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """Per text its sorted distinct shingle hashes: runs of ``size`` words
    (A-Z lower-cased), all words together if there are fewer, none without."""
    for lo, hi in blocks(texts):
        b = Block(texts[lo:hi], IS_WORD, BYTE_VALUES_LOWER)
        first = np.searchsorted(b.doc, np.arange(b.n + 1))
        whole = window_hash(b.hash, size)
        for i in range(b.n):
            s, e = first[i], first[i + 1]
            if e - s >= size:
                yield np.unique(whole[s:e - size + 1])
            elif e > s:
                yield window_hash(b.hash[s:e], int(e - s))
            else:
                yield np.empty(0, U64)


def fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    place = mix(hashes)
    return int(place.sum().astype(np.int64)), int(np.bitwise_xor.reduce(mix(place + U64(1))).astype(np.int64))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set of hashes: ``BUCKETS`` 16-bit registers."""
    at = np.searchsorted(hashes, _EDGES)
    end = np.append(at[1:], len(hashes))
    full = at < end
    rest = hashes[at[full]] << U64(BUCKET_BITS)
    # of 64 bits the highest 53 decide; a float keeps them with their exponent
    share, exponent = np.frexp((rest >> U64(11)).astype(np.float64))
    zeros = np.minimum(53 - exponent, 63)
    mantissa = ((share * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64).clip(0)
    out = np.zeros(BUCKETS, np.uint16)
    out[full] = (zeros << MANTISSA_BITS) | mantissa
    if not full.all():
        have = np.flatnonzero(full)
        need = np.flatnonzero(~full)
        out[need] = out[have[_PRIORITY[need][:, have].argmin(axis=1)]]
    return out


def _sketch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, key, other, sketch = [], [], [], []
        for s in shingle_sets(as_bytes(batch.column("text")), size):
            n.append(len(s))
            if len(s):
                a, b = fingerprint(s)
                key.append(a), other.append(b)
                sketch.append(registers(s).tobytes())
            else:
                key.append(None), other.append(None), sketch.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_doc").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(key, pa.int64()),
             pa.array(other, pa.int64()), pa.array(sketch, pa.binary())],
            names=["doc", "n_shingles", "set_a", "set_b", "sketch"])


# --------------------------------------------------------------------- bands

def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class and band: the hash of the band's registers."""
    n_bands = BUCKETS // ROWS
    salt = mix(np.arange(1, n_bands + 1, dtype=np.uint64))
    for batch in batches:
        ids = batch.column("doc").to_numpy()
        sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(len(ids), BUCKETS)
        part = sketch[:, :n_bands * ROWS].reshape(len(ids), n_bands, ROWS).astype(U64)
        key = np.broadcast_to(salt, (len(ids), n_bands))
        for r in range(ROWS):
            key = mix(key * U64(0xD6E8FEB86659FD93) + part[:, :, r])
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(ids, n_bands))], names=["band", "doc"])


def by_chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The expected share of registers in which two unrelated sets of these
    sizes agree: both minima have as many leading zeros, and equal mantissas."""
    zeros = np.arange(54)
    load_a, load_b = (np.maximum(1.0, n / BUCKETS)[:, None] for n in (n_a, n_b))
    cell = lambda load: (1 - 0.5 ** (zeros + 1)) ** load - (1 - 0.5 ** zeros) ** load
    return (cell(load_a) * cell(load_b)).sum(axis=1) / (1 << MANTISSA_BITS)


def estimate(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers."""
    chance = by_chance(n_a, n_b)
    return (equal / BUCKETS - chance) / (1 - chance)


def _floor(n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """The lowest estimate that may still belong to a pair at the threshold."""
    t = percent / 100
    return t - SIGMAS * np.sqrt(t * (1 - t) / np.minimum(BUCKETS, np.minimum(n_a, n_b)))


def _promising(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS)
                for c in ("sketch_a", "sketch_b"))
        # sets whose sizes alone rule the threshold out need no estimate
        good = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
        good &= estimate((a == b).sum(axis=1), n_a, n_b) >= _floor(n_a, n_b, percent)
        yield batch.select(["a", "b"]).filter(pa.array(good))


class _Roots:
    """Disjoint sets over the places of a piece."""

    def __init__(self, first: np.ndarray):
        self.up = first.tolist()

    def of(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.of(i), self.of(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _by_piece(batches: Iterator[pa.RecordBatch], compare, key: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by piece: a piece holds classes of one ``key`` (side 0, and
    side 1 if it compares two parts of a large one).  Yields the pairs that
    ``compare`` finds in each piece."""
    held: list[dict] = []

    def found() -> pa.RecordBatch:
        pairs = compare(held)
        return pa.RecordBatch.from_arrays([pa.array([min(p) for p in pairs], pa.int64()),
                                           pa.array([max(p) for p in pairs], pa.int64())], names=["a", "b"])

    for batch in batches:
        for row in batch.to_pylist():
            if held and (row[key], row["piece"]) != (held[0][key], held[0]["piece"]):
                yield found()
                held = []
            held.append(row)
    if held:
        yield found()


def _others(i: int, comp: np.ndarray, side: np.ndarray) -> np.ndarray:
    """What place ``i`` of a piece is compared with: other components of the
    other side, or of the rest of the only side."""
    far = comp != comp[i]
    if side.any():
        return np.flatnonzero(far & (side == 1)) if side[i] == 0 else np.empty(0, np.int64)
    return i + 1 + np.flatnonzero(far[i + 1:])


def _near(i: int, j: np.ndarray, sketch: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Those of ``j`` whose sizes and sketches allow a link with ``i``, the
    likeliest first."""
    j = j[100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])]
    if not len(j):
        return j
    n_i = np.full(len(j), n[i])
    guess = estimate((sketch[j] == sketch[i]).sum(axis=1), n_i, n[j])
    passes = guess >= _floor(n_i, n[j], percent)
    return j[passes][np.argsort(-guess[passes], kind="stable")]


def _candidate_forest(held: list[dict], percent: int) -> list[tuple[int, int]]:
    doc, comp, side = (np.array([r[c] for r in held]) for c in ("doc", "component", "side"))
    n = np.array([r["n_shingles"] for r in held], float)
    sketch = np.frombuffer(b"".join(r["sketch"] for r in held), np.uint16).reshape(-1, BUCKETS)
    roots = _Roots(np.arange(len(held)))
    return [(int(doc[i]), int(doc[j])) for i in range(len(held))
            for j in _near(i, _others(i, comp, side), sketch, n, percent).tolist() if roots.join(i, j)]


def _missing_links(held: list[dict], percent: int) -> list[tuple[int, int]]:
    doc, comp, side = (np.array([r[c] for r in held]) for c in ("doc", "component", "side"))
    sets = [np.frombuffer(r["shingles"], U64) for r in held]
    n = np.array([len(s) for s in sets], float)
    sketch = np.array([registers(s) for s in sets])
    _, first, place = np.unique(comp, return_index=True, return_inverse=True)
    roots, out = _Roots(first[place]), []
    for i in range(len(held)):
        for j in _near(i, _others(i, comp, side), sketch, n, percent).tolist():
            if roots.of(i) != roots.of(j) and _linked(sets[i], sets[j], percent):
                roots.join(i, j)
                out.append((int(doc[i]), int(doc[j])))
    return out


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets reach the threshold; an empty one never does."""
    if not len(x) or not len(y):
        return False
    both = np.intersect1d(x, y, assume_unique=True).size
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [_linked(np.frombuffer(a, U64), np.frombuffer(b, U64), percent)
                for a, b in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())]
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The sets of the texts that have shingles, with their fingerprints."""
    for batch in batches:
        sets = [s for s in shingle_sets(as_bytes(batch.column("text")), size) if len(s)]
        prints = [fingerprint(s) for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in prints], pa.int64()), pa.array([f[1] for f in prints], pa.int64()),
                                          pa.array([s.tobytes() for s in sets], pa.binary())], names=["set_a", "set_b", "shingles"])


# ------------------------------------------------------------------ operator

def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the threshold."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b") \
        .mapInArrow(lambda it: _confirmed(it, percent), "a long, b long")


def _dealt(rows: DataFrame, key: str, size: DataFrame, piece: int) -> DataFrame:
    """``rows`` with the pieces that each takes part in: ``size (key, size)``
    tells how many parts a key has; part p meets every part once, on side 1 if
    the other one is lower."""
    parts = size.select(key, F.ceil(F.col("size") / piece).cast("int").alias("parts"))
    part, other = F.col("part"), F.col("other")
    return rows.join(parts, key) \
        .withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .withColumn("piece", F.concat_ws(":", F.least(part, other), F.greatest(part, other))) \
        .withColumn("side", (part > other).cast("int")).drop("part", "parts", "other")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)``, a row for each row of
    ``docs``: size of its shingle set, smallest id reachable over links of a
    similarity of at least ``percent`` / 100, and whether that is its own.

    Defined results: a null or wordless text has no shingles and links with
    nothing (it is kept); a null id takes no part, its component is null and it
    is kept; repeated rows of one id are one document with all their texts: it
    links with what any of them links with, and its rows differ in
    ``n_shingles`` alone; an empty table gives none.  Other columns of ``docs``
    are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("text"))
    sketched = source.mapInArrow(
        lambda it: _sketch(it, words), "doc long, n_shingles long, set_a long, set_b long, sketch binary")
    sketches = written(sketched.withColumn("row", F.monotonically_increasing_id()), "sketches")
    linked = sketches.where("doc is not null and set_a is not null")
    classes = written(linked.groupBy("set_a", "set_b").agg(F.min("doc").alias("low"), F.min("row").alias("node")), "set_classes")
    member = linked.select("doc", "set_a", "set_b").join(classes, ["set_a", "set_b"])
    same = member.where("doc <> low").select(F.col("doc").alias("u"), F.col("low").alias("v"))
    # from here on "doc" is the node of a class
    sketch_of = written(sketches.join(classes.select("node"), F.col("row") == F.col("node"))
                        .select(F.col("node").alias("doc"), F.col("n_shingles").alias("n"), "sketch"), "sketch_of")

    bands = sketch_of.select("doc", "sketch").mapInArrow(_bands, "band long, doc long")
    shared = bands.groupBy("band").agg(F.min("doc").alias("low"), F.count("*").alias("size")).where("size > 1")
    buckets = written(bands.join(shared, "band"), "buckets")

    first = buckets.where("doc <> low").select(F.col("low").alias("a"), F.col("doc").alias("b")).distinct()
    side = lambda x: sketch_of.select(F.col("doc").alias(x), F.col("n").alias(f"n_{x}"),
                                      F.col("sketch").alias(f"sketch_{x}"))
    first = first.join(side("a"), "a").join(side("b"), "b") \
        .mapInArrow(lambda it: _promising(it, percent), "a long, b long")
    first = written(first, "first_pairs")

    in_bucket = classes.join(buckets.select(F.col("doc").alias("node")).distinct(), "node")
    texts = source.join(in_bucket.select(F.col("low").alias("_doc")).distinct(), "_doc", "left_semi")
    sets = texts.mapInArrow(lambda it: _sets(it, words), "set_a long, set_b long, shingles binary") \
        .groupBy("set_a", "set_b").agg(F.first("shingles").alias("shingles")).join(in_bucket, ["set_a", "set_b"]) \
        .select(F.col("node").alias("doc"), "shingles")
    sets = written(sets, "sets")
    links = written(_verify(first, sets, percent), "first_links")

    # what the links of a bucket's smallest class have not joined
    joined = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    labelled = buckets.join(joined.select(F.col("node").alias("doc"), "component"), "doc", "left") \
        .select("band", "doc", F.coalesce("component", "doc").alias("component"))
    open_ = labelled.groupBy("band").agg(F.count("*").alias("size"), F.min("component").alias("c0"),
                                         F.max("component").alias("c1")).where("c0 < c1")
    pieces = _dealt(labelled, "band", open_, SKETCH_PIECE) \
        .join(sketch_of.select("doc", F.col("n").alias("n_shingles"), "sketch"), "doc") \
        .repartition("band", "piece").sortWithinPartitions("band", "piece")
    forest = pieces.mapInArrow(lambda it: _by_piece(it, lambda held: _candidate_forest(held, percent), "band"),
                               "a long, b long")
    cluster = written(connected_components(forest.select(F.col("a").alias("u"), F.col("b").alias("v")))
                      .select(F.col("node").alias("doc"), F.col("component").alias("cluster")), "clusters")
    size = cluster.groupBy("cluster").agg(F.count("*").alias("size"))
    pieces = _dealt(cluster, "cluster", size, SET_PIECE) \
        .join(joined.select(F.col("node").alias("doc"), "component"), "doc", "left") \
        .withColumn("component", F.coalesce("component", "doc")) \
        .join(sets, "doc").repartition("cluster", "piece").sortWithinPartitions("cluster", "piece", "doc")
    more = written(pieces.mapInArrow(lambda it: _by_piece(it, lambda held: _missing_links(held, percent), "cluster"),
                                     "a long, b long"), "more_links")

    near = links.unionByName(more)
    for end in ("a", "b"):
        low = classes.select(F.col("node").alias(end), F.col("low").alias(f"low_{end}"))
        near = near.join(low, end)
    every = same.unionByName(near.select(F.col("low_a").alias("u"), F.col("low_b").alias("v")))
    component = connected_components(every)
    return sketches.join(component, sketches["doc"] == component["node"], "left").select(
        F.col("doc").alias(id_col), "n_shingles",
        F.coalesce("component", "doc").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc") == F.col("doc"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``near_duplicates`` does not keep; same
    columns.  Rows with a null id stay."""
    gone = near_duplicates(docs, words, percent, id_col, text_col).where("not kept") \
        .select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti").select(*[docs[c] for c in docs.columns])
