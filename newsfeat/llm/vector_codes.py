"""Vectors compressed to product codes by active-entry Lloyd rounds.

A vector becomes whole numbers ``floor(scale * x)`` and is cut into ``parts``
equal consecutive parts; each part position has a codebook of at most
``entries`` entries, which start as that part of the vectors with the smallest
ids.  A round assigns every part to its nearest entry and moves every used
entry to the componentwise ``floor(sum / count)`` of its parts.

The rounds keep, for every part, its entry and the exact squared distance to
it.  After a move a part whose own entry stayed fixed compares that distance
with the moved entries only: the other fixed entries lost against it before and
lose again.  A part whose entry moved compares all entries.  Both keep the lower
index among equal distances, so the codes are those of a full scan.

The state of a round (numbers, codes, distances) is one written table, made
without a shuffle from that of the round before, which is then deleted.  What
meets between tasks are sums: a row for each task, entry and component.  The
driver holds the codebooks, ``entries`` times the dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.tables import dropped, written

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Whole numbers of this magnitude and more are outside the grid: their
#: squared distances could leave 64 bits.
GRID = 1 << 27

_STATE = "vec_id long, label string, grid binary, code binary, distance binary"


@dataclass
class Codebooks:
    dim: int
    books: list[np.ndarray]  #: per part its entries, int64, one row an entry
    moved: list[np.ndarray] = field(default_factory=list)  #: which entries the last round moved

    @property
    def edges(self) -> list[int]:
        return [p * self.dim // len(self.books) for p in range(len(self.books) + 1)]

    def text(self) -> str:
        """All components in decimal by part, entry and place."""
        return ",".join(str(int(x)) for book in self.books for x in book.ravel())

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def grid_rows(column: pa.Array, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the usable vectors of an Arrow list column, and their whole
    numbers.  Not usable: null, empty, with a null, a non-finite component or
    one outside the grid."""
    keep, rows = [], []
    lists = column.cast(pa.list_(pa.float64()))
    values = lists.values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    ends, valid = lists.offsets.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(scale * values)
        good = np.abs(whole) < GRID
    bad = np.concatenate([[0], np.cumsum(~good)])
    for i in np.flatnonzero(valid & (ends[1:] > ends[:-1])):
        lo, hi = ends[i], ends[i + 1]
        if bad[lo] == bad[hi]:
            keep.append(i)
            rows.append(whole[lo:hi].astype(np.int32))
    return np.array(keep, np.int64), rows


def _packed(rows: np.ndarray) -> list[bytes]:
    """Rows of whole numbers as bytes, two for each where they fit."""
    narrow = rows.astype(np.int16)
    return [n.tobytes() if fits else r.tobytes()
            for n, r, fits in zip(narrow, rows.astype(np.int32), (narrow == rows).all(axis=1))]


def _unpacked(cells: list[bytes], dim: int) -> np.ndarray:
    return np.array([np.frombuffer(c, np.int16 if len(c) == 2 * dim else np.int32) for c in cells],
                    np.int64).reshape(-1, dim)


def scanned(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, the lower of equal ones, and the squared
    distance to it."""
    code, best = np.zeros(len(x), np.int64), ((x - book[0]) ** 2).sum(axis=1)
    for e in range(1, len(book)):
        d = ((x - book[e]) ** 2).sum(axis=1)
        nearer = d < best
        code[nearer], best[nearer] = e, d[nearer]
    return code, best


def rescanned(x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray,
              distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same after the entries ``moved`` have moved, from the codes and
    distances of before."""
    code, best = code.copy(), distance.copy()
    whole = moved[code]
    if whole.any():
        code[whole], best[whole] = scanned(x[whole], book)
    fixed = np.flatnonzero(~whole)
    if len(fixed):
        y, c, b = x[fixed], code[fixed], best[fixed]
        for e in np.flatnonzero(moved):
            d = ((y - book[e]) ** 2).sum(axis=1)
            nearer = (d < b) | ((d == b) & (e < c))
            c[nearer], b[nearer] = e, d[nearer]
        code[fixed], best[fixed] = c, b
    return code, best


def _assigned(grid: np.ndarray, books: Codebooks, code: np.ndarray | None,
              distance: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    n, parts = len(grid), len(books.books)
    out, best = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
    for p, (lo, hi) in enumerate(zip(books.edges, books.edges[1:])):
        x = grid[:, lo:hi]
        out[:, p], best[:, p] = scanned(x, books.books[p]) if code is None else \
            rescanned(x, books.books[p], books.moved[p], code[:, p], distance[:, p])
    return out, best


def _first(batches: Iterator[pa.RecordBatch], scale: int, books: Codebooks | None) -> Iterator[pa.RecordBatch]:
    """The usable vectors on the grid; with codebooks of their dimension also
    assigned, else all of them without codes."""
    for batch in batches:
        keep, rows = grid_rows(batch.column("vector"), scale)
        if books is not None:
            same = [len(r) == books.dim for r in rows]
            keep, rows = keep[np.array(same, bool)], [r for r, s in zip(rows, same) if s]
        ids, labels = batch.column("vec_id").take(pa.array(keep)), batch.column("label").take(pa.array(keep))
        if books is None:
            cells, code, distance = [r.astype(np.int32).tobytes() for r in rows], [None] * len(rows), [None] * len(rows)
        else:
            grid = np.array(rows, np.int64).reshape(-1, books.dim)
            c, d = _assigned(grid, books, None, None)
            cells, code, distance = _packed(grid), [x.tobytes() for x in c.astype(np.uint8)], [x.tobytes() for x in d]
        yield _state(ids, labels, cells, code, distance)


def _state(ids, labels, cells, code, distance) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, labels, pa.array(cells, pa.binary()), pa.array(code, pa.binary()), pa.array(distance, pa.binary())],
        names=["vec_id", "label", "grid", "code", "distance"])


def _kept(batch: pa.RecordBatch, books: Codebooks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = len(books.books)
    code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)
    distance = np.frombuffer(b"".join(batch.column("distance").to_pylist()), np.int64).reshape(-1, parts)
    return _unpacked(batch.column("grid").to_pylist(), books.dim), code, distance


def _again(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        code, distance = _assigned(*_of(batch, books))
        yield _state(batch.column("vec_id"), batch.column("label"), batch.column("grid").to_pylist(),
                     [x.tobytes() for x in code.astype(np.uint8)], [x.tobytes() for x in distance])


def _of(batch: pa.RecordBatch, books: Codebooks):
    grid, code, distance = _kept(batch, books)
    return grid, books, code, distance


def _last(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        code, distance = _assigned(*_of(batch, books))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"),
             pa.array([x.tobytes().hex() for x in code.astype(np.uint8)], pa.string()),
             pa.array(distance.sum(axis=1), pa.int64())], names=["vec_id", "label", "code", "error"])


def _sums(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    """The component sums and the sizes of a task's entries: a row for each
    ``cell`` (entry number times dimension plus place)."""
    sums = np.zeros((ENTRIES_MOST, books.dim), np.int64)
    sizes = np.zeros((ENTRIES_MOST, books.dim), np.int64)
    for batch in batches:
        grid, code, _ = _kept(batch, books)
        for p, (lo, hi) in enumerate(zip(books.edges, books.edges[1:])):
            np.add.at(sums[:, lo:hi], code[:, p], grid[:, lo:hi])
            sizes[:, lo:hi] += np.bincount(code[:, p], minlength=ENTRIES_MOST)[:, None]
    cell = np.flatnonzero(sizes.ravel())
    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(sums.ravel()[cell]), pa.array(sizes.ravel()[cell])],
                                     names=["cell", "total", "n"])


#: A code is one byte.
ENTRIES_MOST = 256


def _moved(state: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after their used entries have moved."""
    rows = state.select("grid", "code", "distance") \
        .mapInArrow(lambda it: _sums(it, books), "cell long, total long, n long") \
        .groupBy("cell").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    centre = np.zeros((ENTRIES_MOST, books.dim), np.int64)
    used = np.zeros((ENTRIES_MOST, books.dim), bool)
    for cell, total, n in rows:
        centre.flat[cell], used.flat[cell] = total // n, True
    new, moved = [], []
    for book, lo, hi in zip(books.books, books.edges, books.edges[1:]):
        k = len(book)
        b = np.where(used[:k, lo:hi], centre[:k, lo:hi], book)
        new.append(b)
        moved.append((b != book).any(axis=1))
    return Codebooks(books.dim, new, moved)


def _start(source: DataFrame, parts: int, entries: int, scale: int) -> Codebooks | None:
    """Codebooks of the ``entries`` smallest ids (null last; of repeated ids
    by their numbers).  The dimension is that of the smallest one."""
    on_grid = source.mapInArrow(lambda it: _first(it, scale, None), _STATE).select("vec_id", "grid")
    order = [F.col("vec_id").asc_nulls_last(), "grid"]
    rows = on_grid.orderBy(*order).limit(entries).collect()
    if not rows:
        return None
    size = len(rows[0]["grid"])
    if any(len(r["grid"]) != size for r in rows):
        rows = on_grid.where(F.octet_length("grid") == size).orderBy(*order).limit(entries).collect()
    first = np.array([np.frombuffer(r["grid"], np.int32) for r in rows], np.int64)
    books = Codebooks(size // 4, [first] * parts)
    return Codebooks(books.dim, [first[:, lo:hi].copy() for lo, hi in zip(books.edges, books.edges[1:])])


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
               scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
               label_col: str = "label") -> DataFrame:
    """``(id_col, code, error, label_error, codebooks_sha256, label)``, a row
    for each usable vector: its entry in every codebook (two hex digits each),
    the sum of its squared distances, that error summed over the rows of its
    label, and the digest of all entries.

    Defined results: vectors that are null, empty, hold null or non-finite
    components or whole numbers of ``GRID`` and more are left out, and so are
    those of another length than the vector with the smallest id; a null id is
    the largest; rows of one id count each; null labels count as one label; with
    fewer than ``entries`` vectors the codebooks are as small; a length that
    ``parts`` does not divide gives parts that differ by one; an empty table
    gives no rows.  Other columns are not read."""
    if not 0 < entries <= ENTRIES_MOST:
        raise ValueError(f"a codebook has 1 to {ENTRIES_MOST} entries")
    spark = vectors.sparkSession
    label_type = vectors.schema[label_col].dataType
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                            F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vector"))
    books = _start(source, parts, entries, scale)
    out = [F.col("vec_id").alias(id_col), F.col("code"), F.col("error"), F.col("label_error")]
    if books is None:
        empty = spark.createDataFrame([], "vec_id long, label string, code string, error long, label_error long")
        return empty.select(*out, F.lit("").alias("codebooks_sha256"), F.col("label").cast(label_type).alias(label_col))
    step = lambda df, b, f=None: written(
        df.mapInArrow(lambda it: _first(it, scale, b) if f is None else f(it, b), _STATE), "vector_codes")
    state = step(source, books) if rounds else None
    for r in range(rounds):
        books = _moved(state, books)
        if r < rounds - 1:
            state, old = step(state, books, _again), state
            dropped(old)
    schema = "vec_id long, label string, code string, error long"
    if state is None:
        state = step(source, books)
        books = Codebooks(books.dim, books.books, [np.zeros(len(b), bool) for b in books.books])
    final = books
    coded = written(state.mapInArrow(lambda it: _last(it, final), schema), "coded")
    dropped(state)
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, coded["label"].eqNullSafe(by_label["_label"])).select(
        *out, F.lit(books.sha256()).alias("codebooks_sha256"), F.col("label").cast(label_type).alias(label_col))
