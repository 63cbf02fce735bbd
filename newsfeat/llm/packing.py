"""Order-preserving packing of token sequences by dynamic programming.

The documents of a partition form one stream of ids in their order.  Cuts are
allowed behind a document, behind a sentence (an id whose bytes end a sentence
or a line) and, in a stretch without either, every ``STRIDE`` ids.  A window
between two cuts holds at most ``size`` ids and costs its padding up to
``size`` (none if its length is a power of two), ``WINDOW_COST`` for itself,
and the cost of its end: nothing behind a document, ``SENTENCE_COST`` behind a
sentence, ``STRETCH_COST`` elsewhere.

With ``best[i]`` the least cost of all up to cut i at place ``p[i]``,
``best[j] = size - p[j] + cost(j) + min(best[i] + p[i])`` over the cuts i of the
window before j: a queue whose values rise keeps that minimum, so a cut is
handled in constant time.  The few cuts at the distance of a power of two are
compared besides.

A stream is packed in stretches of ``STREAM`` ids: all windows but the last are
final, the last one's ids open the next stretch.  Memory is bounded and only
the end of a partition is cut short.
"""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.hashing import as_bytes

SIZE = 2048
END_ID = 1
STRIDE = 512
STREAM = 1 << 19
WINDOW_COST = 8
SENTENCE_COST = 12
STRETCH_COST = 200
SPECIAL = "<|endoftext|>"


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class ByteCodec:
    """Byte-level BPE of a rank file: the ids of the ``tokenizers`` file with
    the same vocabulary, whose special token has the id behind the last rank."""

    def __init__(self, ranks: str):
        import public_tokenizers

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                        special_tokens={SPECIAL: len(table)})
        self.ends_sentence = np.zeros(len(table) + 1, bool)
        for piece, i in table.items():
            self.ends_sentence[i] = piece.endswith((b".", b"!", b"?")) or b"\n" in piece
        self.ends_sentence[len(table)] = True

    def ids(self, text: str) -> list[int]:
        """No ids are added; the special token's string becomes its id."""
        if SPECIAL in text:
            return self._coder.encode(text, allowed_special="all")
        return self._coder.encode_ordinary(text)


@lru_cache(maxsize=2)
def codec(ranks: str) -> ByteCodec:
    return ByteCodec(ranks)


def window_ends(place: np.ndarray, cost: np.ndarray, size: int = SIZE) -> list[int]:
    """The best cuts of a stream: indices into ``place``, whose first value is
    the start and last one the end; neighbours are at most ``size`` apart."""
    n = len(place)
    twin: list[list[int]] = [[] for _ in range(n)]
    step = 1
    while step < size:
        at = np.searchsorted(place, place - step)
        for j in np.flatnonzero(place[at] == place - step).tolist():
            twin[j].append(int(at[j]))
        step *= 2
    p, extra = place.tolist(), (cost + WINDOW_COST).tolist()
    # a power of two as size is met without padding by the queue itself
    best, before = [0.0] * n, [0] * n
    queue: deque[int] = deque()
    for j in range(1, n):
        value = best[j - 1] + p[j - 1]
        while queue and best[queue[-1]] + p[queue[-1]] >= value:
            queue.pop()
        queue.append(j - 1)
        pj = p[j]
        while p[queue[0]] < pj - size:
            queue.popleft()
        i = queue[0]
        least = best[i] + p[i] + size - pj
        for k in twin[j]:
            if best[k] < least:
                least, i = best[k], k
        best[j], before[j] = least + extra[j], i
    ends, j = [], n - 1
    while j:
        ends.append(j)
        j = before[j]
    return ends[::-1]


class _Stream:
    """The ids of a partition that are not packed yet."""

    def __init__(self, ends_sentence: np.ndarray, size: int):
        self.ends_sentence, self.size = ends_sentence, size
        self.parts: list[tuple[object, int, np.ndarray, int]] = []  # document, first id's place in it, ids, its total
        self.length = 0
        self.sequence = 0

    def add(self, doc, ids: np.ndarray) -> None:
        self.parts.append((doc, 0, ids, len(ids)))
        self.length += len(ids)

    def _cuts(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(ids)
        cost = np.full(n + 1, -1.0)
        cost[1:][self.ends_sentence[ids]] = SENTENCE_COST
        doc_ends = np.cumsum([len(x[2]) for x in self.parts])
        cost[doc_ends] = 0
        cost[0] = 0
        place = np.flatnonzero(cost >= 0)
        gap = np.diff(place)
        wide = np.flatnonzero(gap > STRIDE)
        if len(wide):
            more = np.concatenate([np.arange(place[k] + STRIDE, place[k + 1], STRIDE) for k in wide])
            cost[more] = STRETCH_COST
            place = np.flatnonzero(cost >= 0)
        return place, cost[place]

    def packed(self, last: bool) -> Iterator[tuple]:
        """Pieces of the final windows; ``last``: of all."""
        if not self.parts:
            return
        ids = np.concatenate([x[2] for x in self.parts])
        place, cost = self._cuts(ids)
        ends = place[window_ends(place, cost, self.size)]
        if not last:
            ends = ends[:-1]
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        part, used, at = 0, 0, 0  # of the current part, ids used; place in the stream
        for start, end in zip(starts.tolist(), ends.tolist()):
            while at < end:
                doc, first, own, total = self.parts[part]
                n = min(len(own) - used, end - at)
                piece = own[used:used + n]
                yield (doc, first + used, n, zlib.crc32(piece.astype("<u4").tobytes()), total, self.sequence, at - start)
                used, at = used + n, at + n
                if used == len(own):
                    part, used = part + 1, 0
            self.sequence += 1
        rest = self.parts[part:]
        if rest and used:
            doc, first, own, total = rest[0]
            rest[0] = (doc, first + used, own[used:], total)
        self.parts, self.length = rest, sum(len(x[2]) for x in rest)


_NAMES = ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _packed(batches: Iterator[pa.RecordBatch], ranks: str, size: int) -> Iterator[pa.RecordBatch]:
    own = codec(ranks)
    stream = _Stream(own.ends_sentence, size)
    base = TaskContext.get().partitionId() << 40

    def rows(pieces: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*pieces)) if pieces else [()] * len(_NAMES)
        columns[5] = [base + s for s in columns[5]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES)

    for batch in batches:
        for doc, text in zip(batch.column("_doc").to_pylist(), as_bytes(batch.column("text"))):
            ids = own.ids(text.decode())
            ids.append(END_ID)
            stream.add(doc, np.array(ids, np.int64))
            if stream.length >= STREAM:
                yield rows(list(stream.packed(False)))
    yield rows(list(stream.packed(True)))


def packed(docs: DataFrame, size: int = SIZE, ranks: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset)``:
    a row for each piece of a document, in windows of at most ``size`` ids.
    Packing goes along the rows of each partition of ``docs`` and needs no
    shuffle; sequence ids are unique, not gapless.

    Defined results: a null or empty text is the end id alone; rows with a
    null or repeated id are documents of their own; an empty table gives no
    rows; a text longer than a window is cut, never shortened; other columns
    are not read."""
    path = ranks or default_ranks()
    one = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("text"))
    schema = ", ".join(f"{c} long" for c in _NAMES)
    return one.mapInArrow(lambda it: _packed(it, path, size), schema).withColumnRenamed("doc", id_col)
