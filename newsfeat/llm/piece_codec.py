"""SentencePiece BPE encoding and decoding with a table of prefix tokens.

The merges of a BPE text end in a sequence of pieces of which every two
neighbours are compatible: merged alone, the two come out as those two pieces.
Conversely a sequence of compatible neighbours is the result, and so the last
piece of the result of every prefix is unique.  Encoding therefore walks over
the text once.  An Aho-Corasick automaton names all pieces that end at a place;
the one that is compatible with the last piece of the prefix before it is the
prefix's last piece and is stored.  At the end the pieces are read backwards
from the table.  Compatibility is found by merging the two pieces and is
remembered.

No piece reaches over certain places: it has the space sign only in front, and
none of this vocabulary has a line feed, or a letter before a punctuation sign.
The runs between such places, which are read off the vocabulary, are encoded
independently; results of recent runs are remembered, in two generations of
bounded size.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Letters; raised digits and fractions are none.
LETTER = r"[^\W\d_\u00b2\u00b3\u00b9\u00bc-\u00be]"
#: Remembered runs and pairs of one generation; two generations are held.
REMEMBERED = 300_000


class _Recent(dict):
    """A memory of bounded size: when a generation is full, the one before it
    is forgotten.  What is forgotten is computed anew."""

    def __init__(self, compute):
        super().__init__()
        self._compute, self._older = compute, {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._compute(key)
        if len(self) >= REMEMBERED:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceCodec:
    """Encoder and decoder of a BPE model file with byte fallback."""

    def __init__(self, model: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.byte_of = {i: int(self.pieces[i][1:-1], 16) for i in range(size) if sp.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        self.silent = {i for i in range(size) if sp.is_control(i)}
        self.unknown = sp.unk_id()
        special = self.silent | set(self.byte_of) | {self.unknown}
        self.id_of = {p: i for i, p in enumerate(self.pieces) if i not in special}
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of) or len(self.byte_id) != 256:
            raise ValueError("a BPE model with byte fallback and spaces only in front of pieces is needed")
        self.run_pattern = self._run_pattern()
        self.signs = frozenset(p for p in self.id_of if len(p) == 1)
        self.plain = frozenset(self.id_of.values())
        score = {p: sp.get_score(i) for p, i in self.id_of.items()}
        # merges go by score; equal scores from left to right
        self.rank = {p: -s for p, s in score.items()}
        # a piece that its own merges do not end in is never a result
        self.automaton = ahocorasick.Automaton()
        for p in self.id_of:
            if self._merged(list(p)) == [p]:
                self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.compatible = _Recent(lambda pair: self._merged([*pair[0], *pair[1]]) == [pair[0], pair[1]])
        self.run = _Recent(self._run)

    def _run_pattern(self) -> re.Pattern:
        """What is encoded at a time: no piece goes beyond either end of it."""
        inside = "\n".join(self.id_of)
        line = "" if any("\n" in p for p in self.id_of) else r"\n"
        cut = "".join(re.escape(c) for c in map(chr, range(33, 127))
                      if not c.isalnum() and c != "_" and not re.search(LETTER + re.escape(c), inside))
        other = f"[^{SPACE}{line}]"
        parts = [f"{SPACE}*{LETTER}+(?=[{cut}])"] * bool(cut) + [f"{SPACE}+{other}*", f"{other}+"] + [r"\n+"] * bool(line)
        return re.compile("|".join(parts))

    def _merged(self, signs: list[str]) -> list[str]:
        """The merges themselves; for single pieces and pairs of them."""
        rank = self.rank
        while len(signs) > 1:
            found = [(rank[p], k) for k in range(len(signs) - 1) if (p := signs[k] + signs[k + 1]) in rank]
            if not found:
                break
            _, k = min(found)
            signs[k:k + 2] = [signs[k] + signs[k + 1]]
        return signs

    def _pieces(self, run: str) -> list[str]:
        """The pieces of ``run``, the last one first."""
        last: list[str | None] = [None] * len(run)  # the last piece of the prefix that ends at a place
        if not self.signs.issuperset(run):
            for k, sign in enumerate(run):
                if sign not in self.signs:  # a sign without a piece never merges
                    last[k] = sign
        compatible = self.compatible
        for end, piece in self.automaton.iter(run):
            if last[end] is None:
                before = end - len(piece)
                if before < 0 or compatible[last[before], piece]:
                    last[end] = piece
        out, end = [], len(run) - 1
        while end >= 0:
            out.append(last[end])
            end -= len(last[end])
        return out

    def run_ids(self, run: str) -> list[int]:
        out = []
        for piece in reversed(self._pieces(run)):
            own = self.id_of.get(piece)
            if own is None:
                out += [self.byte_id[b] for b in piece.encode()]
            else:
                out.append(own)
        return out

    def _run(self, run: str) -> tuple[str, int, bytes]:
        """Ids in decimal digits, how many, and the bytes they decode to."""
        ids = self.run_ids(run)
        if self.plain.issuperset(ids):
            back = "".join([self.pieces[i] for i in ids]).replace(SPACE, " ").encode()
        else:
            back = self._bytes(ids)
        return ",".join(map(str, ids)), len(ids), back

    def _bytes(self, ids: list[int]) -> bytes:
        """Pieces in UTF-8; runs of byte ids with U+FFFD for what is not UTF-8."""
        out = []
        for is_byte, part in groupby(ids, self.byte_of.__contains__):
            if is_byte:
                out.append(_byte_text(bytes(self.byte_of[i] for i in part)))
            else:
                out += ["" if i in self.silent else " ⁇ " if i == self.unknown else self.pieces[i] for i in part]
        return "".join(out).replace(SPACE, " ").encode()

    def runs(self, text: str) -> list[str]:
        return self.run_pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        """The ids of ``text``, without begin and end."""
        return [i for run in self.runs(text) for i in self.run_ids(run)]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; the space that encoding puts in front goes."""
        out = self._bytes(ids).decode()
        first = next((i for i in ids if i not in self.silent), None)
        return out[1:] if first is not None and self.pieces[first].startswith(SPACE) else out

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the ids and of the decoded text."""
        found = list(map(self.run.__getitem__, self.runs(text)))
        ids = ",".join([f[0] for f in found])
        back = b"".join([f[2] for f in found])
        if found and back.startswith(b" "):
            back = back[1:]
        return sum([f[1] for f in found]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back).hexdigest()


def _byte_text(data: bytes) -> str:
    """UTF-8 in which each byte that belongs to no valid sign is a U+FFFD."""
    out = []
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as e:
            out.append(data[:e.start].decode() + "�")
            data = data[e.start + 1:]
    return "".join(out)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def codec(model: str) -> PieceCodec:
    """The codec of a model file, once per worker process."""
    return PieceCodec(model)


def _encoded(batches: Iterator[pa.RecordBatch], model: str, full: bool) -> Iterator[pa.RecordBatch]:
    own = codec(model)
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        n, ids, back = zip(*map(own.digests, texts)) if texts else ((), (), ())
        columns = [batch.column("_doc"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]
        names = ["doc", "n_tokens", "ids_sha256", "decoded_sha256"]
        if full:
            columns.append(pa.array([own.encode(t) for t in texts], pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def encoded(docs: DataFrame, model: str | None = None, with_ids: bool = True, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens, ids_sha256, decoded_sha256[, ids])``, a row for each
    row of ``docs``, without a shuffle.  Defined results: a null text counts as
    empty (no ids, digests of the empty string); ids, null or repeated, are
    passed through; other columns are not read."""
    path = model or default_model()
    one = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("text"))
    schema = "doc long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return one.mapInArrow(lambda it: _encoded(it, path, with_ids), schema).withColumnRenamed("doc", id_col)


def _decoded(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    own = codec(model)
    for batch in batches:
        texts = [own.decode(ids or []) for ids in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(texts, pa.string())], names=["doc", "text"])


def decoded(tokens: DataFrame, model: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, text)`` of rows with ids; null ids decode to an empty text."""
    path = model or default_model()
    one = tokens.select(F.col(id_col).cast("long").alias("_doc"), F.col(ids_col).alias("ids"))
    return one.mapInArrow(lambda it: _decoded(it, path), "doc long, text string").withColumnRenamed("doc", id_col)
