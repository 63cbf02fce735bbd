"""Token counts that follow edits.

A text is held in leaves of some hundred characters that end where a pre-token
of the tokenizer ends, in texts without spaces too; only a pre-token that is
longer than a leaf is a longer leaf.  A segment tree over the leaves sums their
characters and tokens.  An edit goes down the tree to its place, replaces the
touched leaves' text and encodes it anew together with the leaves next to it as
far as pre-tokens could change: on the left by ``REACH``, on the right until a
pre-token of the new text ends where a leaf began.  The sums on the way to the
root are updated; nothing else is read.

``edited_counts`` applies edits that stand in a column.  Leaves can be kept as
a table instead (``leaf_table``), to which edits of another table are applied as
they come (``edited_leaves``), and whose sums are the counts (``leaf_counts``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.packing import SPECIAL, ByteCodec, codec, default_ranks

LEAF = 256
#: Characters on which a pre-token's end can depend: two behind it, and those of the special token.
REACH = len(SPECIAL) + 2


class CountedText:
    """A text with its token count, open for edits."""

    def __init__(self, text: str, coder: ByteCodec, pattern: regex.Pattern):
        self._coder, self._pattern = coder, pattern
        self.encoded = 0  #: characters encoded so far
        leaves = self._cut(text)
        self._build(leaves, [self._count(x) for x in leaves])

    @classmethod
    def of_leaves(cls, leaves: list[str], tokens: list[int], coder: ByteCodec, pattern: regex.Pattern) -> CountedText:
        """The text of leaves that were counted before; nothing is encoded."""
        own = cls("", coder, pattern)
        own._build(leaves, tokens)
        return own

    # ------------------------------------------------------------------ tree

    def _build(self, leaves: list[str], counts: list[int]) -> None:
        while leaves and not leaves[-1]:  # room behind the text is made anew
            leaves.pop()
        counts, n = counts[:len(leaves)], 1
        while n < max(1, len(leaves)):
            n *= 2
        self._n = n
        spare = n - len(leaves)
        self.leaf = leaves + [""] * spare
        self._chars = [0] * n + [len(x) for x in self.leaf]
        self._tokens = [0] * n + counts + [0] * spare
        for k in range(n - 1, 0, -1):
            self._chars[k] = self._chars[2 * k] + self._chars[2 * k + 1]
            self._tokens[k] = self._tokens[2 * k] + self._tokens[2 * k + 1]

    def _put(self, i: int, text: str, count: int) -> None:
        self.leaf[i] = text
        k = i + self._n
        chars, tokens = len(text) - self._chars[k], count - self._tokens[k]
        while k:
            self._chars[k] += chars
            self._tokens[k] += tokens
            k //= 2

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (the last with text
        for the end), and the place of its first character."""
        k, start = 1, 0
        place = max(0, min(place, self._chars[1] - 1))
        while k < self._n:
            left = self._chars[2 * k]
            if place - start < left:
                k = 2 * k
            else:
                k, start = 2 * k + 1, start + left
        return k - self._n, start

    # ---------------------------------------------------------------- counts

    def _count(self, text: str) -> int:
        self.encoded += len(text)
        return len(self._coder.ids(text)) if text else 0

    def _ends(self, text: str, at: int) -> Iterator[int]:
        """The ends of the pre-tokens from ``at`` on, where one starts."""
        special = text.find(SPECIAL, at)
        while at < len(text):
            if -1 < special < at:
                special = text.find(SPECIAL, at)
            if at == special:
                at += len(SPECIAL)
            else:
                at = self._pattern.match(text, at, special if special >= 0 else len(text)).end()
            yield at

    def _cut(self, text: str) -> list[str]:
        """Leaves that give the same pre-tokens alone as in the text: a leaf
        ends with a pre-token and not with white space, whose pre-tokens see
        what follows.  A space between two other characters is such an end and
        is looked for first."""
        out, start, n = [], 0, len(text)
        while start < n:
            end = n
            if n - start > 2 * LEAF:
                end = text.find(" ", start + LEAF, start + 2 * LEAF)
                while end > 0 and (text[end - 1].isspace() or text[end + 1].isspace()):
                    end = text.find(" ", end + 1, start + 2 * LEAF)
                if end < 0:
                    end = next(e for e in self._ends(text, start)
                               if e == n or e >= start + LEAF and not text[e - 1].isspace())
            out.append(text[start:end])
            start = end
        return out

    def __len__(self) -> int:
        return self._chars[1]

    @property
    def tokens(self) -> int:
        return self._tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaf)

    def leaves(self) -> tuple[list[str], list[int]]:
        """The leaves with text and their tokens."""
        at = [k for k, x in enumerate(self.leaf) if x]
        return [self.leaf[k] for k in at], [self._tokens[self._n + k] for k in at]

    def _behind(self, last: int, least: int) -> str:
        """At least ``least`` characters behind leaf ``last``, if there are as many."""
        out, k = "", last + 1
        while k < self._n and len(out) < least:
            out, k = out + self.leaf[k], k + 1
        return out

    def edit(self, start: int, length: int, insert: str) -> None:
        """Replaces ``length`` characters from ``start`` by ``insert``; a range
        beyond the text is shortened to it."""
        start = max(0, min(start, len(self)))
        end = min(len(self), start + max(0, length))
        if start == end and not insert:
            return
        first, base = self._find(start - REACH)
        last, _ = self._find(max(start, end - 1))
        old = "".join(self.leaf[first:last + 1])
        new = old[:start - base] + insert + old[end - base:]
        at = 0  # pre-tokens of the new text are known up to here
        while True:
            behind = self._behind(last, REACH)
            if not behind:
                break
            for e in self._ends(new + behind, at):
                if e > len(new):
                    break
                at = e
            if at == len(new) and not new[-1:].isspace():
                break
            last = next(k for k in range(last + 1, self._n) if self.leaf[k])
            new += self.leaf[last]
        self._replace(first, last, self._cut(new))

    def _replace(self, first: int, last: int, cut: list[str]) -> None:
        room = last - first + 1
        known = dict(zip(self.leaf[first:last + 1], self._tokens[self._n + first:self._n + last + 1]))
        if len(cut) > room:  # longer leaves, if they are not too long
            each = -(-len(cut) // room)
            joined = ["".join(cut[k:k + each]) for k in range(0, len(cut), each)]
            if each <= 4:
                cut = joined
        counts = [known[x] if x in known else self._count(x) for x in cut]
        if len(cut) <= room:
            for k in range(room):
                piece, count = (cut[k], counts[k]) if k < len(cut) else ("", 0)
                if piece != self.leaf[first + k]:
                    self._put(first + k, piece, count)
        else:  # a new tree, with room beside each new leaf; the other counts are kept
            tokens = self._tokens[self._n:]
            spaced = [x for piece in cut for x in (piece, "")], [x for c in counts for x in (c, 0)]
            self._build(self.leaf[:first] + spaced[0] + self.leaf[last + 1:], tokens[:first] + spaced[1] + tokens[last + 1:])


def _tools(ranks: str) -> tuple[ByteCodec, regex.Pattern]:
    import public_tokenizers

    return codec(ranks), regex.compile(public_tokenizers.PATTERN)


def _counted(batches: Iterator[pa.RecordBatch], ranks: str) -> Iterator[pa.RecordBatch]:
    coder, pattern = _tools(ranks)
    names = ["doc", "n_tokens_before", "n_tokens_after", "n_chars_after", "n_edits", "n_chars_encoded_again"]
    for batch in batches:
        rows = []
        for doc, text, edits in zip(*(batch.column(c).to_pylist() for c in ("_doc", "text", "edits"))):
            counted = CountedText(text or "", coder, pattern)
            before, encoded = counted.tokens, counted.encoded
            edits = [e for e in edits or [] if e is not None]
            for e in edits:
                counted.edit(e["start"] or 0, e["length"] or 0, e["insert"] or "")
            rows.append((doc, before, counted.tokens, len(counted), len(edits), counted.encoded - encoded))
        columns = list(zip(*rows)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def edited_counts(docs: DataFrame, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                  edits_col: str = "edits") -> DataFrame:
    """Token counts before and after the edits of each row, which are applied
    in order, each to the text that the ones before have left.

    ``edits_col`` is an array of ``struct<start: int, length: int, insert:
    string>`` in characters.  Gives ``(id_col, n_tokens_before, n_tokens_after,
    n_chars_after, n_edits, n_chars_encoded_again)``, a row for each row, without
    a shuffle.  Defined results: a null text counts as empty; null edits and
    null elements change nothing, null fields count as 0 or empty; ranges
    beyond the text are shortened to it; ids, null or repeated, are passed
    through; an empty table gives no rows; other columns are not read."""
    path = ranks or default_ranks()
    one = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("text"),
                      F.col(edits_col).alias("edits"))
    schema = ("doc long, n_tokens_before long, n_tokens_after long, n_chars_after long, n_edits long, "
              "n_chars_encoded_again long")
    return one.mapInArrow(lambda it: _counted(it, path), schema).withColumnRenamed("doc", id_col)


# ------------------------------------------------------------------ kept leaves

def _leaves_of(batches: Iterator[pa.RecordBatch], ranks: str) -> Iterator[pa.RecordBatch]:
    coder, pattern = _tools(ranks)
    for batch in batches:
        for doc, version, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "version", "text"))):
            texts, tokens = CountedText(text, coder, pattern).leaves()
            texts, tokens = texts or [""], tokens or [0]
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc] * n, pa.int64()), pa.array([version] * n, pa.int64()), pa.array(range(n), pa.int32()),
                 pa.array(texts), pa.array([len(x) for x in texts], pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc", "version", "leaf", "text", "chars", "tokens"])


_LEAVES = "doc long, version long, leaf int, text string, chars long, tokens long"


def leaf_table(docs: DataFrame, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counted leaves of every document, to be written as a table:
    ``(id_col, version, leaf, text, chars, tokens)``.

    ``version`` tells texts of one id apart (a hash of the text as it was
    first counted).  Equal rows are one document here; a null text counts as
    empty and has one empty leaf; null ids are kept; an empty table has no rows;
    other columns are not read."""
    path = ranks or default_ranks()
    one = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = one.withColumn("version", F.xxhash64("text")).groupBy("doc", "version").agg(F.min("text").alias("text"))
    return one.mapInArrow(lambda it: _leaves_of(it, path), _LEAVES).withColumnRenamed("doc", id_col)


def edited_leaves(leaves: DataFrame, edits: DataFrame, ranks: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """The leaf table after ``edits`` ``(id_col, seq, start, length, insert)``,
    which are applied to a document in the order of ``seq`` (ties by start,
    length and insert), to each version of an id.

    Only the leaves of edited documents are moved, and of these only the
    regions that edits touch are encoded; the others pass through.  Null ids
    and ids without a document have no edits; null fields count as 0 or empty."""
    path = ranks or default_ranks()
    mine = edits.select(F.col(id_col).cast("long").alias("doc"), *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c)
                                                               for c in ("seq", "start", "length")],
                        F.coalesce("insert", F.lit("")).alias("insert")).where(F.col("doc").isNotNull())
    held = leaves.withColumnRenamed(id_col, "doc")
    asked = mine.select("doc").distinct()
    touched = held.join(asked, "doc", "left_semi")
    per_version = touched.select(F.col("doc").alias("of"), F.col("version").alias("of_version")).distinct().join(
        mine.withColumnRenamed("doc", "of"), "of")

    def apply(own: pd.DataFrame, todo: pd.DataFrame) -> pd.DataFrame:
        coder, pattern = _tools(path)
        own = own.sort_values("leaf")
        text = CountedText.of_leaves(own["text"].tolist(), own["tokens"].tolist(), coder, pattern)
        for e in todo.sort_values(["seq", "start", "length", "insert"]).itertuples():
            text.edit(int(e.start), int(e.length), e.insert)
        texts, tokens = text.leaves()
        texts, tokens = texts or [""], tokens or [0]
        return pd.DataFrame({"doc": own["doc"].iloc[0], "version": own["version"].iloc[0], "leaf": range(len(texts)),
                             "text": texts, "chars": [len(x) for x in texts], "tokens": tokens})

    done = touched.groupBy("doc", "version").cogroup(per_version.groupBy("of", "of_version")).applyInPandas(apply, _LEAVES)
    return held.join(asked, "doc", "left_anti").unionByName(done).withColumnRenamed("doc", id_col)


def leaf_counts(leaves: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, version, n_chars, n_tokens)`` of a leaf table."""
    return leaves.groupBy(id_col, "version").agg(F.sum("chars").alias("n_chars"), F.sum("tokens").alias("n_tokens"))
