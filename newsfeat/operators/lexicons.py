"""Lexicon-guided text operators: lemmas by suffix rules (N2) and entities from
a user's table of names (N6).

*Lemmas.*  Suffix rules propose base forms and a lexicon, which is a table, accepts
them.  The work is done once for each distinct word: candidates of all words are
joined with the lexicon, so neither has a size bound.  The words that change are
measured: up to ``SHIPPED_CHARS`` they go to the documents as small maps by hash,
and no document is shuffled; of a larger table the words of a document that change
come back to it by a join on its key.

*Names.*  Names of any type are matched with an automaton, the leftmost first and of
those the longest, at word boundaries.  The names are measured before they are
shipped; tables above ``BLOCK_CHARS`` go in several blocks, whose matches are
resolved together, so the result does not depend on the blocks.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfeat.operators.ranking import materialize

# Suffix rules of English by part of speech, in their order.
SUFFIX_RULES = (
    ("noun", "s", ""), ("noun", "ses", "s"), ("noun", "ves", "f"), ("noun", "xes", "x"), ("noun", "zes", "z"),
    ("noun", "ches", "ch"), ("noun", "shes", "sh"), ("noun", "men", "man"), ("noun", "ies", "y"),
    ("verb", "s", ""), ("verb", "ies", "y"), ("verb", "es", "e"), ("verb", "es", ""), ("verb", "ed", "e"),
    ("verb", "ed", ""), ("verb", "ing", "e"), ("verb", "ing", ""),
    ("adj", "er", ""), ("adj", "est", ""), ("adj", "er", "e"), ("adj", "est", "e"),
)

#: Characters of names that are shipped to the tasks at once.
BLOCK_CHARS = 1 << 25
#: Characters of changed words and lemmas that go to the documents as maps.
SHIPPED_CHARS = 1 << 22
#: Entries of each map, on average.
PER_MAP = 4


# -------------------------------------------------------------------- lemmas

def lemma_table(words: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None,
                rules: Sequence[tuple[str, str, str]] = SUFFIX_RULES) -> DataFrame:
    """``(word, lemma)`` of the distinct words of ``words (word)`` that change.

    Parts of speech are tried in the order of ``rules``; within one an entry of
    ``exceptions (word, pos, lemma)`` comes first, then the word itself, then the
    rules in their order.  The first candidate that ``lexicon (word, pos)`` holds is
    the lemma; exceptions need not be in it.  A word without an accepted candidate
    stays as it is."""
    parts = list(dict.fromkeys(pos for pos, _, _ in rules))
    w = F.col("word")
    entry = lambda pos, place, lemma, known: F.struct(
        F.lit(pos).alias("pos"), F.lit(place).alias("place"), lemma.alias("lemma"), F.lit(known).alias("known"))
    candidates = [entry(pos, i * 1000 + 1, w, False) for i, pos in enumerate(parts)]
    for k, (pos, suffix, new) in enumerate(rules):
        base = F.concat(F.substring(w, F.lit(1), F.length(w) - F.lit(len(suffix))), F.lit(new))
        candidates.append(F.when(w.endswith(suffix), entry(pos, parts.index(pos) * 1000 + 2 + k, base, False)))
    distinct = words.select("word").where(w.isNotNull()).distinct()
    proposed = distinct.select("word", F.explode(F.array_compact(F.array(*candidates))).alias("c")).select("word", "c.*")
    held = lexicon.select(F.col("word").alias("lemma"), "pos").distinct()
    accepted = proposed.join(held, ["lemma", "pos"]).select("word", "place", "lemma")
    if exceptions is not None:
        place = F.lit(None).cast("int")
        for i, pos in enumerate(parts):
            place = F.when(F.col("pos") == pos, F.lit(i * 1000)).otherwise(place)
        listed = exceptions.select("word", place.alias("place"), "lemma").where("place is not null")
        accepted = accepted.unionByName(distinct.join(listed, "word"))
    first = accepted.groupBy("word").agg(F.min(F.struct("place", "lemma")).alias("f"))
    return first.select("word", F.col("f.lemma").alias("lemma")).where(F.col("word") != F.col("lemma"))


def lemmatised(df: DataFrame, key: str, tokens: str, lemmas: DataFrame, out: str = "lemmas") -> DataFrame:
    """``df`` with the array ``tokens`` where the words of ``lemmas (word,
    lemma)`` are replaced.  ``key`` names a row; rows with a null key keep their
    tokens.  Where the table is not small, the words of a document that change are
    shuffled with it."""
    lemmas = materialize(lemmas.select("word", "lemma"), "lemmas")
    if (lemmas.agg(F.sum(F.length("word") + F.length("lemma") + 8)).first()[0] or 0) <= SHIPPED_CHARS:
        new = F.transform(F.col(tokens), _looked_up([tuple(r) for r in lemmas.collect()]))
        return df.withColumn(out, F.when(F.col(key).isNull(), F.col(tokens)).otherwise(new))
    words = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.explode(F.array_distinct(tokens)).alias("word"))
    changed = words.join(lemmas, "word").groupBy("_key").agg(
        F.map_from_entries(F.collect_set(F.struct("word", "lemma"))).alias("_changed"))
    joined = df.join(changed, df[key] == changed["_key"], "left")
    new = F.transform(F.col(tokens), lambda t: F.coalesce(F.try_element_at(F.col("_changed"), t), t))
    return joined.withColumn(out, F.when(F.col("_changed").isNull(), F.col(tokens)).otherwise(new)).drop("_key", "_changed")


def document_counts(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """``(word, docs)``: the documents that hold a word of ``tokens``; rows of one
    ``key`` are one document, null is a key.  Only the words of keys with several
    rows are shuffled with their key, the others are counted where they stand."""
    repeated = df.groupBy(key).count().where("count > 1").select(F.col(key).alias("_key"), F.lit(True).alias("_several"))
    marked = df.join(materialize(repeated, "repeated"), F.col(key).eqNullSafe(F.col("_key")), "left")
    once = marked.where("_several IS NULL").select(F.explode(F.array_distinct(tokens)).alias("word"))
    several = marked.where("_several").select(key, F.explode(tokens).alias("word")).distinct().select("word")
    counts = [w.groupBy("word").agg(F.count(F.lit(1)).alias("docs")) for w in (once, several)]
    return counts[0].unionByName(counts[1]).groupBy("word").agg(F.sum("docs").alias("docs"))


def _looked_up(lemmas: list[tuple[str, str]]) -> Callable[[Column], Column]:
    """A word's lemma, or the word, by small maps (a map is searched in order),
    which are one literal that is folded once."""
    n = max(1, len(lemmas) // PER_MAP)
    maps: list[dict[str, str]] = [{} for _ in range(n)]
    for word, lemma in lemmas:
        if maps[zlib.crc32(word.encode()) % n].setdefault(word, lemma) != lemma:
            raise ValueError(f"several lemmas of {word!r}")
    table = F.from_json(F.lit(json.dumps(maps)), "array<map<string,string>>")
    part = lambda t: F.pmod(F.crc32(t.cast("binary")), F.lit(n)).cast("int")
    return lambda t: F.coalesce(F.try_element_at(F.get(table, part(t)), t), t)


# --------------------------------------------------------------------- names

_MATCH = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                   T.StructField("type", T.StringType())]))


def _mentions(rows: Iterable[list[tuple[int, int, str]]]) -> pa.Array:
    """Mentions of many texts as one Arrow column: a few bytes a mention."""
    ends, start, end, kind = array("i", [0]), array("i"), array("i"), []
    for row in rows:
        for m in row:
            start.append(m[0])
            end.append(m[1])
            kind.append(m[2])
        ends.append(len(kind))
    each = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(kind, pa.string())],
                                      ["start", "end", "type"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)


def _leftmost_longest(found: Iterable[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    out, end = [], 0
    for m in sorted(found, key=lambda m: (m[0], -m[1], m[2])):
        if m[0] >= end:
            out.append(m)
            end = m[1]
    return out


def _matcher(names: list[tuple[str, str]], resolved: bool):
    """A function that finds all of ``names`` at word boundaries, or of these the
    leftmost longest.  It holds a batch of texts, and of one text at a time the
    matches."""
    import ahocorasick

    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = ahocorasick.Automaton()
        for name, kind in names:
            automaton.add_word(name, (len(name), kind))
        automaton.make_automaton()

        def matches(t: str) -> list[tuple[int, int, str]]:
            every = [(end + 1 - n, end + 1, kind) for end, (n, kind) in automaton.iter(t)
                     if not (end + 1 < len(t) and t[end + 1].isalnum() or end + 1 > n and t[end - n].isalnum())]
            return _leftmost_longest(every) if resolved else every

        for texts in batches:
            yield _mentions(matches(t.as_py() or "") for t in texts)

    return F.arrow_udf(found, _MATCH)


def _resolve(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for matches in batches:
        yield _mentions(_leftmost_longest((m["start"], m["end"], m["type"]) for m in row.as_py()) for row in matches)


def name_blocks(names: DataFrame) -> list[list[tuple[str, str]]]:
    """The usable names in blocks of at most about ``BLOCK_CHARS`` characters;
    a name of several types has the first by code point.  They are measured
    first, and no block is larger than the driver can hold."""
    usable = names.where((F.col("name") != "") & F.col("type").isNotNull()).groupBy("name").agg(F.min("type").alias("type"))
    chars = usable.agg(F.sum(F.length("name") + 8)).first()[0] or 0
    n = max(1, -(-chars // BLOCK_CHARS))
    part = F.pmod(F.xxhash64("name"), F.lit(n))
    return [[tuple(r) for r in usable.where(part == k).orderBy("name").collect()] for k in range(n)]


def name_mentions(df: DataFrame, text: str, names: DataFrame, out: str = "entities") -> DataFrame:
    """N6 with a gazetteer: ``array<struct<type, start, end, salience>>`` of the
    names of ``names (name, type)`` in the text, in its order (code points, end
    exclusive; salience is the share of its characters).  Matches are cased and
    whole words; a null or empty text has none."""
    every = [b for b in name_blocks(names) if b]
    found = [_matcher(b, len(every) == 1)(F.coalesce(F.col(text), F.lit(""))) for b in every]
    matches = found[0] if len(found) == 1 else F.arrow_udf(_resolve, _MATCH)(F.concat(*found)) if found else F.array().cast(_MATCH)
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    return df.withColumn(out, matches).withColumn(out, F.transform(out, lambda m: F.struct(
        m["type"].alias("type"), m["start"].alias("start"), m["end"].alias("end"),
        ((m["end"] - m["start"]) / size).alias("salience"))))


def without_mentions(text: Column, mentions: Column, filler: str = "\n") -> Column:
    """``text`` with every mention replaced by as many fillers, so that the
    built-in expressions find only what the names left over."""
    empty = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    step = lambda a, m: F.struct(
        F.concat(a["done"], F.substring(text, a["at"] + 1, m["start"] - a["at"]),
                 F.repeat(F.lit(filler), m["end"] - m["start"])).alias("done"), m["end"].alias("at"))
    return F.aggregate(mentions, empty, step, lambda a: F.concat(a["done"], F.substring(text, a["at"] + 1, F.length(text))))
