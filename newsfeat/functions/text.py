"""Text column functions: tokens, stop words, lemmas, HTML stripping.

Everything here is a Catalyst expression or a JVM transformer
(``StopWordsRemover`` keeps its stop list in a hash set), so tokenising runs
inside whole-stage code generation.
"""

from __future__ import annotations

import glob
import html.entities
import os
import zipfile
import zlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Token classes.  A token is a run of letters/digits or a run of
# other non-space characters (punctuation kept, as in the reference output).
# Whitespace is spelled out so Java regex and RE2 agree on it.
WS = r" \t\n\x0B\f\r"
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}" + WS + r"]+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@lru_cache(maxsize=None)
def load_stop_words(language: str = "italian") -> tuple[str, ...]:
    """Spark ML's default stop list for ``language`` (the same list as
    ``StopWordsRemover.loadDefaultStopWords``), read from the Spark ML jar
    so that it is available without a running JVM (oracle SQL)."""
    import pyspark

    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    for jar in jars:
        with zipfile.ZipFile(jar) as z:
            name = f"org/apache/spark/ml/feature/stopwords/{language}.txt"
            if name in z.namelist():
                words = z.read(name).decode("utf-8").split("\n")
                return tuple(w.strip() for w in words if w.strip())
    from pyspark.ml.feature import StopWordsRemover
    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def tokens(c: Column | str) -> Column:
    """Word and punctuation tokens (Unicode classes; trap T15)."""
    return F.regexp_extract_all(_c(c), F.lit(TOKEN_PATTERN), 0)


#: Entries of each map that a lemma table is dealt to.
LEMMAS_PER_MAP = 8


def lemmatize(tok: Column, lemmas: dict[str, str] | None) -> Column:
    """Replace tokens found in a user lemma table; identity by default.
    The table is a bounded dictionary shipped as a literal: small maps by hash,
    since a map is searched entry by entry."""
    if not lemmas:
        return tok
    n = -(-len(lemmas) // LEMMAS_PER_MAP)
    parts: list[dict[str, str]] = [{} for _ in range(n)]
    for k, v in sorted(lemmas.items()):
        parts[zlib.crc32(k.encode()) % n][k] = v
    texts = lambda values: F.array(*map(F.lit, values)).cast("array<string>")
    table = F.array(*[F.map_from_arrays(texts(p.keys()), texts(p.values())) for p in parts])
    part = lambda t: F.pmod(F.crc32(t.cast("binary")), F.lit(n)).cast("int")
    return F.transform(tok, lambda t: F.coalesce(F.try_element_at(F.get(table, part(t)), t), t))


def preprocess_text(df: DataFrame, src: str = "body", out: str = "body_pre", language: str = "italian",
                    lemmas: dict[str, str] | None = None, stop_words: list[str] | None = None) -> DataFrame:
    """Tokenise, (N2) lemmatise, drop stop words compared in lower case,
    re-join with single spaces.  Case and punctuation tokens are kept."""
    from pyspark.ml.feature import StopWordsRemover

    stop = list(stop_words if stop_words is not None else load_stop_words(language))
    tmp_in, tmp_out = f"__{out}_tok", f"__{out}_kept"
    # the remover fails on a null array: a null text goes in without tokens and comes out null
    df = df.withColumn(tmp_in, F.coalesce(lemmatize(tokens(src), lemmas), F.array().cast("array<string>")))
    remover = StopWordsRemover(inputCol=tmp_in, outputCol=tmp_out, stopWords=stop,
                               caseSensitive=False, locale="en_US")
    df = remover.transform(df)
    joined = F.when(_c(src).isNotNull(), F.array_join(F.col(tmp_out), " "))
    return df.withColumn(out, joined).drop(tmp_in, tmp_out)


def word_count(c: Column | str) -> Column:
    return F.size(tokens(c))


# ----------------------------------------------------------------- HTML

#: Named character references of HTML 5 (the standard library's table; the
#: semicolon belongs to a name, and some names also go without).  A map is
#: searched in order: the names of HTML 4, which pages use most, come first.
HTML_NAMES = {n: v for _, n, v in sorted((n.rstrip(";") not in html.entities.name2codepoint, n, v)
                                         for n, v in html.entities.html5.items())}
#: The names that are references without a semicolon, longer ones first.
HTML_OPEN_NAME = "^(" + "|".join(sorted((n for n in HTML_NAMES if n[-1] != ";"), key=lambda n: (-len(n), n))) + ")"
#: What a reference looks like.
HTML_REFERENCE = "&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
#: Numbers 128 to 159 mean the characters of the Windows code page, where it has one.
HTML_NUMBERS = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}
#: Numbers above every character.
HTML_TOO_LARGE = 0x110000
HTML_DROP_PATTERNS = [r"(?s)<!--.*?-->", r"(?is)<script[^>]*>.*?</script\s*>",
                      r"(?is)<style[^>]*>.*?</style\s*>", r"(?s)<[^>]*>"]


def _map_literal(items: dict) -> Column:
    """A constant map of texts, from one literal that is folded once: thousands
    of literals would each pass through every rule of the optimizer."""
    pairs = "\u0002".join(f"{k}\u0001{v}" for k, v in items.items())
    return F.str_to_map(F.lit(pairs), F.lit("\u0002"), F.lit("\u0001"))


def _numbered(number: Column) -> Column:
    """The character of a numeric reference: nothing for control characters and
    non-characters, the replacement character for numbers that are none."""
    nothing = number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127) \
        | number.between(0xFDD0, 0xFDEF) | (number % 0x10000 >= 0xFFFE)
    return F.when((number == 0) | number.between(0xD800, 0xDFFF) | (number >= HTML_TOO_LARGE), F.lit("\uFFFD")) \
        .when(number.between(128, 159), F.try_element_at(_map_literal(HTML_NUMBERS), number.cast("string"))) \
        .when(nothing, F.lit("")) \
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


def decode_references(c: Column | str) -> Column:
    """Character references, named or numeric, decoded in one pass
    (``&amp;lt;`` becomes ``&lt;``) as HTML 5 has it: names that may go without
    a semicolon are also found at the start of a longer word, numbers may have
    any length; unknown names stay.  Equal to ``html.unescape``."""
    names = _map_literal(HTML_NAMES)

    def decoded(ref: Column) -> Column:
        is_hex = F.lower(F.substring(ref, 2, 1)) == "x"
        digits = F.regexp_replace(ref, "^#[xX]?0*|;$", "")
        number = F.when(F.length(digits) > 7, F.lit(HTML_TOO_LARGE)) \
            .when(F.length(digits) == 0, F.lit(0)) \
            .otherwise(F.least(F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).cast("int"), F.lit(HTML_TOO_LARGE)))
        start = F.regexp_extract(ref, HTML_OPEN_NAME, 1)
        named = F.coalesce(
            F.try_element_at(names, ref),
            F.when(start != "", F.concat(F.try_element_at(names, start), F.substr(ref, F.length(start) + 1))),
            F.concat(F.lit("&"), ref))
        return F.when(ref.isNull(), F.lit("")).when(ref.startswith("#"), _numbered(number)).otherwise(named)

    def joined(text: Column) -> Column:
        refs = F.regexp_extract_all(text, F.lit(HTML_REFERENCE), 1)
        return F.array_join(F.zip_with(F.split(text, HTML_REFERENCE), refs, lambda p, r: F.concat(p, decoded(r))), "")

    # the text is computed once: as the only element of an array it has a name
    return F.transform(F.array(_c(c)), lambda text: F.when(text.contains("&"), joined(text)).otherwise(text))[0]


def strip_html_regex(c: Column | str) -> Column:
    """Drop comments, script and style blocks and tags, then decode the
    character references.  Pure expressions."""
    out = _c(c)
    for p in HTML_DROP_PATTERNS:
        out = F.regexp_replace(out, p, "")
    return decode_references(out)
