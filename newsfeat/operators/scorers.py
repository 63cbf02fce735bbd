"""Document scorers: sentiment (N4), moderation (N5), entities.

The reference calls a remote language service once per row.  Here a scorer
is either

* a **built-in** default written with Catalyst array functions (lexicon and
  regular-expression scorers: no Python, no shuffle, one projection), or
* a **plug-in**: a factory of a Python function over a pandas Series of
  texts, run with ``mapInPandas`` (Arrow batches, one client per partition
  instead of per row).

Documents with null or empty text are skipped (trap T7).  Dynamic outputs
(moderation categories, entity types) are computed as maps / arrays and
projected to fixed column lists, so schemas are stable.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfeat.functions.columns import ENTITY_TYPES, MODERATION_CATEGORIES, clean_name


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def skip_empty(df: DataFrame, text: str) -> DataFrame:
    """only documents with text are scored."""
    return df.where(F.coalesce(F.col(text), F.lit("")) != "")


def skip_empty_once(df: DataFrame, text: str) -> DataFrame:
    """The same for a computed ``text`` that is dear: a filter on it would be
    pushed below its projection and compute it a second time.  Passing it through
    a generator of one row keeps the filter above."""
    once = F.explode_outer(F.array(F.col(text))).alias(text)
    return skip_empty(df.select(*[once if c == text else F.col(c) for c in df.columns]), text)


# ----------------------------------------------------------------- sentiment

# Polarity lexicon of the built-in sentiment scorer (lower-case
# words of the corpus languages, polarity in [-1, 1]).
SENTIMENT_LEXICON = {
    "good": 0.6, "great": 0.8, "excellent": 0.9, "happy": 0.7, "love": 0.8, "best": 0.8, "success": 0.6,
    "bad": -0.6, "terrible": -0.9, "sad": -0.6, "hate": -0.8, "worst": -0.8, "failure": -0.6, "crisis": -0.5,
    "buono": 0.6, "ottimo": 0.8, "felice": 0.7, "amore": 0.7, "successo": 0.6, "vittoria": 0.6,
    "cattivo": -0.6, "pessimo": -0.8, "triste": -0.6, "odio": -0.8, "crisi": -0.5, "morte": -0.7,
    "bon": 0.6, "heureux": 0.7, "amour": 0.7, "mauvais": -0.6, "guerre": -0.7,
    "gut": 0.6, "glücklich": 0.7, "liebe": 0.7, "schlecht": -0.6, "krieg": -0.7, "tod": -0.7,
    "bueno": 0.6, "feliz": 0.7, "malo": -0.6, "guerra": -0.7, "muerte": -0.7,
}


def keyword_counts(df: DataFrame, text: str, vocabulary: list[str], out: str,
                   n_tokens: str | None = None) -> DataFrame:
    """Per-document counts of each vocabulary word (case-insensitive, whole
    tokens) as ``array<double>`` in vocabulary order, plus optionally the
    number of tokens.  ``RegexTokenizer`` lower-cases and tokenises in one
    JVM pass and ``CountVectorizerModel`` looks every token up in a hash map:
    row-local, no shuffle, no per-token lambdas."""
    from pyspark.ml.feature import CountVectorizerModel, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    from newsfeat.functions.text import TOKEN_PATTERN

    tok = f"__tok_{out}"
    vec = f"__vec_{out}"
    src = f"__txt_{out}"
    t = RegexTokenizer(inputCol=src, outputCol=tok, pattern=TOKEN_PATTERN, gaps=False, toLowercase=True,
                       minTokenLength=1).transform(df.withColumn(src, F.coalesce(F.col(text), F.lit(""))))
    cv = CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol=tok, outputCol=vec)
    r = cv.transform(t).withColumn(out, vector_to_array(vec))
    if n_tokens:
        r = r.withColumn(n_tokens, F.size(F.col(tok)))
    return r.drop(tok, vec, src)


def sentiment_lexicon(df: DataFrame, text: str = "body", lexicon: dict[str, float] | None = None) -> DataFrame:
    """N4 built-in: ``score`` = mean polarity of the lexicon words found
    (0 when none), ``magnitude`` = sum of their absolute polarities; one
    keyword-count pass, then a fixed dot product."""
    lex = lexicon or SENTIMENT_LEXICON
    out = keyword_counts(df, text, sorted(lex), "__kc")
    return _with_sentiment(out, lex, sorted(lex)).drop("__kc")


def _with_sentiment(counted: DataFrame, lex: dict[str, float], vocab: list[str]) -> DataFrame:
    """``score`` and ``magnitude`` from the counts ``__kc`` of ``vocab``."""
    pos = {w: i for i, w in enumerate(vocab)}
    words = sorted(lex)
    c = [F.col("__kc")[pos[w]] for w in words]
    cnt = sum(c, F.lit(0.0))
    total = sum((ci * F.lit(float(lex[w])) for ci, w in zip(c, words)), F.lit(0.0))
    mag = sum((ci * F.lit(abs(float(lex[w]))) for ci, w in zip(c, words)), F.lit(0.0))
    return counted.withColumn("score", F.when(cnt > 0, total / cnt).otherwise(F.lit(0.0))).withColumn("magnitude", mag)


def score_with(df: DataFrame, make_scorer: Callable[[], Callable[[pd.Series], pd.DataFrame]], out_schema: str,
               text: str = "body", keep: list[str] | None = None) -> DataFrame:
    """Plug-in scorer (N4/N5/N6 interface): ``make_scorer()`` is called once
    a partition (a remote client is made there) and returns a function
    ``texts -> DataFrame`` with the columns of ``out_schema``, row-aligned
    with ``texts``.  The output holds the ``keep`` columns (default: all) and
    the scores; only ``keep`` and the text go through Arrow."""
    extra = T._parse_datatype_string(out_schema)
    kept = list(keep if keep is not None else df.columns)
    schema = T.StructType([df.schema[c] for c in kept] + extra.fields)

    def run(batches):
        scorer = make_scorer()
        for pdf in batches:
            res = scorer(pdf[text]).reset_index(drop=True)
            yield pd.concat([pdf[kept].reset_index(drop=True), res], axis=1)

    return df.select(*dict.fromkeys([*kept, text])).mapInPandas(run, schema)


def lexicon_scorer() -> Callable[[pd.Series], pd.DataFrame]:
    """A plug-in for ``score_with`` in plain Python (same lexicon as the
    built-in scorer)."""
    import regex

    from newsfeat.functions.text import TOKEN_PATTERN

    pat = regex.compile(TOKEN_PATTERN)
    lex = SENTIMENT_LEXICON

    def score(texts: pd.Series) -> pd.DataFrame:
        found = [[lex[w.lower()] for w in pat.findall(t or "") if w.lower() in lex] for t in texts]
        return pd.DataFrame({"score": [sum(p) / len(p) if p else 0.0 for p in found],
                             "magnitude": [sum(map(abs, p), 0.0) for p in found]})

    return score


# ----------------------------------------------------------------- moderation

# Keyword lists of the built-in moderation scorer.
MODERATION_LEXICON = {
    "Toxic": ["idiot", "stupid", "idiota", "stupido", "dumm", "estúpido"],
    "Insult": ["loser", "moron", "cretino", "imbecille", "crétin", "imbécil"],
    "Profanity": ["damn", "hell", "merda", "cazzo", "merde", "mierda", "scheiße"],
    "Derogatory": ["inferior", "inferiore", "subhuman"],
    "Sexual": ["sex", "sexual", "sesso", "sexe", "sexo"],
    "Death, Harm & Tragedy": ["death", "dead", "tragedy", "morte", "tragedia", "mort", "tod", "muerte"],
    "Violent": ["kill", "attack", "violence", "uccidere", "violenza", "attaque", "gewalt", "violencia"],
    "Firearms & Weapons": ["gun", "rifle", "weapon", "pistola", "arma", "armi", "waffe", "fusil"],
    "Public Safety": ["police", "emergency", "polizia", "emergenza", "polizei", "policía"],
    "Health": ["health", "hospital", "doctor", "salute", "ospedale", "santé", "gesundheit", "salud"],
    "Religion & Belief": ["church", "god", "faith", "chiesa", "dio", "église", "kirche", "iglesia"],
    "Illicit Drugs": ["drug", "cocaine", "heroin", "droga", "cocaina", "drogue", "droge"],
    "War & Conflict": ["war", "army", "conflict", "guerra", "esercito", "guerre", "krieg"],
    "Politics": ["election", "government", "parliament", "governo", "elezioni", "parlamento", "gouvernement",
                 "regierung", "gobierno"],
    "Finance": ["bank", "market", "stock", "banca", "mercato", "borsa", "banque", "bourse", "banco"],
    "Legal": ["court", "law", "judge", "tribunale", "legge", "giudice", "tribunal", "gericht"],
}


def moderation_map(df: DataFrame, text: str = "body", out: str = "moderation",
                   lexicon: dict[str, list[str]] | None = None) -> DataFrame:
    """N5 built-in scorer: ``map<category, confidence>`` where confidence =
    share of the document's tokens that are keywords of the category;
    categories without a hit are absent from the map.  One keyword-count
    pass; category hits are sums of fixed vector positions."""
    lex = lexicon or MODERATION_LEXICON
    vocab = sorted({w for ws in lex.values() for w in ws})
    cnt = keyword_counts(df, text, vocab, "__kc", n_tokens="__n")
    return _with_moderation(cnt, lex, vocab, out).drop("__kc", "__n")


def _with_moderation(counted: DataFrame, lex: dict[str, list[str]], vocab: list[str], out: str) -> DataFrame:
    """The category map from the counts ``__kc`` of ``vocab`` and the tokens ``__n``."""
    pos = {w: i for i, w in enumerate(vocab)}
    n = F.greatest(F.col("__n"), F.lit(1)).cast("double")
    names, confs = [], []
    for cat in MODERATION_CATEGORIES:
        hits = sum((F.col("__kc")[pos[w]] for w in sorted(set(lex.get(cat, [])))), F.lit(0.0))
        names.append(F.lit(cat))
        confs.append(hits / n)
    m = F.map_filter(F.map_from_arrays(F.array(*names), F.array(*confs)), lambda k, v: v > 0)
    return counted.withColumn(out, m)


def sentiment_and_moderation(df: DataFrame, text: str = "body", out: str = "moderation") -> DataFrame:
    """Equal to ``moderation_map(sentiment_lexicon(df))``, the text tokenised once
    and the words of both lexicons counted in one pass."""
    vocab = sorted({*SENTIMENT_LEXICON, *(w for ws in MODERATION_LEXICON.values() for w in ws)})
    counted = _with_sentiment(keyword_counts(df, text, vocab, "__kc", n_tokens="__n"), SENTIMENT_LEXICON, vocab)
    return _with_moderation(counted, MODERATION_LEXICON, vocab, out).drop("__kc", "__n")


def project_categories(df: DataFrame, map_col: str = "moderation",
                       categories: list[str] = MODERATION_CATEGORIES, keep_other: bool = False) -> DataFrame:
    """Fixed columns from a category map (names cleaned by P19); absent ->
    null.  Unknown categories can be kept in ``other_categories``."""
    m = F.col(map_col)
    cols = {clean_name(cat): F.element_at(m, F.lit(cat)) for cat in categories}
    if keep_other:
        known = F.array(*[F.lit(c) for c in categories])
        cols["other_categories"] = F.map_filter(m, lambda k, v: ~F.array_contains(known, k))
    return df.withColumns(cols).drop(map_col)


def moderate(df: DataFrame, text: str = "body") -> DataFrame:
    """N5 end to end: skip empty text, score, project to the 16 columns."""
    return project_categories(moderation_map(skip_empty(df, text), text))


# ----------------------------------------------------------------- entities

# Regular expressions of the built-in entity extractors (the
# same patterns run in Java regex and RE2).  Where several fit, the first one
# takes the characters.  Types without a pattern get 0.
ENTITY_PATTERNS = {
    "PHONE_NUMBER": r"\+[0-9]{1,3}(?:[ -]?[0-9]{2,4}){2,4}",
    "DATE": r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}",
    "PRICE": r"[$€£] ?[0-9]+(?:[.,][0-9]+)*|[0-9]+(?:[.,][0-9]+)* ?(?:EUR|USD|euro)",
    "ADDRESS": r"(?:[Vv]ia|[Pp]iazza|[Cc]orso|[Vv]iale) \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*,? [0-9]+"
               r"|[0-9]+ \p{Lu}\p{Ll}+ (?:Street|Avenue|Road)",
    "OTHER": r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)+",
    "NUMBER": r"[0-9]+(?:[.,][0-9]+)*",
}


def any_entity(patterns: dict[str, str]) -> str:
    """One expression for all types: a character belongs to one mention only."""
    return "|".join(f"(?:{p})" for p in patterns.values())


def count_column(entity_type: str) -> str:
    """Count column of an entity type; ``DATE`` would collide with ``date``
    in Spark's case-insensitive resolution (trap T1), so it is ``DATE_count``."""
    return "DATE_count" if entity_type == "DATE" else entity_type


def _type_of(mention: Column, patterns: dict[str, str]) -> Column:
    """The first type whose pattern is the whole mention: the alternative of
    ``any_entity`` that found it."""
    *first, last = patterns
    out = F.lit(last)
    for t in reversed(first):
        out = F.when(mention.rlike(f"^(?:{patterns[t]})$"), F.lit(t)).otherwise(out)
    return out


def _has_type(entity_type: str):
    return lambda e: e["type"] == F.lit(entity_type)


def entity_mentions(df: DataFrame, text: str = "body", out: str = "entities",
                    patterns: dict[str, str] | None = None) -> DataFrame:
    """N6 extractor: ``array<struct<type, salience>>`` of the regex
    matches in the order of the text; salience = share of the document's
    characters."""
    pats = patterns or ENTITY_PATTERNS
    L = F.greatest(F.length(F.col(text)), F.lit(1)).cast("double")
    found = F.regexp_extract_all(F.col(text), F.lit(any_entity(pats)), 0)
    return df.withColumn(out, F.transform(found, lambda m: F.struct(_type_of(m, pats).alias("type"),
                                                                    (F.length(m) / L).alias("salience"))))


def entity_features(df: DataFrame, mentions: str = "entities") -> DataFrame:
    """A21 + A22 from an entity array: per type the count and the mean
    salience, 0.0 when absent.  Array functions on each row — no explode,
    no shuffle, no join back."""
    cols = {}
    for t in ENTITY_TYPES:
        sel = F.filter(F.col(mentions), _has_type(t))
        n = F.size(sel)
        s = F.aggregate(sel, F.lit(0.0), lambda a, e: a + e["salience"])
        cols[count_column(t)] = n.cast("double")
        cols[f"{t}_mean_salience"] = F.when(n > 0, s / n).otherwise(F.lit(0.0))
    return df.withColumns(cols).drop(mentions)


def regex_entity_features(df: DataFrame, text: str = "body", patterns: dict[str, str] | None = None) -> DataFrame:
    """N6 built-in fast path, equal to ``entity_features(entity_mentions(...))``:
    per type, count = number of matches and mean salience = total matched
    characters / text length / count; one pass over the text for all types."""
    pats = patterns or ENTITY_PATTERNS
    L = F.greatest(F.length(F.col(text)), F.lit(1)).cast("double")
    found = F.regexp_extract_all(F.col(text), F.lit(any_entity(pats)), 0)
    # two projections (mentions, then features) instead of one per column:
    # each withColumn call would re-analyse the whole plan
    out = df.withColumn("__m", F.transform(found, lambda m: F.struct(_type_of(m, pats).alias("type"),
                                                                     F.length(m).alias("chars"))))
    cols = {}
    for t in ENTITY_TYPES:
        if t in pats:
            own = F.filter(F.col("__m"), _has_type(t))
            n = F.size(own)
            chars = F.aggregate(own, F.lit(0), lambda a, e: a + e["chars"])
            cols[count_column(t)] = n.cast("double")
            cols[f"{t}_mean_salience"] = F.when(n > 0, chars / L / n).otherwise(F.lit(0.0))
        else:
            cols[count_column(t)] = F.lit(0.0)
            cols[f"{t}_mean_salience"] = F.lit(0.0)
    return out.withColumns(cols).drop("__m")


def analyze_entities(df: DataFrame, text: str = "body") -> DataFrame:
    """N6 end to end: skip empty text, then count and mean salience per type."""
    return regex_entity_features(skip_empty(df, text), text)


# ----------------------------------------------------------------- cost estimate

# Price tiers per 1 000-character unit for sentiment analysis
# (lower bound of the tier in units per month, price per unit, USD).
SENTIMENT_TIERS = [(0, 0.0), (5_000, 0.0010), (1_000_000, 0.00050), (5_000_000, 0.000250)]
SINGLE_TIER_PRICE = 0.000250
PROJECTED_ARTICLES = 40_000


def cost_estimate(df: DataFrame, text: str = "body_pre", tiers=SENTIMENT_TIERS) -> DataFrame:
    """Characters -> price.  ``single_tier_cost`` is the reference's
    projection (mean characters x 40 000 articles / 1 000 x 0.00025);
    ``tiered_cost`` prices the corpus' own 1 000-character units over the
    tier table (units in each tier = clamp(units - lower, 0, upper - lower))."""
    L = F.length(F.col(text))
    s = df.agg(F.sum(L).cast("long").alias("total_chars"), F.avg(L).alias("mean_chars"),
               F.sum(F.ceil(L / F.lit(1000.0))).cast("long").alias("units"))
    cost = F.lit(0.0)
    for i, (lo, price) in enumerate(tiers):
        hi = tiers[i + 1][0] if i + 1 < len(tiers) else None
        inside = F.col("units") - F.lit(lo)
        if hi is not None:
            inside = F.least(inside, F.lit(hi - lo))
        cost = cost + F.greatest(inside, F.lit(0)).cast("double") * F.lit(price)
    return s.select("total_chars", "mean_chars", "units",
                    (F.col("mean_chars") * F.lit(PROJECTED_ARTICLES) / F.lit(1000.0) * F.lit(SINGLE_TIER_PRICE))
                    .alias("single_tier_cost"), cost.alias("tiered_cost"))
