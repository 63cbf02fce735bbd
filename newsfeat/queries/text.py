"""Text feature queries (N1-N8, P16-P26) with DuckDB oracles where the
feature is SQL-expressible (same regular expressions, stop list and
lexicons rendered into the SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfeat.functions import columns as Cols
from newsfeat.functions import text as Tx
from newsfeat.operators import learned as Ld
from newsfeat.operators import lexicons as Lx
from newsfeat.operators import scorers as Sc
from newsfeat.operators.ranking import materialize
from newsfeat.plans import featurize as Fz
from newsfeat.queries import sql as S
from newsfeat.sources import sinks as Snk
from newsfeat.session import scratch_path
from newsfeat.queries.common import articles, split_articles, table
from newsfeat.queries.exploration import unscaled
from newsfeat.queries.registry import query

R = 9


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_lit(w) for w in words) + "]"


def tok_sql(c: str) -> str:
    return f"regexp_extract_all({c}, {_lit(Tx.TOKEN_PATTERN)})"


def preprocess_sql(c: str, stop) -> str:
    return f"array_to_string(list_filter({tok_sql(c)}, lambda t: NOT list_contains({_list(stop)}, lower(t))), ' ')"


# ----------------------------------------------------------------- N1

@query("n1_preprocess_articles", S.with_(S.PREPARED_UNSCALED, f"""
SELECT uri, {preprocess_sql('body', Tx.load_stop_words('italian'))} AS body_pre FROM prepared_unscaled"""))
def n1_preprocess_articles(spark, sf_dir):
    """N1 on the prepared articles: tokens, Italian stop words removed."""
    return Tx.preprocess_text(unscaled(spark, sf_dir), "body", "body_pre").select("uri", "body_pre")


@query("n1_token_counts_documents", f"""
SELECT lang, cast(sum(len(list_filter({tok_sql('text')}, lambda t: NOT list_contains({_list(Tx.load_stop_words('english'))}, lower(t))))) AS BIGINT) AS tokens,
       count(*) AS documents
FROM documents GROUP BY lang""")
def n1_token_counts_documents(spark, sf_dir):
    """N1 at scale over every document (whole texts): tokens left after the
    English stop list, per language."""
    d = table(spark, sf_dir, "documents")
    pre = Tx.preprocess_text(d, "text", "pre", language="english", stop_words=list(Tx.load_stop_words("english")))
    # count tokens of the joined text again from the kept array size
    kept = F.size(F.filter(F.split(F.col("pre"), " "), lambda t: F.length(t) > 0))
    return pre.groupBy("lang").agg(F.sum(kept).cast("long").alias("tokens"), F.count(F.lit(1)).alias("documents"))


@query("n1_token_counts_conversations", f"""
SELECT role, cast(sum(len(list_filter({tok_sql('text')}, lambda t: NOT list_contains({_list(Tx.load_stop_words('english'))}, lower(t))))) AS BIGINT) AS tokens,
       count(*) AS turns
FROM conversations GROUP BY role""")
def n1_token_counts_conversations(spark, sf_dir):
    """N1 over every conversation turn (whole texts): tokens left after the
    English stop list, per speaker role."""
    c = table(spark, sf_dir, "conversations")
    pre = Tx.preprocess_text(c, "text", "pre", language="english", stop_words=list(Tx.load_stop_words("english")))
    kept = F.size(F.filter(F.split(F.col("pre"), " "), lambda t: F.length(t) > 0))
    return pre.groupBy("role").agg(F.sum(kept).cast("long").alias("tokens"), F.count(F.lit(1)).alias("turns"))


# ----------------------------------------------------------------- N3

def _strip_sql(c: str) -> str:
    out = c
    for p in Tx.HTML_DROP_PATTERNS:
        out = f"regexp_replace({out}, {_lit(p)}, '', 'g')"
    return out


_NAMES_SQL = f"map({_list(Tx.HTML_NAMES)}, {_list(Tx.HTML_NAMES.values())})"
_NUMBERS_SQL = f"map([{', '.join(map(str, Tx.HTML_NUMBERS))}], {_list(Tx.HTML_NUMBERS.values())})"
_DIGITS_SQL = "regexp_replace(r, '^#[xX]?0*|;$', '', 'g')"
_NUMBER_SQL = f"""CASE WHEN r[1] <> '#' THEN NULL WHEN length({_DIGITS_SQL}) > 7 THEN {Tx.HTML_TOO_LARGE}
  WHEN {_DIGITS_SQL} = '' THEN 0 WHEN lower(r[2]) = 'x' THEN CAST(concat('0x', {_DIGITS_SQL}) AS INTEGER)
  ELSE CAST({_DIGITS_SQL} AS INTEGER) END"""
_SIGN_SQL = f"""CASE WHEN n = 0 OR n BETWEEN 55296 AND 57343 OR n >= {Tx.HTML_TOO_LARGE} THEN chr(65533)
  WHEN n BETWEEN 128 AND 159 THEN {_NUMBERS_SQL}[n]
  WHEN n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007 OR n % 65536 >= 65534 THEN ''
  WHEN n IS NOT NULL THEN chr(n)
  WHEN exact IS NOT NULL THEN exact
  WHEN opened <> '' THEN concat({_NAMES_SQL}[opened], r[length(opened) + 1:])
  ELSE concat('&', r) END"""
_PATTERN_SQL = _lit(Tx.HTML_REFERENCE.replace("(", "(?:", 1))
# each reference is decoded once, in a row of its own, and put back between the pieces
_DECODED_SQL = f"""
WITH stripped AS (SELECT page_id, {_strip_sql('html')} AS s FROM pages),
refs AS (SELECT DISTINCT unnest(regexp_extract_all(s, {_lit(Tx.HTML_REFERENCE)}, 1)) AS r FROM stripped),
parsed AS (SELECT r, {_NUMBER_SQL} AS n, {_NAMES_SQL}[r] AS exact, regexp_extract(r, {_lit(Tx.HTML_OPEN_NAME)}, 1) AS opened FROM refs),
signs AS (SELECT map(list(r), list({_SIGN_SQL})) AS of FROM parsed)
SELECT page_id, CASE WHEN s IS NULL THEN NULL ELSE array_to_string(list_transform(regexp_split_to_array(s, {_PATTERN_SQL}), lambda p, i:
  concat(p, coalesce(signs.of[regexp_extract_all(s, {_lit(Tx.HTML_REFERENCE)}, 1)[i]], ''))), '') END AS text
FROM stripped, signs"""


@query("n3_strip_html_regex", _DECODED_SQL)
def n3_strip_html_regex(spark, sf_dir):
    """N3 native mode over every page."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", Tx.strip_html_regex("html").alias("text"))


# ----------------------------------------------------------------- N4

def _sentiment_sql(c: str) -> str:
    cases = " ".join(f"WHEN {_lit(k)} THEN CAST({v!r} AS DOUBLE)" for k, v in sorted(Sc.SENTIMENT_LEXICON.items()))
    pols = f"list_filter(list_transform({tok_sql(c)}, lambda t: CASE lower(t) {cases} END), lambda p: p IS NOT NULL)"
    return f"""(SELECT CASE WHEN len(pl) > 0 THEN list_sum(pl) / len(pl) ELSE 0.0 END FROM (SELECT {pols} AS pl)) AS score,
  (SELECT coalesce(list_sum(list_transform(pl, lambda p: abs(p))), 0.0) FROM (SELECT {pols} AS pl)) AS magnitude"""


_N4_SQL = f"""
SELECT doc_id, round(score, {R}) AS score, round(magnitude, {R}) AS magnitude FROM (
  SELECT doc_id, {_sentiment_sql('text')} FROM documents WHERE coalesce(text, '') <> '')"""


@query("n4_sentiment_lexicon", _N4_SQL)
def n4_sentiment_lexicon(spark, sf_dir):
    """N4 built-in lexicon scorer over every document."""
    d = Sc.skip_empty(table(spark, sf_dir, "documents"), "text")
    s = Sc.sentiment_lexicon(d, "text")
    return s.select("doc_id", F.round("score", R).alias("score"), F.round("magnitude", R).alias("magnitude"))


@query("n4_sentiment_plugin", _N4_SQL)
def n4_sentiment_plugin(spark, sf_dir):
    """N4 through the plug-in interface (``mapInPandas``); same results as
    the built-in scorer, so it shares its oracle."""
    d = Sc.skip_empty(table(spark, sf_dir, "documents"), "text")
    s = Sc.score_with(d, Sc.lexicon_scorer, "score double, magnitude double", text="text", keep=["doc_id"])
    return s.select("doc_id", F.round("score", R).alias("score"), F.round("magnitude", R).alias("magnitude"))


@query("n4_sentiment_by_role", f"""
SELECT role, count(*) AS turns, round(avg(score), {R}) AS mean_score, round(sum(magnitude), {R}) AS magnitude
FROM (SELECT role, {_sentiment_sql('text')} FROM conversations WHERE coalesce(text, '') <> '') GROUP BY role""")
def n4_sentiment_by_role(spark, sf_dir):
    """N4 over every non-empty conversation turn, then A11-style means per
    role (the per-row scores are the lexicon scorer's)."""
    c = Sc.skip_empty(table(spark, sf_dir, "conversations"), "text")
    s = Sc.sentiment_lexicon(c, "text")
    return s.groupBy("role").agg(F.count(F.lit(1)).alias("turns"), F.round(F.avg("score"), R).alias("mean_score"),
                                 F.round(F.sum("magnitude"), R).alias("magnitude"))


# ----------------------------------------------------------------- N5

def _moderation_cols(c: str, src: str) -> list[str]:
    """The 16 moderation columns over the token list ``src`` of text ``c``."""
    cols = []
    for cat in Cols.MODERATION_CATEGORIES:
        kw = Sc.MODERATION_LEXICON.get(cat, [])
        h = f"len(list_filter({src}, lambda t: list_contains({_list(kw)}, t)))"
        cols.append(f"CASE WHEN {h} > 0 THEN round(cast({h} AS DOUBLE) / greatest(len({src}), 1), {R}) END "
                    f"AS {Cols.clean_name(cat)}")
    return cols


def _words_sql(c: str) -> str:
    return f"list_filter(list_transform({tok_sql(c)}, lambda t: lower(t)), lambda t: length(t) > 0)"


def _moderation_sql(c: str) -> str:
    return (f"SELECT doc_id, {', '.join(_moderation_cols(c, 'w'))} FROM "
            f"(SELECT doc_id, {_words_sql(c)} AS w FROM documents WHERE coalesce({c}, '') <> '')")


@query("n5_moderation", _moderation_sql("text"))
def n5_moderation(spark, sf_dir):
    """N5 built-in scorer over every document, projected to 16 columns."""
    m = Sc.moderate(table(spark, sf_dir, "documents"), "text")
    names = [Cols.clean_name(c) for c in Cols.MODERATION_CATEGORIES]
    return m.select("doc_id", *[F.round(n, R).alias(n) for n in names])


# ----------------------------------------------------------------- N6

_TYPE_SQL = "CASE " + " ".join(f"WHEN regexp_full_match(m, {_lit(p)}) THEN {_lit(t)}"
                               for t, p in Sc.ENTITY_PATTERNS.items()) + " END"


def _entity_cols(c: str) -> list[str]:
    cols = []
    for t in Cols.ENTITY_TYPES:
        cnt, mean = Sc.count_column(t), f"{t}_mean_salience"
        if t in Sc.ENTITY_PATTERNS:
            ms = (f"list_filter(regexp_extract_all({c}, {_lit(Sc.any_entity(Sc.ENTITY_PATTERNS))}), "
                  f"lambda m: {_TYPE_SQL} = {_lit(t)})")
            cols.append(f"cast(len({ms}) AS DOUBLE) AS {cnt}")
            cols.append(f"round(CASE WHEN len({ms}) > 0 THEN list_sum(list_transform({ms}, lambda m: length(m) / "
                        f"cast(greatest(length({c}), 1) AS DOUBLE))) / len({ms}) ELSE 0.0 END, {R}) AS {mean}")
        else:
            cols.append(f"CAST(0.0 AS DOUBLE) AS {cnt}")
            cols.append(f"CAST(0.0 AS DOUBLE) AS {mean}")
    return cols


def _entities_sql(c: str) -> str:
    return f"SELECT doc_id, {', '.join(_entity_cols(c))} FROM documents WHERE coalesce({c}, '') <> ''"


@query("n6_entities", _entities_sql("text"))
def n6_entities(spark, sf_dir):
    """N6 built-in regex extractors over every document: count and mean
    salience per entity type (``DATE_count`` for the DATE count, trap T1)."""
    e = Sc.analyze_entities(table(spark, sf_dir, "documents"), "text")
    out = ["doc_id"]
    for t in Cols.ENTITY_TYPES:
        out += [F.col(Sc.count_column(t)), F.round(f"{t}_mean_salience", R).alias(f"{t}_mean_salience")]
    return e.select(*out)


@query("a21_entity_type_totals", f"""
SELECT entity_type, cast(count(*) AS DOUBLE) AS mentions, count(DISTINCT doc_id) AS documents FROM (
  SELECT doc_id, {_TYPE_SQL} AS entity_type FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, {_lit(Sc.any_entity(Sc.ENTITY_PATTERNS))})) AS m
    FROM documents WHERE coalesce(text, '') <> '')) GROUP BY entity_type""")
def a21_entity_type_totals(spark, sf_dir):
    """A21 rolled up: mentions and documents per entity type over the corpus
    (explode of the per-document mention arrays, partial aggregation)."""
    d = Sc.entity_mentions(Sc.skip_empty(table(spark, sf_dir, "documents"), "text"), "text")
    mentions = d.select("doc_id", F.explode("entities").alias("e")).select("doc_id", F.col("e.type").alias("entity_type"))
    return mentions.groupBy("entity_type").agg(F.count(F.lit(1)).cast("double").alias("mentions"),
                                               F.count_distinct("doc_id").alias("documents"))


# ----------------------------------------------------------------- N7

@query("n7_cost_estimate", S.with_(S.PREPARED_UNSCALED, f"""
, _p AS (SELECT length({preprocess_sql('body', Tx.load_stop_words('italian'))}) AS L FROM prepared_unscaled),
_s AS (SELECT cast(sum(L) AS BIGINT) AS total_chars, avg(L) AS mean_chars, cast(sum(ceil(L / 1000.0)) AS BIGINT) AS units FROM _p)
SELECT total_chars, round(mean_chars, {R}) AS mean_chars, units,
       round(mean_chars * {Sc.PROJECTED_ARTICLES} / 1000.0 * {Sc.SINGLE_TIER_PRICE}, {R}) AS single_tier_cost,
       round({' + '.join(
           f"greatest({'least(' if i + 1 < len(Sc.SENTIMENT_TIERS) else ''}units - {lo}"
           f"{(', ' + str(Sc.SENTIMENT_TIERS[i + 1][0] - lo) + ')') if i + 1 < len(Sc.SENTIMENT_TIERS) else ''}, 0) * CAST({price} AS DOUBLE)"
           for i, (lo, price) in enumerate(Sc.SENTIMENT_TIERS))}, {R}) AS tiered_cost
FROM _s"""))
def n7_cost_estimate(spark, sf_dir):
    """Characters of the tokenised text -> price (single tier projected
    to 40 000 articles, and the tier table on the corpus' own units)."""
    pre = Tx.preprocess_text(unscaled(spark, sf_dir), "body", "body_pre")
    c = Sc.cost_estimate(pre, "body_pre")
    return c.select("total_chars", F.round("mean_chars", R).alias("mean_chars"), "units",
                    F.round("single_tier_cost", R).alias("single_tier_cost"),
                    F.round("tiered_cost", R).alias("tiered_cost"))


# ----------------------------------------------------------------- N8, P16-P26

@query("n8_feature_table")
def n8_feature_table(spark, sf_dir):
    """The whole feature chain for the split articles (prepare -> N1 ->
    N4 -> N5 -> P19 -> N6 -> P20) as one lazy plan."""
    return Fz.feature_table(split_articles(spark, sf_dir))


@query("n8_feature_counts", S.with_(S.SPLIT, f"""
SELECT split, count(*) AS n FROM split_articles
WHERE coalesce({preprocess_sql('body', Tx.load_stop_words('italian'))}, '') <> '' GROUP BY split"""))
def n8_feature_counts(spark, sf_dir):
    """N8 row accounting: feature rows per split (documents without text
    are not scored, trap T7)."""
    return Fz.feature_table(split_articles(spark, sf_dir)).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("p26_scoring_request")
def p26_scoring_request(spark, sf_dir):
    """S8 + P18 + P16 + P26/S11: TEST rows of the feature table without the
    omitted columns, numeric ids cast to strings, one JSON instance per row."""
    feats = Fz.feature_table(split_articles(spark, sf_dir))
    return Fz.scoring_instances(feats.where(F.col("split") == "TEST"))


_N8_MOD = [Cols.clean_name(c) for c in Cols.MODERATION_CATEGORIES]
_N8_ENT = [x for t in Cols.ENTITY_TYPES for x in (Sc.count_column(t), f"{t}_mean_salience")]


@query("n8_feature_values", S.with_(S.SPLIT, f"""
, _b AS (SELECT uri, split, {preprocess_sql('body', Tx.load_stop_words('italian'))} AS body_pre FROM split_articles),
_f AS (SELECT uri, split, body_pre, {_words_sql('body_pre')} AS w FROM _b WHERE coalesce(body_pre, '') <> '')
SELECT uri, split, body_pre, round(score, {R}) AS score, round(magnitude, {R}) AS magnitude,
       {', '.join(_moderation_cols('body_pre', 'w'))}, {', '.join(_entity_cols('body_pre'))}
FROM (SELECT *, {_sentiment_sql('body_pre')} FROM _f)"""))
def n8_feature_values(spark, sf_dir):
    """N8 values: every feature column the chain adds (tokens, sentiment,
    moderation, entities) for the split articles, checked column by column."""
    f = Fz.feature_table(split_articles(spark, sf_dir))
    return f.select("uri", "split", "body_pre", F.round("score", R).alias("score"),
                    F.round("magnitude", R).alias("magnitude"),
                    *[F.round(c, R).alias(c) for c in _N8_MOD],
                    *[F.round(c, R).alias(c) if c.endswith("_mean_salience") else F.col(c) for c in _N8_ENT])


# ----------------------------------------------------------------- N2, G4, P16, P17, P20, N8 for a request

#: Articles of the corpus languages, brought to one form each.
LEMMAS = {"la": "il", "le": "il", "los": "el", "las": "el", "der": "die", "das": "die", "les": "le", "an": "a", "was": "be",
          "is": "be", "are": "be"}


def _lemma_sql(t: str) -> str:
    return f"CASE {t} " + " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in LEMMAS.items()) + f" ELSE {t} END"


@query("n2_lemmas", f"""
SELECT doc_id, array_to_string(list_transform({tok_sql('text')}, lambda t: {_lemma_sql('t')}), ' ') AS pre FROM documents""")
def n2_lemmas(spark, sf_dir):
    """N2 over every document: tokens replaced by a user's lemma table."""
    d = table(spark, sf_dir, "documents")
    return Tx.preprocess_text(d, "text", "pre", lemmas=LEMMAS, stop_words=[]).select("doc_id", "pre")


_RULES_SQL = ", ".join(f"({k}, '{pos}', '{a}', '{b}')" for k, (pos, a, b) in enumerate(Lx.SUFFIX_RULES))
_POS = list(dict.fromkeys(r[0] for r in Lx.SUFFIX_RULES))
_POS_SQL = ", ".join(f"({i}, '{pos}')" for i, pos in enumerate(_POS))


@query("n2_dictionary_lemmas", f"""
WITH toks AS MATERIALIZED (SELECT doc_id, {tok_sql('text')} AS t FROM documents)
, words AS MATERIALIZED (SELECT w, count(*) AS docs FROM (SELECT DISTINCT doc_id, unnest(t) AS w FROM toks) GROUP BY w)
, parts(i, pos) AS (VALUES {_POS_SQL}), rules(k, pos, old, new) AS (VALUES {_RULES_SQL})
, lexicon AS MATERIALIZED (SELECT w, pos FROM words, parts WHERE docs >= 4 AND (length(w) + i) % 3 <> 0)
, irregular AS MATERIALIZED (SELECT w, reverse(w) AS lemma FROM words WHERE docs = 3 AND length(w) = 4)
, candidates AS (
    SELECT w, i * 1000 AS place, lemma FROM irregular, parts WHERE pos = 'verb'
    UNION ALL SELECT w, i * 1000 + 1, w FROM words JOIN lexicon USING (w) JOIN parts USING (pos)
    UNION ALL
    SELECT c.w, c.place, c.lemma FROM (
        SELECT w, i * 1000 + 2 + k AS place, pos, left(w, length(w) - length(old)) || new AS lemma
        FROM words, rules JOIN parts USING (pos) WHERE ends_with(w, old)) c
      JOIN lexicon l ON l.w = c.lemma AND l.pos = c.pos)
, lemmas AS MATERIALIZED (SELECT w, arg_min(lemma, place) AS lemma FROM candidates GROUP BY w)
, one AS (SELECT doc_id, generate_subscripts(t, 1) AS spot, unnest(t) AS w FROM toks)
SELECT doc_id, coalesce(string_agg(coalesce(lemma, w), ' ' ORDER BY spot), '') AS lemmas,
       count(*) FILTER (WHERE lemma <> w)::BIGINT AS changed
FROM one LEFT JOIN lemmas USING (w) GROUP BY doc_id""")
def n2_dictionary_lemmas(spark, sf_dir):
    """N2 with suffix rules, a lexicon (the words of four documents and more)
    and a list of exceptions, both tables made from the documents."""
    # as the only element of an array the tokens are not computed again for a filter on them
    docs = table(spark, sf_dir, "documents")
    d = docs.select("doc_id", F.explode(F.array(Tx.tokens("text"))).alias("t"))
    words = materialize(Lx.document_counts(docs.select("doc_id", "text"), "doc_id", Tx.tokens("text")), "words")
    lexicon = words.where("docs >= 4").select("word", F.posexplode(F.array(*map(F.lit, _POS))).alias("i", "pos")) \
        .where((F.length("word") + F.col("i")) % 3 != 0)
    irregular = words.where("docs = 3 and length(word) = 4").select("word", F.lit("verb").alias("pos"), F.reverse("word").alias("lemma"))
    out = Lx.lemmatised(d, "doc_id", "t", Lx.lemma_table(words, lexicon, irregular))
    pairs = F.zip_with("t", "lemmas", lambda a, b: (a != b).cast("long"))
    return out.where(F.size("t") > 0).select("doc_id", F.array_join("lemmas", " ").alias("lemmas"),
                                            F.aggregate(pairs, F.lit(0).cast("long"), lambda a, x: a + x).alias("changed"))


_TYPES_SQL = "[" + ", ".join(f"'{t}'" for t in Cols.ENTITY_TYPES) + "]"
_PAIR = r"[A-Za-z]{3,} [A-Za-z]{3,}"


@query("n6_gazetteer_entities", f"""
WITH names AS MATERIALIZED (
    SELECT name, min(type) AS type FROM (
        SELECT unnest(regexp_extract_all(text, '{_PAIR}')) AS name, {_TYPES_SQL}[item_id % 12 + 1] AS type FROM benchmark
        UNION ALL
        SELECT regexp_extract(text, '[A-Za-z]{{5,}}') AS name, {_TYPES_SQL}[item_id % 12 + 1] AS type FROM benchmark)
    WHERE name <> '' GROUP BY name)
, pattern AS (SELECT '(?:^|[^\\p{{L}}\\p{{N}}])(' || string_agg(replace(name, ' ', '  '), '|' ORDER BY length(name) DESC)
                     || ')(?:$|[^\\p{{L}}\\p{{N}}])' AS p FROM names)
, mentions AS (
    SELECT doc_id, replace(unnest(regexp_extract_all(regexp_replace(text, '([^\\p{{L}}\\p{{N}}])', '\\1\\1', 'g'), p, 1)), '  ', ' ') AS name
    FROM documents, pattern)
SELECT type AS entity_type, count(*) AS mentions, count(DISTINCT doc_id) AS documents, sum(length(name))::BIGINT AS chars
FROM mentions JOIN names USING (name) GROUP BY type""".replace("\\\\", "\\"))
def n6_gazetteer_entities(spark, sf_dir):
    """N6 with names of all twelve types: pairs of words and single words of
    the benchmark items, found in every document."""
    b = table(spark, sf_dir, "benchmark")
    kind = F.element_at(F.array(*map(F.lit, Cols.ENTITY_TYPES)), (F.col("item_id") % 12 + 1).cast("int")).alias("type")
    names = b.select(F.explode(F.regexp_extract_all("text", F.lit(_PAIR), 0)).alias("name"), kind) \
        .unionByName(b.select(F.regexp_extract("text", "[A-Za-z]{5,}", 0).alias("name"), kind))
    d = Lx.name_mentions(table(spark, sf_dir, "documents"), "text", names)
    m = d.select("doc_id", F.explode("entities").alias("e"))
    return m.groupBy(F.col("e.type").alias("entity_type")).agg(
        F.count("*").alias("mentions"), F.count_distinct("doc_id").alias("documents"),
        F.sum(F.col("e.end") - F.col("e.start")).cast("long").alias("chars"))


@query("g4_new_columns", f"WITH _e AS ({_entities_sql('text')})\n" + "\nUNION ALL\n".join(
    f"SELECT {_lit(c)} AS \"column\", round(sum({c}), 6) AS total FROM _e" for c in _N8_ENT))
def g4_new_columns(spark, sf_dir):
    """The columns that the entity scorer added to the documents, summed."""
    d = table(spark, sf_dir, "documents")
    e = Sc.analyze_entities(d, "text")
    new = Cols.new_columns(d, e)
    one = e.agg(*[F.round(F.sum(F.round(c, R)), 6).alias(c) for c in new])
    return one.selectExpr(f"stack({len(new)}, {', '.join(f'{_lit(c)}, {c}' for c in new)}) AS (column, total)")


@query("p17_drop_exact", S.with_(S.ARTICLES, "SELECT uri, date FROM articles"))
def p17_drop_exact(spark, sf_dir):
    """Of ``date`` and ``DATE`` only the latter goes."""
    both = articles(spark, sf_dir).select("uri", "date", F.lit(1).alias("DATE"))
    return Cols.drop_exact(both, "DATE")


_P20_COLS = ["PERSON", "EVENT_mean_salience", "Public_Safety", "num_documents"]


@query("p20_conform", S.with_(S.ARTICLES, "SELECT uri, title, " + ", ".join(f"0 AS {c}" for c in _P20_COLS) + " FROM articles"))
def p20_conform(spark, sf_dir):
    """P20: columns that the model needs and the articles lack are 0."""
    return Cols.conform(articles(spark, sf_dir)).select("uri", "title", *_P20_COLS)


_P26_VALUES = ["title", "sourceTitle", "importanceRank", "alexaGlobalRank", "month", "authors", "body_pre"]
_P26_SQL = S.with_(S.SPLIT, f"""
, _b AS (SELECT *, {preprocess_sql('body', Tx.load_stop_words('italian'))} AS body_pre FROM split_articles WHERE split = 'TEST')
SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _P26_VALUES)}, round(score, {R}) AS score, round(shares_scaled, {R}) AS shares_scaled
FROM (SELECT *, {_sentiment_sql('body_pre')} FROM _b WHERE coalesce(body_pre, '') <> '')""")


def _instance_values(instances):
    """JSON instances as columns again."""
    schema = ", ".join(f"{c} string" for c in _P26_VALUES) + ", score double, shares_scaled double"
    rows = instances.select(F.from_json("instance", schema).alias("i")).select("i.*")
    return rows.select(*_P26_VALUES, F.round("score", R).alias("score"), F.round("shares_scaled", R).alias("shares_scaled"))


@query("p26_instance_values", _P26_SQL)
def p26_instance_values(spark, sf_dir):
    """P16 + P18 + P26: the values that the TEST rows' JSON instances carry,
    ranks and month as strings."""
    feats = Fz.feature_table(split_articles(spark, sf_dir))
    return _instance_values(Fz.scoring_instances(feats.where(F.col("split") == "TEST")))


@query("s11_json_lines_values", _P26_SQL)
def s11_json_lines_values(spark, sf_dir):
    """The instances written as JSON lines, read back and parsed."""
    feats = Fz.feature_table(split_articles(spark, sf_dir))
    inst = Fz.scoring_instances(feats.where(F.col("split") == "TEST"))
    path = Snk.write_json_lines(inst.select("instance"), scratch_path(spark, "jsonl"))
    return _instance_values(spark.read.text(path).select(F.col("value").alias("instance")))


@query("s11_request_document", _P26_SQL)
def s11_request_document(spark, sf_dir):
    """One ``{"instances": [...]}`` body of the TEST rows (a request holds
    ``MOST_INSTANCES`` at most, which is its limit), parsed back to columns."""
    feats = Fz.feature_table(split_articles(spark, sf_dir))
    inst = Fz.scoring_instances(feats.where(F.col("split") == "TEST"))
    body = Fz.instances_document(inst, Fz.MOST_INSTANCES)
    return _instance_values(body.select(F.explode(F.from_json("request", "instances array<string>")["instances"]).alias("instance")))


_P26_KEYS = ["title", "relevance", "authors", "sourceTitle", "importanceRank", "alexaGlobalRank", "month", "shares_scaled",
             "body_pre", "score", "magnitude", *[Cols.clean_name(c) for c in Cols.MODERATION_CATEGORIES],
             *[f"{t}_mean_salience" for t in ["PERSON", "OTHER", "ORGANIZATION", "EVENT", "LOCATION", "WORK_OF_ART",
                                              "CONSUMER_GOOD", "PRICE"]]]


@query("p26_instance_keys", S.with_(S.SPLIT, f"""
SELECT key, count(*) AS n FROM (
  SELECT unnest({_list(_P26_KEYS)}) AS key FROM split_articles
  WHERE split = 'TEST' AND coalesce({preprocess_sql('body', Tx.load_stop_words('italian'))}, '') <> '') GROUP BY key"""))
def p26_instance_keys(spark, sf_dir):
    """P24 + P26: every instance has the same keys, null or not."""
    feats = Fz.feature_table(split_articles(spark, sf_dir))
    inst = Fz.scoring_instances(feats.where(F.col("split") == "TEST"))
    return inst.select(F.explode(F.json_object_keys("instance")).alias("key")).groupBy("key").agg(F.count("*").alias("n"))


# ----------------------------------------------------------------- learned scorers

# documents of the training part: by the first hexadecimal digit of the id's md5
_TRAIN = "substr(md5(cast(doc_id AS VARCHAR)), 1, 1) < 'c'"
_WORDS_SQL = f"unnest(regexp_extract_all(lower(coalesce(text, '')), '{Ld.WORD_PATTERN}'))"
_LEXICON_SQL = f"""_lw AS (SELECT DISTINCT doc_id, toxic, {_WORDS_SQL} AS word FROM documents JOIN labels USING (doc_id) WHERE {_TRAIN}),
_lc AS (SELECT word, count(*) FILTER (WHERE toxic = 1) AS n_positive, count(*) FILTER (WHERE toxic = 0) AS n_negative
        FROM _lw WHERE toxic IN (0, 1) GROUP BY word),
_la AS (SELECT *, sum(n_positive) OVER () AS tp, sum(n_negative) OVER () AS tn,
               1000.0::DOUBLE * (n_positive + n_negative) / (sum(n_positive) OVER () + sum(n_negative) OVER ()) AS a FROM _lc),
_lo AS (SELECT word, n_positive, n_negative, ln((n_positive + a) / (tp + 1000 - n_positive - a)) - ln((n_negative + a) / (tn + 1000 - n_negative - a)) AS log_odds,
               1 / (n_positive + a) + 1 / (n_negative + a) AS v FROM _la),
lexicon AS (SELECT word, n_positive, n_negative, log_odds, log_odds / sqrt(v) AS z FROM _lo WHERE abs(log_odds / sqrt(v)) >= 3)"""
_SCORED_SQL = f"""{_LEXICON_SQL},
_dw AS (SELECT doc_id, {_WORDS_SQL} AS word FROM documents),
_ds AS (SELECT doc_id, count(*) AS n_words, count(log_odds) AS n_hits, sum(log_odds) AS s, sum(abs(log_odds)) AS m
        FROM _dw LEFT JOIN lexicon USING (word) GROUP BY doc_id),
scored AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hits, 0) AS n_hits,
                  coalesce(s / nullif(n_hits, 0), 0) AS score, coalesce(m, 0) AS magnitude
           FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN _ds USING (doc_id))"""


def _toxic_lexicon(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "toxic")
    lexicon = Ld.induce_lexicon(docs.join(labels, "doc_id").where(F.expr(_TRAIN.replace("VARCHAR", "STRING"))), "toxic")
    return docs, labels, lexicon


@query("n5_learned_lexicon", f"WITH {_LEXICON_SQL} SELECT * FROM lexicon", round_cols=("log_odds", "z"), digits=6)
def n5_learned_lexicon(spark, sf_dir):
    """The words that tell toxic documents from others, by their log-odds."""
    return _toxic_lexicon(spark, sf_dir)[2]


@query("n5_learned_scores", f"WITH {_SCORED_SQL} SELECT * FROM scored", round_cols=("score", "magnitude"), digits=5)
def n5_learned_scores(spark, sf_dir):
    """Every document scored by the learned table."""
    docs, _labels, lexicon = _toxic_lexicon(spark, sf_dir)
    return Ld.score_by_lexicon(docs, lexicon)


@query("n5_learned_agreement", f"""WITH {_SCORED_SQL},
_known AS (SELECT round(score, 6) AS score, toxic, {_TRAIN} AS train FROM scored JOIN labels USING (doc_id) WHERE toxic IN (0, 1)),
_cut AS (SELECT c.score AS cut FROM (SELECT DISTINCT score FROM _known WHERE train) c, _known k WHERE k.train GROUP BY c.score
  ORDER BY count(*) FILTER (WHERE toxic = 1 AND k.score >= c.score) * count(*) FILTER (WHERE toxic = 0)
         - count(*) FILTER (WHERE toxic = 0 AND k.score >= c.score) * count(*) FILTER (WHERE toxic = 1) DESC, cut DESC LIMIT 1)
SELECT toxic, count(*) AS documents, count(*) FILTER (WHERE score >= cut) AS called_toxic
FROM _known, _cut WHERE NOT train GROUP BY toxic""")
def n5_learned_agreement(spark, sf_dir):
    """Held-out labels against the learned score, with the cut that is best
    on the documents it was learned from."""
    docs, labels, lexicon = _toxic_lexicon(spark, sf_dir)
    scored = materialize(Ld.score_by_lexicon(docs, lexicon).join(labels.where("toxic IN (0, 1)"), "doc_id"), "scored")
    train = F.expr(_TRAIN.replace("VARCHAR", "STRING"))
    cut = Ld.best_cut(scored.where(train), "toxic").select("cut").scalar()
    return scored.where(~train).groupBy("toxic").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.round("score", 6) >= cut).alias("called_toxic"))
