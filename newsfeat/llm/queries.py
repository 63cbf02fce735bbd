"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.llm import (edit_counts, embedding_caps, hyperminhash, lexical_search, main_text, mixing, packing, pii,
                          piece_codec, quality, toxicity, url_filter, vector_codes)
from newsfeat.llm.tables import read


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_caps.near_vectors(read(spark, sf_dir, "embeddings"))


def op2_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encoded(read(spark, sf_dir, "documents"), with_ids=False)


def op3_toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.graded(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op4_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.judged(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.found_spans(docs, pii.fit(docs))


def derived_edits(docs: DataFrame) -> DataFrame:
    """Three edits of every document, placed by hashes of its id: an insertion,
    a deletion, and a replacement by a part of its own text."""
    n = F.length("text")
    place = lambda salt: F.when(n > 0, F.pmod(F.xxhash64("doc_id", F.lit(salt)), n)).otherwise(0).cast("int")
    edit = lambda start, length, insert: F.struct(
        start.alias("start"), F.lit(length).alias("length"), insert.alias("insert"))
    copied = F.substring(F.col("text"), F.lit(1), F.lit(60))
    return docs.withColumn("edits", F.array(edit(place(1), 0, F.lit(" [corrected] ")), edit(place(2), 25, F.lit("")),
                                            edit(place(3), 40, F.upper(copied))))


def op6_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return edit_counts.edited_counts(derived_edits(docs))


def op7_hyperminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(read(spark, sf_dir, "documents"), words=4, percent=80)


def op8_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted(read(spark, sf_dir, "pages"))


def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(read(spark, sf_dir, "pages"), url_filter.fit(url_filter.labelled_urls(spark)))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(read(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_piece_codec, op3_toxicity_severity, op4_quality_ratio, op5_pii_spans,
    op6_edit_token_counts, op7_hyperminhash_dedup, op8_pack_sequences, op9_main_text, op10_url_verdicts,
    op11_source_mix, op12_ranked_search, op13_vector_codes)}

_COMPONENTS = """
, twoway AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links)
, reach(id, other) AS (
    SELECT id, id FROM nodes
    UNION
    SELECT r.id, l.b FROM reach r JOIN twoway l ON r.other = l.a)
, component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


def _vector_codes_sql() -> str:
    """The rounds of op13, each a full scan of all entries."""
    assign = """
, assigned_{t} AS MATERIALIZED (
    SELECT row, label, vec_id, p, any_value(x) AS x, min(d * 16 + e) AS nearest
    FROM (SELECT a.*, b.e, list_sum(list_transform(list_zip(a.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
          FROM parts a JOIN book_{t} b USING (p))
    GROUP BY row, label, vec_id, p)"""
    move = """
, book_{u} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book_{t} b LEFT JOIN (
        SELECT p, e, list(total ORDER BY i) AS c FROM (
            SELECT p, nearest % 16 AS e, i, floor(sum(x[i]) / count(*))::BIGINT AS total
            FROM assigned_{t}, generate_series(1, len(x)) AS g(i) GROUP BY ALL)
        GROUP BY p, e) m USING (p, e))"""
    rounds = "".join(assign.format(t=t) + move.format(t=t, u=t + 1) for t in range(6))
    return """
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
           list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS g
    FROM embeddings WHERE embedding IS NOT NULL
      AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))))
, parts AS MATERIALIZED (
    SELECT row, vec_id, label, p, g[p * len(g) // 8 + 1 : (p + 1) * len(g) // 8] AS x FROM kept, range(8) AS r(p))
, book_0 AS MATERIALIZED (SELECT p, row - 1 AS e, x AS c FROM parts WHERE row <= 16)""" + rounds + assign.format(t=6) + """
, coded AS (
    SELECT vec_id, label, string_agg(printf('%02x', (nearest % 16)::INTEGER), '' ORDER BY p) AS code,
           sum(nearest // 16)::BIGINT AS error
    FROM assigned_6 GROUP BY row, vec_id, label)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book_6) AS codebooks_sha256, label
FROM coded
"""


SQL = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE nodes AS (
    SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings)
, links AS (
    SELECT x.id AS a, y.id AS b FROM nodes x JOIN nodes y ON x.id < y.id
    WHERE list_cosine_similarity(x.v, y.v) >= 0.95)
""" + _COMPONENTS + """
SELECT n.id AS vec_id, (SELECT count(*) FROM twoway t WHERE t.a = n.id) AS n_links, c.component_id,
       c.component_id = n.id AS kept
FROM nodes n JOIN component c USING (id)
""",
    "op7_hyperminhash_dedup": r"""
WITH RECURSIVE worded AS (
    SELECT doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS w FROM documents)
, nodes AS (
    SELECT id, list_distinct(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 3], ' ') for i in generate_series(1, len(w) - 3)] END) AS s
    FROM worded)
, shingles AS (SELECT id, unnest(s) AS s FROM nodes)
, shared AS (
    SELECT x.id AS a, y.id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.id < y.id GROUP BY ALL)
, links AS (
    SELECT a, b FROM shared JOIN nodes x ON x.id = a JOIN nodes y ON y.id = b
    WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n))
""" + _COMPONENTS + """
SELECT n.id AS doc_id, len(n.s)::BIGINT AS n_shingles, c.component_id, c.component_id = n.id AS kept
FROM nodes n JOIN component c USING (id)
""",
    "op11_source_mix": r"""
WITH counted AS MATERIALIZED (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           coalesce(length(text), 0) AS chars,
           coalesce(length(text) - length(translate(text, '0123456789#*$%&|<>=+~^{}[]\/@_`', '')), 0) AS junk
    FROM documents)
, keyed AS MATERIALIZED (
    SELECT doc_id, source, size,
           -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496)
             / (1.0::DOUBLE / (1.0::DOUBLE + 10.0::DOUBLE * junk / greatest(chars, 1))) AS key
    FROM counted)
, sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
    FROM keyed GROUP BY source)
, levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - (sum(2.0::DOUBLE * source_size) OVER w - 2.0::DOUBLE * source_size))
              / (sum(weight) OVER () - (sum(weight) OVER w - weight)) AS level
    FROM sources WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING))
, goals AS (
    SELECT source, source_size, least(2.0::DOUBLE * source_size, (SELECT max(level) FROM levels) * weight) AS target FROM levels)
, budgets AS (
    SELECT *, floor(target + 0.5)::BIGINT AS budget,
           CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS passes FROM goals)
, drawn AS (
    SELECT k.*, b.source_size, b.target, b.passes, b.budget - b.passes * b.source_size AS rest,
           sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) - k.size AS before
    FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (passes * size + greatest(0, least(size, rest - before)))::BIGINT AS taken, source
FROM drawn
""",
    "op12_ranked_search": """
WITH terms AS MATERIALIZED (
    SELECT doc_id, """ + _TERMS + """ AS t FROM documents)
, lengths AS MATERIALIZED (SELECT doc_id, len(t)::BIGINT AS n FROM terms WHERE len(t) > 0)
, totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths)
, asked AS MATERIALIZED (
    SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest(""" + _TERMS + """) AS t FROM benchmark) GROUP BY ALL)
, postings AS MATERIALIZED (
    SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS t FROM terms)
    WHERE t IN (SELECT t FROM asked) GROUP BY ALL)
, weights AS (
    SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM postings, totals GROUP BY t, docs)
, normal AS (SELECT doc_id, 100 - 75 + (75 * n * docs) // words AS m FROM lengths, totals)
, scored AS (
    SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN postings USING (t) JOIN weights USING (t) JOIN normal USING (doc_id) GROUP BY ALL HAVING score > 0)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored QUALIFY rank <= 10
""",
    "op13_vector_codes": _vector_codes_sql(),
}
