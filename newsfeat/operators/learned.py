"""Scorers learned from labelled documents.

``induce_lexicon`` turns documents with a 0/1 label into a table of words and
the log-odds of occurring in a document of either class, under a Dirichlet prior
in proportion to the words' share of all (Monroe, Colaresi and Quinn 2008), kept
where the log-odds are ``least_z`` standard deviations from 0.  A word counts once
a document: words come in bursts, and one text that repeats a word is one witness.  ``score_by_lexicon``
applies such a table: a mean polarity over the words found, as in the built-in
sentiment scorer; ``best_cut`` finds the score from which a document belongs to
the class.  Tables of words are written, so that their size is known: one that
fits a broadcast meets the words of a document where they stand, and only sums
by document are shuffled; a larger one is joined by shuffling the words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfeat.operators.ranking import cumulative_within, materialize

WORD_PATTERN = r"[\p{L}\p{N}]+"


def words(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))), F.lit(WORD_PATTERN), 0)


def induce_lexicon(labelled: DataFrame, label: str, text: str = "text", prior: float = 1000.0,
                   least_z: float = 3.0) -> DataFrame:
    """``(word, n_positive, n_negative, log_odds, z)`` of the words that tell
    label 1 from label 0, with the documents of each that hold them.  Rows with a null label are left out, a null text has
    no words; repeated rows count each; without words of both labels there is
    no row."""
    held = labelled.where(F.col(label).isin(0, 1)).select((F.col(label) == 1).alias("_pos"), F.explode(F.array_distinct(words(text))).alias("word"))
    counts = held.groupBy("word").agg(F.count_if("_pos").alias("n_positive"), F.count_if(~F.col("_pos")).alias("n_negative"))
    counts = materialize(counts, "word_counts")  # read twice
    total = counts.agg(F.struct(F.sum("n_positive").cast("double").alias("p"), F.sum("n_negative").cast("double").alias("n"))).scalar()
    c = counts.withColumn("_t", total)
    share = F.lit(prior) * (F.col("n_positive") + F.col("n_negative")) / (F.col("_t.p") + F.col("_t.n"))
    c = c.withColumn("_a", share)
    p, n = F.col("n_positive") + F.col("_a"), F.col("n_negative") + F.col("_a")
    odds = F.log(p / (F.col("_t.p") + prior - p)) - F.log(n / (F.col("_t.n") + prior - n))
    c = c.where((F.col("_t.p") > 0) & (F.col("_t.n") > 0)).withColumn("log_odds", odds)
    return c.withColumn("z", F.col("log_odds") / F.sqrt(1 / p + 1 / n)).where(F.abs("z") >= least_z) \
        .select("word", "n_positive", "n_negative", "log_odds", "z")


def score_by_lexicon(docs: DataFrame, lexicon: DataFrame, id_col: str = "doc_id", text: str = "text",
                     word: str = "word", polarity: str = "log_odds") -> DataFrame:
    """``(id_col, n_words, n_hits, score, magnitude)`` per id: ``score`` is the
    mean polarity of the words found (0 when none), ``magnitude`` the sum of
    their absolute values.  Texts of a repeated id count as one, null ids as
    one id; a null or empty text has score 0.  Words of the lexicon are taken in
    lower case, the first of equals by polarity."""
    found = docs.select(F.col(id_col).alias("_id"), F.explode_outer(words(text)).alias("_w"))
    lex = lexicon.select(F.lower(word).alias("_w"), F.col(polarity).cast("double").alias("_p")).where(F.col("_w").isNotNull()) \
        .groupBy("_w").agg(F.min("_p").alias("_p"))
    value = F.coalesce(F.col("_p"), F.lit(0.0))
    sums = found.join(materialize(lex, "lexicon"), "_w", "left").groupBy("_id").agg(
        F.count("_w").alias("n_words"), F.count("_p").alias("n_hits"), F.sum(value).alias("_s"), F.sum(F.abs(value)).alias("magnitude"))
    return sums.select(F.col("_id").alias(id_col), "n_words", "n_hits",
                       F.when(F.col("n_hits") > 0, F.col("_s") / F.col("n_hits")).otherwise(F.lit(0.0)).alias("score"), "magnitude")


def best_cut(scored: DataFrame, label: str, score: str = "score", digits: int = 6) -> DataFrame:
    """One row ``(cut, recall, false_alarms)``: the score, rounded to ``digits``,
    with the most recall less false alarms when documents with that score or
    more are called positive; the highest of equals.  Rows with a null score or
    another label than 0 and 1 are left out; no row unless both labels occur."""
    cells = scored.where(F.col(label).isin(0, 1) & F.col(score).isNotNull()) \
        .groupBy((-F.round(score, digits)).alias("_low")).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n"))
    run = cumulative_within(cells, [], ["_low"], ["_p", "_n"], cum=["_tp", "_fp"], total=["_all_p", "_all_n"])
    whole = lambda c: F.col(c).cast("decimal(18,0)")
    rates = run.where((F.col("_all_p") > 0) & (F.col("_all_n") > 0)).select(
        (-F.col("_low")).alias("cut"), (F.col("_tp") / F.col("_all_p")).alias("recall"), (F.col("_fp") / F.col("_all_n")).alias("false_alarms"),
        (whole("_tp") * whole("_all_n") - whole("_fp") * whole("_all_p")).alias("_gain"))  # exact, so that equals are equal
    best = F.max_by(F.struct("cut", "recall", "false_alarms"), F.struct("_gain", "cut"))
    return rates.agg(best.alias("b")).where("b IS NOT NULL").select("b.*")
