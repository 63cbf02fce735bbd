"""Lemmas by rules and lexicon, names by longest match, column profiles."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from newsfeat.operators import lexicons as Lx
from newsfeat.operators import profiles as Pf

SF = "/root/testdata/sf0.01"


def test_lemmas_need_the_lexicon(spark):
    words = ["dogs", "buses", "wolves", "men", "flies", "flies", "running", "hoping", "geese", "bus", "larger", "was", "s", "walked", None]
    lexicon = [("dog", "noun"), ("bus", "noun"), ("wolf", "noun"), ("man", "noun"), ("fly", "verb"), ("hope", "verb"), ("hop", "verb"),
               ("large", "adj"), ("walk", "verb"), ("walk", "noun"), ("running", "noun"), ("run", "verb")]
    exceptions = [("geese", "noun", "goose"), ("was", "verb", "be"), ("was", "adverb", "?")]
    table = Lx.lemma_table(spark.createDataFrame([(w,) for w in words], "word string"),
                           spark.createDataFrame(lexicon, "word string, pos string"),
                           spark.createDataFrame(exceptions, "word string, pos string, lemma string"))
    assert dict(map(tuple, table.collect())) == {
        "dogs": "dog", "buses": "bus", "wolves": "wolf", "men": "man", "flies": "fly", "hoping": "hope", "geese": "goose",
        "larger": "large", "was": "be", "walked": "walk"}  # "running" is a noun of the lexicon itself
    df = spark.createDataFrame([(1, ["dogs", "and", "men", "dogs"], "x"), (2, [], "x"), (3, None, "x"), (None, ["dogs"], "x")],
                               "id long, t array<string>, word string")
    got = {r["id"]: r["lemmas"] for r in Lx.lemmatised(df, "id", "t", table).collect()}
    assert got == {1: ["dog", "and", "man", "dog"], 2: [], 3: None, None: ["dogs"]}
    assert E.queries()["n2_dictionary_lemmas"](spark, SF).agg(F.sum("changed")).first()[0] > 100


def mentions_by_hand(text, names):
    found = []
    for name, kind in names.items():
        at = text.find(name)
        while at >= 0:
            end = at + len(name)
            if not (at and text[at - 1].isalnum()) and not (end < len(text) and text[end].isalnum()):
                found.append((at, -end, kind))
            at = text.find(name, at + 1)
    out, last = [], 0
    for at, end, kind in sorted(found):
        if at >= last:
            out.append((kind, at, -end))
            last = -end
    return out


@pytest.mark.parametrize("block", [1 << 25, 30])
def test_names_are_leftmost_longest(spark, monkeypatch, block):
    monkeypatch.setattr(Lx, "BLOCK_CHARS", block)
    rng = random.Random(3)
    names = {"Ann": "PERSON", "Ann Lee": "PERSON", "Lee Park": "LOCATION", "Lee": "PERSON", "Park": "LOCATION", "Élan": "ORGANIZATION",
             "Lee Park Fair": "EVENT", "A. B.": "PERSON", "梦": "WORK_OF_ART"}
    parts = ["Ann", "Lee", "Park", "Fair", "Élan", "A.", "B.", "梦", "Annex", "x", "-", ",", "😀"]
    texts = [rng.choice(["", " "]).join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(300)]
    texts += [" ".join(rng.choice(parts) for _ in range(8)) for _ in range(200)] + [None, "", "Ann Lee Park Fair Ann"]
    table = spark.createDataFrame([*names.items(), ("Ann", "ZZZ"), ("", "PERSON"), ("none", None)], "name string, type string")
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    out = {r["id"]: [(m["type"], m["start"], m["end"]) for m in r["entities"]] for r in Lx.name_mentions(df, "text", table).collect()}
    assert out == {i: mentions_by_hand(t or "", names) for i, t in enumerate(texts)}


def test_names_then_expressions(spark):
    names = spark.createDataFrame([("Rosa Verdi", "PERSON"), ("Via Roma", "WORK_OF_ART")], "name string, type string")
    df = Lx.name_mentions(spark.createDataFrame([("Rosa Verdi met Anna Neri in Via Roma 7.",)], "t string"), "t", names)
    rest = df.select(Lx.without_mentions(F.col("t"), F.col("entities")).alias("r")).first()["r"]
    assert rest == "\n" * 10 + " met Anna Neri in " + "\n" * 8 + " 7."
    none = Lx.name_mentions(df.drop("entities"), "t", names.limit(0)).first()
    assert none["entities"] == []


def top_by_hand(values, k):
    count = {}
    for v in values:
        if v is not None:
            count[str(v)] = count.get(str(v), 0) + 1
    return sorted(((v, n) for v, n in count.items()), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("tracked", [1024, 8])
def test_top_values_are_exact(spark, monkeypatch, tracked):
    monkeypatch.setattr(Pf, "TRACKED", tracked)
    rng = random.Random(5)
    rows = [(rng.choice("aab"), f"k{i}", int(rng.expovariate(0.05)), None, rng.choice([None, "", "x"]), f"t{rng.randint(0, 900)}")
            for i in range(3000)]
    cols = ["hot", "key", "skew", "none", "gaps", "flat"]
    df = spark.createDataFrame(rows, "hot string, key string, skew int, none string, gaps string, flat string").repartition(4)
    out = {}
    for r in Pf.top_values(df, cols, 4).orderBy("column", "rank").collect():
        out.setdefault(r["column"], []).append((r["value"], r["count"]))
    assert out == {c: t for i, c in enumerate(cols) if (t := top_by_hand([r[i] for r in rows], 4))}
    assert Pf.top_values(df.limit(0), cols, 4).count() == 0


def test_sketches_of_parts_equal_the_whole(spark):
    df = spark.range(30_000).select((F.col("id") % 7000).alias("few"), F.xxhash64("id").cast("string").alias("key"),
                                    F.when(F.col("id") % 5 > 0, F.sqrt("id")).alias("x"), F.lit(None).cast("int").alias("none"))
    whole = {r["column"]: r for r in Pf.sketch_report(Pf.column_sketches(df.repartition(6))).collect()}
    parts = [Pf.column_sketches(df.where(F.pmod(F.xxhash64("few"), F.lit(3)) == k)) for k in range(3)] + [Pf.column_sketches(df.limit(0))]
    merged = {r["column"]: r for r in Pf.sketch_report(Pf.merged_sketches(*parts)).collect()}
    x = df.where("x is not null").agg(F.avg("x"), F.stddev_samp("x")).first()
    for report in (whole, merged):
        assert abs(report["few"]["distinct"] / 7000 - 1) < 4 * Pf.DISTINCT_ERROR
        assert abs(report["key"]["distinct"] / 30_000 - 1) < 4 * Pf.DISTINCT_ERROR
        assert (report["x"]["rows"], report["x"]["missing"], report["none"]["missing"], report["none"]["p50"]) == (30_000, 6000, 30_000, None)
        assert abs(report["x"]["mean"] - x[0]) < 1e-9 and abs(report["x"]["std"] - x[1]) < 1e-9
        assert abs(report["x"]["p50"] ** 2 / 30_000 - 0.5) < 2 * Pf.RANK_ERROR
    assert all(whole[c]["distinct"] == merged[c]["distinct"] for c in whole)


def test_small_tables_of_lemmas_need_no_shuffle(spark, monkeypatch):
    """Documents were shuffled to meet the words that change (F4); a large table still is joined."""
    table = spark.createDataFrame([(f"w{i}", f"l{i}") for i in range(300)] + [('"\\\u0001é', "odd")], "word string, lemma string")
    df = spark.createDataFrame([(1, ["w7", None, "x", '"\\\u0001é']), (1, ["w299"]), (None, ["w7"]), (2, None), (3, [])], "id long, t array<string>")
    small = Lx.lemmatised(df, "id", "t", table)
    assert "Exchange" not in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(Lx, "SHIPPED_CHARS", 10)
    large = Lx.lemmatised(df, "id", "t", table)
    rows = lambda d: sorted(((r["id"], r["lemmas"]) for r in d.collect()), key=str)
    assert rows(small) == rows(large) == sorted([(1, ["l7", None, "x", "odd"]), (1, ["l299"]), (None, ["w7"]), (2, None), (3, [])], key=str)


def test_documents_of_a_word_with_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "a"), (2, "a c"), (None, "a"), (None, "a d"), (3, None)], "id long, t string")
    got = dict(map(tuple, Lx.document_counts(df, "id", F.split("t", " ")).collect()))
    assert got == {"a": 3, "b": 1, "c": 1, "d": 1}


def test_mentions_of_a_batch_are_compact():
    """Matches were tuples and dicts of a whole batch of texts at once."""
    import tracemalloc

    tracemalloc.start()
    made = Lx._mentions(Lx._leftmost_longest([(10 * i, 10 * i + 5, "PERSON") for i in range(300)]) for _ in range(1000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(made) == 1000 and made[999].as_py()[299] == {"start": 2990, "end": 2995, "type": "PERSON"}
    assert peak < 300_000 * 40  # bytes a mention; a dict of three takes some 300
