"""Behaviours that bite and invariants of the operators."""

import math

import pytest
from pyspark.sql import functions as F

from newsfeat.functions import columns as Cols
from newsfeat.functions import distributions as D
from newsfeat.operators import model as Mdl
from newsfeat.operators import prepare as P
from newsfeat.operators import sampling as Smp
from newsfeat.operators import scorers as Sc
from newsfeat.operators import split as Sp
from newsfeat.operators import stats as X
from newsfeat.queries import common as C
from conftest import SF


def test_t1_date_entity_column_does_not_collide(spark):
    df = spark.createDataFrame([("2023-01-02", "5 on 2023-01-02")], "date string, body string")
    out = Sc.analyze_entities(df, "body")
    assert "DATE_count" in out.columns and "date" in out.columns
    assert out.first()["DATE_count"] == 1.0
    # exact-case drop keeps the lower-case column (df.drop would drop both)
    both = df.withColumn("DATE_", F.lit(1)).withColumnRenamed("DATE_", "DATE")
    assert Cols.drop_exact(both, "DATE").columns == ["date", "body"]


def test_t16_guarded_drop(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert Cols.drop_exact(df, "DATE").columns == ["a"]
    with pytest.raises(KeyError):
        Cols.drop_exact(df, "DATE", strict=True)


def test_t5_sample_larger_than_rows(spark):
    df = spark.range(5).withColumn("uri", F.col("id").cast("string"))
    assert Smp.seeded_sample(df, 50, seed=1).count() == 5


def test_d3_sample_independent_of_partitioning(spark):
    base = spark.range(200).withColumn("uri", F.concat(F.lit("u"), F.col("id").cast("string")))
    a = {r.uri for r in Smp.seeded_sample(base.repartition(1), 17, seed=3).collect()}
    b = {r.uri for r in Smp.seeded_sample(base.repartition(7), 17, seed=3).collect()}
    assert a == b and len(a) == 17


def test_t6_year_month_unpadded_and_null(spark):
    df = spark.createDataFrame([("2023-01-05",), ("not-a-date",)], "date string")
    out = P.add_year_month(P.parse_date(df)).orderBy("date").collect()
    assert out[0].year_month == "2023-1" and out[1].year_month is None


def test_t7_empty_and_null_texts_are_not_scored(spark):
    df = spark.createDataFrame([(1, "buono"), (2, ""), (3, None)], "id int, body string")
    assert [r.id for r in Sc.moderate(df).collect()] == [1]
    assert Sc.skip_empty(df, "body").count() == 1


def test_t8_column_name_cleaning():
    assert Cols.clean_name("Death, Harm & Tragedy") == "Death_Harm__Tragedy"
    assert Cols.clean_name("Firearms & Weapons") == "Firearms__Weapons"
    assert Cols.clean_name("Public Safety") == "Public_Safety"
    cleaned = [Cols.clean_name(c) for c in Cols.MODERATION_CATEGORIES]
    assert all(c in Cols.REQUIRED_COLUMNS for c in cleaned)


def test_t9_gate_requires_dict():
    with pytest.raises(TypeError):
        Mdl.deployment_gate({"auRoc": 0.9}, None, "0.95")
    assert Mdl.deployment_gate({"auRoc": 0.96}, {"auRoc": 0.99}, {"auRoc": 0.95})
    assert Mdl.deployment_gate({"auRoc": 0.90}, {"auRoc": 0.80}, {"auRoc": 0.95})  # better than before
    assert not Mdl.deployment_gate({"auRoc": 0.90}, {"auRoc": 0.93}, {"auRoc": 0.95})
    assert Mdl.deployment_gate({"logLoss": 0.2}, {"logLoss": 0.5}, {"logLoss": 1.0})
    assert not Mdl.deployment_gate({"logLoss": 2.0}, {"logLoss": 0.5}, {"logLoss": 1.0})
    with pytest.raises(ValueError):
        Mdl.deployment_gate({"f1": 0.2}, None, {"f1": 1.0})


def test_t14_train_count_integer():
    for n, want in [(1, 0), (7, 6), (20, 19), (299_999, 284_999)]:
        assert (95 * n) // 100 == want


def test_v1_and_d7_invariants(spark):
    s = C.split_articles(spark, SF)
    sizes = {(r.topic, r.split): r.n for r in s.groupBy("topic", "split").agg(F.count("*").alias("n")).collect()}
    for t in {k[0] for k in sizes}:
        n = sum(v for (tt, _), v in sizes.items() if tt == t)
        train = (95 * n) // 100
        assert sizes.get((t, "TRAIN"), 0) == train
        assert sizes.get((t, "VALIDATE"), 0) == (n - train) // 2
    b = Sp.balance_classes(s.where(F.col("split") == "TRAIN"))
    counts = {r["count"] for r in b.groupBy("topic").count().collect()}
    assert len(counts) == 1


def test_t12_rank_correlations_drop_null_pairs_and_are_bounded(spark):
    rows = [(float(i % 7), float((i * 3) % 11) if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "x double, y double")
    rho = X.spearman(df, "x", "y").first()[0]
    tau = X.kendall_tau_b(df, "x", "y").first()[0]
    assert -1 <= rho <= 1 and -1 <= tau <= 1 and not math.isnan(rho)


def test_x9_tail_functions_against_tables():
    # published critical values at the 5 % level
    assert abs(D.f_sf(3.4928, 2, 20) - 0.05) < 1e-4
    assert abs(D.chi2_sf(5.9915, 2) - 0.05) < 1e-4
    assert abs(2 * D.t_sf(2.2281, 10) - 0.05) < 1e-4
    assert abs(D.chi2_sf(3.8415, 1) - 0.05) < 1e-4
    assert abs(D.f_sf(1.0, 5, 5) - 0.5) < 1e-9


def test_n6_price_and_date_extractors(spark):
    df = spark.createDataFrame([(1, "Paid $ 12.50 and 3 EUR on 2023-12-18, call +39 06 1234 5678 at Via Roma 5")],
                               "id int, body string")
    r = Sc.analyze_entities(df).first()
    assert r.PRICE == 2.0 and r.DATE_count == 1.0 and r.PHONE_NUMBER == 1.0 and r.ADDRESS == 1.0
    assert 0 < r.PRICE_mean_salience < 1
    assert r.NUMBER == 0.0  # every digit belongs to another mention
    both = Sc.entity_features(Sc.entity_mentions(df, "body")).first()
    assert both.PRICE == 2.0 and math.isclose(both.PRICE_mean_salience, r.PRICE_mean_salience)


def test_plugin_scorer_is_made_once_a_partition(spark):
    import pandas as pd

    def make():
        calls = []

        def score(texts):
            calls.append(len(texts))
            return pd.DataFrame({"batch": [len(calls)] * len(texts)})

        return score

    df = spark.range(25_000).select(F.col("id"), F.lit("x").alias("body"), F.lit("wide").alias("rest")).coalesce(1)
    out = Sc.score_with(df, make, "batch int", keep=["id"])
    assert out.columns == ["id", "batch"] and out.agg(F.max("batch")).first()[0] > 1


def test_a20_a14_profile_of_null_and_constant_columns(spark):
    from newsfeat.operators import aggregates as A

    df = spark.createDataFrame([("a", None, 1), ("b", None, 1), ("b", None, 1)], "k string, none long, one long")
    p = {r["column"]: r for r in A.profile(df).collect()}
    assert (p["k"].top, p["k"].freq, p["one"].top, p["one"].p50, p["one"].std) == ("b", 2, "1", 1.0, 0.0)
    assert p["none"].missing == 3 and p["none"].top is None and p["none"].p50 is None
    d = {r["column"]: r for r in A.describe_all(df, ["k", "none", "one"]).collect()}
    assert d["k"]["unique"] == 2 and d["one"].mean == 1.0 and d["none"]["count"] == 0


def test_p20_conformance_adds_missing_columns(spark):
    df = spark.createDataFrame([("u", 1.0)], "uri string, Toxic double")
    out = Cols.conform(df)
    assert out.columns[:2] == ["uri", "Toxic"] and set(Cols.REQUIRED_COLUMNS) <= set(out.columns)
    assert out.first()["PERSON"] == 0


def test_n2_lemma_table_and_g4_new_columns(spark):
    from newsfeat.functions import text as Tx
    df = spark.createDataFrame([("I gatti e i cani",)], "body string")
    out = Tx.preprocess_text(df, "body", "body_pre", lemmas={"gatti": "gatto", "cani": "cane"})
    assert out.first().body_pre == "gatto cane"
    assert Cols.new_columns(df, out) == ["body_pre"]


def test_s11_request_document(spark):
    from newsfeat.plans import featurize as Fz
    df = spark.createDataFrame([(i, f"t{i}") for i in range(30)], "relevance long, title string")
    doc = Fz.instances_document(Cols.to_instances(df), n=10).first().request
    import json
    assert len(json.loads(doc)["instances"]) == 10


def test_p13_holiday_calendar_and_d4_unseeded(spark):
    from newsfeat.functions import dates as Dt
    ev = spark.createDataFrame([("2023-12-25 10:00:00",), ("2023-12-27 11:00:00",)], "ts string") \
        .selectExpr("cast(ts as timestamp) as ts")
    hol = spark.createDataFrame([("2023-12-25",)], "date string")
    out = Dt.calendar_features(ev, "ts", "ts", holidays=hol).orderBy("ts").collect()
    assert [r.is_holiday for r in out] == [1, 0] and out[0].day == "Monday"
    base = spark.range(100).withColumn("uri", F.col("id").cast("string"))
    assert Smp.seeded_sample(base, 7, seed=None).count() == 7


def test_p19_clean_column_names_on_frame(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "`Death, Harm & Tragedy` double, `War & Conflict` double")
    assert Cols.clean_column_names(df).columns == ["Death_Harm__Tragedy", "War__Conflict"]


def test_q1_watermark_dedup_alternative(spark, tmp_path):
    import json
    from newsfeat.streaming import incremental as Inc
    src = tmp_path / "src"
    src.mkdir()
    arts = [{"uri": "u1", "dateTime": "2023-01-02T10:00:00Z"}, {"uri": "u1", "dateTime": "2023-01-02T11:00:00Z"},
            {"uri": "u2", "dateTime": "2023-01-03T10:00:00Z"}]
    (src / "a.json").write_text(json.dumps({"articles": {"results": arts}}))
    s = Inc.drop_duplicates_within_watermark(Inc.article_stream(spark, str(src)))
    q = (s.writeStream.format("memory").queryName("wm_dedup").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.uri for r in spark.sql("SELECT uri FROM wm_dedup").collect()) == ["u1", "u2"]


def test_t2_stage_output_carries_the_split(spark):
    """The preparation stage returns the split frame (the reference saved
    the frame before splitting, without the column training needs)."""
    s = C.split_articles(spark, SF)
    assert "split" in s.columns and "shares_scaled" in s.columns
    assert {r[0] for r in s.select("split").distinct().collect()} <= {"TRAIN", "VALIDATE", "TEST"}
    prepared = C.prepared(spark, SF).select("uri")
    assert s.count() == prepared.count()
    assert s.select("uri").exceptAll(prepared).count() == 0


def test_t3_scaler_fit_and_apply_are_separate(spark):
    """Fit on the prepared rows by default; a given fit (the balanced set,
    a request sample) is applied as is."""
    import numpy as np

    df = C.prepared(spark, SF)
    shares = np.array([r[0] for r in df.select("sharesFacebook").collect() if r[0] is not None], dtype=float)
    q25, q50, q75 = np.percentile(shares, [25, 50, 75])
    fit = P.robust_fit(df, "sharesFacebook").first()
    assert math.isclose(fit.center, q50) and math.isclose(fit.scale, (q75 - q25) or 1.0)
    row = df.select("sharesFacebook", "shares_scaled").where(F.col("sharesFacebook").isNotNull()).first()
    assert math.isclose(row.shares_scaled, (row.sharesFacebook - fit.center) / fit.scale)
    given = spark.createDataFrame([(10.0, 4.0)], "center double, scale double")
    other = P.prepare_articles(C.articles(spark, SF), fit=given)
    r2 = other.select("sharesFacebook", "shares_scaled").where(F.col("sharesFacebook").isNotNull()).first()
    assert math.isclose(r2.shares_scaled, (r2.sharesFacebook - 10.0) / 4.0)
    # a zero range scales by 1 (scikit-learn behaviour)
    flat = spark.createDataFrame([(5,), (5,), (5,)], "x long")
    assert P.robust_fit(flat, "x").first().scale == 1.0


def test_t4_json_input_is_processed(spark, tmp_path):
    """T4: a JSON input is read and goes through the chain (the reference
    loaded it and then ignored it)."""
    import json

    from newsfeat.plans import featurize as Fz
    from newsfeat.sources import articles as Src

    recs = [{"uri": f"u{i}", "date": "2023-03-0%d" % (i + 1), "dateTime": "2023-03-0%dT10:00:00Z" % (i + 1),
             "body": "Il governo approva la legge. Roma, 12 marzo.", "authors": "A. B.",
             "categoryLabels": "news/Politics", "sharesFacebook": i, "lang": "ita"} for i in range(3)]
    path = tmp_path / "input.json"
    path.write_text("\n".join(json.dumps(r) for r in recs))
    df = Src.read_request_input(spark, str(path))
    prepared = P.prepare_articles(df)
    feats = Fz.feature_table(prepared)
    assert feats.count() == 3
    assert {"body_pre", "score", "magnitude", "Toxic", "NUMBER"} <= set(feats.columns)
    # a copy later in the file is dropped by the first-row de-duplication
    path.write_text("\n".join(json.dumps(r) for r in recs + [dict(recs[0], title="later copy")]))
    again = P.prepare_articles(Src.read_request_input(spark, str(path)), scale=False)
    assert again.count() == 3 and again.where(F.col("title") == "later copy").count() == 0
    one = P.prepare_articles(Src.read_request_input(spark, recs[1]), scale=False)
    assert [r.uri for r in one.collect()] == ["u1"]


def test_t13_bad_dates_are_null_under_ansi(spark):
    """ANSI mode is on; unparsable dates and times become null instead
    of failing the job, and fall out of the year filter."""
    from newsfeat.functions import dates as Dt

    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("2023-02-30", "2023-02-30T10:00:00Z"), ("not-a-date", ""),
                                ("", "2023-01-05T25:00:00Z"), ("2023-01-05", "2023-01-05T09:30:00Z")],
                               "date string, dateTime string")
    out = P.parse_date(df).select("date", "date_column", Dt.hour_of_iso("dateTime").alias("hour")).collect()
    by = {r.date: r for r in out}
    assert by["2023-02-30"].date_column is None and by["not-a-date"].date_column is None
    assert by[""].date_column is None and by[""].hour is None
    assert by["2023-01-05"].date_column is not None and by["2023-01-05"].hour == 9
    assert P.filter_year(P.parse_date(df), 2023).count() == 1


def test_t15_unicode_word_tokens_agree_with_duckdb(spark):
    """Word tokens are runs of Unicode letters/digits (``\\w`` is ASCII
    in both engines); Spark and DuckDB give the same tokens."""
    import duckdb

    from newsfeat.functions import text as Tx
    from newsfeat.queries.text import tok_sql

    texts = ["Perché è già così? Sì: l'àncora — 3,5 €", "Straße über Ärger, naïve café!", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(Tx.tokens("text")).collect()]
    assert got[0][:4] == ["Perché", "è", "già", "così"]
    assert "Straße" in got[1] and "naïve" in got[1] and "café" in got[1]
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (VALUES " + ", ".join(
        "('" + t.replace("'", "''") + "', " + str(i) + ")" for i, t in enumerate(texts)) + ") v(text, i)")
    duck = [r[0] for r in con.execute(f"SELECT {tok_sql('text')} FROM t ORDER BY i").fetchall()]
    assert [list(x) for x in duck] == got


def test_f1_keeps_every_whole_date_of_the_year(spark):
    rows = [(" 2023-01-05",), ("+2023-01-05",), ("2023-1-5",), ("2023",), ("2023-5",), ("2022-12-31",), (None,)]
    df = spark.createDataFrame(rows, "date string")
    assert {r.date for r in P.filter_year(P.parse_date(df), 2023).collect()} == {" 2023-01-05", "+2023-01-05", "2023-1-5"}


def test_n2_lemma_table_of_many_entries(spark):
    from newsfeat.functions import text as Tx

    lemmas = {f"w{i}": f"l{i}" for i in range(100)}
    df = spark.createDataFrame([("w0 w57 w99 è other",), (None,)], "body string")
    got = [r.p for r in Tx.preprocess_text(df, "body", "p", lemmas=lemmas, stop_words=[]).select("p").collect()]
    assert got == ["l0 l57 l99 è other", None]
