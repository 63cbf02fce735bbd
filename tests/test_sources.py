"""Sources and sinks with hand-made inputs in a temporary folder."""

import json
import os
import random
import tempfile
from html import entities as html_names
from html import unescape

import pytest
from pyspark.sql import functions as F

from newsfeat.functions import text as Tx
from newsfeat.operators.prepare import InputMissing
from newsfeat.sources import articles as Src
from newsfeat.sources import sinks as Snk


def _export(path, results):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump({"articles": {"results": results}}, f, indent=2)


def test_s1_nested_export_cases(spark):
    root = tempfile.mkdtemp(prefix="s1-")
    _export(f"{root}/day1/a.json", [
        {"uri": "u1", "title": "no authors", "categories": []},
        {"uri": "u2", "authors": [{"name": "A"}, {"type": "x"}, {"name": "B"}], "source": None},
        {"uri": "u3", "source": {"title": "S", "location": None}, "categories": [{"label": "news/X"}]},
    ])
    _export(f"{root}/day2/b.json", [
        {"uri": "u4", "source": {"title": "T", "location": {"label": {"eng": "Rome"}},
                                 "ranking": {"importanceRank": 7}},
         "shares": {"facebook": 3}, "categories": [{"label": "news/Politics", "wgt": 53}, {"label": "dmoz/Y"}]},
    ])
    with open(f"{root}/day2/readme.txt", "w") as f:
        f.write("not an export")
    rows = {r.uri: r for r in Src.read_article_exports(spark, [f"{root}/day1", f"{root}/day2"]).collect()}
    assert set(rows) == {"u1", "u2", "u3", "u4"}
    assert rows["u1"].authors == "" and rows["u1"].categoryLabels == "" and rows["u1"].sharesFacebook == 0
    assert rows["u2"].authors == "A, B" and rows["u2"].sourceTitle == "" and rows["u2"].importanceRank == 0
    assert rows["u3"].sourceLocationLabel == "" and rows["u3"].categoryWeights == ""
    assert rows["u4"].categoryLabels == "news/Politics; dmoz/Y" and rows["u4"].categoryWeights == "53; "
    assert rows["u4"].sourceLocationLabel == "Rome" and rows["u4"].importanceRank == 7
    assert rows["u4"].alexaGlobalRank == 0 and rows["u4"].isDuplicate is False


def test_s3_missing_input(spark):
    with pytest.raises(InputMissing):
        Src.read_parquet_input(spark, "/nonexistent/file.parquet")
    assert Src.read_parquet_input(spark, "/nonexistent/file.parquet", on_missing="skip") is None


def test_s4_single_record(spark):
    rec = {"uri": "u", "date": "2023-12-18", "lang": "ita", "sharesFacebook": 0}
    df = Src.read_single_record(spark, rec)
    assert df.count() == 1 and len(df.columns) == 24 and df.first().lang == "ita"
    with pytest.raises(ValueError):
        Src.read_single_record(spark, "/tmp/input.csv")


def test_s5_s6_s10_roundtrips(spark):
    root = tempfile.mkdtemp(prefix="sinks-")
    df = spark.createDataFrame([("a", 'line1\nline "2" | x', 1), ("b", " padded ", 2)],
                               "k string, text string, n int")
    Snk.write_parquet(df, f"{root}/p")
    assert sorted(spark.read.parquet(f"{root}/p").collect()) == sorted(df.collect())
    Snk.write_pipe_csv(df, f"{root}/c")
    assert sorted(Snk.read_pipe_csv(spark, f"{root}/c", df.schema).collect()) == sorted(df.collect())
    calls = []

    def build():
        calls.append(1)
        return df

    Snk.run_stage(spark, f"{root}/stage", build)
    Snk.run_stage(spark, f"{root}/stage", build)
    assert len(calls) == 1
    Snk.run_stage(spark, f"{root}/stage", build, overwrite=True)
    assert len(calls) == 2


def test_n3_leaves_no_tag(spark):
    html = '<!DOCTYPE html><html><head><title>T &amp; U</title></head><body><p>a&lt;b</p><!-- c --></body></html>'
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(Tx.strip_html_regex("html").alias("t")).first().t == "T & Ua<b"


def test_n3_decodes_all_references_once(spark):
    html = "<p>caff&egrave; l&#8217;arte &#x1F600; &amp;lt; &nosuch; &#xD800; &#0; a & b; x&nbsp;y&amp; &comma;&lpar;&notit; &#00000065;&#128</p>"
    df = spark.createDataFrame([(html,), (None,), ("plain",)], "html string")
    got = [r.t for r in df.select(Tx.strip_html_regex("html").alias("t")).collect()]
    assert got == ["caffè l’arte \U0001F600 &lt; &nosuch; � � a & b; x y& ,(¬it; A€", None, "plain"]


def test_n3_references_equal_the_standard_library(spark):
    rng = random.Random(5)
    names = sorted(html_names.html5)
    numbers = [0, 1, 8, 9, 10, 11, 12, 13, 14, 31, 32, 127, 128, 129, 150, 159, 160, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFDF0,
               0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x10FFFF, 0x110000, 9_999_999, 10**30]
    refs = [f"&{n}" for n in names] + [f"&{n.rstrip(';')}{t}" for n in names for t in ("", "x", "=1", "é;")]
    refs += [f"&#{z}{n}{t}" for n in numbers for z in ("", "000") for t in (";", "", "z")]
    refs += [f"&#{x}{z}{n:{x}}{t}" for n in numbers for x in "xX" for z in ("", "0000") for t in (";", "", "g")]
    refs += ["&", "&;", "&#", "&#;", "&#x;", "&&amp;", "& amp;", "&" + "a" * 100 + ";", "&am p;"]
    rng.shuffle(refs)
    texts = ["".join(rng.choice(["", " ", "t", ";"]) + r for r in refs[i:i + 7]) for i in range(0, len(refs), 7)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [r.d for r in df.select(Tx.decode_references("t").alias("d")).collect()]
    assert got == [unescape(t) for t in texts]


def test_s4_reads_strings_and_json_of_any_shape(spark, tmp_path):
    one = {"uri": "u1", "date": "2023-12-18", "sharesFacebook": "7", "relevance": "nan", "title": "t"}
    assert Src.read_single_record(spark, one).select("uri", "sharesFacebook", "relevance").first()[:] == ("u1", 7, None)
    many = tmp_path / "many.json"
    many.write_text("[\n {\"uri\": \"a\", \"sharesFacebook\": 3},\n {\"uri\": \"b\"}\n]")
    got = Src.read_single_record(spark, str(many)).select("uri", "sharesFacebook").collect()
    assert sorted(map(tuple, got), key=str) == [("a", 3), ("b", None)]
    (tmp_path / "bad.json").write_text("{not json")
    with pytest.raises(Exception, match="(?i)malformed"):
        Src.read_single_record(spark, str(tmp_path / "bad.json")).collect()


def test_intermediate_tables_are_deleted_at_the_end_of_a_job(spark, monkeypatch):
    from newsfeat import session
    from newsfeat.operators.ranking import materialize

    monkeypatch.setattr(session, "_SCRATCH", [])
    assert materialize(spark.range(5), "few").count() == 5
    (path,) = session._SCRATCH
    assert os.path.exists(path) and session.drop_scratch(spark) == 1 and not os.path.exists(path)
    assert session.drop_scratch(spark) == 0


def test_year_layout_prunes_folders_and_keeps_odd_dates(spark, tmp_path):
    from newsfeat.sources import sinks as Snk

    rows = [(1, " 2023-05-01"), (2, "2023-05-02T10:00:00Z"), (3, "2022-12-31"), (4, "not-a-date"), (5, None), (6, "+2023-7-4"), (7, "2023-11-30")]
    path = Snk.write_by_year(spark.createDataFrame(rows, "id long, date string"), str(tmp_path / "y"), partitions=3)
    df = Snk.read_year(spark, path, 2023, first="2023-05-02", last="2023-10-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("]")[0]
    assert "date_year" in filters and "2023" in filters
    assert "date_column" in plan.split("PushedFilters:")[1].split("]")[0]
    assert sorted(r[0] for r in df.select("id").collect()) == [2, 6]
    assert sorted(r[0] for r in Snk.read_year(spark, path, 2023).select("id").collect()) == [1, 2, 6, 7]
