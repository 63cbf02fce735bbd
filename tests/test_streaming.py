"""Q1: first copies by keyed state over three micro-batches."""

import json
import os
import time

from pyspark.sql import functions as F

from newsfeat.operators import prepare as prep
from newsfeat.sources.articles import read_article_exports
from newsfeat.streaming import incremental as Inc


def article(uri, title, date="2023-05-01", author="A. B.", label="news/Politics"):
    return {"uri": uri, "title": title, "body": f"Testo di {title} con parole", "date": date, "dateTime": f"{date}T10:00:00Z",
            "authors": [{"name": author}] if author else [], "categories": [{"label": label, "wgt": 10}],
            "shares": {"facebook": 5}, "source": {"title": "S", "ranking": {"importanceRank": 2**60 + 1, "alexaGlobalRank": 3}}}


BATCHES = [
    [article("a", "a1"), article("b", "b1", author=None), article("hot", "hot1"), article(None, "n1"), article("old", "o1", "2022-05-01")],
    [article("a", "a2"), article("c", "c1"), article("b", "b2"), article("c", "c2"), article("old", "o2"), article(None, "n2")],
    [article("d", "d1"), article("hot", "hot2"), article("a", "a3"), article("c", "c3")] + [article("hot", "hot3")] * 500,
]


def test_three_batches_equal_one(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    for k, rows in enumerate(BATCHES):
        (tmp_path / "src").mkdir(exist_ok=True)
        (tmp_path / "src" / f"f{k}.json").write_text(json.dumps({"articles": {"results": rows}}))
        progress = Inc.run_incremental_scoring(spark, src, sink, ckpt, 0.0, 1.0)
        touched = sum(s["numRowsUpdated"] for p in progress for s in p["stateOperators"])
        assert touched <= len({r["uri"] for r in rows})  # the state of other uris is not read or written
    out = spark.read.parquet(sink)
    whole = prep.prepared_rows(read_article_exports(spark, src), 2023)
    rows = lambda df: sorted(map(tuple, df.select("uri", "title", "importanceRank", "topic").collect()), key=str)
    assert rows(out) == rows(whole)
    # b1 has no author: the first copy counts, so none of b is kept; o1 is of another year
    assert sorted(r["title"] for r in out.collect()) == ["a1", "c1", "d1", "hot1", "n1", "o2"]
    assert {r[0] for r in out.select("importanceRank").distinct().collect()} == {2**60 + 1}  # not through a float
    Inc.run_incremental_scoring(spark, src, sink, ckpt, 0.0, 1.0)
    assert spark.read.parquet(sink).count() == 6


def test_late_copies_need_no_sink(spark, tmp_path):
    """What an earlier batch wrote is not read: the state alone knows it."""
    (tmp_path / "src").mkdir()
    run = lambda sink: Inc.run_incremental_scoring(spark, str(tmp_path / "src"), str(tmp_path / sink), str(tmp_path / "c"), 0.0, 1.0)
    for k, sink in enumerate(("one", "two")):
        (tmp_path / "src" / f"f{k}.json").write_text(json.dumps({"articles": {"results": BATCHES[k]}}))
        run(sink)
    assert sorted(r["title"] for r in spark.read.parquet(str(tmp_path / "two")).select(F.col("title")).collect()) == ["c1", "o2"]


def test_many_uris_in_several_micro_batches(spark, tmp_path):
    """No Python for each uri: thousands of uris take seconds; copies in other
    micro-batches of the same run are late, those of one micro-batch go by file."""
    (tmp_path / "src").mkdir()
    for k in range(4):
        rows = [article(f"u{i}", f"t{k}-{i}") for i in range(k * 1000, k * 1000 + 2000)]
        (tmp_path / "src" / f"f{k}.json").write_text(json.dumps({"articles": {"results": rows + rows[:5]}}))
        os.utime(tmp_path / "src" / f"f{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    begun = time.monotonic()
    progress = Inc.run_incremental_scoring(spark, *(str(tmp_path / n) for n in ("src", "sink", "ckpt")), 0.0, 1.0, max_files_per_trigger=2)
    took = time.monotonic() - begun
    assert len([p for p in progress if p["numInputRows"]]) == 2
    out = {r["uri"]: r["title"] for r in spark.read.parquet(str(tmp_path / "sink")).select("uri", "title").collect()}
    assert out == {f"u{i}": f"t{max(0, i // 1000 - 1)}-{i}" for i in range(5000)}
    assert spark.read.parquet(str(tmp_path / "sink")).count() == 5000
    assert took < 60  # 8 ms a uri and core before, on top of the rest


def test_a_micro_batch_run_again_adds_nothing(spark, tmp_path):
    """A failure after the uris are looked up and before the micro-batch is committed."""
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "f0.json").write_text(json.dumps({"articles": {"results": BATCHES[0]}}))
    run = lambda: Inc.run_incremental_scoring(spark, *(str(tmp_path / n) for n in ("src", "sink", "ckpt")), 0.0, 1.0)
    run()
    for f in (".0.crc", "0"):
        (tmp_path / "ckpt" / "arrivals" / "commits" / f).unlink()
    run()
    assert sorted(r["title"] for r in spark.read.parquet(str(tmp_path / "sink")).collect()) == ["a1", "hot1", "n1"]
