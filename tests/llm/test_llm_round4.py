"""The fits of the quality and toxicity models: every labelled document counts."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsfeat.llm import quality, tables, toxicity


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """20,400 documents of 30 random words; the 400 whose ids come last by hash
    have other words too, those of a few lists, and no other has any."""
    number = lambda *x: F.pmod(F.xxhash64(*x), F.lit(3000)).cast("string")
    rows = spark.range(20_400).select(F.col("id").alias("doc_id"))
    last = rows.orderBy(F.xxhash64("doc_id").desc(), F.col("doc_id").desc()).limit(400).select(F.col("doc_id").alias("other"))
    rows = rows.join(F.broadcast(last), F.col("doc_id") == F.col("other"), "left")
    plain = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.concat(F.lit("w"), number("doc_id", i))))
    bad = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(6)),
                                       lambda i: F.concat(F.lit("vile"), F.pmod(F.xxhash64("doc_id", i), F.lit(40)).cast("string"))))
    rows = rows.select("doc_id", F.when(F.col("other").isNull(), plain).otherwise(F.concat_ws(" ", plain, bad)).alias("text"),
                       F.col("other").isNull().cast("int").alias("quality"), F.col("other").isNotNull().cast("int").alias("toxic"))
    path = str(tmp_path_factory.mktemp("many") / "documents")
    rows.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("places", [3, 25])
def test_every_document_with_a_label_is_found(spark, monkeypatch, places):
    monkeypatch.setattr(tables, "PLACE_BITS", places)
    docs = spark.createDataFrame([(i, f"t{i}") for i in [1, 2, 2, 3, -4, None, 2**62, *range(10, 3000)]], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 0), (2, 1), (3, None), (-4, 0), (None, 1), (2**62, 1), (9, 1), (10, 0), (10, 0)],
                                   "doc_id long, toxic int")
    got = sorted(map(tuple, tables.labelled(docs, labels, "toxic").collect()))
    assert got == [(-4, "t-4", 0), (2, "t2", 1), (2, "t2", 1), (10, "t10", 0), (2**62, f"t{2**62}", 1)]


def test_marked_rows_are_those_of_the_set(spark):
    numbers = sorted({*range(1, 40), 32768, 32769, 40_000, (3 << 33) + 5, (3 << 33) + 32768})
    marks = tables.bits(spark.createDataFrame([(n,) for n in numbers[::2]], "n long"), F.col("n"))
    rows = spark.createDataFrame([(n, str(n)) for n in numbers], "n long, s string")
    assert sorted(r["s"] for r in tables.marked(rows, F.col("n"), marks).collect()) == sorted(map(str, numbers[::2]))


def rates(judged, many, column, label):
    seen = judged.join(many, "doc_id").groupBy(label).agg(F.avg(F.col(column).cast("double")).alias("r")).collect()
    return {r[label]: r["r"] for r in seen}


def test_quality_is_fitted_on_all_labels(many):
    model = quality.fit(many.select("doc_id", "text"), many.select("doc_id", "quality"))
    assert np.isfinite(model.threshold)
    got = rates(quality.judged(many.select("doc_id", "text"), model), many, "kept", "quality")
    assert got[1] > 0.99 and got[0] < 0.1


def test_toxicity_is_fitted_on_all_labels(many):
    model = toxicity.fit(many.select("doc_id", "text"), many.select("doc_id", "toxic"))
    assert len(model.bucket)
    got = rates(toxicity.graded(many.select("doc_id", "text"), model).withColumnRenamed("toxic", "found"), many, "found", "toxic")
    assert got[1] > 0.95 and got[0] < 0.01


@pytest.mark.parametrize("piece", [3, 1000])
def test_originals_are_those_unlike_any_original_before(spark, monkeypatch, piece):
    monkeypatch.setattr(toxicity, "PIECE", piece)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 60_000, (6, 256)).astype(np.uint16)
    rows = []
    for at in range(160):
        # chains of texts that resemble their neighbours, and exact copies; ids repeat
        sketch = base[rng.integers(0, 6)].copy()
        sketch[:rng.integers(0, 130)] = rng.integers(0, 60_000)
        rows.append((int(rng.choice([1, 1, 1, 2, -3])), int(rng.integers(0, 90)), int(rng.integers(0, 3)), at, sketch))
    expected, kept = [], {}
    for low, _doc, _hash, at, sketch in sorted(rows, key=lambda r: r[:4]):
        if all((sketch == k).mean() < toxicity.COPY for k in kept.get(low, [])):
            kept.setdefault(low, []).append(sketch)
            expected.append(at)
    assert 8 < len(expected) < 150 and max(map(len, kept.values())) > 3
    table = spark.createDataFrame([(*r[:4], bytearray(r[4].tobytes())) for r in rows],
                                  "low long, _doc long, _hash long, _row long, sketch binary").repartition(3)
    assert sorted(r[0] for r in toxicity.originals(table).collect()) == sorted(expected)


def covering_by_texts(has, cost, least):
    open_, chosen = np.ones(len(has), bool), []
    while True:
        gain = has[open_].sum(axis=0) - cost
        if gain.max() < least:
            return chosen
        chosen.append(int(gain.argmax()))
        open_ &= ~has[:, chosen[-1]]


@pytest.mark.parametrize("front", [1, 3, 20])
def test_covering_equals_selection_text_by_text(spark, monkeypatch, front):
    monkeypatch.setattr(toxicity, "FRONT", front)
    monkeypatch.setattr(toxicity, "CLEAN_COST", 2)
    rng = np.random.default_rng(8)
    has = rng.random((300, 40)) < np.linspace(0.01, 0.12, 40)[rng.permutation(40)]
    clean = rng.integers(0, 3, 40) * (rng.random(40) < 0.5)
    share = has.sum(axis=0)
    expected = covering_by_texts(has, 2 * clean, toxicity.LEAST_TOXIC)
    common = np.flatnonzero((clean == 0) & (share >= max(2 * toxicity.LEAST_TOXIC, toxicity.COMMON * 300)))
    sets = spark.createDataFrame([(np.flatnonzero(h).tolist(),) for h in has], "x array<long>").repartition(3)
    got = toxicity.covering(sets, share, clean, 300)
    assert len(expected) > 5 and got.tolist() == np.union1d(expected, common).tolist()
    assert toxicity.covering(sets.limit(0), share * 0, clean, 1).tolist() == []


def test_threshold_has_the_least_cost_of_all_cuts(spark):
    rng = np.random.default_rng(3)
    label = (rng.random(300) < 0.7).astype(int)
    score = np.round(rng.normal(label, 0.7), 1)
    label[:5] = 2
    cuts = np.unique(score)
    cost = [quality.GOOD_COST * ((score < c) & (label == 1)).sum() + ((score >= c) & (label != 1)).sum() for c in cuts]
    k = int(np.argmin(cost))
    assert k > 0
    seen = spark.createDataFrame(list(zip(score.tolist(), label.tolist())), "score double, label int")
    assert quality.best_threshold(seen) == (cuts[k - 1] + cuts[k]) / 2
    assert quality.best_threshold(seen.where("label = 1")) == quality.best_threshold(seen.where("label > 0")) == float("-inf")
    assert quality.best_threshold(seen.where("label = 0")) == quality.best_threshold(seen.limit(0)) == float("-inf")


def test_ordinal_fit_by_texts_cells_and_tasks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    has = rng.random((400, 5)) < 0.3
    grade = np.digitize(has @ np.array([1, 2, 3, 1, 2]) + rng.normal(0, 0.3, 400), [2, 4, 6])
    table = spark.createDataFrame([(i, np.flatnonzero(h).tolist(), int(g)) for i, (h, g) in enumerate(zip(has, grade))],
                                  "at long, x array<long>, grade int")
    centre = np.array([1.0, 2.0, 3.0, 1.0, 2.0])
    row, col = np.nonzero(has)
    expected = np.concatenate(toxicity.fit_ordinal(row, col, np.ones(len(col)), 5, grade, 12, centre))
    fits = [np.concatenate(toxicity.fit_texts(table, 5, centre, 12))]
    monkeypatch.setattr(toxicity, "DRIVER_ROWS", 0)
    fits.append(np.concatenate(toxicity.fit_texts(table, 5, centre, 12)))
    monkeypatch.setattr(toxicity, "DRIVER_ENTRIES", 0)
    fits.append(np.concatenate(toxicity.fit_texts(table, 5, centre, 12)))
    assert all(np.allclose(f, expected, atol=1e-9) for f in fits)


def test_presence_is_the_same_however_often_it_is_added_up(spark, many, monkeypatch):
    whole = many.limit(300).selectExpr("text", "toxic as _label").toPandas()
    batches = [pa.RecordBatch.from_arrays([pa.array(b["text"]), pa.array(b["_label"], pa.int32())], names=["text", "_label"])
               for b in (whole.iloc[i::7] for i in range(7))]
    whole = next(toxicity._presence(iter(batches)))
    monkeypatch.setattr(toxicity, "HELD", 100)
    assert next(toxicity._presence(iter(batches))).equals(whole)
    assert next(toxicity._presence(iter([]))).num_rows == 0


def test_texts_without_features_have_evidence_of_no_size():
    got = toxicity._against(np.empty(0, int), np.empty(0, int), np.zeros(3, int), np.zeros((5, 0)))
    assert got.dtype == float and got.tolist() == [0, 0, 0]
