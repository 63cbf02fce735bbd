"""Mixing, ranked search and vector codes on odd rows and against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsfeat.llm import lexical_search, mixing, vector_codes

# ------------------------------------------------------------------- mixing

MIX = "doc_id long, text string, source string, size string, key int, rest int"


def mix_rows():
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["word", "a1", "#", "dé", "x" * 30]) for _ in range(n))
    rows = [(i, text(rng.randint(0, 40)), rng.choice(["a", "a", "a", "b", "C", "é", None])) for i in range(400)]
    rows += [(1000, text(20_000), "a"), (1001, text(5_000), "tiny"), (None, text(9), "b"), (None, None, "b"), (7, text(3), "b")]
    rows += [(2000, "one two three four five six seven", "copies")] * 40 + [(3000, None, "none"), (3001, " \n", "none")]
    return [(*r, "x", 1, 1) for r in rows]


def poured(sizes, weights, share, most):
    """Targets by resharing what is over, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not over:
            return full | {s: level * weight[s] for s in open_}
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]


@pytest.mark.parametrize("weights,share", [((5, 2, 1), 1.5), ((1, 1), 0.3), ((1, 40, 3), 1.99)])
def test_mix_meets_its_targets(spark, weights, share):
    rows = mix_rows()
    docs = spark.createDataFrame(rows, MIX).repartition(5)
    out = mixing.mixed(docs, weights, share).toPandas()
    size = lambda t: len(re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()))
    assert sorted(out["size"]) == sorted(size(r[1]) for r in rows) and len(out) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + size(r[1])
    goal = poured(sizes, weights, share, 2)
    assert ((out["taken"] >= 0) & (out["taken"] <= 2 * out["size"])).all()
    for source, own in out.groupby("source", dropna=False):
        source = None if source != source else source
        assert (own["source_size"] == sizes[source]).all() and np.allclose(own["target"], goal[source])
        slack = 40 if source == "copies" else 1  # equal rows at the cut share its words evenly
        assert abs(own["taken"].sum() - goal[source]) <= slack
        passes = (own["taken"] // own["size"])[own["size"] > 0].tolist() or [0]
        assert max(passes) - min(passes) <= 1  # whole passes come first
    again = mixing.mixed(docs.repartition(3), weights, share).toPandas()
    order = ["doc_id", "size", "taken", "source"]
    assert out.sort_values(order)[order].reset_index(drop=True).equals(again.sort_values(order)[order].reset_index(drop=True))


def test_mix_draws_by_quality(spark):
    good, bad = "plain words of prose " * 3, "1 # 2 % 3 & 4 | 5 * 6 $"
    rows = [(i, good if i % 2 else bad, "s", "", 0, 0) for i in range(3000)]
    out = mixing.mixed(spark.createDataFrame(rows, MIX), (1,), 0.3).toPandas()
    taken = out[out["taken"] > 0].groupby(out["doc_id"] % 2).size()
    assert taken[1] > 3 * taken[0]


def test_mixed_texts_are_the_words_taken(spark):
    docs = spark.createDataFrame(mix_rows(), MIX)
    texts = mixing.drawn_texts(docs).withColumn("n", F.expr(r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')"))
    took = {(r[0], r[1]): r[2] for r in texts.groupBy("doc_id", "source").agg(F.sum("n")).collect()}
    mix = mixing.mixed(docs).groupBy("doc_id", "source").agg(F.sum("taken").alias("taken")).where("taken > 0")
    assert took == {(r["doc_id"], r["source"]): r["taken"] for r in mix.collect()}


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], MIX)
    assert mixing.mixed(empty).count() == 0 and mixing.drawn_texts(empty).count() == 0
    wordless = spark.createDataFrame([(1, None, None, "", 0, 0), (2, "", "a", "", 0, 0)], MIX)
    assert [tuple(r)[1:5] for r in mixing.mixed(wordless).collect()] == [(0, 0, 0.0, 0)] * 2


# ------------------------------------------------------------------- search

def ranked_by_hand(docs, items, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                                 (t or "").translate({c: c + 32 for c in range(65, 91)}))
    held = [(d, terms(t)) for d, t in docs]
    held = [(d, t) for d, t in held if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for d, t in held:
            m = 25 + 75 * len(t) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * t.count(x) // (1000 * t.count(x) + 8 * m))
                    for x in terms(text) if x in df)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("docs_a_piece,postings,visits", [(4096, 1 << 18, 8), (3, 1 << 18, 1), (4096, 5, 1)])
def test_search_equals_brute_force(spark, monkeypatch, docs_a_piece, postings, visits):
    monkeypatch.setattr(lexical_search, "PIECE_DOCS", docs_a_piece)
    monkeypatch.setattr(lexical_search, "PIECE_POSTINGS", postings)
    monkeypatch.setattr(lexical_search, "FIRST_VISITS", visits)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)] + ["The", "the", "THE", "É", "é", "x-y", "a_b", "梦想", "9"]
    text = lambda n: " ".join(rng.choice(words[:rng.choice([4, 20, 69])]) for _ in range(n))
    docs = [(i, text(rng.choice([1, 5, 5, 30]))) for i in range(300)]
    docs += [(1000 + i, "same the text w1 w2") for i in range(40)] + [(5, "w1 w1 w1 w2"), (None, "w1 w2"), (None, "w1 w2"),
                                                                   (2000, None), (2001, ""), (2002, "-- !"), (2003, "w3 " * 30_000)]
    rng.shuffle(docs)
    items = [(i, text(rng.choice([1, 4, 12]))) for i in range(25)] + [(7, "w1 w1 w2"), (None, "the w5"), (90, None), (91, "!"),
                                                                     (92, "nowhere"), (93, "same same text")]
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, m string, item long").repartition(4)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc int")
    got = sorted(map(tuple, lexical_search.ranked(table, asked).collect()), key=str)
    assert got == ranked_by_hand(docs, items, 10)


def test_search_in_blocks_and_of_nothing(spark, monkeypatch):
    docs = [(i, f"w{i % 7} w{i % 5} w{i % 3} z") for i in range(100)]
    items = [(i, f"w{i} w{i + 1}") for i in range(6)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 4)
    assert sorted(map(tuple, lexical_search.ranked(table, asked, k=3).collect()), key=str) == ranked_by_hand(docs, items, 3)
    assert lexical_search.ranked(table.limit(0), asked).count() == 0
    assert lexical_search.ranked(table, asked.limit(0)).count() == 0
    assert lexical_search.ranked(table.limit(0), asked).columns == ["item_id", "rank", "doc_id", "score"]


def test_search_leaves_strata_out():
    import pyarrow as pa

    one = lambda m, docs, tf: pa.RecordBatch.from_arrays(
        [pa.array([m]), pa.array([docs]), pa.array([[0]], pa.list_(pa.int32())), pa.array([[tf]], pa.list_(pa.int32())),
         pa.array([[len(docs)]], pa.list_(pa.int32())), pa.array([list(range(len(docs)))], pa.list_(pa.int32()))],
        names=["m", "docs", "term", "tf", "size", "places"])
    rows = pa.Table.from_batches([one(25 + i, [100 * i + j for j in range(12)], 1) for i in range(200)]).combine_chunks()
    strata = lexical_search._Strata(rows.to_batches()[0], np.array([700]))
    best = lexical_search._Best(10)
    assert strata.search(np.array([0]), np.array([1]), best) == lexical_search.FIRST_VISITS
    assert best.id.tolist() == list(range(10))


# ------------------------------------------------------------- vector codes

def coded_by_hand(rows, parts, entries, rounds, scale):
    """Full scans with Python's whole numbers; rows of ``(id, vector, label)``."""
    usable = [(i, v, x) for i, v, x in rows
              if v and all(c is not None and math.isfinite(c) and abs(math.floor(scale * c)) < 2**27 for c in v)]
    usable = [(i, [math.floor(scale * float(np.float32(c))) for c in v], x) for i, v, x in usable]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], np.int32).tobytes()))
    if not usable:
        return []
    dim = len(usable[0][1])
    usable = [r for r in usable if len(r[1]) == dim]
    edges = [p * dim // parts for p in range(parts + 1)]
    cut = lambda v: [v[a:b] for a, b in zip(edges, edges[1:])]
    books = [[cut(v)[p] for _, v, _ in usable[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            at = [(near(cut(v)[p], books[p])[1], cut(v)[p]) for _, v, _ in usable]
            for e in range(len(books[p])):
                own = [x for a, x in at if a == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = []
    for i, v, x in usable:
        found = [near(y, books[p]) for p, y in enumerate(cut(v))]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), x))
    by = {}
    for _, _, d, x in out:
        by[x] = by.get(x, 0) + d
    return sorted(((i, c, d, by[x], digest, x) for i, c, d, x in out), key=str)


@pytest.mark.parametrize("parts,entries,rounds", [(8, 16, 6), (3, 5, 4), (8, 16, 0), (2, 256, 2)])
def test_vector_codes_equal_full_scans(spark, parts, entries, rounds):
    rng = np.random.default_rng(8)
    coarse = lambda n: [float(np.float32(c)) for c in rng.integers(-3, 4, n) / 4096]  # noqa: E731  many equal distances
    rows = [(i, coarse(16) if i % 2 else [float(np.float32(c)) for c in rng.normal(size=16)], int(i % 4)) for i in range(120)]
    rows += [(500, None, 1), (501, [], 1), (502, [None] + [0.0] * 15, 1), (503, [math.nan] * 16, 1), (504, [math.inf] * 16, 2),
             (505, [1e30] * 16, 2), (506, [1.0] * 12, 2), (None, coarse(16), None), (None, coarse(16), None),
             (3, coarse(16), 3), (3, rows[3][1], 3), (600, [20_000.0, -20_000.0] * 8, 0)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, vector int")
    got = vector_codes.compressed(table.repartition(4), parts, entries, rounds)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256", "label"]
    assert sorted(map(tuple, got.collect()), key=str) == coded_by_hand(rows, parts, entries, rounds, 4096)


def test_vector_codes_of_few_and_none(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert vector_codes.compressed(spark.createDataFrame([], kind)).count() == 0
    assert vector_codes.compressed(spark.createDataFrame([(1, None, 1), (2, [math.nan], 1)], kind)).count() == 0
    rows = [(1, [0.5, 0.25, 1.0], 1), (1, [0.5, 0.25, 1.0], 1)]  # fewer components than parts, fewer vectors than entries
    got = vector_codes.compressed(spark.createDataFrame(rows, kind)).collect()
    assert sorted(map(tuple, got)) == coded_by_hand(rows, 8, 16, 6, 4096)


def test_fixed_entries_are_compared_with_moved_ones_only():
    rng = np.random.default_rng(2)
    for _ in range(200):
        x, old = rng.integers(-4, 5, (50, 3)), rng.integers(-4, 5, (6, 3))
        new = np.where(rng.random((6, 1)) < 0.4, rng.integers(-4, 5, (6, 3)), old)
        code, distance = vector_codes.scanned(x, old)
        again = vector_codes.rescanned(x, new, (new != old).any(axis=1), code, distance)
        assert all((a == b).all() for a, b in zip(again, vector_codes.scanned(x, new)))
