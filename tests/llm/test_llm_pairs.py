"""The near-duplicate operators and the pipeline against brute force."""

import random

import numpy as np
import pytest

import corpus_pipeline
from newsfeat.llm import components, embedding_caps, hyperminhash
from newsfeat.llm.components import connected_components


def roots_of(n, links):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (1, 0), (200, 201)]
    out = dict(map(tuple, connected_components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert out == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_of_a_hot_node(spark):
    links = [(0, k) for k in range(1, 3000)] + [(5000 + k, 5001 + k) for k in range(60)] + [(2999, 9000), (9000, 9001)]
    out = dict(map(tuple, connected_components(spark.createDataFrame(links, "u long, v long").repartition(7)).collect()))
    assert out == {**{k: 0 for k in [*range(3000), 9000, 9001]}, **{k: 5000 for k in range(5000, 5061)}}


def test_components_keep_the_drivers_plans_small(spark, monkeypatch):
    """A plan holds one star at most, and links that are stars take no round."""
    plans, write = [], components.written

    def counted(df, name):
        plans.append(df._jdf.queryExecution().analyzed().toString().count("Aggregate ["))
        return write(df, name)

    monkeypatch.setattr(components, "written", counted)
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)]
    out = dict(map(tuple, connected_components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert out == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}}
    assert len(plans) > 3 and max(plans) <= 4

    plans.clear()
    stars = [(k % 7, k) for k in range(7, 300)] + [(3, 3), (10, 3), (10, 3)]
    out = dict(map(tuple, connected_components(spark.createDataFrame(stars, "u long, v long")).collect()))
    assert out == {k: k % 7 for k in range(300)}
    assert len(plans) == 1


def test_components_raise_only_when_the_rounds_do_not_suffice(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "u long, v long")
    with pytest.raises(RuntimeError, match="in 1 rounds"):
        connected_components(path, max_rounds=1)
    star = spark.createDataFrame([(1, 2), (1, 3)], "u long, v long")
    assert {tuple(r) for r in connected_components(star, max_rounds=0).collect()} == {(1, 1), (2, 1), (3, 1)}


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text, size):
    w = words_of(text)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


@pytest.fixture(scope="module")
def texts():
    """Copies, a large group of near copies with links below and above the
    threshold, a passage that many share, short and odd texts."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(60)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    out = [None, "", "  ", "one", "One", "two words", "ABC def ghi jkl", "abc DEF ghi jkl"]
    for _ in range(120):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append(" ".join(w))
    out += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.choice([4, 20]))) for _ in range(60)]
    return out + [" ".join(rng.choice(vocabulary) for _ in range(5)) for _ in range(40)] + ["long " * 50_000] * 2


@pytest.mark.parametrize("size,piece", [(4, 256), (5, 16)])
def test_near_duplicates_equal_brute_force(spark, texts, monkeypatch, size, piece):
    monkeypatch.setattr(hyperminhash, "SKETCH_PIECE", piece)
    monkeypatch.setattr(hyperminhash, "SET_PIECE", piece)
    sets = [shingles(t, size) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, doc string, band int")
    out = hyperminhash.near_duplicates(docs, words=size).toPandas().sort_values("doc_id")
    assert out["component_id"].tolist() == roots_of(len(texts), links)
    assert out["n_shingles"].tolist() == [len(s) for s in sets]
    assert (out["kept"] == (out["doc_id"] == out["component_id"])).all()


def test_near_duplicates_of_odd_rows(spark):
    rows = [(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, None), (3, "a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(map(tuple, hyperminhash.near_duplicates(docs, words=4).collect()), key=str)
    assert out == sorted([(None, 2, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (3, 2, 1, False)], key=str)
    assert hyperminhash.deduplicated(docs, 4).columns == docs.columns and hyperminhash.deduplicated(docs, 4).count() == 4
    assert hyperminhash.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_of_ids_with_several_texts(spark, monkeypatch):
    """Against brute force over documents that hold several texts."""
    monkeypatch.setattr(hyperminhash, "SKETCH_PIECE", 8)
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    one, two = ([rng.choice(vocabulary) for _ in range(50)] for _ in range(2))

    def near(base):
        w = list(base)
        w[rng.randrange(len(w))] = rng.choice(vocabulary)
        return " ".join(w)

    rows = [(i, near(one)) for i in range(30)] + [(i, None) for i in range(30)] + [(i, "") for i in range(0, 30, 3)]
    rows += [(40 + i, near(two)) for i in range(20)] + [(5, None), (5, " ")]
    rows += [(100, " ".join(rng.choice(vocabulary) for _ in range(30))), (100, None), (101, None), (101, ""), (102, "  ")]
    rows += [(0, " ".join(one)), (0, " ".join(two)), (41, "short text"), (200, "short text"), (None, near(one)), (41, near(two))]
    rows += [(300, t) for t in ("a b c d e f", "g h i j k l")] + [(301, "a b c d e f"), (302, "g h i j k l")]
    rng.shuffle(rows)
    ids = sorted({i for i, _ in rows if i is not None})
    sets = {i: [x for d, t in rows if d == i and (x := shingles(t, 4))] for i in ids}
    links = [(p, q) for p in range(len(ids)) for q in range(p) if any(
        100 * len(x & y) >= 80 * len(x | y) for x in sets[ids[p]] for y in sets[ids[q]])]
    expected = {i: ids[r] for i, r in zip(ids, roots_of(len(ids), links))}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = hyperminhash.near_duplicates(docs, words=4).collect()
    assert len(out) == len(rows) and {r["doc_id"]: r["component_id"] for r in out if r["doc_id"] is not None} == expected
    assert all(r["kept"] == (r["doc_id"] is None or r["component_id"] == r["doc_id"]) for r in out)
    assert sorted((str(r["doc_id"]), r["n_shingles"]) for r in out) == sorted((str(i), len(shingles(t, 4))) for i, t in rows)
    kept = hyperminhash.deduplicated(docs, 4).select("doc_id").distinct().collect()
    assert {r[0] for r in kept} == {i for i in ids if expected[i] == i} | {None}


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    for n in (40, 500, 20_000):
        x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: int(n * 0.9)], rng.integers(0, 2**64, n // 10, dtype=np.uint64)]))
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        equal = np.array([(hyperminhash.registers(x) == hyperminhash.registers(y)).sum()])
        got = hyperminhash.estimate(equal, np.array([len(x)]), np.array([len(y)]))[0]
        assert abs(got - true) < 5 * np.sqrt(0.2 / min(n, hyperminhash.BUCKETS))


@pytest.mark.parametrize("piece", [512, 8])
def test_near_vectors_equal_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(embedding_caps, "PIECE", piece)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((260, 24))
    x[40:120] = x[3] + 0.2 * rng.standard_normal((80, 24))
    x[120:140] = x[5]
    x[140:160] = 3 * x[5]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.95
    np.fill_diagonal(hit, False)
    rows = [(i, [float(c) for c in v], "x") for i, v in enumerate(x)]
    odd = [(900, None, "x"), (901, [], "x"), (902, [0.0] * 24, "x"), (903, [1.0, None] * 12, "x"),
           (904, [float("nan")] * 24, "x"), (905, [1.0], "x"), (None, [1.0] * 24, "x")]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, links string")
    out = embedding_caps.near_vectors(vectors).toPandas().sort_values("vec_id")
    mine = out[out["vec_id"] < 900]
    assert mine["n_links"].tolist() == hit.sum(axis=1).tolist()
    assert mine["component_id"].tolist() == roots_of(260, zip(*np.nonzero(hit)))
    rest = out[~(out["vec_id"] < 900)]
    assert len(rest) == len(odd) and (rest["n_links"] == 0).all() and rest["kept"].all()
    assert embedding_caps.near_vectors(vectors.limit(0)).count() == 0


def test_links_at_exactly_the_threshold_are_found():
    rng = np.random.default_rng(7)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((1500, 64))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    shared = np.zeros(1500, bool)
    for k in range(embedding_caps.CODES):
        code = embedding_caps.ProductCode(64, 112, k)
        a, b = ({*zip(r.tolist(), c.tolist())} for r, c in (code.decode(x), code.decode(y)))
        shared[[r for r, _ in a & b]] = True
    assert shared.mean() > 0.999


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_dedup", "pii", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.schema.simpleString() == docs.schema.simpleString()
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert 0 < docs.count() <= rows
        rows = docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").select("doc_id").distinct().count() == rows
