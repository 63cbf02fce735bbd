"""Op6 on texts of any kind and on kept leaves, against encoding anew."""

import random

import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from newsfeat.llm import edit_counts, packing

CODE = "def f(x):\n\tif x>0:\n\t\treturn[x*2,'it''s',x]#end\n\n"
CHINESE = "今天天气很好，我们去公园散步。他说：“明天会下雨！”"


@pytest.fixture(scope="module")
def tools():
    return packing.codec(packing.default_ranks()), regex.compile(public_tokenizers.PATTERN)


@pytest.mark.parametrize("leaf", [4, 16, 256])
def test_edits_near_the_special_token_and_in_any_script(monkeypatch, tools, leaf):
    monkeypatch.setattr(edit_counts, "LEAF", leaf)
    rng = random.Random(leaf)
    signs = ["a", "the", " ", "   ", "\n", "\n\n", "'", "'s", "é", "梦，", "。", "1", ".", " ", "😀", "\x1c", "\x85",
             packing.SPECIAL, "<|endof", "text|>", "<|", "|>", CHINESE, CODE]
    text_of = lambda n: "".join(rng.choice(signs) for _ in range(n))
    for _ in range(200):
        text = text_of(rng.randint(0, 60))
        counted = edit_counts.CountedText(text, *tools)
        assert counted.tokens == len(tools[0].ids(text))
        for _ in range(8):
            start, n, insert = rng.randint(0, len(text) + 2), rng.choice([0, 0, 1, 2, 5, 40]), text_of(rng.choice([0, 1, 3, 12]))
            counted.edit(start, n, insert)
            start = min(start, len(text))
            text = text[:start] + insert + text[min(len(text), start + n):]
            assert counted.text == text and counted.tokens == len(tools[0].ids(text))


@pytest.mark.parametrize("unit", [CHINESE, CODE, "a\n", "x,", "word "])
def test_edits_of_a_text_without_spaces_encode_little(tools, unit):
    text = unit * (100_000 // len(unit))
    counted = edit_counts.CountedText(text, *tools)
    before, rng = counted.encoded, random.Random(2)
    for _ in range(20):
        counted.edit(rng.randint(0, len(text)), 3, "字b ")
    assert counted.tokens == len(tools[0].ids(counted.text))
    assert counted.encoded - before < 0.02 * 20 * 100_000 and counted.encoded - before < 20 * 6 * edit_counts.LEAF


def test_growing_text_keeps_its_counts(tools):
    counted = edit_counts.CountedText(CHINESE * 40, *tools)
    rng = random.Random(4)
    for _ in range(300):
        counted.edit(rng.randint(0, len(counted)), 0, rng.choice([CODE, CHINESE, "word "]) * 20)
    assert counted.tokens == len(tools[0].ids(counted.text))
    assert max(map(len, counted.leaf)) < 12 * edit_counts.LEAF


def test_kept_leaves_follow_a_table_of_edits(spark, tools):
    long = CHINESE * 300 + CODE * 300
    rows = [(1, "one two three"), (1, "one two three"), (1, "other text"), (2, long), (3, None), (4, ""), (None, "no id"),
            (5, "not edited")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("leaf", F.lit("clash")).withColumn("doc", F.lit(1))
    edits = [(1, 2, 0, 3, "ONE"), (1, 1, 4, 0, "and "), (2, 1, 5000, 10, "x"), (2, 2, 20, 0, packing.SPECIAL), (3, 1, 0, 0, "new"),
             (4, 1, 9, 9, None), (9, 1, 0, 0, "no such"), (None, 1, 0, 9, "none")]
    todo = spark.createDataFrame(edits, "doc_id long, seq int, start int, length int, insert string")
    kept = edit_counts.leaf_table(docs)
    assert kept.where("doc_id = 2").count() > 20
    after = edit_counts.edited_leaves(kept, todo)

    def texts(table):
        out = {}
        for r in sorted(table.collect(), key=lambda r: r["leaf"]):
            out[r["doc_id"], r["version"]] = out.get((r["doc_id"], r["version"]), "") + r["text"]
        return out

    def by_hand(doc, text):
        for _, _, start, length, insert in sorted((e for e in edits if e[0] == doc and doc is not None), key=lambda e: e[1]):
            start = min(start, len(text))
            text = text[:start] + (insert or "") + text[min(len(text), start + length):]
        return text

    assert sorted(map(str, texts(after).items())) == sorted(str((k, by_hand(k[0], t))) for k, t in texts(kept).items())
    whole = texts(after)
    for r in edit_counts.leaf_counts(after).collect():
        text = whole[r["doc_id"], r["version"]]
        assert r["n_tokens"] == len(tools[0].ids(text)) and r["n_chars"] == len(text)
    assert len(whole) == 7  # equal rows are one document
    # further edits go on from the kept leaves
    again = edit_counts.edited_leaves(after, todo.where("doc_id = 2"))
    text = next(t for k, t in texts(again).items() if k[0] == 2)
    assert text == by_hand(2, by_hand(2, long))
    assert edit_counts.leaf_table(docs.limit(0)).count() == 0
    assert edit_counts.edited_leaves(kept, todo.limit(0)).count() == kept.count()
