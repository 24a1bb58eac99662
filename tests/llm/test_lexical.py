"""Scanned search against a plain ranking."""

import random

import brute
import pytest

from tablelens.llm import lexical

WORDS = ["the", "The", "a", "Ab", "ab", "abc", "é", "É", "日本", "x1", "1", "😀", "an", "banana", "ana"]
GAPS = [" ", "  ", "\n", "-", "_", ".", "\x00", "\t", "'", "\x7f", "/"]


def text(rng, most):
    return "".join(rng.choice(WORDS) + rng.choice(GAPS) for _ in range(rng.randint(0, most)))


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (str(r.item_id), r["rank"])):
        rows = out.setdefault(r.item_id, [])
        assert r["rank"] == len(rows) + 1
        rows.append((r.doc_id, r.score))
    return out


def cases():
    rng = random.Random(5)
    rows = [(i, text(rng, 40)) for i in range(150)] + [(200, None), (201, ""), (202, "..-"), (None, "the abc"), (7, "ab " * 30_000)]
    rows += [(3, "banana ab"), (3, "banana ab"), (1, "banana ab")]  # repeated rows and ties
    items = [(k, text(rng, 6)) for k in range(12)] + [(50, None), (51, "--"), (52, "unheard of"), (None, "banana"), (4, "é more of item 4"), (4, "é more of item 4")]
    return rows, items


@pytest.mark.parametrize("limit", [50, 3])
def test_search(spark, limit):
    rows, items = cases()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, item_id string, score int").repartition(5)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    wanted = {k: v for k, v in brute.ranked(rows, items, limit).items() if v}
    result = lexical.search(docs, asked, limit)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    assert dict(result.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert found(result) == wanted


def test_blocks_of_items(spark, monkeypatch):
    """Many blocks, one term list larger than a block, and score matrices of a few rows give the same ranks."""
    rows, items = cases()
    items += [(99, " ".join(f"w{k}" for k in range(400)) + " ab é")]
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 300)
    monkeypatch.setattr(lexical, "CELLS", 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert lexical.item_blocks(asked, "item_id", "text")[1] > 2
    assert found(lexical.search(docs, asked, 5)) == {k: v for k, v in brute.ranked(rows, items, 5).items() if v}


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    asked = spark.createDataFrame([("q", "a"), ("r", "c")], "item_id string, text string")
    assert lexical.search(docs.limit(0), asked).collect() == []
    assert lexical.search(docs, asked.limit(0)).collect() == []
    assert [(r.item_id, r.doc_id) for r in lexical.search(docs, asked).collect()] == [("q", 1)]


def test_terms_agree(spark):
    """The expression, the folded bytes and the pattern cut alike."""
    rng = random.Random(6)
    sample = [text(rng, 30) for _ in range(200)] + ["", "é", "aÀb", "A-Z@[`{0:9/"]
    df = spark.createDataFrame([(t,) for t in sample], "text string")
    for r in df.select("text", lexical.terms_of("text").alias("terms")).collect():
        assert r.terms == brute.search_terms(r.text)
        assert lexical.term_count(lexical.folded(r.text)) == len(r.terms)
