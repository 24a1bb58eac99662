"""Encoding against the library on whole texts."""

import random

import numpy as np
import pytest

from tablelens.llm import bpe
from tablelens.llm.queries import tokenizer

PARTS = ["a", "b", "th", "'", "re", "'re", "s", " ", "\n", "\t", "1", "é", "É", "é", "İ", "Σ", "<|endoftext|>", "<|", "endof", "|>", "😀", "!!", ".", " ", "\x85", "\x1c", "X", "日本", "ǆ", "ll", "²", "_"]


def texts(seed, n, most=300, parts=PARTS):
    rng = random.Random(seed)
    for _ in range(n):
        weights = [rng.randint(1, 8) if rng.random() < 0.7 else 1 for _ in parts]
        yield "".join(rng.choices(parts, weights, k=rng.randint(0, most)))


def wanted(text, path):
    return bpe.load(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_tree_of_pieces(name):
    path = tokenizer(name)
    for i, text in enumerate(texts(1, 1500)):
        size = (37, 64, 100)[i % 3]
        parts = [bpe.encode(path, text, k, min(len(text), k + size)) for k in range(0, len(text), size)]
        if parts:
            assert bpe.tree(path, text, parts).ids.tolist() == wanted(text, path), repr(text)


def test_words():
    path = tokenizer("word_bpe_49k.json")
    for text in texts(2, 3000):
        ids = wanted(text, path)
        assert np.frombuffer(bpe.ids_of(path, text), "<u4").tolist() == ids, repr(text)
        assert bpe.decoded_bytes(path, bpe.ids_of(path, text)).decode() == bpe.decoded(path, bpe.ids_of(path, text))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_documents(spark, name):
    path = tokenizer(name)
    unsplit = [p for p in PARTS if not p.isspace()]
    rows = [(i, t) for i, t in enumerate([None, "", " ", *texts(3, 60, 2000), *texts(4, 60, 1500, unsplit), "ab" * 4000])]
    rows += [(3, rows[40][1]), rows[50], rows[50], (None, "x " * 700)]
    df = spark.createDataFrame([(a, b, "clash") for a, b in rows], "doc_id long, text string, ids string")
    found = sorted(((r.doc_id is None, r.doc_id, bytes(r.ids)) for r in bpe.encode_documents(df, path, piece=300).collect()), key=str)
    expected = sorted(((i is None, i, np.array(wanted(t or "", path), "<u4").tobytes()) for i, t in rows), key=str)
    assert found == expected
    back = {r.doc_id: r.text for r in bpe.decode_documents(bpe.encode_documents(df, path), path).collect()}
    assert back[7] == bpe.load(path).decode(wanted(rows[7][1], path), skip_special_tokens=False)
    empty = bpe.encode_decode(df.limit(0), path)
    assert empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and empty.count() == 0


MARKS = ["\u0301", "\u0323", "\u0316", "\u0345", "\u0338", "\u1161", "\u11a8"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_runs_of_marks(name):
    """Normalisation reaches over any number of marks, also across cuts."""
    path = tokenizer(name)
    rng = random.Random(11)
    for i in range(200):
        few = i % 2
        parts = ["e", "a", "\u1100", *(MARKS[: rng.randint(1, len(MARKS))])]
        weights = [9 if few and p in "ea" else rng.randint(1, 4) for p in parts]
        text = "".join(rng.choices(parts, weights, k=rng.randint(200, 900)))
        pieces = [bpe.encode(path, text, k, min(len(text), k + 64)) for k in range(0, len(text), 64)]
        assert bpe.tree(path, text, pieces).ids.tolist() == wanted(text, path), repr(text)


def test_marks_at_the_default_piece(spark):
    path = tokenizer("word_bpe_49k.json")
    rng = random.Random(12)
    rows = [(i, "".join(rng.choices(["e", "\u0301", "\u0323", "\u0316"], k=n))) for i, n in enumerate((33_000, 50_000, 66_000, 98_000))]
    found = {r.doc_id: bytes(r.ids) for r in bpe.encode_documents(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()}
    assert found == {i: np.array(wanted(t, path), "<u4").tobytes() for i, t in rows}
