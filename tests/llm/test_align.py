"""Alignment of two tokenizers against whole texts given to the libraries."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tablelens.llm import align
from tablelens.llm.queries import tokenizer

A, B = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
PARTS = [
    "the ", "Word", " ", "  ", "\n", "\n\n", "\t", "\r", ";\r", "}\r\n", "'s", "'", "é", "é", "x́", "日本", "ひら", "😀", "\x00", "\x1c", "\x85", " ", " ", "​", "1", "23", "-",
    "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", "ing", "ﬁ", "ab", ".",
]


def text(rng, most):
    weights = [rng.choice((0, 1, 1, 5)) for _ in PARTS]
    return "".join(rng.choices(PARTS, weights, k=rng.randint(0, most))) if any(weights) else ""


def brute_groups(t):
    """[(ids of A, ids of B)] of a whole text, or none."""
    if not t:
        return []
    a_tok, a_bytes = align.byte_level(A)
    b_tok, b_bytes = align.pieces(B)
    a, b = a_tok.encode(" " + t, add_special_tokens=False).ids, b_tok.encode(t)
    data = (" " + t).encode()
    if b"".join(a_bytes[i] for i in a) != data or b"".join(b_bytes[i] for i in b) != data:
        return []
    out, i, j, x, y = [], 0, 0, 0, 0
    ga, gb = [], []
    while i < len(a) or j < len(b):
        if x <= y and i < len(a):
            ga.append(a[i])
            x += len(a_bytes[a[i]])
            i += 1
        else:
            gb.append(b[j])
            y += len(b_bytes[b[j]])
            j += 1
        if x == y and ga and gb:
            out.append((ga, gb))
            ga, gb = [], []
    return out


def brute(rows):
    groups = [(i, brute_groups(t)) for i, t in rows]
    links = [Counter((a, b) for ga, gb in g for a in ga for b in gb) for _, g in groups]
    counts = Counter(k for x in links for k in x)
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for (i, g), x in zip(groups, links, strict=True):
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((
            i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(x.values()),
            sum(n for k, n in x.items() if counts[k] == most[k[0]]), sum(n * counts[k] for k, n in x.items()), hashlib.sha256(written.encode()).hexdigest() if g else "",
        ))
    return sorted(out, key=repr), counts


def rows():
    rng = random.Random(8)
    found = [(i, text(rng, 40)) for i in range(150)] + [(200, None), (201, ""), (202, " "), (203, "\n"), (204, "a ▁ b"), (205, "  x  ")]
    return found + [(3, found[3][1]), (3, "other"), (None, "the the"), (300, "".join(rng.choice("abcdefgh日é") for _ in range(30_000))), (301, "the word " * 9000)]


def test_texts():
    """Every text is cut into segments without a change of any group."""
    assert align.splits(A, B)
    rng, aligner = random.Random(9), align.Aligner(A, B)
    seen = 0
    sample = [text(rng, 30) for _ in range(1500)] + [None, "", "x" * 900, "word " * 400]
    for t, found in zip(sample, aligner.documents(sample), strict=True):
        groups = ";".join(p.text for p in found.parts)
        assert groups == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in brute_groups(t)), repr(t)
        seen += len(found.parts) > 1
    assert seen > 500


def test_held_segments(monkeypatch):
    """Few held segments and texts cut one at a time change nothing; short and long forms agree."""
    rng = random.Random(10)
    sample = [text(rng, 30) for _ in range(200)]
    wanted = [d.parts for d in align.Aligner(A, B).documents(sample)]
    monkeypatch.setattr(align, "HELD", 5)
    monkeypatch.setattr(align, "TOGETHER", 1)
    assert [d.parts for d in align.Aligner(A, B).documents(sample)] == wanted
    monkeypatch.setattr(align, "SHORT", 0)
    for x, y in zip(align.Aligner(A, B).documents(sample), wanted, strict=True):
        assert [p[:5] for p in x.parts] == [p[:5] for p in y]
        (k, n), (m, t) = x.pairs(), align.Document(y).pairs()
        assert k.tolist() == m.tolist() and n.tolist() == t.tolist()


def test_ranks_are_the_tokenizer():
    """Ranks of byte strings encode as the library does: random letters, syllables, bytes, and the given texts."""
    import duckdb

    rng = random.Random(13)
    tokenizer_a = align.byte_level(A)[0]
    sample = [" " + "".join(rng.choices(alphabet, k=rng.randint(1, 12))) for alphabet in ("abcdefghijklmnopqrstuvwxyz", "aeinrst", "ab", "éüßaeñ日本ひ", "0123456789.,-", "aA'st ") for _ in range(4000)]
    sample += [" " + (r[0] or "") for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    wanted = [x.ids for x in tokenizer_a.encode_batch_fast(sample, add_special_tokens=False)]
    assert [align.ranks(A).encode_ordinary(t) for t in sample] == wanted


@pytest.mark.parametrize("frequent", [align.FREQUENT, 40, 0.5])
def test_alignment(spark, monkeypatch, frequent):
    """With all, some and no pairs broadcast; a task gathers few pairs at once."""
    monkeypatch.setattr(align, "FREQUENT", frequent)
    monkeypatch.setattr(align, "GATHER", 500)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows()], "doc_id long, text string, keys string, n_a int").repartition(4)
    wanted, counts = brute(rows())
    found = align.alignment(docs, A, B)
    assert found.columns == ["doc_id", *align.NUMBERS, "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == wanted
    if frequent == align.FREQUENT:
        pairs = align.linked_pairs(align.pair_counts(align.texts(docs), A, B)).collect()
        assert len(pairs) == len(counts) and {(r.a, r.b): r.documents for r in pairs} == counts


def test_texts_are_aligned_once(spark, tmp_path):
    """The answers are looked up from what the only alignment wrote, not from the texts."""
    spark.createDataFrame(rows(), "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    found = align.alignment(spark.read.parquet(str(tmp_path / "docs")), A, B)
    assert str(tmp_path) not in found._jdf.queryExecution().toString()
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows())[0]


@pytest.mark.parametrize("sizes", [(50_000, 32_000), (1 << 17, 1 << 16)])
def test_packed_pairs(sizes):
    """Pairs of vocabularies of any size, links of any number, documents without pairs."""
    kind = align.pair_type(*sizes)
    last = ((sizes[0] - 1) << 32) | (sizes[1] - 1)
    docs = [([0, 5, last], [1, 255, 2]), ([], []), ([1 << 32], [1 << 40]), ([last], [256])]
    made = [align.packed_pairs(np.array(k, np.int64), np.array(n, np.int64), sizes[1], kind) for k, n in docs]
    keys, times, ends = align.unpacked_pairs(*map(list, zip(*made, strict=True)), sizes[1], kind)
    assert keys.tolist() == [x for k, _ in docs for x in k] and times.tolist() == [x for _, n in docs for x in n] and ends.tolist() == [3, 3, 4, 5]


def test_groups_and_empty(spark):
    docs = spark.createDataFrame([(1, "ab cd"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in align.token_groups(docs, A, B).collect()}
    assert found == {1: brute_groups("ab cd"), 2: []}
    assert align.alignment(docs.limit(0), A, B).collect() == []
    assert [r.n_a for r in align.alignment(docs.filter("text is null"), A, B).collect()] == [0]


def test_large_group():
    """A group whose product is larger than what is expanded at once."""
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 900, 3000), rng.integers(0, 700, 2000)
    group_a, group_b = np.sort(rng.integers(0, 2, 3000)), np.sort(rng.integers(0, 2, 2000))
    keys, times = align.links(a, b, group_a, group_b, 2)
    wanted = Counter()
    for g in (0, 1):
        x, y = Counter(a[group_a == g].tolist()), Counter(b[group_b == g].tolist())
        wanted.update({(k << 32) | m: n * o for k, n in x.items() for m, o in y.items()})
    assert dict(zip(keys.tolist(), times.tolist(), strict=True)) == wanted


def test_minimal_perfect_hash():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 48, n))
        table = align.Table.of(keys, keys * 3)
        at = table.mph.numbers(keys)
        assert sorted(at.tolist()) == list(range(len(keys)))
        again = align.Mph.unpacked(table.mph.packed())
        assert (again.numbers(keys) == at).all()
        assert (table.counts[table.find(keys)] == keys * 3).all()
        assert (table.find(np.setdiff1d(rng.integers(0, 1 << 48, 1000), keys)) == -1).all()
