"""Exact duplicates, similar classes and repeated passages against brute force."""

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from brute import components, exact, kept, sha, words
from pyspark.sql import functions as F

from tablelens.llm import common, exact_dedup, jaccard, substrings
from tablelens.llm.components import components as spark_components
from tablelens.plans.runtime import staged

SHAPE = "doc_id long, text string, digest string, row int, node string, group_size int"


def frame(spark, rows):
    """Columns with clashing names, cut into several partitions."""
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SHAPE).repartition(5)


def corpus(seed, n=120):
    """Copies, near copies, shared passages, spacing variants, short, empty, null and long texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["É", "ß日本", "\x1c", "A", "a"]
    passage = " ".join(rng.choices(vocabulary, k=30))
    base = rng.choices(vocabulary, k=150)
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "One"), (5, "a b c"), (6, " ".join(base)), (7, " ".join(rng.choices(vocabulary, k=9000)))]
    for i in range(8, n):
        kind = rng.randrange(6)
        if kind == 0:
            text = rng.choice(rows)[1]
        elif kind == 1:
            near = list(base)
            for _ in range(rng.randint(1, 8)):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            text = " ".join(near)
        elif kind == 2:
            text = " ".join([*rng.choices(vocabulary, k=rng.randint(0, 40)), passage, *rng.choices(vocabulary, k=rng.randint(0, 40))])
        elif kind == 3:
            text = (rng.choice(rows)[1] or "").replace(" ", rng.choice(["  ", "\t", "\r\n "]))
        else:
            text = " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))
        rows.append((i, text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("counters", [2, 1024])
def test_exact(spark, counters):
    rows = corpus(1)
    found = exact_dedup.exact_duplicates(frame(spark, rows), counters=counters).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found} == exact(rows)
    stays = exact_dedup.without_duplicates(frame(spark, rows), counters=counters)
    assert stays.columns == [c.split()[0] for c in SHAPE.split(", ")]
    assert sorted(r.doc_id for r in stays.collect()) == sorted(i for i, x in exact(rows).items() if x[2])


def test_exact_ties_and_repeats(spark):
    rows = [(5, "a b"), (5, "a b"), (3, "ab"), (None, "a b"), (2, "a  b"), (2, "a  b"), (None, None), (9, "")]
    found = exact_dedup.exact_duplicates(frame(spark, rows)).collect()
    group = [r for r in found if r.text_sha256 == sha("ab")]
    assert {r.keep_id for r in group} == {2} and sum(r.kept for r in group) == 1 and {r.group_size for r in group} == {6}
    assert [(r.doc_id, r.kept) for r in found if r.text_sha256 == sha("") and r.doc_id] == [(9, True)]
    assert sorted((r.doc_id, r.text) for r in exact_dedup.without_duplicates(frame(spark, rows)).collect()) == [(2, "a  b"), (9, "")]
    assert exact_dedup.exact_duplicates(frame(spark, []).limit(0)).count() == 0


def test_frequent_values(spark):
    rng = random.Random(3)
    values = ["hot"] * 300 + ["warm"] * 120 + [f"v{k}" for k in range(500)]
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(7)
    found = {r.v for r in exact_dedup.frequent(df, "v", counters=20).collect()}
    assert {"hot", "warm"} <= found and len(found) <= 20
    counts = exact_dedup.reduced(Counter(values), 5)
    assert len(counts) <= 5 and counts["hot"] >= 300 - len(values) / 5


def test_jaccard(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", 8)  # several parts and copies of a group
    monkeypatch.setattr(jaccard, "QUERIES", 4)
    rows = corpus(2, 150)
    found = jaccard.similar_classes(frame(spark, rows), width=3, percent=70).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components(rows, 3, 70)


@pytest.mark.parametrize("percent", [55, 85])
def test_jaccard_of_frequent_shingles(spark, monkeypatch, percent):
    """Texts of few templates, some linked and some just not, with nearly every shingle in many of them."""
    monkeypatch.setattr(jaccard, "GROUP", 5)
    monkeypatch.setattr(jaccard, "QUERIES", 3)
    monkeypatch.setattr(jaccard, "HOT", 2)
    monkeypatch.setattr(jaccard, "EXACT_SIZES", 8)
    rng = random.Random(percent)
    rows = []
    for i in range(160):
        base = [f"t{rng.randint(0, 2)}w{k}" for k in range(1)] + [f"w{k}" for k in range(rng.choice((6, 9, 20, 40)))]
        for _ in range(rng.randint(0, 4)):
            base[rng.randrange(len(base))] = rng.choice(("x", "y", f"u{i}"))
        rows.append((i, " ".join(base)))
    found = jaccard.similar_classes(frame(spark, rows), width=3, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components(rows, 3, percent)


def test_jaccard_template_texts_ask_nobody(spark, monkeypatch):
    """Texts that differ in one word of ten share six of eight shingles: no two link, and none is compared however many there are."""
    asked = []
    plain = jaccard.asking

    def counted(*args):
        found = plain(*args)
        asked.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "asking", counted)
    for n in (300, 600):
        rows = [(i, f"a b c d e f g h i z{i}") for i in range(n)]
        found = jaccard.similar_classes(frame(spark, rows), width=4, percent=85).collect()
        assert all(r.component_id == r.doc_id for r in found) and len(found) == n
    assert asked == [0, 0]


def test_jaccard_chain_of_hot_copies(spark, monkeypatch):
    """A row of texts each like the next: one component that no leader alone connects."""
    monkeypatch.setattr(jaccard, "GROUP", 4)
    stream = [f"c{k}" for k in range(220)]
    rows = [(100 - k, " ".join(stream[2 * k : 2 * k + 60])) for k in range(60)] + [(500 + k, " ".join(stream[:60])) for k in range(40)]
    found = jaccard.similar_classes(frame(spark, rows), width=5, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components(rows, 5, 80)
    stays = jaccard.near_duplicates_removed(frame(spark, rows), width=5, percent=80)
    assert [r.doc_id for r in stays.collect()] == [41]


def test_jaccard_sets_are_not_kept(spark):
    """What is written on the way is smaller than the sets of texts that all have near copies."""
    rng = random.Random(4)
    rows = []
    for i in range(40):
        base = [f"v{rng.randrange(10**6)}" for _ in range(1500)]
        rows += [(3 * i + k, " ".join([*base, f"end{k}"])) for k in range(3)]
    before = set(staged())
    found = jaccard.similar_classes(frame(spark, rows), width=5, percent=80).collect()
    assert all(r.component_id == r.doc_id // 3 * 3 for r in found) and len(found) == len(rows)
    files = [f for p in set(staged()) - before for f in Path(p.removeprefix("file:")).rglob("*.parquet")]
    assert files and sum(f.stat().st_size for f in files) < sum(8 * r.n_shingles for r in found) / 2


def test_jaccard_sets_take_one_worker_a_task(spark):
    """One Python operator makes the sets and drops those of other nodes; of the wanted ones, those with an id or not, none is lost."""
    rows = spark.createDataFrame([(i if i % 7 else None, f"a{i % 50} b c d e{i % 50}") for i in range(100)], "doc_id long, text string")
    documents, classes, _ = jaccard.rooted_nodes(rows, 3, 80, "doc_id", "text")
    nodes = classes.select("node", F.coalesce("least", F.lit(int(jaccard.NO_ID))).alias("least"))
    members = nodes.filter("node % 3 = 0").select("node")
    found = jaccard.sets_of(rows, nodes, members, 3)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    sets = {(r.node, bytes(r.set)) for r in found.collect()}
    assert {n for n, _ in sets} == {r.node for r in members.collect()} and any(n < 0 for n, _ in sets)
    assert {s for _, s in sets} <= {jaccard.shingles(r.text, 3).tobytes() for r in rows.collect()}


def test_jaccard_edges(spark):
    rows = [(4, "a b c d e f"), (4, "a b c d e f"), (None, "a b c d e f"), (2, None), (7, ""), (9, "x")]
    found = sorted(((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.similar_classes(frame(spark, rows)).collect()))
    assert found == [("2", 0, 2), ("4", 2, 4), ("4", 2, 4), ("7", 0, 7), ("9", 1, 9), ("None", 2, 4)]
    assert jaccard.similar_classes(frame(spark, []).limit(0)).count() == 0


def test_one_of_each_component(spark):
    """One row of each component stays, whatever ids its rows share or lack; other texts are not touched."""
    stream = [f"c{k}" for k in range(200)]

    def near(at, k):
        return " ".join([*stream[at : at + 60], f"x{k}"])

    a, b = near(0, 0), near(100, 0)
    rows = [(5, a), (5, b), (3, near(100, 1)), (None, near(100, 2)), (None, near(100, 3))]
    assert sorted((r.doc_id, r.text) for r in jaccard.near_duplicates_removed(frame(spark, rows)).collect()) == [(3, near(100, 1)), (5, a)]
    rows = [(5, b), (5, near(100, 1)), (None, a), (None, near(0, 1)), (None, a), (8, "lone text"), (8, "lone text"), (7, None), (7, ""), (None, " ")]
    stays = jaccard.near_duplicates_removed(frame(spark, rows))
    assert stays.columns == [c.split()[0] for c in SHAPE.split(", ")]
    found = sorted((str(r.doc_id), r.text) for r in stays.collect() if (r.text or "").strip())
    assert [i for i, _ in found] == ["5", "8", "None"] and set(found) <= {(str(i), t) for i, t in rows}
    assert stays.count() == 6


@pytest.mark.parametrize("chunk", [60, 1 << 19])
def test_substrings(spark, monkeypatch, chunk):
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    rows = corpus(5)
    found = substrings.kept_digest(frame(spark, rows), width=6).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == kept(rows, 6)


def test_substring_edges(spark):
    text = "a b c d e f g h"
    rows = [(3, text), (3, text), (8, "x " + text + " y"), (None, text), (5, None), (6, "")]
    spans = substrings.removed_spans(frame(spark, rows), width=4).collect()
    got = sorted((str(r.doc_id), r.n_words, [tuple(s) for s in r.spans]) for r in spans)
    assert got == [("3", 8, []), ("3", 8, []), ("5", 0, []), ("6", 0, []), ("8", 10, [(1, 9)]), ("None", 8, [(0, 8)])]
    left = {str(r.doc_id): r.text for r in substrings.without_repeats(frame(spark, rows), width=4).collect()}
    assert left["8"] == "x y" and left["None"] == "" and left["3"] == text
    assert substrings.removed_spans(frame(spark, []).limit(0)).count() == 0


def test_copies_of_a_text_are_dealt():
    """Lost windows of a text's copies go to many ranges and slices; a repeated row counts once in a chunk."""
    chunk = substrings._Chunk(4, 64)
    for doc_id in [*range(400), *[7] * 100]:
        chunk.add(doc_id, 77, "a b c d e f")
    rows = [r for r in chunk.rows() if r[1]]
    assert sorted(r[2] for r in rows) == list(range(1, 400)) and all(sorted(np.frombuffer(r[4], "<u4")) == [0, 1, 2] for r in rows)
    assert max(Counter(r[0] for r in rows).values()) < 30
    ids, keys, docs = np.arange(400), np.full(400, 77), np.repeat(np.arange(400), 3)
    found = [substrings.unsliced(data) for _, data in substrings.sliced(ids, keys, docs, np.tile([0, 1, 2], 400), 16)]
    assert len(found) == 16 and max(len(x[0]) for x in found) < 200
    assert sorted(zip(*(np.concatenate(x).tolist() for x in zip(*found)))) == [(i, 77, p) for i in range(400) for p in range(3)]


def test_word_hashes(monkeypatch):
    text = "Ab  c\x0bÉé\x1c x\x00 x\n" + "long " * 300 + "y" * 900 + " z"
    for segment in (1 << 20, 64):
        monkeypatch.setattr(common, "SEGMENT", segment)
        found = common.word_hashes(text)
        assert len(found) == len(words(text)) and len(set(found.tolist())) == len(set(words(text)))
        assert common.word_hashes("Ab ÉÀ", lower=True)[0] == common.word_hashes("ab")[0]
        assert common.word_hashes("ÉÀ", lower=True)[0] == common.word_hashes("ÉÀ")[0]
    assert common.split_words(text) == words(text)
    windows = common.rolling_hashes(np.array([3, 9, 3, 9, 3], np.uint64), 2)
    assert windows[0] == windows[2] and windows[1] == windows[3] and windows[0] != windows[1]


def test_filter_bitmap(spark):
    keys = spark.range(3000).withColumnRenamed("id", "k")
    bitmap = common.filter_bitmap(keys.filter("k % 3 = 0"), "k")
    bits = np.array([r.b for r in keys.select("k", common.filter_bit("k").alias("b")).orderBy("k").collect()])
    has = common.has_bit(bitmap, bits)
    assert has[::3].all() and has.sum() < 1010
    hashes = keys.select(F.xxhash64("k").alias("h"))
    bitmap = common.filter_bitmap(hashes.filter("h % 3 = 0"), "h", hashed=True)
    found = np.array([r.h for r in hashes.collect()], np.int64)
    has = common.has_bit(bitmap, common.hash_bits(found))
    assert has[found % 3 == 0].all() and has.sum() < (found % 3 == 0).sum() + 10


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(999, k) for k in range(500, 540)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    found = spark_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {x: find(x) for x in linked} and len(found) == len(linked)
