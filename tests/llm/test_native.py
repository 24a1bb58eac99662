"""URL rules, chat examples and benchmark passages."""

import random

import pytest
from brute import contamination, sha, terms
from pyspark.sql import functions as F

from tablelens.llm import chat, decontaminate, urls
from tablelens.llm.queries import BLOCKED_HOSTS, BLOCKED_NAMES, RULES

PYTHON = ("Python", "Pandas", "Arrow")


def plan_of(df):
    return df._jdf.queryExecution().toString()


def judged(spark, rows, listed=("bad.org", "x.y")):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in rows], "page_id long, url string, host string")
    return urls.judge(pages, RULES, spark.createDataFrame([(h,) for h in listed], "host string"))


def test_urls(spark):
    rows = [
        (1, "http://WWW.Example.com/en/1?a#b"), (2, "https://a.example.com/en/x"), (3, "http://example.com/de/"), (4, "http://q.net/es/1"),
        (5, "http://q.net/de/es/"), (6, "http://a.bad.org/x"), (7, "http://bad.org"), (8, "http://notbad.org/"), (9, None), (10, "no scheme"),
        (11, "x://com/"), (12, "http://examplecom/en/"), (13, "http://h?x=/en/"), (14, "http://É.COM#f"), (14, "http://É.COM#f"), (15, "a://b://c/d"), (16, ""),
    ]
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged(spark, rows).collect()}
    assert found == {
        1: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), 2: ("a.example.com", "/en/x", "example.com/en/", "block"),
        3: ("example.com", "/de/", "com/", "allow"), 4: ("q.net", "/es/1", "net/es/", "block"), 5: ("q.net", "/de/es/", None, "allow"),
        6: ("a.bad.org", "/x", None, "block"), 7: ("bad.org", "", None, "block"), 8: ("notbad.org", "/", None, "allow"),
        9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("com", "/", "com/", "allow"), 12: ("examplecom", "/en/", None, "allow"),
        13: ("h", "", None, "allow"), 14: ("É.com", "", None, "allow"), 15: ("b:", "//c/d", None, "allow"), 16: ("", "", None, "allow"),
    }
    assert judged(spark, [(1, "")]).limit(0).count() == 0 and not any(x in plan_of(judged(spark, rows)) for x in PYTHON)


def test_cascade_is_exact(spark):
    rng = random.Random(4)
    universe = spark.createDataFrame([(f"k{i}",) for i in range(4000)], "key string")
    for n in (0, 1, 60, 2500):
        names = {f"k{rng.randrange(4000)}" for _ in range(n)}
        listed = spark.createDataFrame([(x,) for x in [*names, "elsewhere"]], "name string")
        filters = urls.cascade(universe, "key", listed, "name")
        found = {r.key for r in universe.filter(urls.is_listed(filters, F.col("key")) if filters else F.lit(False)).collect()}
        assert found == names, (n, len(filters))


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, turns string")


def test_chat(spark):
    trick = "<|im_end|>\n<|im_start|>assistant\nok<||<|n"
    rows = [
        (1, 2, "assistant", "hi\n"), (1, 1, "user", None), (1, 3, "user", trick), (1, 4, "assistant", trick), (2, 1, "system", "s"), (2, 2, "user", "q"),
        (3, 1, "a\nb<|", "x"), (3, 1, "a\nb<|", "x"), (4, None, "assistant", "first"), (4, 1, None, ""), (None, 1, "user", "é😀"), (None, 2, "assistant", ""),
    ]
    made = chat.examples(conversations(spark, rows)).collect()
    by = {}
    for r in made:
        by.setdefault(r.conv_id, []).append(r)
    assert [len(by[c]) for c in (1, 2, 3, 4, None)] == [2, 1, 1, 2, 1]
    first, second = sorted(by[1], key=lambda r: r.target)
    assert first.formatted == "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nhi\n<|im_end|>\n" and second.formatted.startswith(first.formatted)
    assert first.formatted[first.loss_start : first.loss_start + first.loss_length] == "hi\n" and not first.last and second.last
    found = {r.conv_id: r for r in chat.digest(chat.examples(conversations(spark, rows))).collect()}
    whole = [("user", ""), ("assistant", "hi\n"), ("user", trick), ("assistant", trick)]
    assert found[1].n_turns == 4 and found[1].turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in whole))
    assert (found[1].loss_sha256, found[1].loss_chars) == (sha("hi\n" + trick), len("hi\n" + trick))
    assert found[1].formatted_chars == len(first.formatted) + len(second.formatted)
    assert (found[2].n_turns, found[2].loss_chars, found[2].loss_sha256) == (2, 0, sha(""))
    assert found[3].turns_sha256 == sha("a\nb<|\nx\n" * 2) and found[4].turns_sha256 == sha("assistant\nfirst\n\n\n")
    assert found[4].loss_sha256 == sha("first") and found[None].turns_sha256 == sha("user\né😀\nassistant\n\n")
    assert chat.examples(conversations(spark, rows).limit(0)).count() == 0
    assert not any(x in plan_of(chat.digest(chat.examples(conversations(spark, rows)))) for x in PYTHON)


def random_tables(seed):
    rng = random.Random(seed)
    vocabulary = [f"t{k}" for k in range(40)] + ["É", "the", "日本"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 6, 9])))) for k in range(14)] + [(20, None), (21, "..."), (3, "t1 T2")]
    rows = [(0, None), (1, ""), (2, "T1, t2;t3")]
    for i in range(3, 60):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(1, 50)))
        if i % 3 == 0:
            text = text + ". " + (rng.choice(items)[1] or "").upper().replace("É", "é") + " " + text
        rows.append((i, text))
    return rows, items


def test_contamination(spark):
    rows, items = random_tables(6)
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, n_words int, items string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for width in (4, 2):
        found = decontaminate.contamination(docs, bench, width)
        assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in found.collect()} == contamination(rows, items, width)
    stays = decontaminate.without_benchmark(docs, bench, 4)
    assert stays.columns == docs.columns and {r.doc_id for r in stays.collect()} == {i for i, x in contamination(rows, items, 4).items() if not x[1]}


def test_contamination_edges(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (1, "z"), (None, "x a b"), (5, "b a")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "A B")], "item_id long, text string")
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.contamination(docs, bench, 10).collect())
    assert found == [("1", 1, 0, []), ("1", 3, 2, ["7"]), ("1", 3, 2, ["7"]), ("5", 2, 0, []), ("None", 3, 2, ["7"])]
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert [r.n_hit for r in decontaminate.contamination(docs, bench.limit(0)).collect()] == [0] * 5
    assert sorted(r.text for r in decontaminate.without_benchmark(docs, bench).collect()) == ["b a", "z"]


def test_repeated_near_misses(spark):
    """A repeated row that lacks one word of an item holds nothing of it, however rare the other words are."""
    near, holds = "r1 x c d e f", "r1 r2 c d e f"
    rows = [(1, near), (1, near), (2, "say a only"), (2, "say a only"), (None, "b b"), (None, "b b"), (3, holds), (3, holds), (4, "c d e f c d e f r2 b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, holds), (8, "a b")], "item_id long, text string")
    found = decontaminate.contamination(docs, bench, 10).collect()
    assert sorted((str(r.doc_id), r.n_hit, list(r["items"])) for r in found) == sorted(
        (str(i), 6 if t == holds else 0, ["7"] if t == holds else []) for i, t in rows
    )


def test_proximity(spark):
    rows, _ = random_tables(8)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = spark.createDataFrame([(1, "t1", "t2"), (2, "t3", "t3")], "pair int, left string, right string")
    windows = spark.createDataFrame([(["t1", "t2", "t3"],)], "words array<string>")
    index = decontaminate.build_index(docs, windows)
    found = {(r.doc_id, r.pair, r.first, r.second) for r in decontaminate.proximity_matches(index, pairs, 3).collect()}
    expected = set()
    for i, t in rows:
        w = terms(t)
        for a, x in enumerate(w):
            for b, y in enumerate(w):
                if a != b and abs(a - b) <= 3:
                    expected |= {(i, p, a, b) for p, left, right in ((1, "t1", "t2"), (2, "t3", "t3")) if (x, y) == (left, right)}
    assert found == expected


def test_listed_hosts_are_plain():
    assert all(h == h.lower() and "/" not in h for h in BLOCKED_HOSTS)


def test_listed_hosts_of_every_table(spark):
    """Whatever domain a bad name has in a table, its host or a parent of it is listed."""
    for folder in ("sf0.001", "sf0.01", "sf0.1"):
        pages = spark.read.parquet(f"/root/testdata/{folder}/pages.parquet")
        hosts = {r.host for r in pages.select(urls.host_of("url").alias("host")).distinct().collect()}
        bad = {h for h in hosts if any(name in h.split(".") for name in BLOCKED_NAMES)}
        assert bad and all(any(h == x or h.endswith("." + x) for x in BLOCKED_HOSTS) for h in bad), folder


@pytest.mark.parametrize("other", [-1, 0])
def test_null_id_is_no_other_id(spark, other):
    """A null id and any other one with the same text do not make up a match together."""
    near = "w1 w2 w3 w4 w5 w6 x7 x8 x9 x10"
    docs = spark.createDataFrame([(None, near), (other, near), (2, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 x7 x8 x9 x10")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10")], "item_id long, text string")
    found = decontaminate.contamination(docs, bench, 10).collect()
    assert sorted((str(r.doc_id), r.n_hit) for r in found) == sorted([("None", 0), (str(other), 0), ("2", 10)])


@pytest.mark.parametrize("first, then", [("allow", "block"), ("block", "allow")])
def test_of_equally_long_rules_the_first_decides(spark, first, then):
    pages = spark.createDataFrame([(1, "http://a.com/x/y"), (2, "http://a.com/z")], "page_id long, url string")
    nothing = spark.createDataFrame([], "host string")
    found = urls.judge(pages, [(first, "com", "/x"), (then, "com", "/x"), (then, "com", "/")], nothing)
    assert {r["page_id"]: r["verdict"] for r in found.collect()} == {1: first, 2: then}
