"""Properties that hold whatever the data, brute force on small inputs, and plan shapes."""

import itertools
import math
import random
from collections import Counter

import __spark_entry__ as entry
import numpy as np
import pytest
from pyspark.sql import functions as F

import tablelens.operators.batch_text as batch_text
import tablelens.operators.postings as postings
from tablelens import ENGLISH, STANDARD, Search, with_tokens
from tablelens.functions import vectors as V
from tablelens.functions.atoms import Word, sloppy_phrase
from tablelens.functions.porter import stem
from tablelens.functions.text import ENGLISH_STOP_WORDS, fold_text
from tablelens.operators import aggregations as A
from tablelens.operators import retrieval, tiles
from tablelens.operators.wildcards import WildcardIndex
from tablelens.operators.postings import TextIndex
from tablelens.plans.conditions import Range, required
from tablelens.plans.runtime import join_sized, shared_folder, staged
from tablelens.queries.vectors import DIM, probe

FOLDER = "/root/testdata/sf0.001"


def read(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


# Stemming and analysis -----------------------------------------------------------------

STEMS = {
    "caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "digitizer": "digit",
    "operator": "oper", "feudalism": "feudal", "hopefulness": "hope", "formality": "formal", "triplicate": "triplic",
    "formative": "form", "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "adjustable": "adjust", "replacement": "replac", "adoption": "adopt", "effective": "effect", "probate": "probat",
    "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "mystery": "mysteri", "mysterious": "mysteri",
}


@pytest.mark.parametrize("word", STEMS)
def test_stem(word):
    assert stem(word) == STEMS[word]


def test_english_tokens_match_the_rule(spark):
    import regex

    docs = read(spark, "documents").select("doc_id", "text")
    got = {r[0]: r[1] for r in docs.select("doc_id", ENGLISH.tokens(F.col("text"))).collect()}
    for row in docs.collect():
        words = regex.findall(r"[\p{L}\p{N}]+", row["text"].lower())
        want = ["" if w in ENGLISH_STOP_WORDS else fold_text(stem(w)) for w in words]
        assert got[row["doc_id"]] == want


def test_fold():
    assert fold_text("Ångström Œuvre STRASSE ß ñandú Łódź") == "angstrom oeuvre strasse ss nandu lodz"


def test_missing_text_has_no_tokens(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "The cats")], "id int, t string")
    rows = df.select("id", ENGLISH.tokens(F.col("t")), STANDARD.tokens(F.col("t"))).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, None, None), (2, [], []), (3, ["", "cat"], ["the", "cats"])]


def test_texts_without_words_have_no_first_token(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "... !"), (4, "The cats, the CATS"), (5, "one")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = entry.queries()["tokens_standard"](spark, str(tmp_path)).select("doc_id", "tokens", "distinct_tokens", "first_token", "last_token")
    assert rows_of(found) == [(1, None, None, None, None), (2, 0, 0, None, None), (3, 0, 0, None, None), (4, 4, 2, "the", "cats"), (5, 1, 1, "one", "one")]


# Phrases -------------------------------------------------------------------------------


def brute_sloppy(tokens, words, slop):
    places = [[i for i, t in enumerate(tokens) if t == w] for w in words]
    for chosen in itertools.product(*places):
        shifts = [p - i for i, p in enumerate(chosen)]
        if len(set(chosen)) == len(chosen) and max(shifts) - min(shifts) <= slop:
            return True
    return False


@pytest.mark.parametrize("words", [("a", "b"), ("b", "a"), ("a", "b", "a"), ("a", "a"), ("c", "a", "b")])
def test_sloppy_phrase_by_brute_force(spark, words):
    rng = random.Random(3)
    rows = [(i, [rng.choice("abcdef") for _ in range(rng.randint(0, 12))]) for i in range(150)]
    df = spark.createDataFrame(rows, "id int, t array<string>")
    parts = [(i, Word(w)) for i, w in enumerate(words)]
    for slop in (1, 2, 4):
        got = {r[0] for r in df.filter(sloppy_phrase(F.col("t"), parts, slop)).collect()}
        assert got == {i for i, t in rows if brute_sloppy(t, words, slop)}


# Paging and conditions -------------------------------------------------------------------


def test_pages_and_keyset_pages_make_the_whole_sort(spark):
    orders = read(spark, "orders")

    def search():
        return Search(orders, "o_orderkey").range("o_totalprice", "gt", 250000).sort("o_orderpriority").sort("-o_totalprice")

    whole = [r["o_orderkey"] for r in search().hits().collect()]
    size = 97
    pages = [r["o_orderkey"] for p in range(1, len(whole) // size + 2) for r in search().limit(size).page(p).hits().collect()]
    assert pages == whole
    keyset, last = [], None
    while True:
        s = search().limit(size)
        rows = (s.search_after(last) if last else s).hits().collect()
        if not rows:
            break
        keyset += [r["o_orderkey"] for r in rows]
        last = [rows[-1]["o_orderpriority"], rows[-1]["o_totalprice"], rows[-1]["o_orderkey"]]
    assert keyset == whole


CONDITIONS = [
    lambda q: q.term("quality", 1),
    lambda q: q.range("quality", "lt", 1).range("n_chars", "gt", 100),
    lambda q: q.range("toxic", "between", [0, 0]),
    lambda q: q.exists("quality"),
    lambda q: q.should([lambda b: b.term("quality", 1), lambda b: b.term("lang", "fr").term("toxic", 0)]),
    lambda q: q.should([lambda b: b.term("quality", 1), lambda b: b.term("lang", "fr"), lambda b: b.exists("toxic")], 2),
    lambda q: q.must_not(lambda n: n.term("toxic", 1)),
    lambda q: q.wildcard("source", "src1*"),
    lambda q: q.term("nothing", 1),
]


@pytest.mark.parametrize("number", range(len(CONDITIONS)))
def test_a_condition_and_its_negation_split_the_rows(spark, number):
    rows = read(spark, "documents").select("doc_id", "lang", "source", "n_chars").join(read(spark, "labels"), "doc_id", "left")
    build = CONDITIONS[number]
    probe_condition = Search(rows, "doc_id")
    build(probe_condition)
    if len(probe_condition.conditions) == 1:
        other = Search(rows, "doc_id").must_not(build)
    else:  # none of several is not the opposite of all of them; wrap them as one
        other = Search(rows, "doc_id").must_not(lambda q: q.should([build]))
    yes = [r[0] for r in build(Search(rows, "doc_id")).hits().select("doc_id").collect()]
    no = [r[0] for r in other.hits().select("doc_id").collect()]
    assert len(yes) + len(no) == rows.count() and not set(yes) & set(no)
    assert build(Search(rows, "doc_id")).count() == len(yes)


def test_bad_arguments():
    with pytest.raises(TypeError):
        Range.parse("f", "~", 1)
    with pytest.raises(TypeError):
        Range.parse("f", "between", 3)
    assert Range.parse("f", "between", [None, None]) is None
    assert Range.parse("f", "between", [500, None]).bounds == [("gte", 500)]
    with pytest.raises(ValueError):
        A.offset_text("2 hours")
    with pytest.raises(ValueError):
        A.bucket_start("ts", "fortnight")
    assert [A.offset_text(o) for o in (120, 330, -210, 0, "-01:00")] == ["+02:00", "+05:30", "-03:30", "+00:00", "-01:00"]
    assert [required(m, 5) for m in (2, "50%", "-20%", -1, "100%")] == [2, 2, 4, 4, 5]


# Batch against single, and joins beyond the broadcast limit ----------------------------------


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_batch_search_equals_single_searches(spark):
    docs, asked = read(spark, "documents"), read(spark, "benchmark").orderBy("item_id").limit(3)
    batch = batch_text.batch_search(docs, "doc_id", "text", asked, "item_id", "text", 5, digits=6)
    got = rows_of(batch.select("item_id", "rank", "doc_id", "_score"))
    for item in asked.collect():
        hits = Search(docs, "doc_id", {"text": STANDARD}).match("text", item["text"]).limit(5).hits().collect()
        want = [(item["item_id"], i + 1, h["doc_id"], round(h["_score"], 6)) for i, h in enumerate(hits)]
        assert [r for r in got if r[0] == item["item_id"]] == want


def test_large_sides_give_the_same_rows(spark, monkeypatch, tmp_path):
    docs, asked = read(spark, "documents"), read(spark, "benchmark")
    seeds = read(spark, "labels").filter("toxic = 1").select(F.col("doc_id").alias("seed_id"))
    index = TextIndex.write(docs, "doc_id", {"text": STANDARD}, str(tmp_path / "index"))

    def run():
        return [
            rows_of(batch_text.batch_search(docs, "doc_id", "text", asked, "item_id", "text", 5, digits=6)),
            rows_of(batch_text.similar_documents(docs, "doc_id", "text", seeds, "seed_id", k=4, digits=6)),
            rows_of(batch_text.semantic_search(docs, "doc_id", "text", asked, "item_id", "text", 5, digits=6)),
            rows_of(index.search(asked, "item_id", "text", "text", 5, digits=6)),
        ]

    broadcast = run()
    monkeypatch.setattr(batch_text, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(postings, "fits_broadcast", lambda df: False)
    assert run() == broadcast


def brute_similar(docs, seeds, k, min_freq, min_docs, most, minimum, stored):
    """Rows of one id are one document whose scores are added; a seed's repeated terms count as often as they stand."""
    split = lambda t: (t or "").replace(".", " ").split()
    tokens = [(i, split(t)) for i, t in docs]
    n, average = sum(bool(t) for _, t in tokens), sum(len(t) for _, t in tokens) / max(sum(bool(t) for _, t in tokens), 1)
    df = Counter(w for _, t in tokens for w in set(t))
    asked = {}
    for i, t in seeds:
        telling = lambda w, f: round(f * (math.log((n + 1) / (df[w] + 1)) + 1), 9)
        asked.setdefault(i, []).extend((-telling(w, f), w) for w, f in Counter(split(t)).items() if f >= min_freq and df[w] >= min_docs)
    found = []
    for seed, terms in asked.items():
        terms = Counter(w for _, w in sorted(terms)[:most])
        score, matched = Counter(), Counter()
        for i, t in tokens:
            for w, tf in Counter(t).items():
                if w in terms:
                    weight = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                    score[i] += terms[w] * weight * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / average))
                    matched[i] += terms[w]
        need = max(math.floor(sum(terms.values()) * minimum), 1)
        good = [(-round(s, 6), i is not None, i or 0) for i, s in score.items() if matched[i] >= need and not (stored and (i is None or i == seed))]
        found += [(seed, i if known else None, -s, r + 1) for r, (s, known, i) in enumerate(sorted(good)[:k])]
    return sorted(found, key=repr)


@pytest.mark.parametrize("stored", [True, False])
def test_similar_documents_by_brute_force(spark, monkeypatch, stored):
    """Several parts and tiles; repeated and null ids, equal texts, frequent and rare words, texts without words."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    text = lambda: " ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randint(4, 40)))
    docs = [(i, text()) for i in range(300)]
    docs += [(i + 1000, docs[i % 5][1]) for i in range(40)] + docs[:9] + [(7, text()), (7, ""), (None, text()), (None, text()), (400, None), (401, "...")]
    rng.shuffle(docs)
    ids = [*range(0, 300, 7), 7, 1001, 400, 999999]
    seeds = [(i, t) for i, t in docs if i in ids] if stored else [(i, text()) for i in range(50)] + [(3, text()), (None, text()), (60, None)]
    for name, size in (("QUERIES", 8), ("PART_QUERIES", 20), ("DOCUMENTS", 16), ("CELLS", 64), ("COLUMNS", 6)):
        monkeypatch.setattr(tiles, name, size)
    held = spark.createDataFrame(docs, "id long, t string").repartition(5)
    asked = spark.createDataFrame([(i,) for i in ids], "seed long") if stored else spark.createDataFrame(seeds, "seed long, t string")
    for k, minimum in ((3, 0.3), (400, 0.9)):
        found = batch_text.similar_documents(held, "id", "t", asked, "seed", None if stored else "t", k, min_term_freq=2, min_doc_freq=3, max_query_terms=6, minimum_match=minimum, digits=6)
        assert sorted([tuple(r) for r in found.collect()], key=repr) == brute_similar(docs, seeds, k, 2, 3, 6, minimum, stored)


def test_pairs_of_seeds_and_documents_are_not_shuffled(spark):
    """What is shuffled is each task's best documents, ranked by seed; no row for each pair."""
    seeds = read(spark, "documents").select(F.col("doc_id").alias("seed_id"))
    text = plan(batch_text.similar_documents(read(spark, "documents"), "doc_id", "text", seeds, "seed_id", k=2))
    assert "Aggregate" not in text and text.count("Exchange") == 1


def test_salted_join_of_a_hot_key(spark):
    big = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    small = spark.range(9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = rows_of(big.join(small, "k").select("id", "k", "v"))
    assert rows_of(join_sized(big, small, "k", False).select("id", "k", "v")) == plain


def test_fuzzy_expansions(spark, tmp_path):
    docs = read(spark, "documents")
    index = TextIndex.write(docs, "doc_id", {"text": STANDARD}, str(tmp_path / "index"))
    near = index.near_spellings("text", "thing", 1, max_expansions=3).collect()
    assert near[0]["term"] == "thing" and len(near) == 3 and all(r["distance"] <= 1 for r in near)


def test_spelling_table(spark, tmp_path):
    """The table of deletions finds what a look through the vocabulary finds, at every distance, and reads no vocabulary."""
    rng = random.Random(3)
    words = {"".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(300)} | {"x" * 39, "x" * 41, "x" * 45, "thing", "things", "é", "éa"}
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(sorted(words))], "doc_id long, text string")
    index = TextIndex.write(docs, "doc_id", {"text": STANDARD}, str(tmp_path / "index"))
    spelled = index.with_spellings(str(tmp_path / "index"))
    for word in ("abc", "a", "thing", "x" * 40, "x" * 43, "é", "cabbac", "zzzz"):
        for distance in (0, 1, 2, 3):
            assert rows_of(spelled.near_spellings("text", word, distance)) == rows_of(index.near_spellings("text", word, distance)), (word, distance)
    text = plan(spelled.near_spellings("text", "thing", 2))
    assert "/spellings" in text and "/terms" not in text


def test_wildcard_index(spark, tmp_path):
    rng = random.Random(4)
    values = ["".join(rng.choices("abé%_*", k=rng.randint(0, 8))) for _ in range(300)] + [None, "", "abab", "abab"]
    rows = spark.createDataFrame(list(enumerate(values)), "id long, v string")
    index = WildcardIndex.write(rows, "id", "v", str(tmp_path / "w"))
    for pattern in ("ab*", "*ab", "*bab*", "a?b*", "*", "", "?", "abab", "*a%_*", "ab?*éa*", "???b"):
        wanted = rows_of(Search(rows, "id").wildcard("v", pattern).hits().select("id"))
        assert rows_of(index.matching_ids(pattern)) == wanted, pattern
    text = plan(index.matching_values("*bab*"))
    assert "/pieces" in text and "/values" not in text and "piece" in text.split("PushedFilters")[1][:200]


def test_stored_tokens_give_the_same_scores(spark):
    docs = read(spark, "documents")
    wide, names = with_tokens(docs, {"text": ENGLISH})
    fresh = Search(docs, "doc_id", {"text": ENGLISH}).match("text", "things only").hits()
    stored = Search(wide, "doc_id", {"text": ENGLISH}, names).match("text", "things only").hits()
    assert rows_of(fresh.select("doc_id", F.round("_score", 9))) == rows_of(stored.select("doc_id", F.round("_score", 9)))


# Vectors ---------------------------------------------------------------------------------------


def test_approximate_neighbours_recall(spark):
    vectors = retrieval.with_signature(read(spark, "embeddings"), "embedding", DIM)
    found = total = 0
    for row in vectors.orderBy("vec_id").limit(10).collect():
        exact = retrieval.nearest(vectors, "vec_id", "embedding", row["embedding"], 5).collect()
        near = retrieval.nearest(vectors, "vec_id", "embedding", row["embedding"], 5, 150, signature="signature").collect()
        found += len({r[0] for r in exact} & {r[0] for r in near})
        total += len(exact)
    assert found / total >= 0.7


def around_centres(spark, rows=3000, centres=40):
    """Vectors as models give them: many around few directions."""
    rng = np.random.default_rng(4)
    points = rng.standard_normal((centres, DIM))
    vectors = points[rng.integers(0, centres, rows)] + 0.5 * rng.standard_normal((rows, DIM))
    data = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(rows, None)]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>")


def test_lists_find_neighbours_in_few_rows(spark, tmp_path):
    """Nine tenths of the neighbours among five hundredths of the rows, the asking row left out."""
    vectors = around_centres(spark)
    lists = retrieval.VectorLists.write(vectors, "vec_id", "embedding", DIM, str(tmp_path / "lists"), lists=80)
    asked = vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("q"), "embedding")
    assert lists.recall(asked, "q", "embedding", 10, probes=4) >= 0.9
    sizes = {r[0]: r[1] for r in lists.rows.groupBy(retrieval.LIST).count().collect()}
    read_rows = [sum(sizes.get(n, 0) for n in lists.nearest_lists(r["embedding"], 4)) for r in asked.filter("embedding is not null").collect()]
    assert np.mean(read_rows) <= 0.055 * 3000


def test_lists_of_the_given_vectors(spark, tmp_path):
    """Their directions are even, so most lists must be read; every row has a list, and all lists give the exact answer."""
    vectors = read(spark, "embeddings")
    lists = retrieval.VectorLists.write(vectors, "vec_id", "embedding", DIM, str(tmp_path / "lists"), lists=16)
    assert lists.rows.count() == vectors.count() and lists.rows.filter(F.col(retrieval.LIST).isNull()).count() == 0
    asked = vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("q"), "embedding")
    assert lists.recall(asked, "q", "embedding", 10, probes=12) >= 0.9
    whole = lists.nearest_for_each(asked, "q", "embedding", 5, probes=16, rows_per_block=50, queries_per_block=7)
    exact = retrieval.nearest_for_each(vectors, "vec_id", "embedding", asked, "q", "embedding", 5, DIM)
    assert rows_of(whole.select("q", "vec_id", "rank")) == rows_of(exact.select("q", "vec_id", "rank"))


def test_a_search_reads_few_lists(spark, tmp_path):
    lists = retrieval.VectorLists.write(around_centres(spark), "vec_id", "embedding", DIM, str(tmp_path / "lists"), lists=80)
    found = Search(lists.rows, "vec_id").knn("embedding", probe(4), 5, lists=lists, probes=4).hits()
    assert "PartitionFilters: [vector_list" in plan(found).replace("isnotnull(vector_list#", "").replace("  ", " ") or "vector_list" in plan(found).split("PartitionFilters")[1][:200]
    filtered = Search(lists.rows, "vec_id").knn("embedding", probe(4), 5, lists=lists, probes=80, filter=lambda q: q.range("vec_id", "lt", 100))
    assert {r.vec_id for r in filtered.hits().collect()} == {r.vec_id for r in retrieval.nearest(lists.rows, "vec_id", "embedding", probe(4), 5, filter=F.col("vec_id") < 100).collect()}


def test_candidates_prune_partitions(spark, tmp_path):
    stored = retrieval.write_signed(read(spark, "embeddings"), "embedding", DIM, str(tmp_path / "signed"))
    args = ("vec_id", "embedding", probe(4), 5, 20)
    found = retrieval.nearest(stored, *args, signature="signature", partition="signature_prefix")
    assert "dynamicpruning" in plan(found)
    assert rows_of(found) == rows_of(retrieval.nearest(stored, *args, signature="signature"))


@pytest.mark.parametrize("metric", V.METRICS)
def test_neighbour_join_by_brute_force(spark, metric):
    vectors = read(spark, "embeddings")
    asked = vectors.filter("label = 1").select(F.col("vec_id").alias("q"), F.col("embedding").alias("v"))
    got = retrieval.nearest_for_each(
        vectors, "vec_id", "embedding", asked, "q", "v", 3, DIM, metric, queries_per_block=20, blocks=5
    ).collect()
    rows = vectors.orderBy("vec_id").collect()
    m = np.array([r["embedding"] for r in rows], dtype=np.float64)
    names = [r["vec_id"] for r in rows]
    for row in asked.collect():
        q = np.array(row["v"], dtype=np.float64)
        if metric == "l2_norm":
            s = 1 / (1 + ((m - q) ** 2).sum(1))
        else:
            raw = m @ q
            s = (1 + (raw / np.linalg.norm(m, axis=1) / np.linalg.norm(q) if metric == "cosine" else raw)) / 2
        best = [names[i] for i in np.argsort(-np.round(s, 12), kind="stable")[:3]]
        assert [r["vec_id"] for r in sorted((r for r in got if r["q"] == row["q"]), key=lambda r: r["rank"])] == best


def test_similarity_forms_agree(spark):
    vectors = read(spark, "embeddings")
    for metric in V.METRICS:
        both = vectors.select(
            V.similarity(F.col("embedding"), V.literal_vector(probe(1)), metric).alias("a"),
            V.similarity_to(F.col("embedding"), probe(1), metric).alias("b"),
        )
        assert both.agg(F.max(F.abs(F.col("a") - F.col("b")))).head()[0] < 1e-9


def test_approximate_facet_is_exact_when_the_sketch_holds_every_value(spark):
    rows = read(spark, "events")
    near = rows_of(A.approximate_facet(rows, "event_type", 10))
    assert near == rows_of(A.facet_counts(rows, ["event_type"]).select("key", "count"))


@pytest.mark.parametrize("interval", A.INTERVALS)
def test_histograms_do_not_depend_on_the_session_zone(spark, interval):
    times = ["2024-03-10 06:59:59", "2024-03-10 07:30:00", "2024-11-03 05:30:00", "2024-11-03 06:30:00", "2021-01-03 23:59:59"]
    aware = spark.createDataFrame([(t,) for t in times], "t string").select(
        F.timestamp_micros(F.unix_micros(F.to_timestamp("t"))).alias("aware"), F.to_timestamp_ntz("t").alias("plain")
    )
    aware = spark.createDataFrame(aware.toArrow())
    want = {f: rows_of(A.date_histogram(aware, f, interval, "+05:30")) for f in aware.columns}
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert {f: rows_of(A.date_histogram(aware, f, interval, "+05:30")) for f in aware.columns} == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert want["aware"] == want["plain"] and len(want["aware"]) >= 2


# Plans -----------------------------------------------------------------------------------------------


def test_filters_and_columns_reach_the_scan(spark):
    orders = read(spark, "orders")
    search = Search(orders, "o_orderkey").term("o_orderstatus", "F").must_not(lambda q: q.term("o_orderpriority", "5-LOW"))
    text = plan(search.sort("-o_totalprice").fields(["o_totalprice"]).limit(5).hits())
    assert "EqualTo(o_orderstatus,F)" in text and "Not(EqualNullSafe(o_orderpriority,5-LOW))" in text
    assert "TakeOrderedAndProject" in text and "o_orderdate" not in text


def test_group_cuts_run_before_the_shuffle(spark):
    text = plan(A.facets(read(spark, "part"), ["p_brand", "p_type"], 5))
    assert text.count("WindowGroupLimit") == 2
    asked = read(spark, "benchmark")
    text = plan(batch_text.batch_search(read(spark, "documents"), "doc_id", "text", asked, "item_id", "text", 5))
    assert text.count("WindowGroupLimit") >= 2 and "CartesianProduct" not in text and "NestedLoop" not in text


def test_unsorted_hits_are_not_sorted(spark):
    text = plan(Search(read(spark, "documents"), "doc_id").match("text", "thing").hits())
    assert "Sort" not in text and "rangepartitioning" not in text


def test_explicit_sorts_do_not_score(spark):
    text = plan(Search(read(spark, "documents"), "doc_id").match("text", "thing").sort("n_chars").limit(3).hits())
    assert "Subquery" not in text


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_an_indexed_search_does_not_read_the_text(spark, tmp_path):
    docs = read(spark, "documents")
    index = TextIndex.write(docs, "doc_id", {"text": STANDARD}, str(tmp_path / "index"))
    search = Search(docs, "doc_id", {"text": STANDARD}, index=index).match("text", "thing").match_phrase("text", "of the")
    assert "text:string" not in plan(search.fields(["doc_id"]).hits())


def test_negations_similar_texts_and_fusion_do_not_read_the_text(spark, tmp_path):
    docs = read(spark, "documents")
    index = TextIndex.write(docs, "doc_id", {"text": STANDARD}, str(tmp_path / "index"))

    def made():
        return Search(docs, "doc_id", {"text": STANDARD}, index=index)

    searches = [
        made().match("text", "thing").must_not(lambda q: q.match("text", "only")),
        made().more_like_this("text", "thing thing only only there there", min_doc_freq=1),
        made().match("text", "thing").rescore(20, lambda q: q.match("text", "only")).limit(5),
    ]
    for search in searches:
        assert "text:string" not in plan(search.fields(["doc_id"]).hits())
        search.index = None
        scan = {(r[0], round(r[-1], 9)) for r in search.fields(["doc_id"]).hits().select("doc_id", "_score").collect()}
        search.index = index
        assert {(r[0], round(r[-1], 9)) for r in search.fields(["doc_id"]).hits().select("doc_id", "_score").collect()} == scan


def test_phrases_of_frequent_words_read_pairs(spark, tmp_path):
    docs = read(spark, "documents").unionByName(
        spark.createDataFrame([(-1, "of of of the the of the"), (-2, ""), (-3, None)], "doc_id long, text string"), allowMissingColumns=True
    )
    plain = TextIndex.write(docs, "doc_id", {"text": STANDARD}, str(tmp_path / "index"))
    index = plain.with_pairs(str(tmp_path / "index"))

    def made(held):
        return Search(docs, "doc_id", {"text": STANDARD}, index=held)

    def found(search):
        return {(r[0], round(r[1], 9)) for r in search.hits().select("doc_id", "_score").collect()}

    assert index.frequent_of("text", ["of", "the", "nowhere"]) == {"of", "the"}
    text = plan(made(index).match_phrase("text", "of the").fields(["doc_id"]).hits())
    assert "second:string" in text and "term:string,id" not in text and "text:string" not in text
    for phrase in ("of the", "of of the", "of the of", "of nowhere the", "of of", "of"):
        assert found(made(index).match_phrase("text", phrase)) == found(made(None).match_phrase("text", phrase)), phrase
    assert (-1, ) in {r[:1] for r in found(made(index).match_phrase("text", "of of the"))}
    mixed = [
        lambda s: s.match_phrase("text", "of the").must_not(lambda q: q.match_phrase("text", "the of")),
        lambda s: s.should([lambda q: q.match_phrase("text", "of the"), lambda q: q.match_phrase("text", "only thing")]),
        lambda s: s.match_phrase("text", "of the").match("text", "thing"),
        lambda s: s.match_phrase("text", "of the").rescore(20, lambda q: q.match("text", "only")),
        lambda s: s.match_phrase("text", "of the", slop=2),
    ]
    for make in mixed:
        assert found(make(made(index))) == found(make(made(None)))


def test_a_result_made_once_reads_its_source_once(spark):
    docs = read(spark, "documents")

    def made():
        search = Search(docs, "doc_id", {"text": STANDARD}).match("text", "thing only").highlight_field("text").limit(5)
        return search.include_facets(["lang", "source"]).aggregate("by_lang", ["lang"], longest=F.max(F.length("text")))

    lazy = made().find_many()
    with made().find_many(once=True) as result:
        for df in [result.hits, *result.aggs.values()]:
            assert df.inputFiles() and all("/matched-" in f for f in df.inputFiles())
        assert result.hits.columns == lazy.hits.columns
        for one, other in [(result.hits, lazy.hits), *zip(result.aggs.values(), lazy.aggs.values())]:
            assert sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))
        assert result.total() == lazy.total()
        held = list(result._written)
    assert held and not set(held) & set(staged())
    narrow = Search(docs, "doc_id").exists("lang").include_facets(["lang"]).limit(0).find_many(once=True)
    assert set(narrow._matched().columns) == {"doc_id", "lang", "_score"} and narrow.hits.count() == 0
    narrow.close()
    fused = Search(docs, "doc_id", {"text": STANDARD}).match("text", "thing").semantic("text", "only there")
    fused.rescore(30, lambda q: q.match("text", "there")).fields(["doc_id"]).limit(10)
    wanted = sorted(map(repr, fused.find_many().hits.collect()))
    with fused.find_many(once=True) as result:
        assert sorted(map(repr, result.hits.collect())) == wanted


def test_a_field_without_an_index_form_leaves_the_others_indexed(spark, tmp_path):
    docs = read(spark, "documents").withColumn("title", F.col("lang"))
    analyzers = {"text": STANDARD, "title": STANDARD}
    index = TextIndex.write(docs, "doc_id", analyzers, str(tmp_path / "index"))
    search = Search(docs, "doc_id", analyzers, index=index).match("text", "thing").match_phrase("title", "en", slop=5000)
    assert "text:string" not in plan(search.fields(["doc_id"]).hits())


def test_rescoring_retrieved_rows_with_and_without_a_limit(spark):
    """A limit only scores the rows that the window and the page can show."""
    docs = read(spark, "documents")

    def fused(limit=None):
        search = Search(docs, "doc_id", {"text": STANDARD}).match("text", "thing").semantic("text", "only there")
        search.rescore(30, lambda q: q.match("text", "there"))
        return search if limit is None else search.limit(limit)

    whole = fused().hits()
    best = {r.doc_id: round(r._score, 9) for r in fused(10).hits().collect()}
    everything = {r.doc_id: round(r._score, 9) for r in whole.collect()}
    assert len(best) == 10 and all(everything[i] == s for i, s in best.items())


def test_rescoring_phases_do_not_add_scans(spark):
    def scans(phases):
        search = Search(read(spark, "documents"), "doc_id", {"text": STANDARD}).match("text", "thing only")
        for window in range(10, 10 * phases + 1, 10):
            search.rescore(window, lambda q: q.match("text", "there"))
        return plan(search.limit(30).hits()).count("FileScan parquet")

    assert scans(1) == scans(2) == scans(3)
