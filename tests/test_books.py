"""End-to-end searches over three books with known answers."""

import pytest
from pyspark.sql import functions as F

from tablelens import ENGLISH, STANDARD, Search, phrase, prefix, word

TEXT = {"title": ENGLISH, "premise": ENGLISH, "categories.name": ENGLISH,
        "publishing.series": ENGLISH, "publishing.organization": ENGLISH}


@pytest.fixture()
def search(books):
    return Search(books, text=TEXT).limit(10)


def ids(s):
    return sorted(r["id"] for r in s.hits().collect())


CASES = {
    "all": (lambda q: q, "123"),
    "term": (lambda q: q.term("country", "United Kingdom"), "12"),
    "match": (lambda q: q.match("title", "Harry"), "12"),
    "nested_range": (lambda q: q.nested("publishing", lambda n: n.range("publishing.year", "gte", 1999)), "23"),
    "nested_slop": (
        lambda q: q.nested("publishing", lambda n: n.match_phrase("publishing.series", "harry series", slop=3)), "12"),
    "must_and_not": (
        lambda q: q.term("country", "United Kingdom").must_not(lambda n: n.term("title", "stone")), "2"),
    "either_field_stemmed": (
        lambda q: q.should([lambda b: b.match("title", "mystery"), lambda b: b.match("premise", "mystery")]), "12"),
    "exists_undeclared": (lambda q: q.exists("extra"), "3"),
    "not_exists": (lambda q: q.must_not(lambda n: n.exists("extra")), "12"),
    "exists_unknown_column": (lambda q: q.exists("nowhere"), ""),
    "not_exists_unknown_column": (lambda q: q.must_not(lambda n: n.exists("nowhere")), "123"),
    "phrase": (lambda q: q.match_phrase("title", "Harry Potter"), "12"),
    "phrase_gap": (lambda q: q.match_phrase("title", "potter and the chamber"), "2"),
    "phrase_prefix": (lambda q: q.match_phrase_prefix("title", "Harry Pot"), "12"),
    "expression": (lambda q: q.text_expression("premise", prefix("myster") & ~word("alien")), "12"),
    "expression_or": (lambda q: q.text_expression("premise", phrase("alien attack") | word("orphan")), "13"),
    "boosted_exact": (lambda q: q.match_boosted_phrase("title", "Harry Potter", ["exact"], [4]), "12"),
    "boosted_all_words": (lambda q: q.match_boosted_phrase("premise", "young wizard", ["and"], [2]), "1"),
    "boosted_nothing": (lambda q: q.match_boosted_phrase("premise", "young wizard", []), "123"),
    "array_term": (lambda q: q.term("heroes", "Ron"), "12"),
    "terms_set": (lambda q: q.terms_set("heroes", ["Ron", "Harry", "Spensa"], "least(num_terms, 2)"), "12"),
    "wildcard": (lambda q: q.wildcard("country", "united ki*"), ""),
    "wildcard_case": (lambda q: q.wildcard("country", "United ?i*"), "12"),
    "fuzzy": (lambda q: q.match("title", "hary", fuzziness="AUTO"), "12"),
    "fuzzy_expanded": (lambda q: q.match("title", "hary", fuzziness=1, max_expansions=5), "12"),
    "phonetic": (lambda q: q.sounds_like("title", "hery"), "12"),
    "raw": (lambda q: q.raw_condition("price < 20"), "3"),
    "minimum": (lambda q: q.match("premise", "young alien wizard", minimum_should_match=2), "13"),
    "empty_should": (lambda q: q.should([lambda b: b]), "123"),
    "nested_same_element": (
        lambda q: q.nested("categories", lambda n: n.term("categories.id", 103).match("categories.name", "fantasy")), ""),
    "nested_unmapped": (lambda q: q.nested("nowhere", lambda n: n.term("x", 1), ignore_unmapped=True), ""),
}


@pytest.mark.parametrize("name", CASES)
def test_case(search, name):
    build, expected = CASES[name]
    build(search)
    assert ids(search) == list(expected)
    assert search.count() == len(expected)


def test_similar_to_text(search):
    search.more_like_this("premise", "alien attack young pilot", min_term_freq=1, min_doc_freq=1, max_query_terms=25)
    hits = search.hits().collect()
    assert hits[0]["id"] == "3" and hits[0]["_score"] > 0


def test_sort_and_limit(search):
    rows = search.fields(["id", "price"]).sort("price").limit(2).hits().collect()
    assert [(r["id"], r["price"]) for r in rows] == [("3", 18.99), ("2", 22.99)]
    assert rows[0].__fields__ == ["id", "price", "_score"] and rows[0]["_score"] is None


def test_page(search):
    rows = search.limit(2).page(2).hits().collect()
    assert [r["id"] for r in rows] == ["3"] and rows[0]["publishing"][0]["year"] == 2018


def test_keyset_page(search):
    assert [r["id"] for r in search.sort("-price").search_after([22.99, "2"]).hits().collect()] == ["3"]


def test_facets_and_terms(search, books):
    result = search.include_facets(["country", "heroes"], limit=2).find_many()
    got = {(r["facet"], r["key"]): (r["count"], r["other_count"]) for r in result.aggs["facets"].collect()}
    assert got[("country", "United Kingdom")] == (2, 0) and got[("country", "United States of America")] == (1, 0)
    assert got[("heroes", "Harry")] == (2, 3) and len([k for k in got if k[0] == "heroes"]) == 2
    result = Search(books).aggregate_term("country").find_many()
    assert [(r["key"], r["count"]) for r in result.aggs["country"].collect()] == [
        ("United Kingdom", 2), ("United States of America", 1)]
    assert result.hits.count() == 0 and result.total() == 3


def test_nested_facet(books):
    result = Search(books).include_facets({"year": "publishing.year"}).find_many()
    assert {r["key"] for r in result.aggs["facets"].collect()} == {"1998", "1999", "2018"}


def test_histogram(books):
    rows = Search(books).date_histogram("published_at", "year", "+00:00").find_many().aggs["published_at"]
    assert sorted((r["key"], r["count"]) for r in rows.collect()) == [("1998", 1), ("1999", 1), ("2018", 1)]


def test_highlight(books):
    search = Search(books, text={"title": STANDARD}).match("title", "harry").highlight_field("title")
    rows = search.hits().collect()
    assert len(rows) == 2
    assert all(r["highlight_title"][0].startswith('<em class="hlt1">Harry</em> Potter') for r in rows)


def test_highlight_marks_words_as_written(search):
    rows = search.match("premise", "mystery").highlight_field("premise", pre_tag="[", post_tag="]").hits().collect()
    by_id = {r["id"]: " ".join(r["highlight_premise"]) for r in rows}
    assert "[mysterious]" in by_id["1"]
    assert "[mystery]" in by_id["2"] and "[mysterious]" in by_id["2"]


def test_scores_rank_by_relevance(search):
    rows = search.match("premise", "mystery").hits().collect()
    assert [r["id"] for r in rows] == ["2", "1"] and rows[0]["_score"] > rows[1]["_score"] > 0


def test_nested_scores_and_inner_hits(search):
    search.nested("categories", lambda n: n.term("categories.id", 101), score_mode="sum", inner_hits="found")
    rows = search.hits().collect()
    assert [r["_score"] for r in rows] == [1.0, 1.0, 1.0] and [c["name"] for c in rows[0]["found"]] == ["Fantasy"]


def test_rescore(search, books):
    search.term("country", "United Kingdom").rescore(1, lambda q: q.match("title", "stone"))
    rows = search.hits().collect()
    assert [r["id"] for r in rows] == ["1", "2"] and rows[0]["_score"] > 1.0 and rows[1]["_score"] == 1.0
    only_vectors = Search(books.withColumn("v", F.array(F.col("price"), F.lit(1.0))))
    only_vectors.knn("v", [1.0, 0.0], 2).rescore(2, lambda q: q.term("country", "United Kingdom"))
    assert max(r["_score"] for r in only_vectors.hits().collect()) <= 1.0


def test_min_score_total_and_first(search):
    search.match("premise", "mystery young").min_score(0.0).track_total_hits(2)
    assert search.find_many().total() == 2
    assert search.find_many().total(True) == 3
    assert search.find_first()["id"] in "123"
    with pytest.raises(LookupError):
        search.term("country", "Nowhere").find_first_or_throw()


def test_random_order_is_reproducible(books):
    first = [r["id"] for r in Search(books).sort_by_random(seed=5).limit(10).hits().collect()]
    assert first == [r["id"] for r in Search(books).sort_by_random(seed=5).limit(10).hits().collect()]
    assert sorted(first) == ["1", "2", "3"]


def test_fields(search):
    row = search.fields(["title", "publishing.y*"]).exclude_fields(["title"]).hits().head()
    assert row.__fields__ == ["publishing", "_score"]
    assert row["publishing"][0].__fields__ == ["year"]


def test_fusion(books):
    frame = books.withColumn("v", F.array(F.col("price"), F.lit(20.0)))
    search = Search(frame, text=TEXT).limit(10).knn("v", [1.0, 0.5], 2, weight=0.5).match("title", "chamber")
    rows = search.hits().collect()
    assert rows[0]["id"] == "2"
    search = Search(frame, text=TEXT).limit(10).rrf("premise", "premise", "alien attack", 1.0)
    assert search.hits().head()["id"] == "3"
    search = Search(frame, text=TEXT).limit(10).semantic("premise", "alien attack")
    assert [r["id"] for r in search.hits().collect()] == ["3"]


def test_decay_and_factor(books):
    rows = Search(books).limit(10).decay_function_score("gauss", "published_at", "1998-06-26", 86400.0 * 365).hits().collect()
    assert [r["id"] for r in rows] == ["1", "2", "3"] and rows[0]["_score"] == 1.0
    rows = Search(books).limit(10).field_value_factor("price", 2.0).hits().collect()
    assert rows[0]["_score"] == pytest.approx(49.98)
