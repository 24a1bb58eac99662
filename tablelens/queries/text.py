"""Analysis, postings, full-text conditions and batch search over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelens.functions import text as T
from tablelens.operators import batch_text as B
from tablelens.operators.postings import TextIndex, field_statistics, postings, term_statistics, text_fields
from tablelens.plans.criteria import fuzzy, phrase, prefix, word
from tablelens.plans.runtime import new_path, written
from tablelens.plans.search import Search, with_tokens
from tablelens.queries import SQL, query
from tablelens.queries.filters import LINES, lined, unscored
from tablelens.sources.reader import read_table, spread

WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"
DOC_WORDS = WORDS.format("text")

# Tokens, per-document term counts and collection statistics of `documents`.
CORPUS = f"""d AS (SELECT doc_id, {DOC_WORDS} AS t FROM documents),
  c AS (SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t)) / count(*) FILTER (len(t) > 0) AS a FROM d),
  o AS (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM d),
  f AS (SELECT doc_id, dl, term, count(*) AS tf FROM o GROUP BY ALL),
  v AS (SELECT term, count(*) AS df FROM f GROUP BY term)"""


def idf_sql(df: str, n: str = "n") -> str:
    return f"ln(1 + ({n} - {df} + 0.5) / ({df} + 0.5))"


def bm25_sql(tf: str, weight: str) -> str:
    return f"({weight} * ({tf} * 2.2) / ({tf} + 1.2 * (1 - 0.75 + 0.75 * dl / a)))"


PART = bm25_sql("tf", idf_sql("df"))


def documents(spark, d):
    return spread(read_table(spark, d, "documents"), "doc_id")


def search(spark, d):
    return Search(documents(spark, d), "doc_id", {"text": T.STANDARD})


def ids(s):
    return unscored(s.fields(["doc_id"]))


def scores(s):
    return s.hits().select("doc_id", F.round("_score", 6).alias("_score"))


# Analysis ---------------------------------------------------------------------


@query(
    "tokens_standard",
    f"""SELECT doc_id, len(t) AS tokens, len(list_distinct(t)) AS distinct_tokens, t[1] AS first_token, t[-1] AS last_token
        FROM (SELECT doc_id, {DOC_WORDS} AS t FROM documents)""",
)
def _(spark, d):
    rows = documents(spark, d).select("doc_id", T.word_tokens(F.col("text")).alias("t"))
    return rows.select(
        "doc_id",
        F.size("t").cast("long").alias("tokens"),
        F.size(F.array_distinct("t")).cast("long").alias("distinct_tokens"),
        F.get("t", F.lit(0)).alias("first_token"),
        F.try_element_at("t", F.lit(-1)).alias("last_token"),  # a text without words has neither
    )


@query("tokens_english")
def _(spark, d):
    rows = documents(spark, d).select("doc_id", T.ENGLISH.tokens(F.col("text")).alias("t"))
    return rows.select(
        "doc_id",
        F.size("t").alias("positions"),
        T.token_count(F.col("t")).alias("tokens"),
        F.size(F.array_distinct("t")).alias("distinct_tokens"),
    )


_STOP_LIST = ", ".join(f"'{w}'" for w in sorted(T.ENGLISH_STOP_WORDS))


@query(
    "tokens_english_kept",
    f"""SELECT doc_id, len(t) AS positions, len(list_filter(t, lambda x: x NOT IN ({_STOP_LIST}))) AS tokens
        FROM (SELECT doc_id, {DOC_WORDS} AS t FROM documents)""",
)
def _(spark, d):
    """What stemming does not change: every word keeps its position, stop words hold no token."""
    rows = documents(spark, d).select("doc_id", T.ENGLISH.tokens(F.col("text")).alias("t"))
    return rows.select("doc_id", F.size("t").cast("long").alias("positions"), T.token_count(F.col("t")).cast("long").alias("tokens"))


FOLDED_SQL = f"translate(lower({{0}}), '{''.join(T.FOLD_TABLE)}', '{''.join(T.FOLD_TABLE.values())}')"
for _ligature, _plain in T.LIGATURES.items():
    FOLDED_SQL = f"replace({FOLDED_SQL}, '{_ligature}', '{_plain}')"


@query("keyword_folded", f"SELECT doc_id, {FOLDED_SQL.format('text')} AS folded FROM documents")
def _(spark, d):
    return documents(spark, d).select("doc_id", T.fold(F.col("text")).alias("folded"))


@query(
    "characters_stripped",
    f"""SELECT term, count(*) AS n FROM (SELECT unnest({WORDS.format("translate(p_name || '® ' || p_brand || '™', '®™', '')")}) AS term
        FROM part) GROUP BY term""",
)
def _(spark, d):
    analyzer = T.Analyzer(dropped_chars="®™")
    name = F.concat("p_name", F.lit("® "), "p_brand", F.lit("™"))
    terms = read_table(spark, d, "part").select(F.explode_outer(analyzer.tokens(name)).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("n"))


# The digit of each letter A to Z in the phonetic code; H and W are skipped inside a word.
_LETTERS, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "01230127022455012623017202"


def soundex_sql(t: str) -> str:
    kept = f"left(upper({t}), 1) || translate(substr(upper({t}), 2), 'HW', '')"
    code = f"translate({kept}, '{_LETTERS}', '{_DIGITS}')"
    for digit in "123456":
        code = f"regexp_replace({code}, '{digit}+', '{digit}', 'g')"
    return f"left(upper({t}), 1) || left(replace(substr({code}, 2), '0', '') || '000', 3)"


@query(
    "sounds_like",
    f"""WITH w AS (SELECT p_partkey, unnest({WORDS.format('p_name')}) AS t FROM part)
       SELECT DISTINCT p_partkey FROM w WHERE {soundex_sql('t')} IN ({soundex_sql("'rad'")}, {soundex_sql("'ballt'")})""",
)
def _(spark, d):
    rows = read_table(spark, d, "part")
    return unscored(Search(rows, "p_partkey").sounds_like("p_name", "rad ballt").fields(["p_partkey"]))


# Postings -----------------------------------------------------------------------


@query(
    "postings",
    f"""WITH d AS (SELECT doc_id, {DOC_WORDS} AS t FROM documents),
         o AS (SELECT doc_id, len(t) AS length, unnest(t) AS term, generate_subscripts(t, 1) - 1 AS p FROM d)
       SELECT term, doc_id AS id, length::INT AS length, count(*)::INT AS tf, min(p)::INT AS first_position,
         max(p)::INT AS last_position, sum(p)::BIGINT AS position_sum FROM o GROUP BY term, doc_id, length""",
)
def _(spark, d):
    rows = postings(documents(spark, d), "doc_id", {"text": T.STANDARD})
    return rows.select(
        "term",
        "id",
        "length",
        "tf",
        F.element_at("positions", 1).alias("first_position"),
        F.element_at("positions", -1).alias("last_position"),
        F.aggregate("positions", F.lit(0).cast("long"), lambda a, p: a + p).alias("position_sum"),
    )


@query(
    "analyze_all_fields",
    f"""WITH o AS (SELECT 'lang' AS field, doc_id, unnest({WORDS.format('lang')}) AS term FROM documents
          UNION ALL SELECT 'lines.kind', doc_id, kind FROM {LINES}
          UNION ALL SELECT 'lines.text', doc_id, unnest({DOC_WORDS}) FROM {LINES})
        SELECT field, term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM o GROUP BY field, term""",
)
def _(spark, d):
    rows = lined(spark, d)
    return term_statistics(postings(rows, "doc_id", {f: T.STANDARD for f in text_fields(rows.schema)}))


@query(
    "collection_statistics",
    f"""SELECT 'text' AS field, count(*) FILTER (len(t) > 0) AS documents,
          round(sum(len(t)) / count(*) FILTER (len(t) > 0), 6) AS average
        FROM (SELECT {DOC_WORDS} AS t FROM documents)""",
)
def _(spark, d):
    found = field_statistics(postings(documents(spark, d), "doc_id", {"text": T.STANDARD}, markers=True))
    return found.select("field", "documents", F.round("average", 6).alias("average"))


# Conditions on text -----------------------------------------------------------------


def match_sql(words: list[str], need: int) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"""WITH {CORPUS} SELECT doc_id, round(sum({PART}), 6) AS _score FROM f JOIN v USING (term), c
      WHERE term IN ({listed}) GROUP BY doc_id HAVING count(*) >= {need}"""


@query("match_any", match_sql(["thing", "only", "there"], 1))
def _(spark, d):
    return scores(search(spark, d).match("text", "Thing, only there"))


@query("match_all_words", match_sql(["thing", "only"], 2))
def _(spark, d):
    return scores(search(spark, d).match("text", "thing only", operator="and"))


@query("match_minimum", match_sql(["thing", "only", "there", "than"], 3))
def _(spark, d):
    return scores(search(spark, d).match("text", "thing only there than", minimum_should_match="75%"))


@query(
    "match_boosted",
    f"""SELECT doc_id, round(2.5 * _score, 6) AS _score FROM
        (WITH {CORPUS} SELECT doc_id, sum({PART}) AS _score FROM f JOIN v USING (term), c
         WHERE term IN ('than') GROUP BY doc_id)""",
)
def _(spark, d):
    return scores(search(spark, d).match("text", "than", boost=2.5))


@query("match_stored_tokens", match_sql(["thing", "only", "there"], 1))
def _(spark, d):
    """Tokens written once; the search does not read the texts."""
    wide, names = with_tokens(documents(spark, d), {"text": T.STANDARD})
    stored = written(wide.select("doc_id", names["text"]), "tokens")
    return scores(Search(stored, "doc_id", {"text": T.STANDARD}, names).match("text", "thing only there"))


FUZZY = "levenshtein(term, 'thing') <= 1"


def fuzzy_sql(test: str) -> str:
    return f"""WITH {CORPUS}, g AS (SELECT doc_id, dl, sum(tf) AS tf FROM f WHERE {test} GROUP BY doc_id, dl),
      w AS (SELECT count(*) AS df FROM g)
      SELECT doc_id, round({bm25_sql('tf', idf_sql('df'))}, 6) AS _score FROM g, w, c"""


@query("match_fuzzy", fuzzy_sql(FUZZY))
def _(spark, d):
    return scores(search(spark, d).match("text", "thing", fuzziness="AUTO"))


@query("match_fuzzy_prefix", fuzzy_sql("term LIKE 'th%' AND levenshtein(term, 'thing') <= 2"))
def _(spark, d):
    return scores(search(spark, d).match("text", "thing", fuzziness=2, prefix_length=2))


@query(
    "match_fuzzy_expansions",
    fuzzy_sql(
        f"""term IN (SELECT term FROM (SELECT term, count(*) AS n FROM o WHERE {FUZZY} GROUP BY term)
            ORDER BY levenshtein(term, 'thing'), n DESC, term LIMIT 4)"""
    ),
)
def _(spark, d):
    return scores(search(spark, d).match("text", "thing", fuzziness=1, max_expansions=4))


# Phrases in SQL: positions of each word, joined by distance.
POSITIONS = f"""p AS (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM d)"""


@query(
    "phrase",
    f"""WITH {CORPUS}, {POSITIONS},
      g AS (SELECT a1.doc_id, count(*) AS tf FROM p a1 JOIN p a2 ON a1.doc_id = a2.doc_id AND a2.pos = a1.pos + 1
            WHERE a1.term = 'of' AND a2.term = 'the' GROUP BY a1.doc_id),
      w AS (SELECT sum({idf_sql('df')}) AS weight FROM v, c WHERE term IN ('of', 'the'))
      SELECT doc_id, round({bm25_sql('tf', 'weight')}, 6) AS _score
      FROM (SELECT g.doc_id, tf, len(t) AS dl FROM g JOIN d USING (doc_id)), w, c""",
)
def _(spark, d):
    return scores(search(spark, d).match_phrase("text", "of the"))


@query(
    "phrase_with_slop",
    f"""WITH d AS (SELECT doc_id, {DOC_WORDS} AS t FROM documents), {POSITIONS}
      SELECT DISTINCT a1.doc_id FROM p a1 JOIN p a2 ON a1.doc_id = a2.doc_id AND abs((a2.pos - 1) - a1.pos) <= 3
      WHERE a1.term = 'thing' AND a2.term = 'the'""",
)
def _(spark, d):
    return ids(search(spark, d).match_phrase("text", "thing the", slop=3))


@query(
    "phrase_with_slop_repeated_word",
    f"""WITH d AS (SELECT doc_id, {DOC_WORDS} AS t FROM documents), {POSITIONS},
      q AS (SELECT * FROM p WHERE term IN ('than', 'of'))
      SELECT DISTINCT a1.doc_id FROM q a1 JOIN q a2 USING (doc_id) JOIN q a3 USING (doc_id)
      WHERE a1.term = 'than' AND a2.term = 'of' AND a3.term = 'than' AND a1.pos <> a3.pos
        AND greatest(a1.pos, a2.pos - 1, a3.pos - 2) - least(a1.pos, a2.pos - 1, a3.pos - 2) <= 12""",
)
def _(spark, d):
    return ids(search(spark, d).match_phrase("text", "than of than", slop=12))


@query(
    "phrase_prefix",
    f"""WITH {CORPUS}, {POSITIONS},
      g AS (SELECT a1.doc_id, count(*) AS tf FROM p a1 JOIN p a2 ON a1.doc_id = a2.doc_id AND a2.pos = a1.pos + 1
            WHERE a1.term = 'of' AND a2.term LIKE 'thi%' GROUP BY a1.doc_id),
      e AS (SELECT df FROM v WHERE term = 'of' UNION ALL
            SELECT count(DISTINCT doc_id) FROM o WHERE term LIKE 'thi%'),
      w AS (SELECT sum({idf_sql('df')}) AS weight FROM e, c)
      SELECT doc_id, round({bm25_sql('tf', 'weight')}, 6) AS _score
      FROM (SELECT g.doc_id, tf, len(t) AS dl FROM g JOIN d USING (doc_id)), w, c""",
)
def _(spark, d):
    return scores(search(spark, d).match_phrase_prefix("text", "of thi"))


@query(
    "boosted_phrase",
    f"""WITH {CORPUS}, {POSITIONS},
      ph AS (SELECT a1.doc_id, count(*) AS tf FROM p a1 JOIN p a2 ON a1.doc_id = a2.doc_id AND a2.pos = a1.pos + 1
             WHERE a1.term = 'for' AND a2.term = 'the' GROUP BY a1.doc_id),
      w AS (SELECT sum({idf_sql('df')}) AS weight FROM v, c WHERE term IN ('for', 'the')),
      s1 AS (SELECT doc_id, {bm25_sql('tf', 'weight')} AS s
             FROM (SELECT ph.doc_id, tf, len(t) AS dl FROM ph JOIN d USING (doc_id)), w, c),
      m AS (SELECT doc_id, sum({PART}) AS s, count(*) AS k FROM f JOIN v USING (term), c
            WHERE term IN ('for', 'the') GROUP BY doc_id)
      SELECT m.doc_id, round(coalesce(s1.s, 0) * 7 + (CASE WHEN k = 2 THEN m.s ELSE 0 END) * 5 + m.s * 2, 6) AS _score
      FROM m LEFT JOIN s1 USING (doc_id)""",
)
def _(spark, d):
    return scores(search(spark, d).match_boosted_phrase("text", "for the", ["or", "and", "exact"], [2, 5, 7]))


@query(
    "text_expression",
    f"""WITH d AS (SELECT doc_id, {DOC_WORDS} AS t FROM documents)
      SELECT doc_id FROM d WHERE len(list_filter(t, lambda x: x LIKE 'thor%')) > 0
        AND (list_contains(t, 'thing') OR contains(' ' || array_to_string(t, ' ') || ' ', ' of the ')
             OR len(list_filter(t, lambda x: levenshtein(x, 'onlyx') <= 1)) > 0)
        AND NOT list_contains(t, 'ther')""",
)
def _(spark, d):
    wanted = prefix("thor") & (word("thing") | phrase("of the") | fuzzy("onlyx", 1)) & ~word("ther")
    return ids(search(spark, d).text_expression("text", wanted))


# Batch search -------------------------------------------------------------------------

BENCHMARK_TERMS = f"""q AS (SELECT item_id, unnest(list_distinct({DOC_WORDS})) AS term FROM benchmark)"""
RANKED = """SELECT {0}, doc_id, _score, rank FROM (SELECT *, row_number() OVER
  (PARTITION BY {0} ORDER BY _score DESC, doc_id) AS rank FROM {1}) WHERE rank <= {2}"""


@query(
    "batch_search",
    f"""WITH {CORPUS}, {BENCHMARK_TERMS},
      s AS (SELECT item_id, doc_id, round(sum({PART}), 6) AS _score FROM q JOIN f USING (term) JOIN v USING (term), c
            GROUP BY item_id, doc_id)
      {RANKED.format('item_id', 's', 10)}""",
)
def _(spark, d):
    return B.batch_search(
        documents(spark, d), "doc_id", "text", read_table(spark, d, "benchmark"), "item_id", "text", 10, digits=6
    )


@query(
    "batch_search_indexed",
    f"""WITH {CORPUS}, {BENCHMARK_TERMS},
      s AS (SELECT item_id, doc_id, round(sum({PART}), 6) AS _score FROM q JOIN f USING (term) JOIN v USING (term), c
            GROUP BY item_id, doc_id)
      {RANKED.format('item_id', 's', 5)}""",
)
def _(spark, d):
    index = TextIndex.write(documents(spark, d), "doc_id", {"text": T.STANDARD}, new_path(spark, "index"))
    found = index.search(read_table(spark, d, "benchmark"), "item_id", "text", "text", 5, digits=6)
    return found.withColumnRenamed("id", "doc_id")


@query(
    "index_match_and_phrase",
    f"""WITH {CORPUS}, {POSITIONS},
      m AS (SELECT doc_id, round(sum({PART}), 6) AS _score FROM f JOIN v USING (term), c
            WHERE term IN ('in', 'the') GROUP BY doc_id HAVING count(*) = 2),
      g AS (SELECT a1.doc_id, count(*) AS tf FROM p a1 JOIN p a2 ON a1.doc_id = a2.doc_id AND a2.pos = a1.pos + 1
            WHERE a1.term = 'in' AND a2.term = 'the' GROUP BY a1.doc_id)
      SELECT doc_id, _score, coalesce(tf, 0)::INT AS phrases FROM m LEFT JOIN g USING (doc_id)""",
)
def _(spark, d):
    index = TextIndex.write(documents(spark, d), "doc_id", {"text": T.STANDARD}, new_path(spark, "index"))
    both = index.match("text", "in the", "and")
    exact = index.phrase("text", "in the")
    return both.join(exact, "id", "left").select(
        F.col("id").alias("doc_id"), F.round("_score", 6).alias("_score"), F.coalesce("tf", F.lit(0)).alias("phrases")
    )


def similar_sql(seed_rows: str, seed: str, minimum_freq: int, doc_freq: int, terms: int, k: int, own: str) -> str:
    return f"""WITH {CORPUS}, so AS ({seed_rows}),
      st AS (SELECT {seed}, term, count(*) AS seed_tf FROM so GROUP BY ALL HAVING count(*) >= {minimum_freq}),
      ch AS (SELECT {seed}, term, df, row_number() OVER (PARTITION BY {seed} ORDER BY telling DESC, term) AS place
             FROM (SELECT {seed}, term, df, round(seed_tf * (ln((n + 1) / (df + 1)) + 1), 9) AS telling
                   FROM st JOIN v USING (term), c WHERE df >= {doc_freq})),
      kept AS (SELECT {seed}, term, df, count(*) OVER (PARTITION BY {seed}) AS terms FROM ch WHERE place <= {terms}),
      s AS (SELECT {seed}, doc_id, round(sum({PART}), 6) AS _score FROM kept JOIN f USING (term), c
            GROUP BY {seed}, doc_id HAVING count(*) >= greatest(floor(max(terms) * 0.3), 1) {own})
      {RANKED.format(seed, 's', k)}"""


@query(
    "similar_to_texts",
    similar_sql(f"SELECT item_id, unnest({DOC_WORDS}) AS term FROM benchmark", "item_id", 1, 5, 25, 10, ""),
)
def _(spark, d):
    return B.similar_documents(
        documents(spark, d), "doc_id", "text", read_table(spark, d, "benchmark"), "item_id", "text", 10,
        min_term_freq=1, digits=6,
    )


@query(
    "similar_to_stored",
    similar_sql(
        f"SELECT doc_id AS seed_id, unnest({DOC_WORDS}) AS term FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)",
        "seed_id", 2, 5, 25, 5, "AND seed_id <> doc_id",
    ),
)
def _(spark, d):
    seeds = read_table(spark, d, "labels").filter("toxic = 1").select(F.col("doc_id").alias("seed_id"))
    return B.similar_documents(documents(spark, d), "doc_id", "text", seeds, "seed_id", k=5, digits=6)


LIKE = "there is only a thing in the other than the than only thing"


@query(
    "more_like_this",
    f"""WITH {CORPUS}, st AS (SELECT term, count(*) AS seed_tf
          FROM (SELECT unnest({WORDS.format(repr(LIKE))}) AS term) GROUP BY term HAVING count(*) >= 2),
      kept AS (SELECT term, df FROM (SELECT term, df, round(seed_tf * (ln((n + 1) / (df + 1)) + 1), 9) AS telling
               FROM st JOIN v USING (term), c WHERE df >= 5) ORDER BY telling DESC, term LIMIT 3)
      SELECT doc_id, round(sum({PART}), 6) AS _score FROM kept JOIN f USING (term), c GROUP BY doc_id
      HAVING count(*) >= greatest(floor((SELECT count(*) FROM kept) * 0.7), 1)""",
)
def _(spark, d):
    return scores(search(spark, d).more_like_this("text", LIKE, max_query_terms=3, minimum_should_match="70%"))


def semantic_sql(query_rows: str, key: str, k: int, dim: int = 4096) -> str:
    bucket = f"('0x' || substr(md5(term), 1, 8))::BIGINT % {dim}"
    return f"""WITH d AS (SELECT doc_id, {DOC_WORDS} AS t FROM documents),
      n AS (SELECT count(*) FILTER (len(t) > 0) AS n FROM d),
      h AS (SELECT doc_id, {bucket} AS b, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL),
      i AS (SELECT b, ln((n + 1) / (count(*) + 1)) AS idf FROM h, n GROUP BY b, n),
      w AS (SELECT doc_id, b, tf * idf AS w FROM h JOIN i USING (b)),
      l AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id),
      qh AS (SELECT {key}, {bucket} AS b, count(*) AS tf FROM ({query_rows}) GROUP BY ALL),
      qw AS (SELECT {key}, b, tf * idf AS qw FROM qh JOIN i USING (b)),
      ql AS (SELECT {key}, sqrt(sum(qw * qw)) AS qnorm FROM qw GROUP BY {key}),
      s AS (SELECT {key}, doc_id, round((1 + sum(w * (qw / qnorm)) / norm) / 2, 6) AS _score
            FROM qw JOIN ql USING ({key}) JOIN w USING (b) JOIN l USING (doc_id) GROUP BY {key}, doc_id, norm)
      {RANKED.format(key, 's', k)}"""


@query("semantic_batch", semantic_sql(f"SELECT item_id, unnest({DOC_WORDS}) AS term FROM benchmark", "item_id", 10))
def _(spark, d):
    found = B.semantic_search(
        documents(spark, d), "doc_id", "text", read_table(spark, d, "benchmark"), "item_id", "text", 10, digits=6
    )
    return found.select("item_id", "doc_id", "_score", "rank")


def indexed(spark, d):
    """A search whose text is read only through a written index."""
    index = TextIndex.write(documents(spark, d), "doc_id", {"text": T.STANDARD}, new_path(spark, "index"))
    return Search(documents(spark, d), "doc_id", {"text": T.STANDARD}, index=index)


def _indexed(name: str, of: str, make):
    """The scan form's SQL must hold for the indexed form."""
    query(name, SQL[of])(lambda spark, d: scores(make(indexed(spark, d))))


_indexed("match_indexed", "match_any", lambda s: s.match("text", "Thing, only there"))
_indexed("phrase_indexed", "phrase", lambda s: s.match_phrase("text", "of the"))
_indexed("fuzzy_indexed", "match_fuzzy_expansions", lambda s: s.match("text", "thing", fuzziness=1, max_expansions=4))
_indexed("boosted_indexed", "boosted_phrase", lambda s: s.match_boosted_phrase("text", "for the", ["or", "and", "exact"], [2, 5, 7]))


_indexed("similar_indexed", "more_like_this", lambda s: s.more_like_this("text", LIKE, max_query_terms=3, minimum_should_match="70%"))


def _paired(spark, d):
    folder = new_path(spark, "index")
    index = TextIndex.write(documents(spark, d), "doc_id", {"text": T.STANDARD}, folder).with_pairs(folder)
    return Search(documents(spark, d), "doc_id", {"text": T.STANDARD}, index=index)


@query("phrase_frequent_indexed", SQL["phrase"])
def _(spark, d):
    """Both words are frequent: one list of the pair is read, and no list of a word."""
    return scores(_paired(spark, d).match_phrase("text", "of the"))


@query(
    "phrase_mixed_indexed",
    f"""WITH {CORPUS}, {POSITIONS},
      g AS (SELECT a1.doc_id, count(*) AS tf FROM p a1 JOIN p a2 ON a1.doc_id = a2.doc_id AND a2.pos = a1.pos + 1
              JOIN p a3 ON a1.doc_id = a3.doc_id AND a3.pos = a1.pos + 2
            WHERE a1.term = 'of' AND a2.term = 'the' AND a3.term = 'of' GROUP BY a1.doc_id),
      w AS (SELECT sum({idf_sql('df')} * CASE term WHEN 'of' THEN 2 ELSE 1 END) AS weight FROM v, c WHERE term IN ('of', 'the'))
      SELECT doc_id, round({bm25_sql('tf', 'weight')}, 6) AS _score
      FROM (SELECT g.doc_id, tf, len(t) AS dl FROM g JOIN d USING (doc_id)), w, c""",
)
def _(spark, d):
    """Two pairs that overlap in a word."""
    return scores(_paired(spark, d).match_phrase("text", "of the of"))


@query("fuzzy_spelled", SQL["match_fuzzy_expansions"])
def _(spark, d):
    """Near terms come from a table of deletions; the vocabulary is not read for them."""
    folder = new_path(spark, "index")
    index = TextIndex.write(documents(spark, d), "doc_id", {"text": T.STANDARD}, folder).with_spellings(folder)
    found = Search(documents(spark, d), "doc_id", {"text": T.STANDARD}, index=index)
    return scores(found.match("text", "thing", fuzziness=1, max_expansions=4))


@query("expression_indexed", SQL["text_expression"])
def _(spark, d):
    wanted = prefix("thor") & (word("thing") | phrase("of the") | fuzzy("onlyx", 1)) & ~word("ther")
    return ids(indexed(spark, d).text_expression("text", wanted))


@query("semantic_stored", semantic_sql(f"SELECT item_id, unnest({DOC_WORDS}) AS term FROM benchmark", "item_id", 10))
def _(spark, d):
    """Against vectors that were written once."""
    stored = written(B.hashed_vectors(documents(spark, d), "doc_id", "text"), "vectors")
    asked = read_table(spark, d, "benchmark")
    found = B.semantic_search(documents(spark, d), "doc_id", "text", asked, "item_id", "text", 10, digits=6, vectors=stored)
    return found.select("item_id", "doc_id", "_score", "rank")


# Highlighting ---------------------------------------------------------------------------

_PIECES = r"regexp_extract_all(text, '(?s).{1,150}(?:\s|$)|.{150}')"


def _tagged(words: str) -> str:
    marked = r"regexp_replace(x, '([\p{L}\p{N}]+)', chr(1) || '\1' || chr(2), 'g')"
    tagged = rf'''regexp_replace({marked}, chr(1) || '({words})' || chr(2), '<em class="hlt1">\1</em>', 'gi')'''
    return f"translate({tagged}, chr(1) || chr(2), '')"


@query(
    "highlight",
    f"""WITH d AS (SELECT doc_id, text, {DOC_WORDS} AS t, {_PIECES} AS pieces FROM documents),
      m AS (SELECT doc_id, pieces FROM d WHERE list_contains(t, 'thing') OR list_contains(t, 'only')),
      x AS (SELECT doc_id, unnest(pieces) AS x, generate_subscripts(pieces, 1) AS pos FROM m),
      g AS (SELECT doc_id, pos, {_tagged('thing|only')} AS fragment FROM x),
      r AS (SELECT doc_id, fragment, row_number() OVER (PARTITION BY doc_id
              ORDER BY len(fragment) - len(replace(fragment, '<em class="hlt1">', '')) DESC, pos) AS rank
            FROM g WHERE contains(fragment, '<em class="hlt1">'))
      SELECT doc_id, rank - 1 AS rank, fragment FROM r WHERE rank <= 3""",
)
def _(spark, d):
    hits = search(spark, d).match("text", "thing only").highlight_field("text").hits()
    return hits.select("doc_id", F.posexplode_outer("highlight_text").alias("rank", "fragment")).select(
        "doc_id", F.col("rank").cast("long").alias("rank"), "fragment"
    ).filter(F.col("fragment").isNotNull())


@query("english_match_and_highlight")
def _(spark, d):
    found = Search(documents(spark, d), "doc_id", {"text": T.ENGLISH}).match("text", "things only")
    hits = found.highlight_field("text", number_of_fragments=2, fragment_size=80).hits()
    return hits.select("doc_id", F.round("_score", 6).alias("_score"), "highlight_text")
