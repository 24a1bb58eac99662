"""Nearest vectors and fused lists."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tablelens.functions import vectors as V
from tablelens.functions.text import ENGLISH
from tablelens.operators import fusion, retrieval
from tablelens.operators.batch_text import batch_search, hashed_vectors, semantic_search
from tablelens.plans.runtime import new_path, written
from tablelens.plans.search import Search
from tablelens.queries import SQL, query
from tablelens.queries.text import (
    BENCHMARK_TERMS, CORPUS, DOC_WORDS, PART, documents, indexed, search, semantic_sql,
)
from tablelens.sources.reader import read_table

DIM = 64


def probe(shift: int) -> list[float]:
    """A unit vector by rule."""
    raw = [math.cos((i + 1) * (shift + 1)) for i in range(DIM)]
    norm = math.sqrt(sum(x * x for x in raw))
    return [x / norm for x in raw]


def embeddings(spark, d):
    return read_table(spark, d, "embeddings")


def literal(vector) -> str:
    return "[" + ", ".join(repr(float(x)) for x in vector) + "]::DOUBLE[]"


def cosine_sql(vector) -> str:
    return f"list_cosine_similarity(embedding::DOUBLE[], {literal(vector)})"


def nearest_sql(vector, k: int, where: str = "true") -> str:
    return f"""SELECT vec_id, (1 + raw) / 2 AS _score FROM (SELECT *, {cosine_sql(vector)} AS raw FROM embeddings)
      WHERE {where} ORDER BY _score DESC, vec_id LIMIT {k}"""


def rounded(sql: str) -> str:
    return f"SELECT vec_id, round(_score, 6) AS _score FROM ({sql})"


def hits(s):
    return s.hits().select("vec_id", F.round("_score", 6).alias("_score"))


@query("knn_exact", rounded(nearest_sql(probe(0), 10)))
def _(spark, d):
    return hits(Search(embeddings(spark, d), "vec_id").knn("embedding", probe(0), 10))


@query("knn_filtered", rounded(nearest_sql(probe(1), 8, "label = 3 AND vec_id >= 10")))
def _(spark, d):
    found = Search(embeddings(spark, d), "vec_id")
    return hits(found.knn("embedding", probe(1), 8, filter=lambda q: q.term("label", 3).range("vec_id", "gte", 10)))


@query("knn_minimum_similarity", rounded(nearest_sql(probe(2), 1000, "raw >= 0.1")))
def _(spark, d):
    return hits(Search(embeddings(spark, d), "vec_id").knn("embedding", probe(2), 1000, similarity=0.1))


@query(
    "knn_dot_product",
    f"""SELECT vec_id, round((1 + list_dot_product(embedding::DOUBLE[], {literal(probe(3))})) / 2, 6) AS _score
        FROM embeddings ORDER BY list_dot_product(embedding::DOUBLE[], {literal(probe(3))}) DESC, vec_id LIMIT 12""",
)
def _(spark, d):
    return hits(Search(embeddings(spark, d), "vec_id").knn("embedding", probe(3), 12, similarity="dot_product"))


@query(
    "knn_l2_norm",
    f"""SELECT vec_id, round(1 / (1 + pow(list_distance(embedding::DOUBLE[], {literal(probe(3))}), 2)), 6) AS _score
        FROM embeddings ORDER BY list_distance(embedding::DOUBLE[], {literal(probe(3))}), vec_id LIMIT 12""",
)
def _(spark, d):
    return hits(Search(embeddings(spark, d), "vec_id").knn("embedding", probe(3), 12, similarity="l2_norm"))


def _signature_sql(column: str, bits: int = 62) -> str:
    planes = V.hyperplanes(DIM, bits, 7)
    return " + ".join(
        f"(CASE WHEN list_dot_product({column}, {literal(planes[:, b])}) >= 0 THEN {1 << b} ELSE 0 END)::BIGINT"
        for b in range(bits)
    )


APPROXIMATE = rounded(
    f"""SELECT vec_id, (1 + {cosine_sql(probe(4))}) / 2 AS _score FROM
      (SELECT *, {_signature_sql('embedding::DOUBLE[]')} AS sig FROM embeddings
       ORDER BY bit_count(xor(sig, {V.vector_signature(probe(4))}::BIGINT)), vec_id LIMIT 100)
      ORDER BY _score DESC, vec_id LIMIT 10"""
)


@query("knn_approximate", APPROXIMATE)
def _(spark, d):
    signed = retrieval.with_signature(embeddings(spark, d), "embedding", DIM)
    return hits(Search(signed, "vec_id").knn("embedding", probe(4), 10, num_candidates=100, signature="signature"))


#: Lists whose centres are the first rows of the sample (no rounds of fitting), so that SQL can say the same.
LISTS, PROBES = 16, 11
_NEAR = "list_cosine_similarity({}.embedding::DOUBLE[], {}.v)"
_CENTRES = f"""centres AS (SELECT embedding::DOUBLE[] AS v, row_number() OVER (ORDER BY md5(vec_id::VARCHAR), vec_id) AS n FROM embeddings
    WHERE embedding IS NOT NULL QUALIFY n <= {LISTS}),
  rows AS (SELECT e.vec_id, arg_max(n, (round({_NEAR.format("e", "c")}, 12), -n)) AS list FROM embeddings e, centres c GROUP BY e.vec_id)"""


def stored_lists(spark, d, rounds=0, lists=LISTS):
    return retrieval.VectorLists.write(embeddings(spark, d), "vec_id", "embedding", DIM, new_path(spark, "lists"), lists, rounds=rounds)


@query(
    "knn_lists",
    rounded(
        f"""WITH {_CENTRES}, chosen AS (SELECT n FROM centres ORDER BY round(list_cosine_similarity(v, {literal(probe(4))}), 12) DESC, n LIMIT {PROBES})
        SELECT vec_id, (1 + {cosine_sql(probe(4))}) / 2 AS _score FROM embeddings JOIN rows USING (vec_id)
        WHERE list IN (SELECT n FROM chosen) ORDER BY _score DESC, vec_id LIMIT 10"""
    ),
)
def _(spark, d):
    """Only the files of the nearest lists are read."""
    stored = stored_lists(spark, d)
    return hits(Search(stored.rows, "vec_id").knn("embedding", probe(4), 10, lists=stored, probes=PROBES))


@query(
    "knn_join_lists",
    f"""WITH {_CENTRES}, asked AS (SELECT vec_id AS query_id, embedding FROM embeddings WHERE vec_id % 20 = 0),
      near AS (SELECT query_id, n, row_number() OVER (PARTITION BY query_id ORDER BY round({_NEAR.format("a", "c")}, 12) DESC, n) AS place FROM asked a, centres c),
      pairs AS (SELECT a.query_id, e.vec_id, round((1 + round(list_cosine_similarity(a.embedding::DOUBLE[], e.embedding::DOUBLE[]), 12)) / 2, 6) AS _score
        FROM asked a JOIN near USING (query_id) JOIN rows ON list = n JOIN embeddings e ON e.vec_id = rows.vec_id WHERE place <= {PROBES})
      SELECT query_id, vec_id, _score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY _score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 5""",
)
def _(spark, d):
    """Every twentieth row asks for its neighbours among the rows of its nearest lists."""
    stored = stored_lists(spark, d)
    asked = embeddings(spark, d).filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    found = stored.nearest_for_each(asked, "query_id", "embedding", 5, PROBES)
    return found.select("query_id", "vec_id", F.round("_score", 6).alias("_score"))


@query("knn_approximate_stored", APPROXIMATE)
def _(spark, d):
    stored = retrieval.write_signed(embeddings(spark, d), "embedding", DIM, new_path(spark, "vectors"))
    found = retrieval.nearest(
        stored, "vec_id", "embedding", probe(4), 10, 100, signature="signature", partition="signature_prefix"
    )
    return found.select("vec_id", F.round("_score", 6).alias("_score"))


@query(
    "knn_join",
    """SELECT query_id, vec_id, round(_score, 6) AS _score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY _score DESC, vec_id) AS rank FROM (
          SELECT q.vec_id AS query_id, e.vec_id AS vec_id,
            (1 + list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[])) / 2 AS _score
          FROM embeddings e CROSS JOIN embeddings q)) WHERE rank <= 5""",
)
def _(spark, d):
    rows = embeddings(spark, d)
    asked = rows.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    found = retrieval.nearest_for_each(rows, "vec_id", "embedding", asked, "query_id", "vector", 5, DIM)
    return found.select("query_id", "vec_id", F.round("_score", 6).alias("_score"), "rank")


def _list_sql(vector, window: int) -> str:
    return f"""SELECT vec_id, _score, row_number() OVER (ORDER BY _score DESC, vec_id) AS rank
      FROM ({nearest_sql(vector, window)})"""


@query(
    "reciprocal_rank_fusion",
    f"""SELECT vec_id, round(sum(1.0 / (60 + rank)), 6) AS _score FROM (
        {_list_sql(probe(5), 100)} UNION ALL {_list_sql(probe(6), 100)}) GROUP BY vec_id""",
)
def _(spark, d):
    rows = embeddings(spark, d)
    lists = [retrieval.nearest(rows, "vec_id", "embedding", probe(n), 100) for n in (5, 6)]
    fused = fusion.reciprocal_rank(lists, "vec_id", 100, 60)
    return fused.select("vec_id", F.round("_score", 6).alias("_score"))


def _scaled(sql: str, weight: float) -> str:
    return f"""SELECT vec_id, {weight} * CASE WHEN max(_score) OVER () > min(_score) OVER ()
        THEN (_score - min(_score) OVER ()) / (max(_score) OVER () - min(_score) OVER ()) ELSE 1.0 END AS part
      FROM ({sql})"""


@query(
    "weighted_fusion",
    f"""SELECT vec_id, round(sum(part), 6) AS _score FROM (
        {_scaled(nearest_sql(probe(7), 40), 2.0)} UNION ALL {_scaled(nearest_sql(probe(8), 30), 0.5)}
        UNION ALL SELECT vec_id, 1.0 FROM embeddings WHERE label % 2 = 0)
      GROUP BY vec_id""",
)
def _(spark, d):
    found = Search(embeddings(spark, d), "vec_id").knn("embedding", probe(7), 40, weight=2.0)
    return hits(found.knn("embedding", probe(8), 30, weight=0.5).raw_condition("label % 2 = 0"))


@query(
    "knn_with_decay",
    f"""SELECT vec_id, round(_score * exp(abs(label - 3) * ln(0.5) / 2), 6) AS _score
        FROM ({nearest_sql(probe(7), 40)}) JOIN embeddings USING (vec_id)""",
)
def _(spark, d):
    found = Search(embeddings(spark, d), "vec_id").knn("embedding", probe(7), 40)
    return hits(found.decay_function_score("exp", "label", 3, 2.0))


@query("knn_random_order", f"SELECT vec_id FROM ({nearest_sql(probe(7), 30)})")
def _(spark, d):
    found = Search(embeddings(spark, d), "vec_id").knn("embedding", probe(7), 30).sort_by_random(seed=3)
    return found.limit(1000).hits().select("vec_id")


def labelled_tags(spark, d):
    """Vectors with their label as a nested tag and as text."""
    tag = F.array(F.struct(F.col("label").alias("number"), F.concat(F.lit("Label "), F.col("label")).alias("name")))
    return embeddings(spark, d).withColumn("tags", tag).withColumn("note", F.concat(F.lit("Labels were "), F.col("label")))


@query(
    "fused_inner_hits",
    f"""SELECT vec_id, round(sum(part), 6) AS _score, max(number) AS number FROM (
        SELECT vec_id, part, NULL::INT AS number FROM ({_scaled(nearest_sql(probe(7), 40), 1.0)})
        UNION ALL SELECT vec_id, 1.0, label FROM embeddings WHERE label = 2) GROUP BY vec_id""",
)
def _(spark, d):
    found = Search(labelled_tags(spark, d), "vec_id").knn("embedding", probe(7), 40)
    found.nested("tags", lambda q: q.term("tags.number", 2), inner_hits="found")
    return found.hits().select("vec_id", F.round("_score", 6).alias("_score"), F.element_at("found", 1)["number"].alias("number"))


@query("knn_text_filter", rounded(nearest_sql(probe(1), 8, "label IN (3, 4) AND label <> 3")))
def _(spark, d):
    """A stemmed text and a nested condition as the filter of a retriever."""
    found = Search(labelled_tags(spark, d), "vec_id", text={"note": ENGLISH})
    condition = lambda q: q.match("note", "label").nested("tags", lambda n: n.term("tags.number", 4))
    return hits(found.knn("embedding", probe(1), 8, filter=condition))


@query(
    "minmax_normalizer",
    f"SELECT vec_id, round(part, 6) AS scaled FROM ({_scaled(nearest_sql(probe(9), 50), 1.0)})",
)
def _(spark, d):
    found = retrieval.nearest(embeddings(spark, d), "vec_id", "embedding", probe(9), 50)
    return fusion.scaled(found).select("vec_id", F.round("scaled", 6).alias("scaled"))


@query(
    "text_rank_fusion",
    f"""WITH lex AS (SELECT doc_id, row_number() OVER (ORDER BY _score DESC, doc_id) AS rank FROM
        (WITH {CORPUS} SELECT doc_id, sum({PART}) AS _score FROM f JOIN v USING (term), c
         WHERE term IN ('thing', 'there', 'only') GROUP BY doc_id ORDER BY _score DESC, doc_id LIMIT 50)),
      sem AS (SELECT doc_id, rank FROM ({semantic_sql(
          "SELECT 0 AS query, unnest(['thing', 'there', 'only']) AS term", "query", 50).replace("round((1 + ", "((1 + ")
          .replace(") / 2, 6) AS _score", ") / 2) AS _score")}))
      SELECT doc_id, round(sum(1.0 / (20 + rank)), 6) AS _score
      FROM (SELECT * FROM lex UNION ALL SELECT * FROM sem) GROUP BY doc_id""",
)
def _(spark, d):
    found = search(spark, d).rrf("text", "text", "thing there only")
    return found.hits().select("doc_id", F.round("_score", 6).alias("_score"))


@query("rrf_indexed", SQL["text_rank_fusion"])
def _(spark, d):
    """Words by the index, meaning by vectors that were written once: no text is read for either list."""
    stored = written(hashed_vectors(documents(spark, d), "doc_id", "text"), "vectors")
    found = indexed(spark, d).rrf("text", "text", "thing there only", vectors=stored)
    return found.hits().select("doc_id", F.round("_score", 6).alias("_score"))


@query(
    "fused_rescored",
    f"""WITH sem AS (SELECT doc_id, _score AS s, rank FROM ({semantic_sql(
          "SELECT 0 AS query, unnest(['thing', 'there', 'only']) AS term", "query", 50).replace("round((1 + ", "((1 + ")
          .replace(") / 2, 6) AS _score", ") / 2) AS _score")})),
      e AS (SELECT doc_id, x FROM (WITH {CORPUS} SELECT doc_id, sum({PART}) AS x FROM f JOIN v USING (term), c
        WHERE term = 'there' GROUP BY doc_id))
      SELECT doc_id, round(s + CASE WHEN rank <= 25 THEN coalesce(x, 0) ELSE 0 END, 6) AS _score
      FROM sem LEFT JOIN e USING (doc_id) ORDER BY rank <= 25 DESC, _score DESC, doc_id LIMIT 30""",
)
def _(spark, d):
    found = indexed(spark, d).semantic("text", "thing there only").rescore(25, lambda q: q.match("text", "there"))
    return found.limit(30).hits().select("doc_id", F.round("_score", 6).alias("_score"))


@query(
    "batch_rank_fusion",
    f"""WITH lex AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY _score DESC, doc_id) AS rank
        FROM (WITH {CORPUS}, {BENCHMARK_TERMS} SELECT item_id, doc_id, round(sum({PART}), 6) AS _score
              FROM q JOIN f USING (term) JOIN v USING (term), c GROUP BY item_id, doc_id)),
      sem AS (SELECT item_id, doc_id, rank FROM ({semantic_sql(
          f"SELECT item_id, unnest({DOC_WORDS}) AS term FROM benchmark", "item_id", 50)}))
      SELECT item_id, doc_id, round(sum(1.0 / (20 + rank)), 6) AS _score
      FROM (SELECT * FROM lex WHERE rank <= 50 UNION ALL SELECT * FROM sem) GROUP BY item_id, doc_id""",
)
def _(spark, d):
    rows, asked = documents(spark, d), read_table(spark, d, "benchmark")
    lexical = batch_search(rows, "doc_id", "text", asked, "item_id", "text", 50, digits=6).drop("rank")
    semantic = semantic_search(rows, "doc_id", "text", asked, "item_id", "text", 50, digits=6).drop("rank")
    fused = fusion.reciprocal_rank([lexical, semantic], "doc_id", by=("item_id",))
    return fused.select("item_id", "doc_id", F.round("_score", 6).alias("_score"))
