"""Many text queries over all documents at once: search, similar documents, hashed tf-idf.

Search and similar documents read the texts once.  The term counts they need are written to the shared folder and
everything after that (document frequencies, collection statistics, scores) reads those rows.
Scores are summed with the rows of a document in one task, so the many (query, document) pairs are
never shuffled; only the k best per query and task are.  Seeds can be as many as documents, so their pairs
are not made as rows at all (``operators/tiles.py``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelens.functions.scoring import bm25, idf
from tablelens.functions.text import STANDARD, Analyzer
from tablelens.operators.grouping import TokenGroups, term_counts
from tablelens.operators.tiles import best_documents, document_vectors
from tablelens.plans.runtime import fits_broadcast, join_sized, ship_package, written

MARKER = ""

# Scores are rounded before they are ranked: a sum's last digits depend on the order of its rows, and
# copies of a document must tie on every evaluation so that the id decides.
DIGITS = 9


def analyzed(df: DataFrame, row_id: str, field: str, analyzer: Analyzer) -> DataFrame:
    return df.select(row_id, analyzer.tokens(F.col(field)).alias("tokens"))


def query_terms(queries: DataFrame, query_id: str, text: str, analyzer: Analyzer) -> DataFrame:
    terms = queries.select(query_id, F.explode_outer(F.array_distinct(analyzer.tokens(F.col(text)))).alias("term"))
    return terms.filter(F.col("term") != "")


def relevant_counts(
    documents: DataFrame, row_id: str, field: str, analyzer: Analyzer, vocabulary: DataFrame, broadcast: bool
) -> tuple[DataFrame, Column]:
    """Written ``(id, length, term, tf)`` rows of the vocabulary's terms, and the collection statistics."""
    counts = term_counts(analyzed(documents, row_id, field, analyzer), row_id, marker=MARKER)
    marker = vocabulary.sparkSession.createDataFrame([(MARKER,)], "term string")
    wanted = vocabulary.select("term").distinct().unionByName(marker)
    staged = written(join_sized(counts, wanted, "term", broadcast).select(row_id, "length", "term", "tf"), "counts")
    corpus = (
        staged.filter(F.col("term") == MARKER)
        .agg(F.struct(F.count("*").alias("documents"), F.avg("length").alias("average")))
        .scalar()
    )
    return staged.filter(F.col("term") != MARKER), corpus


def document_frequencies(counts: DataFrame, term: str = "term") -> DataFrame:
    return counts.groupBy(term).agg(F.count("*").alias("df"))


def pairs_by_document(counts: DataFrame, weights: DataFrame, term: str, row_id: str, broadcast: bool) -> DataFrame:
    """Counts joined with query weights; with a broadcast the pairs stay partitioned by document."""
    if broadcast:
        counts = counts.repartition(row_id)
    return join_sized(counts, weights, term, broadcast)


def bm25_part(corpus: str = "corpus") -> Column:
    return bm25(F.col("tf").cast("double"), F.col("length"), F.col(f"{corpus}.average"), F.col("weight"))


def best_per_query(scored: DataFrame, row_id: str, query_id: str, k: int, digits: int = DIGITS) -> DataFrame:
    """The k best rows of every query; the cut runs per task before the shuffle."""
    scored = scored.withColumn("_score", F.round("_score", digits))
    order = Window.partitionBy(query_id).orderBy(F.desc("_score"), F.asc(row_id))
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(query_id, row_id, "_score", "rank")


def batch_search(
    documents: DataFrame,
    row_id: str,
    field: str,
    queries: DataFrame,
    query_id: str,
    text: str,
    k: int = 10,
    analyzer: Analyzer = STANDARD,
    digits: int = DIGITS,
) -> DataFrame:
    """``(query, id, _score, rank)``: the k best documents of every query by BM25."""
    asked = query_terms(queries, query_id, text, analyzer)
    small = fits_broadcast(asked)
    counts, corpus = relevant_counts(documents, row_id, field, analyzer, asked, small)
    weights = (
        join_sized(asked, document_frequencies(counts), "term", small)
        .withColumn("corpus", corpus)
        .select(query_id, "term", idf(F.col("corpus.documents"), F.col("df")).alias("weight"))
    )
    pairs = pairs_by_document(counts, weights, "term", row_id, small).withColumn("corpus", corpus)
    scored = pairs.groupBy(query_id, row_id).agg(F.sum(bm25_part()).alias("_score"))
    return best_per_query(scored, row_id, query_id, k, digits)


def similar_documents(
    documents: DataFrame,
    row_id: str,
    field: str,
    seeds: DataFrame,
    seed_id: str,
    text: str | None = None,
    k: int = 10,
    analyzer: Analyzer = STANDARD,
    min_term_freq: int = 2,
    min_doc_freq: int = 5,
    max_query_terms: int = 25,
    minimum_match: float = 0.3,
    digits: int = DIGITS,
) -> DataFrame:
    """``(seed, id, _score, rank)``: documents sharing enough of each seed's most telling terms.

    Seeds are texts, or ids of stored documents when ``text`` is not given; a stored seed is not
    its own neighbour.
    """
    stored = text is None
    if stored:
        ids = seeds.select(F.col(seed_id).alias(row_id)).distinct()
        ids = F.broadcast(ids) if fits_broadcast(ids) else ids
        seeds = documents.join(ids, row_id, "left_semi").select(
            F.col(row_id).alias(seed_id), F.col(field).alias("__text")
        )
        text = "__text"
    seed_terms = written(
        term_counts(analyzed(seeds, seed_id, text, analyzer), seed_id)
        .filter(F.col("tf") >= min_term_freq)
        .select(seed_id, "term", F.col("tf").alias("seed_tf")),
        "seeds",
    )
    small = fits_broadcast(seed_terms.select("term").distinct())
    counts, corpus = relevant_counts(documents, row_id, field, analyzer, seed_terms, small)
    frequencies = document_frequencies(counts).filter(F.col("df") >= min_doc_freq)
    telling = F.col("seed_tf") * (F.log((F.col("corpus.documents") + 1) / (F.col("df") + 1)) + 1)
    place = F.row_number().over(Window.partitionBy(seed_id).orderBy(F.desc("telling"), F.asc("term")))
    chosen = (
        join_sized(seed_terms, frequencies, "term", small)
        .withColumn("corpus", corpus)
        .withColumn("telling", F.round(telling, 9))
        .withColumn("place", place)
        .filter(F.col("place") <= max_query_terms)
    )
    need = F.greatest(F.floor(F.count("*").over(Window.partitionBy(seed_id)) * minimum_match), F.lit(1))
    weights = written(chosen.select(seed_id, "term", idf(F.col("corpus.documents"), F.col("df")).alias("weight"), need.alias("need")), "weights")
    terms = written(weights.select("term").distinct().withColumn("code", F.monotonically_increasing_id()), "terms")
    average = counts.sparkSession.range(1).select(corpus["average"]).head()[0]
    vectors = document_vectors(join_sized(counts, terms, "term", small), row_id, average)
    weights = written(join_sized(weights, terms, "term", small), "weights")
    if stored:  # a seed may be among its own best
        vectors = vectors.filter(F.col(row_id).isNotNull())
        scored = best_documents(vectors, row_id, weights, seed_id, k + 1, digits).filter(F.col(seed_id) != F.col(row_id))
    else:
        scored = best_documents(vectors, row_id, weights, seed_id, k, digits)
    return best_per_query(scored, row_id, seed_id, k, digits)


# Semantic search without a model: hashed tf-idf vectors ----------------------


def buckets(dim: int):
    """Terms to vector dimensions, by the leading bits of their MD5."""

    def name(terms: list[str]) -> pa.Array:
        return pa.array([int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % dim for t in terms], pa.int64())

    return name


def hashed_vectors(
    documents: DataFrame, row_id: str, field: str, analyzer: Analyzer = STANDARD, dim: int = 4096
) -> DataFrame:
    """``(id, buckets, counts)`` of every document with words, one row each and without a shuffle.

    Write it once, and give it to every :func:`semantic_search` as ``vectors``.
    """
    ship_package()
    name = buckets(dim)
    rows = analyzed(documents, row_id, field, analyzer).filter(F.col("tokens").isNotNull())
    kind = rows.schema[row_id].dataType.simpleString()

    def hashed(batches):
        for batch in batches:
            groups = TokenGroups(batch.column("tokens"), name)
            present = np.flatnonzero(groups.lengths)
            offsets = pa.array(np.r_[np.searchsorted(groups.rows, present), len(groups.rows)].astype(np.int32))
            held = groups.terms.take(pa.array(groups.codes)).cast(pa.int32())
            counts = pa.array(groups.counts.astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (held, counts)]
            yield pa.record_batch([batch.column(row_id).take(pa.array(present)), *lists], names=[row_id, "buckets", "counts"])

    return rows.mapInArrow(hashed, f"`{row_id}` {kind}, buckets array<int>, counts array<int>")


def semantic_search(
    documents: DataFrame,
    row_id: str,
    field: str,
    queries: DataFrame,
    query_id: str,
    text: str,
    k: int = 10,
    analyzer: Analyzer = STANDARD,
    dim: int = 4096,
    digits: int = DIGITS,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """``(query, id, _score, rank)`` by cosine of hashed tf-idf vectors, as ``(1 + cos) / 2``.

    A document's length and its weights in the queries' buckets are computed where its vector lies;
    only those few weights are joined and summed.  The bucket weights, at most ``dim`` numbers, pass
    the driver.  ``vectors`` are stored :func:`hashed_vectors` of the same ``dim``; without them the
    texts are read.  A document without a shared bucket is not returned.
    """
    if dim > 1 << 18:
        raise ValueError("dim is limited to 262144, so that the weights stay broadcastable")
    spark = documents.sparkSession
    held = vectors if vectors is not None else hashed_vectors(documents, row_id, field, analyzer, dim)
    # one more entry per document counts the documents
    seen = held.select(F.explode(F.concat("buckets", F.array(F.lit(-1)))).alias("bucket")).groupBy("bucket").count()
    found = {r["bucket"]: r["count"] for r in seen.collect()}  # at most dim + 1 rows
    weights = np.zeros(dim)
    for bucket, df in found.items():
        if bucket >= 0:
            weights[bucket] = np.log((found[-1] + 1) / (df + 1))
    asked = term_counts(analyzed(queries, query_id, text, analyzer), query_id, buckets(dim), "bucket long")
    table = spark.createDataFrame([(int(b), float(w)) for b, w in enumerate(weights) if b in found], "bucket long, idf double")
    asked = asked.join(F.broadcast(table), "bucket").select(query_id, "bucket", (F.col("tf") * F.col("idf")).alias("qw"))
    norms = asked.groupBy(query_id).agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qnorm"))
    asked = asked.join(norms, query_id).select(query_id, "bucket", (F.col("qw") / F.col("qnorm")).alias("qw"))
    wanted = np.zeros(dim, bool)
    wanted[[r["bucket"] for r in asked.select("bucket").distinct().collect()]] = True  # at most dim rows
    kind = held.schema[row_id].dataType.simpleString()

    def weighed(batches):
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            which = np.repeat(np.arange(len(sizes)), sizes)
            bucket = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            w = batch.column(2).flatten().to_numpy(zero_copy_only=False) * weights[bucket]
            norm = np.sqrt(np.bincount(which, w * w, len(sizes)))
            keep = wanted[bucket] & (norm[which] > 0)
            which, bucket, w = which[keep], bucket[keep], w[keep]
            columns = [batch.column(0).take(pa.array(which)), pa.array(bucket.astype(np.int64)), pa.array(w / norm[which])]
            yield pa.record_batch(columns, names=[row_id, "bucket", "w"])

    rows = held.select(row_id, "buckets", "counts").mapInArrow(weighed, f"`{row_id}` {kind}, bucket long, w double")
    scored = (
        join_sized(rows, asked, "bucket", fits_broadcast(asked))
        .groupBy(query_id, row_id)
        .agg(((1 + F.sum(F.col("w") * F.col("qw"))) / 2).alias("_score"))
    )
    return best_per_query(scored, row_id, query_id, k, digits)
