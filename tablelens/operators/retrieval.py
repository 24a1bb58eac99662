"""Vector retrieval: exact, by signature, and many queries at once."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelens.functions import vectors as V
from tablelens.plans.runtime import ship_package


def _best(df: DataFrame, row_id: str, k: int) -> DataFrame:
    return df.orderBy(F.desc("_score"), F.asc(row_id)).limit(k)


def nearest(
    df: DataFrame,
    row_id: str,
    field: str,
    vector: Sequence[float],
    k: int,
    num_candidates: int | None = None,
    filter: Column | None = None,
    similarity: float | str | None = None,
    signature: str | None = None,
    partition: str | None = None,
    seed: int = 7,
    lists: VectorLists | None = None,
    probes: int = 8,
) -> DataFrame:
    """``(id, _score)`` of the k nearest rows.

    ``similarity`` is a metric name or a minimum cosine.  With ``num_candidates`` and a stored
    ``signature`` column, rows are first ranked by differing signature bits, reading 8 bytes a row,
    and only that many candidates are compared.  When the table is partitioned by the leading bits
    (``partition``, see :func:`write_signed`), the candidates' partitions alone are read in full.
    Without a stored signature the exact ranking is cheaper, so ``num_candidates`` changes nothing.

    With ``lists`` (``df`` holds their column) only the ``probes`` lists nearest to the vector are read.
    """
    metric = similarity if isinstance(similarity, str) else "cosine"
    rows = df.filter(F.col(field).isNotNull())
    if filter is not None:
        rows = rows.filter(filter)
    if lists is not None:
        rows = rows.filter(F.col(LIST).isin(lists.nearest_lists(vector, probes)))
    if signature and num_candidates:
        far = V.hamming(F.col(signature), V.vector_signature(vector, seed=seed))
        keys = [row_id, *([partition] if partition else [])]
        ranked = rows.filter(F.col(signature).isNotNull()).select(*keys, far.alias("far"))
        chosen = ranked.orderBy("far", row_id).limit(max(num_candidates, k))
        # The comparison holds for every row; it tells Spark that pruning partitions may pay off.
        chosen = chosen.filter(F.col("far") < 64).select(*keys)
        rows = rows.join(F.broadcast(chosen), keys, "left_semi")
    scored = rows.select(row_id, V.similarity_to(F.col(field), vector, metric).alias("raw"))
    if similarity is not None and not isinstance(similarity, str):
        scored = scored.filter(V.within(F.col("raw"), float(similarity), metric))
    return _best(scored.select(row_id, V.score(F.col("raw"), metric).alias("_score")), row_id, k)


def with_signature(df: DataFrame, field: str, dim: int, name: str = "signature", bits: int = 62, seed: int = 7) -> DataFrame:
    """Add the signature column; write the result once and search it often."""
    return df.withColumn(name, F.when(F.col(field).isNotNull(), V.signature(F.col(field), dim, bits, seed)))


def write_signed(df: DataFrame, field: str, dim: int, path: str, prefix_bits: int = 8, bits: int = 62, seed: int = 7) -> DataFrame:
    """Write the vectors with their signature, partitioned by its leading bits; returns the table.

    Near vectors tend to share those bits, so a search's candidates lie in few partitions.  The
    rebalance splits a partition that holds many copies over several files.
    """
    signed = with_signature(df, field, dim, "signature", bits, seed)
    lead = F.shiftrightunsigned(F.coalesce("signature", F.lit(0)), bits - prefix_bits).cast("int")
    signed.withColumn("signature_prefix", lead).hint("rebalance", "signature_prefix").write.mode("overwrite").partitionBy(
        "signature_prefix"
    ).parquet(path)
    return df.sparkSession.read.parquet(path)


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def _scores(q: np.ndarray, m: np.ndarray, metric: str) -> np.ndarray:
    raw = q @ m.T
    if metric != "l2_norm":
        return (1 + V.settled(raw)) / 2
    square = (q * q).sum(1)[:, None] + (m * m).sum(1)[None, :] - 2 * raw
    return V.settled(1 / (1 + np.maximum(square, 0)))


def _block_products(rows: DataFrame, asked: DataFrame, keys: list[str], k: int, dim: int, metric: str) -> DataFrame:
    """(qid, id, _score): the k best rows (id, v) for each query (qid, v) of the same block, by one product a block."""

    def product(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if rows.num_rows == 0 or asked.num_rows == 0:
            return pa.table({"qid": asked["qid"][:0], "id": rows["id"][:0], "_score": pa.array([], pa.float64())})
        # Ids in ascending order, so that equal scores keep the smaller id.
        rows = rows.sort_by("id")
        q, m = V.stack(asked["v"], dim), V.stack(rows["v"], dim)
        if metric == "cosine":
            q, m = _unit(q), _unit(m)
        picks = []
        for start in range(0, len(q), 256):
            scores = _scores(q[start : start + 256], m, metric)
            for i, row in enumerate(scores):
                floor = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
                near = np.flatnonzero(row >= floor)
                near = near[np.argsort(-row[near], kind="stable")][:k]
                picks.append((np.full(len(near), start + i), near, row[near]))
        which, near, found = (np.concatenate(column) for column in zip(*picks))
        return pa.table(
            {
                "qid": asked["qid"].combine_chunks().take(pa.array(which)),
                "id": rows["id"].combine_chunks().take(pa.array(near)),
                "_score": pa.array(found),
            }
        )

    qid_type, id_type = asked.schema["qid"].dataType.simpleString(), rows.schema["id"].dataType.simpleString()
    blocks = rows.groupBy(*keys).cogroup(asked.groupBy(*keys))
    return blocks.applyInArrow(product, f"qid {qid_type}, id {id_type}, _score double")


def nearest_for_each(
    df: DataFrame,
    row_id: str,
    field: str,
    queries: DataFrame,
    query_id: str,
    query_field: str,
    k: int,
    dim: int,
    metric: str = "cosine",
    rows_per_block: int = 20_000,
    queries_per_block: int = 5_000,
    blocks: int | None = None,
) -> DataFrame:
    """``(query id, id, _score, rank)``: the k nearest rows of every query row.

    Rows and queries are hashed into blocks of bounded size; each pair of blocks is one matrix
    product that keeps k rows per query, so no more than k candidates per query and block are
    shuffled.  Rows are copied once per query block (once for up to ``queries_per_block`` queries).
    """
    if metric not in V.METRICS:
        raise ValueError(f"unknown metric: {metric}")
    ship_package()
    if query_id == row_id:
        raise ValueError("the query id needs a name of its own")
    vectors = df.filter(F.col(field).isNotNull()).select(F.col(row_id).alias("id"), F.col(field).cast("array<float>").alias("v"))
    asked = queries.filter(F.col(query_field).isNotNull()).select(
        F.col(query_id).alias("qid"), F.col(query_field).cast("array<float>").alias("v")
    )
    if blocks is None:
        slots = df.sparkSession.sparkContext.defaultParallelism
        blocks = max(-(-vectors.count() // rows_per_block), slots)
    query_blocks = max(-(-asked.count() // queries_per_block), 1)

    def spread(frame: DataFrame, key: str, own: int, other: int, own_name: str, other_name: str) -> DataFrame:
        # The vector takes part in the hash, so copies under one id are spread too.
        mine = F.pmod(F.xxhash64(key, "v"), F.lit(own)).cast("int").alias(own_name)
        copies = F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(other_name)
        return frame.select("*", mine).select("*", copies)

    left = spread(vectors, "id", blocks, query_blocks, "block", "query_block")
    right = spread(asked, "qid", query_blocks, blocks, "query_block", "block")

    partial = _block_products(left, right, ["block", "query_block"], k, dim, metric)
    order = Window.partitionBy("qid").orderBy(F.desc("_score"), F.asc("id"))
    ranked = partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.withColumnsRenamed({"qid": query_id, "id": row_id})


#: Column with the number of a row's inverted list; rows without a vector have none.
LIST = "vector_list"
#: Rows on which centres are fitted, at most; with ``sample_per_list`` rows for each list that bounds the driver's share.
MAX_SAMPLE = 1 << 16


class VectorLists:
    """Stored inverted lists: every row under the nearest of a few centres, one partition of the table a list.

    Centres are fitted on a bounded sample: of the rows with a vector those with the smallest md5 of their id,
    ``sample_per_list`` for each list and MAX_SAMPLE at most.  Every row is stored.  A search reads the lists whose centres are
    nearest to its vector; how many it needs for a recall depends on the data, so measure it (:meth:`recall`).
    """

    def __init__(self, rows: DataFrame, centres: np.ndarray, row_id: str, field: str, metric: str):
        self.rows, self.centres, self.row_id, self.field, self.metric = rows, centres, row_id, field, metric

    @classmethod
    def write(
        cls, df: DataFrame, row_id: str, field: str, dim: int, path: str, lists: int = 256, metric: str = "cosine",
        rounds: int = 10, sample_per_list: int = 64,
    ) -> VectorLists:
        if metric not in ("cosine", "l2_norm"):
            raise ValueError("lists are for the metrics cosine and l2_norm")
        if not 0 < lists <= MAX_SAMPLE // 16:
            raise ValueError(f"lists must be between 1 and {MAX_SAMPLE // 16}")
        spark = df.sparkSession
        some = df.filter(F.col(field).isNotNull()).select(row_id, F.col(field).cast("array<double>").alias("v"))
        some = some.withColumn("md5", F.md5(F.col(row_id).cast("string").cast("binary"))).orderBy("md5", row_id)
        sample = some.limit(min(lists * sample_per_list, MAX_SAMPLE)).select("v").toArrow()
        centres = fitted_centres(V.stack(sample["v"], dim), lists, metric, rounds)
        rows = df.withColumn(LIST, assigned_list(F.col(field), centres, metric))
        rows.hint("rebalance", LIST).write.mode("overwrite").partitionBy(LIST).parquet(f"{path}/rows")
        spark.createDataFrame([(json.dumps(centres.tolist()), row_id, field, metric)], "centres string, id string, field string, metric string").coalesce(
            1
        ).write.mode("overwrite").parquet(f"{path}/centres")
        return cls.read(spark, path)

    @classmethod
    def read(cls, spark, path: str) -> VectorLists:
        kept = spark.read.parquet(f"{path}/centres").head()
        found = np.array(json.loads(kept["centres"]), dtype=np.float64)
        return cls(spark.read.parquet(f"{path}/rows"), found, kept["id"], kept["field"], kept["metric"])

    def nearest_lists(self, vector: Sequence[float], probes: int) -> list[int]:
        near = _closeness(np.asarray(vector, dtype=np.float64)[None, :], self.centres, self.metric)[0]
        return np.argsort(-near, kind="stable")[:probes].tolist()

    def nearest_for_each(
        self, queries: DataFrame, query_id: str, query_field: str, k: int, probes: int = 8, rows_per_block: int = 20_000, queries_per_block: int = 5_000
    ) -> DataFrame:
        """``(query id, id, _score, rank)`` among the rows of each query's nearest lists.

        A list above ``rows_per_block`` rows, or asked by more than ``queries_per_block`` queries, is split by a hash, so
        neither a crowded list nor a popular one is a single task; equal scores go by id.
        """
        ship_package()
        centres, metric, dim = self.centres, self.metric, self.centres.shape[1]
        kind = "array<int>"

        @F.arrow_udf(kind)
        def probed(vectors: pa.Array) -> pa.Array:
            near = _closeness(V.stack(vectors, dim), centres, metric)
            return pa.array(np.argsort(-near, axis=1, kind="stable")[:, :probes].astype(np.int32).tolist(), pa.list_(pa.int32()))

        vectors = self.rows.filter(F.col(self.field).isNotNull())
        vectors = vectors.select(F.col(self.row_id).alias("id"), F.col(self.field).cast("array<float>").alias("v"), F.col(LIST).alias("list"))
        asked = queries.filter(F.col(query_field).isNotNull()).select(F.col(query_id).alias("qid"), F.col(query_field).cast("array<float>").alias("v"))
        asked = asked.withColumn("list", F.explode(probed("v")))
        # at most a row a list
        sizes = self._split(vectors, rows_per_block), self._split(asked, queries_per_block)
        own, other = (F.element_at(F.array(*[F.lit(n) for n in s]), F.col("list") + 1) for s in sizes)

        def spread(frame: DataFrame, key: str, mine: str, parts: Column, theirs: str, copies: Column) -> DataFrame:
            frame = frame.withColumn(mine, F.pmod(F.xxhash64(key, "v"), parts).cast("int"))
            return frame.withColumn(theirs, F.explode(F.sequence(F.lit(0), copies - 1)))

        left = spread(vectors, "id", "block", own, "query_block", other)
        right = spread(asked, "qid", "query_block", other, "block", own)
        partial = _block_products(left, right, ["list", "block", "query_block"], k, dim, metric)
        order = Window.partitionBy("qid").orderBy(F.desc("_score"), F.asc("id"))
        ranked = partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return ranked.withColumnsRenamed({"qid": query_id, "id": self.row_id})

    def _split(self, frame: DataFrame, most: int) -> list[int]:
        counts = {r["list"]: r["count"] for r in frame.groupBy("list").count().collect()}
        return [max(1, -(-counts.get(i, 0) // most)) for i in range(len(self.centres))]

    def recall(self, queries: DataFrame, query_id: str, query_field: str, k: int, probes: int) -> float:
        """Part of the exact k nearest rows that the lists find, a query that is itself a row left out."""
        plain = [c for c in (query_id, self.row_id)]
        asked = queries.select(query_id, query_field)
        exact = nearest_for_each(self.rows, self.row_id, self.field, asked, query_id, query_field, k + 1, self.centres.shape[1], self.metric)
        found = self.nearest_for_each(asked, query_id, query_field, k + 1, probes)

        def others(ranked: DataFrame) -> DataFrame:
            kept = ranked.filter(F.col(query_id) != F.col(self.row_id))
            order = Window.partitionBy(query_id).orderBy("rank")
            return kept.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select(*plain)

        wanted = others(exact)
        hit = wanted.join(others(found), plain, "left_semi").count()
        return hit / max(wanted.count(), 1)


def _closeness(q: np.ndarray, centres: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        return V.settled(_unit(q) @ _unit(centres).T)
    return V.settled(-np.maximum((q * q).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * (q @ centres.T), 0))


def fitted_centres(sample: np.ndarray, lists: int, metric: str, rounds: int) -> np.ndarray:
    """Lloyd's rounds from the first rows of the sample; an empty cluster keeps its centre, equal rows are one centre's start."""
    if not len(sample):
        return np.zeros((1, sample.shape[1] or 1))
    start = np.sort(np.unique(sample, axis=0, return_index=True)[1])[:lists]
    centres = sample[start]
    for _ in range(rounds):
        near = _closeness(sample, centres, metric).argmax(1)
        for j in np.unique(near):
            rows = sample[near == j]
            centres[j] = (_unit(rows) if metric == "cosine" else rows).mean(0)
    return centres


def assigned_list(field: Column, centres: np.ndarray, metric: str) -> Column:
    """The nearest centre's number, null for a null vector."""
    ship_package()
    dim = centres.shape[1]

    @F.arrow_udf("int")
    def nearest_centre(vectors: pa.Array) -> pa.Array:
        given = vectors.is_valid().to_numpy(zero_copy_only=False)
        found = np.zeros(len(vectors), np.int32)
        if given.any():
            found[given] = _closeness(V.stack(vectors.filter(pa.array(given)), dim), centres, metric).argmax(1)
        return pa.array(found, mask=~given)

    return nearest_centre(field)
