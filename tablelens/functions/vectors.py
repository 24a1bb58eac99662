"""Vector similarity as column expressions, and random-hyperplane signatures."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tablelens.plans.runtime import ship_package

METRICS = ("cosine", "dot_product", "l2_norm")


def _sum_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum_of(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def literal_vector(vector: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in vector])


def similarity(field: Column, vector: Column, metric: str = "cosine") -> Column:
    """Raw similarity; for ``l2_norm`` the distance."""
    if metric == "dot_product":
        return dot(field, vector)
    if metric == "l2_norm":
        return F.sqrt(_sum_of(F.zip_with(field, vector, lambda x, y: F.pow(x.cast("double") - y, F.lit(2)))))
    if metric == "cosine":
        return dot(field, vector) / F.sqrt(dot(field, field) * dot(vector, vector))
    raise ValueError(f"unknown metric: {metric}; use one of {', '.join(METRICS)}")


def settled(values: np.ndarray) -> np.ndarray:
    """Without the last digits, which depend on the batch: equal vectors tie, and the id decides."""
    return np.round(values, 12)


def similarity_to(field: Column, vector: Sequence[float], metric: str = "cosine") -> Column:
    """:func:`similarity` with a fixed vector, one matrix product per batch; the column has no nulls.

    About seven times faster than the same sum as a column expression.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric: {metric}; use one of {', '.join(METRICS)}")
    ship_package()
    query = np.asarray(vector, dtype=np.float64)

    @F.arrow_udf("double")
    def compare(vectors: pa.Array) -> pa.Array:
        rows = stack(vectors, len(query))
        if metric == "l2_norm":
            return pa.array(settled(np.linalg.norm(rows - query, axis=1)))
        raw = rows @ query
        if metric == "cosine":
            raw = raw / (np.linalg.norm(rows, axis=1) * np.linalg.norm(query))
        return pa.array(settled(raw))

    # Non-deterministic only so that a threshold on the result does not compute it twice.
    return compare.asNondeterministic()(field)


def score(raw: Column, metric: str = "cosine") -> Column:
    """Similarity as a non-negative score that grows with closeness."""
    if metric == "l2_norm":
        return 1 / (1 + raw * raw)
    return (1 + raw) / 2


def within(raw: Column, threshold: float, metric: str = "cosine") -> Column:
    return raw <= threshold if metric == "l2_norm" else raw >= threshold


def hyperplanes(dim: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, bits))


def stack(vectors: pa.Array, dim: int) -> np.ndarray:
    """A list column as a dense matrix, without a Python object per row."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), dim)


def signature(col: Column, dim: int, bits: int = 62, seed: int = 7) -> Column:
    """Side of each random hyperplane, one bit per plane (Charikar 2002)."""
    if not 0 < bits < 64:
        raise ValueError("bits must be between 1 and 63")
    ship_package()
    weights = (1 << np.arange(bits)).astype(np.int64)

    @F.arrow_udf("long")
    def sign_bits(vectors: pa.Array) -> pa.Array:
        sides = stack(vectors, dim) @ hyperplanes(dim, bits, seed) >= 0
        return pa.array(sides @ weights, pa.int64())

    return sign_bits(col)


def vector_signature(vector: Sequence[float], bits: int = 62, seed: int = 7) -> int:
    sides = np.asarray(vector, dtype=np.float64) @ hyperplanes(len(vector), bits, seed) >= 0
    return int(sides @ (1 << np.arange(bits)).astype(np.int64))


def hamming(signatures: Column, other: Column | int) -> Column:
    other = F.lit(other) if isinstance(other, int) else other
    return F.bit_count(signatures.bitwiseXOR(other))
