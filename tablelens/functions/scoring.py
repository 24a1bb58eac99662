"""Score arithmetic: BM25, decay curves, field factors, reproducible random order."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

K1, B = 1.2, 0.75


def idf(docs: Column, doc_freq: Column) -> Column:
    return F.log(1 + (docs - doc_freq + 0.5) / (doc_freq + 0.5))


def bm25(tf: Column, length: Column, avg_length: Column, weight: Column) -> Column:
    norm = K1 * (1 - B + B * length / avg_length)
    return weight * (tf * (K1 + 1)) / (tf + norm)


def _distance(value: Column, origin, offset: float) -> Column:
    return F.greatest(F.abs(value - origin) - offset, F.lit(0.0))


def seconds(col: Column) -> Column:
    """A date or timestamp as seconds, so decay can treat it as a number."""
    return F.unix_micros(col.cast("timestamp")) / 1_000_000.0


def decay(kind: str, value: Column, origin, scale: float, offset: float = 0.0, decay: float = 0.5) -> Column:
    """1.0 within ``offset`` of ``origin``, ``decay`` at ``offset + scale``; a missing value keeps 1.0."""
    d = _distance(value, origin, offset)
    if kind == "gauss":
        curve = F.exp(d * d * (math.log(decay) / (scale * scale)))
    elif kind == "exp":
        curve = F.exp(d * (math.log(decay) / scale))
    elif kind == "linear":
        curve = F.greatest(1 - d * ((1 - decay) / scale), F.lit(0.0))
    else:
        raise ValueError(f"unknown decay function: {kind}")
    return F.coalesce(curve, F.lit(1.0))


def field_factor(col: Column, factor: float = 1.0, missing: float = 1.0) -> Column:
    return F.coalesce(col.cast("double"), F.lit(float(missing))) * factor


def random_score(row_id: Column, seed: int = 0) -> Column:
    """Uniform in [0, 1) and the same on every evaluation, so a retried task cannot reorder rows."""
    bits = F.shiftrightunsigned(F.xxhash64(row_id, F.lit(seed)), 11)
    return bits.cast("double") / float(1 << 53)
