"""Helpers that the operators of this package share.

Rules that hold for every operator here: a null text counts as an empty one, extra columns of the
input are ignored, an empty table gives an empty result, and a repeated row is answered once per
occurrence.  Documents are addressed by ``document_key``: the id together with a hash of the text,
so rows that share an id but not a text are never mixed up.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelens.plans.runtime import ship_package

#: ASCII white space: the separators of words in every contract of this package.
SPACES = " \t\n\x0b\x0c\r"
#: Bits of the fixed-size filter that keeps most rows out of a shuffle.
FILTER_BITS = 1 << 24
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

def prepared(df: DataFrame) -> DataFrame:
    """Ready for Python workers: the package is shipped, and batches are cut by bytes as well as by rows."""
    ship_package()
    df.sparkSession.conf.set(BATCH_BYTES, str(4 << 20))
    return df


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and whole text, null as empty."""
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def text_key(text: str | Column = "text") -> Column:
    return F.xxhash64(text)


def split_words(text: str) -> list[str]:
    """Maximal runs of anything but ASCII white space."""
    for c in SPACES[1:]:
        if c in text:
            text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the whole hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD_BASE = 0xD6E8FEB86659FD93
_WORD_INVERSE = pow(_WORD_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 14), base, np.uint64)
        held[0] = 1
        held = _powers[base] = np.multiply.accumulate(held)
    return held[:n]


_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES.encode())] = True
#: Bytes hashed at once, so that long texts need little memory besides their word hashes.
SEGMENT = 1 << 20


def word_hashes(text: str, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word (run of anything but ASCII white space); ``lower`` folds A-Z first.

    A word's hash is the sum of its bytes times powers of a base, from one running sum over the text.
    """
    data = text.encode("utf-8", "surrogatepass")
    data = data.lower() if lower else data  # of bytes: A-Z only
    if len(data) <= SEGMENT:
        return _word_hashes(data)
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        found.append(_word_hashes(data[at:end]))
        at = end
    return np.concatenate(found)


def _word_hashes(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    space = np.ones(len(b) + 2, np.int8)
    space[1:-1] = _SPACE[b]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b + np.uint64(1)) * _power(_WORD_BASE, len(b)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power(_WORD_INVERSE, len(b) + 1)[starts])


def rolling_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of each window of ``width`` word hashes, modulo 2^64, from one prefix sum.

    With S the running sum of h[i] * B^-i, the window at i has (S[i + width] - S[i]) * B^i.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes * _power(_INVERSE, len(hashes)), dtype=np.uint64)))
    return mixed((sums[width:] - sums[:-width]) * _power(_BASE, n))


def runs(positions: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Sorted window starts merged into maximal intervals [start, end)."""
    if not len(positions):
        return []
    cuts = np.flatnonzero(np.diff(positions) > width) + 1
    starts = positions[np.concatenate(([0], cuts))]
    ends = positions[np.concatenate((cuts - 1, [len(positions) - 1]))] + width
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def filter_bitmap(keys: DataFrame, column: str, hashed: bool = False) -> np.ndarray:
    """A bit for each value's hash: FILTER_BITS bits whatever the input, so 2 MB reach the driver.

    Used to keep rows that cannot match out of a shuffle; an exact join always follows.  ``hashed``
    says that the values are hashes themselves; their lowest bits are taken, see ``hash_bits``.
    """
    bit = F.pmod(F.col(column) if hashed else F.xxhash64(column), F.lit(FILTER_BITS))
    rows = (
        keys.select(bit.alias("bit"))
        .groupBy(F.expr("bitmap_bucket_number(bit)").alias("part"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS, bool)
    size = 8 * len(rows[0]["bits"]) if rows else 0
    for row in rows:  # at most FILTER_BITS / size rows
        part = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little").astype(bool)
        # value v is bit (v - 1) mod size of bucket 1 + (v - 1) div size; 0 is bit 0 of bucket 0
        if row["part"] == 0:
            bits[0] |= part[0]
            continue
        start = (row["part"] - 1) * size + 1
        bits[start : start + size] |= part[: max(0, min(size, FILTER_BITS - start))]
    return np.packbits(bits)


def filter_bit(column: str) -> Column:
    """The bit that ``filter_bitmap`` sets for a row."""
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)).cast("int")


def hash_bits(hashes: np.ndarray) -> np.ndarray:
    """The bits that ``filter_bitmap`` sets for values that are hashes themselves."""
    return hashes & (FILTER_BITS - 1)


def has_bit(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bitmap[bits >> 3] >> (7 - (bits & 7)).astype(np.uint8)) & 1 > 0
