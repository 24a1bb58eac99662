"""Quality scores by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1; unlabelled web text is any row outside the
held-out third.  A small network minimises the non-negative unbiased risk

    prior * E+[l(g)] + max(0, Eu[l(-g)] - prior * E+[l(-g)])

with the sigmoid loss, where the class prior is the share of positives among the labels it may see.
It is fitted on the driver on at most MAX_POSITIVE + MAX_UNLABELLED rows (the smallest hashes of id
and text, a repeated row once), and then scores every whole text in Spark.  Inputs are how often character classes follow
each other and how much words repeat; never labels, language, source or id.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import prepared, text_key, texts

MAX_POSITIVE, MAX_UNLABELLED = 8_000, 16_000
HIDDEN, EPOCHS, BATCH, RATE, SEED = 24, 100, 1024, 4e-3, 7
DEFAULT_PRIOR = 0.5

#: Classes of bytes: runs of one kind of sign that texts mix in different ways.
GROUPS = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:", b"!?", b"'\"`()[]-",
    b"#$%&*", b"|=+<>{}\\/@_^~", bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100)),
]
KINDS = len(GROUPS) + 1
CLASS = np.full(256, KINDS - 1, np.uint8)
for _i, _group in enumerate(GROUPS):
    CLASS[np.frombuffer(_group, np.uint8)] = _i
FEATURES = KINDS * KINDS + 6


def features(text: str) -> np.ndarray:
    """Roots of class-pair shares, and length, repetition and word-length figures."""
    out = np.zeros(FEATURES, np.float32)
    words = text.split()
    n = len(words)
    if n:
        kinds = CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)].astype(np.int64)
        pairs = np.bincount(kinds[:-1] * KINDS + kinds[1:], minlength=KINDS * KINDS)
        out[: KINDS * KINDS] = np.sqrt(pairs / max(1, len(kinds) - 1))
        repeats = sum(map(eq, words, words[1:]))
        out[-6:-1] = (np.log1p(n) / 10, len(set(words)) / n, np.sqrt(repeats / n), len(text) / n / 10, np.log1p(n) * len(set(words)) / n / 10)
    out[-1] = n == 0
    return out


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """The third of the ids that no label may be learnt from; a null id is not in it."""
    text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.coalesce(F.pmod(F.crc32(text.cast("binary")), F.lit(3)) == 1, F.lit(False))


class Network:
    """One hidden layer on standardized features."""

    def __init__(self, mean, scale, parameters):
        self.mean, self.scale, self.parameters = mean, scale, parameters

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.parameters
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Network:
    """Adam on the non-negative risk; steps that would make its negative part fall below zero climb back."""
    rng = np.random.default_rng(SEED)
    both = np.concatenate((positive, unlabelled))
    mean, scale = both.mean(0), both.std(0) + 1e-2
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    width = p.shape[1]
    parameters = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(())]
    first, second = [np.zeros_like(w) for w in parameters], [np.zeros_like(w) for w in parameters]
    steps, step = max(1, len(u) // BATCH), 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for xp, xu in zip(np.array_split(p[rng.permutation(len(p))], min(steps, len(p))), np.array_split(u[rng.permutation(len(u))], min(steps, len(p))), strict=True):
            a, b, c, d = parameters
            x = np.concatenate((xp, xu))
            hidden = np.tanh(x @ a + b)
            s = 1 / (1 + np.exp(-np.clip(hidden @ c + d, -30, 30)))
            slope, k = s * (1 - s), len(xp)
            # loss of calling a row positive is 1 - s, negative s
            negative = s[k:].mean() - prior * s[:k].mean()
            grad = np.zeros(len(x))
            if negative >= 0:
                grad[:k] = -2 * prior * slope[:k] / k
                grad[k:] = slope[k:] / len(xu)
            else:
                grad[:k] = prior * slope[:k] / k
                grad[k:] = -slope[k:] / len(xu)
            back = np.outer(grad, c) * (1 - hidden**2)
            grads = [x.T @ back + 1e-4 * a, back.sum(0), hidden.T @ grad + 1e-4 * c, grad.sum()]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                parameters[i] = parameters[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Network(mean, scale, parameters)


def _sample_features(rows: DataFrame, pool: DataFrame, most: int) -> np.ndarray:
    """Features of at most ``most`` distinct rows of the pool (doc_id, key), those of the smallest hashes, in a fixed order."""

    def compute(batches):
        done = set()  # at most ``most``
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            found = []
            for doc_id, key, t in zip(ids, keys, batch.column(1).to_pylist(), strict=True):
                if (doc_id, key) not in done:
                    done.add((doc_id, key))
                    found.append((doc_id, key, features(t).tobytes()))
            if found:
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "key", "packed"])

    names = pool.distinct().orderBy(F.xxhash64("doc_id", "key"), "doc_id", "key").limit(most)
    chosen = rows.join(F.broadcast(names), ["doc_id", "key"], "left_semi").select("doc_id", "text", "key")
    packed = chosen.mapInArrow(compute, "doc_id long, key long, packed binary")
    once = packed.groupBy("doc_id", "key").agg(F.first("packed").alias("packed"))
    found = sorted((r["doc_id"], r["key"], bytes(r["packed"])) for r in once.collect())
    return np.array([np.frombuffer(x, np.float32) for *_, x in found], np.float64).reshape(-1, FEATURES)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> Network | None:
    """The fitted network; None when there is no trusted positive or no other row to learn from."""
    rows = prepared(texts(docs, doc_id, text)).withColumn("key", text_key()).filter(F.col("doc_id").isNotNull() & ~held_out())
    known = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{quality}`").alias("quality"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    prior = known.agg(F.avg((F.col("quality") == 1).cast("double"))).head()[0]
    pool = rows.select("doc_id", "key")
    trusted = known.filter("quality = 1").select("doc_id").distinct()
    positive = _sample_features(rows, pool.join(trusted, "doc_id", "left_semi"), MAX_POSITIVE)
    unlabelled = _sample_features(rows, pool, MAX_UNLABELLED)
    if not len(positive) or not len(unlabelled):
        return None
    return fit(positive, unlabelled, min(max(prior if prior is not None else DEFAULT_PRIOR, 0.05), 0.95))


def score(docs: DataFrame, network: Network | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Null and empty texts score 0 (there is nothing to keep); without a network every other text
    scores 0.5; repeated rows are scored each; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(network)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def scored(batches):
        for batch in batches:
            held = batch.column(1).to_pylist()
            if not held:
                continue
            x = np.stack([features(t) for t in held]).astype(np.float64)
            s = model.value.score(x) if model.value else np.full(len(held), 0.5)
            s = np.where(x[:, -1] > 0, 0.0, s)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], schema=schema)

    rows = prepared(texts(docs, doc_id, text)).select("doc_id", "text", held_out().alias("held_out"))
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def without_rejected(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with a score of 0.5 or more, columns as they came; texts are scored where they lie, nothing is shuffled."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, doc_id, text))
    schema, at = docs.schema, docs.columns.index(text)

    def kept(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([features(t or "") for t in batch.column(at).to_pylist()]).astype(np.float64)
            s = model.value.score(x) if model.value else np.full(len(x), 0.5)
            yield batch.filter(pa.array((s >= 0.5) & (x[:, -1] == 0)))

    return prepared(docs).mapInArrow(kept, schema)
