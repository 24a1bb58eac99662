"""Ranked lexical search by scanning the texts: no index of the documents is built or kept.

All terms of the asked items stand in one Aho-Corasick automaton, each guarded by a boundary sign on
both sides, so that only whole words are found however many terms overlap.  It is broadcast, and a task runs its
texts through it once for the corpus counts (documents, terms, documents that hold a term) and once
for the scores.  What the automaton finds is mapped to the items that ask for the term, and a task hands on no
more than its best documents of each item.

Items are searched in blocks of bounded size, each block against all documents, so the
automaton does not grow with the number of items.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelens.llm.common import prepared, texts
from tablelens.plans.runtime import written

#: Bytes of distinct (item, term) rows and number of items of a block; one larger item is a block of its own.
BLOCK_BYTES, BLOCK_ITEMS = 4 << 20, 1 << 14
#: Cells of the score matrix and (document, term, item) rows that a task scores at once.
CELLS = 1 << 21
#: Parts in which the tasks' best documents of an item are ranked before the last ranking.
SALTS = 64

#: What is no term: ASCII but for letters and digits.
NO_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GUARD = b"\n"
FOLD = bytes(
    c if chr(c).isalnum() or c > 127 else GUARD[0] for c in bytes(range(128)).lower() + bytes(range(128, 256))
)


def terms_of(text: str | Column) -> Column:
    """Terms of a text with repeats: A-Z in lower case, cut at ASCII signs that are no letter or digit."""
    column = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.translate(F.coalesce(column, F.lit("")), UPPER, LOWER), NO_TERM), lambda t: t != "")


def folded(text: str) -> bytes:
    """The text's bytes in lower case, every separator as the guard."""
    return text.encode().translate(FOLD)


def term_count(data: bytes) -> int:
    inside = np.frombuffer(data, np.uint8) != GUARD[0]
    return int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(inside[:1].sum())


class Terms:
    """A block of items for the workers: the automaton of their terms, and which items ask for a term."""

    def __init__(self, asked: list[list[str]]):
        numbers: dict[str, int] = {}
        holders: list[list[int]] = []
        for item, terms in enumerate(asked):
            for term in terms:
                k = numbers.setdefault(term, len(numbers))
                if k == len(holders):
                    holders.append([])
                holders[k].append(item)
        self.automaton = ahocorasick.Automaton()
        for term, k in numbers.items():
            # one character a byte: the guards and all letters of any script are bytes
            self.automaton.add_word((GUARD + term.encode() + GUARD).decode("latin-1"), k)
        if numbers:
            self.automaton.make_automaton()
        self.size, self.n_items = len(numbers), len(asked)
        self.lengths = np.array([len(h) for h in holders], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))[:-1].astype(np.int64) if holders else self.lengths
        self.items = np.array([i for h in holders for i in h], np.int64)

    def counts(self, data: bytes) -> Counter:
        """Occurrences of each term in a folded text."""
        if not self.size:
            return Counter()
        return Counter(map(itemgetter(1), self.automaton.iter((GUARD + data + GUARD).decode("latin-1"))))


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Best:
    """The ``most`` best documents of each item: higher score first, then smaller id, null ids last."""

    def __init__(self, items: int, most: int):
        self.most, self.floor = most, np.ones(items, np.int64)
        self.held, self.size = [], 0

    def add(self, ids: np.ndarray, null: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` has a row per document and a column per item."""
        row, item = np.nonzero(scores >= self.floor)
        if len(row):
            self.held.append((item, scores[row, item], null[row], ids[row]))
            self.size += len(row)
            if self.size > 4 * self.most * max(len(self.floor), 64):
                self.prune()

    def prune(self) -> tuple[np.ndarray, ...]:
        columns = [np.concatenate(c) for c in zip(*self.held, strict=True)] if self.held else [np.empty(0, np.int64)] * 4
        item, score, null, ids = columns
        order = np.lexsort((ids, null, -score, item))
        item = item[order]
        first = np.searchsorted(item, item, "left")
        place = np.arange(len(item)) - first
        last = order[place == self.most - 1]
        self.floor[columns[0][last]] = columns[1][last]
        order = order[place < self.most]
        kept = tuple(c[order] for c in columns)
        self.held, self.size = [kept], len(order)
        return kept


def item_blocks(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, int]:
    """(block, item_id, terms) and the number of blocks; rows of one item are one item with all their terms."""
    rows = items.select(F.col(f"`{item_id}`").alias("item_id"), F.explode(terms_of(F.col(f"`{text}`"))).alias("term")).distinct()
    found = written(rows.groupBy("item_id").agg(F.collect_list("term").alias("terms")), "items")
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 8)
    found = found.withColumn("size", size)
    total, count = found.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).head()
    blocks = max(1, -(-total // BLOCK_BYTES), -(-count // BLOCK_ITEMS)) if count else 0
    while blocks:
        block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block")
        full = found.groupBy(block).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        crowded = (F.col("n") > 1) & ((F.col("bytes") > 2 * BLOCK_BYTES) | (F.col("n") > 2 * BLOCK_ITEMS))
        if not full.filter(crowded).head(1):
            return found.select(block, "item_id", "terms"), blocks
        blocks *= 2
    return found.select(F.lit(0).alias("block"), "item_id", "terms"), 0


def corpus_counts(rows: DataFrame, terms) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each term of a broadcast block."""
    schema = pa.schema([("term", pa.int32()), ("n", pa.int64())])

    def count(batches):
        block = terms.value
        holding, documents, length = np.zeros(block.size, np.int64), 0, 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                data = folded(t)
                n = term_count(data)
                documents, length = documents + (n > 0), length + n
                found = block.counts(data)
                holding[np.fromiter(found, np.int64, len(found))] += 1
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate((some, [-1, -2])), pa.int32()), pa.array(np.concatenate((holding[some], [documents, length])), pa.int64()),
        ], schema=schema)

    summed = rows.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(summed.column(0).to_pylist(), summed.column(1).to_pylist(), strict=True))
    holding = np.zeros(terms.value.size, np.int64)
    for term, n in found.items():
        if term >= 0:
            holding[term] = n
    return found.get(-1, 0), found.get(-2, 0), holding


def scored(rows: DataFrame, terms, documents: int, length: int, weights: np.ndarray, most: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents of each item of the block."""
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def score(batches):
        block = terms.value
        best = Best(block.n_items, most)
        most_rows = max(1, CELLS // max(block.n_items, 1))
        ids, null, where, term, part, pending = [], [], [], [], [], 0

        def flush():
            nonlocal pending
            if ids:
                t, n = np.concatenate(term), np.concatenate([np.full(len(x), i) for i, x in zip(where, term, strict=True)])
                lengths = block.lengths[t]
                # the t-th term's items, one row each
                at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                items = block.items[np.repeat(block.starts[t], lengths) + at]
                cells = np.zeros((len(ids), block.n_items), np.int64)
                np.add.at(cells.reshape(-1), np.repeat(n, lengths) * block.n_items + items, np.repeat(np.concatenate(part), lengths))
                best.add(np.array([i or 0 for i in ids], np.int64), np.array(null), cells)
            for held in (ids, null, where, term, part):
                held.clear()
            pending = 0

        for batch in batches:
            for doc_id, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = folded(t)
                found = block.counts(data)
                if not found:
                    continue
                k = np.fromiter(found.keys(), np.int64, len(found))
                tf = np.fromiter(found.values(), np.int64, len(found))
                m = 100 - 50 + (50 * term_count(data) * documents) // length
                where.append(len(ids))
                ids.append(doc_id)
                null.append(doc_id is None)
                term.append(k)
                part.append(weights[k] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m)))
                pending += int(block.lengths[k].sum())
                if pending >= CELLS or len(ids) >= most_rows:
                    flush()
        flush()
        item, scores, empty, found = best.prune()
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(found, pa.int64(), mask=empty.astype(bool)), pa.array(scores, pa.int64())], schema=schema)

    return rows.mapInArrow(score, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, limit: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``limit`` best documents of each item, scores above 0 only.

    Null and empty texts have no terms: such documents are never found and count nowhere, such items
    have no rows.  Repeated document rows are documents of their own; rows of one item_id, null included,
    are one item with the terms of all.  Equal scores go by ascending doc_id, null last.  An empty table on either
    side gives no rows.
    """
    kind = items.schema[item_id].dataType.simpleString()
    rows = prepared(texts(docs, doc_id, text))
    held, blocks = item_blocks(items, item_id, item_text)
    spark, found = docs.sparkSession, []
    for block in range(blocks):
        asked = held.filter(F.col("block") == block).toArrow()  # of bounded size
        if not asked.num_rows:
            continue
        terms = spark.sparkContext.broadcast(Terms(asked.column("terms").to_pylist()))
        documents, length, holding = corpus_counts(rows, terms)
        weights = np.array([weight(documents, int(n)) for n in holding], np.int64)
        names = spark.createDataFrame(list(enumerate(asked.column("item_id").to_pylist())), f"item int, item_id {kind}")
        best = scored(rows, terms, documents, length, weights, limit)
        # an item's rows of all tasks are cut in parts first
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item", salt).orderBy(*order))).filter(F.col("rank") <= limit)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= limit)
        found.append(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
