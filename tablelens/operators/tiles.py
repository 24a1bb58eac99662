"""The best documents of very many weighted queries, without a row for each pair of a query and a document.

The pairs grow with the product of both sides, so they are neither shuffled nor kept: a task multiplies tiles of
documents and queries.  Terms that are frequent on both sides are columns of two matrices, all others are added entry by entry.
Only scores that reach a query's worst kept one are looked at, and a task hands on no more than its best documents of each query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.functions.scoring import bm25
from tablelens.plans.runtime import ship_package, written

#: Queries and their terms that are broadcast at a time; the documents are read once for each such part.
PART_QUERIES, PART_TERMS = 1 << 14, 1 << 19
#: Documents and queries of a tile.
DOCUMENTS, QUERIES = 256, 4096
#: Part of a tile's cells from which a term is a column of its matrices, and columns at most.
DENSE, COLUMNS = 1 / 256, 512
#: Cells that are added one by one at a time.
CELLS = 1 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _entries(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of the list of each value, and the values."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy(zero_copy_only=False)


def _lists(starts: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[starts, len(values)].astype(np.int32)), pa.array(values))


def _changes(ids: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before; nulls are equal."""
    numbers = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.r_[True, numbers[1:] != numbers[:-1]] if len(numbers) else np.zeros(0, bool)


def document_vectors(counts: DataFrame, row_id: str, average: float) -> DataFrame:
    """Written ``(id, codes, parts, times)`` of ``(id, length, code, tf)`` rows: one row an id.

    ``parts`` has a term's score without the query's weight and ``times`` the rows it stands in, both summed over
    the rows of an id.  Rows of a document that follow each other are packed before they are shuffled.
    """
    ship_package()
    counts.sparkSession.conf.set(BATCH_BYTES, str(4 << 20))
    kind = counts.schema[row_id].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(1).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(_changes(batch.column(0)) | np.r_[True, length[1:] != length[:-1]][: len(length)])
            codes, tfs = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            firsts = pa.array(starts)
            columns = [batch.column(0).take(firsts), batch.column(1).take(firsts), _lists(starts, codes), _lists(starts, tfs)]
            yield pa.record_batch(columns, names=[row_id, "length", "codes", "tfs"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by id.  The last id of a batch may go on in the next one."""
        held = None

        def rows(ids: pa.Array, number, code, part, times) -> pa.RecordBatch:
            starts = np.searchsorted(number, np.arange(len(ids)))
            return pa.record_batch([ids, *[_lists(starts, x) for x in (code, part, times)]], names=[row_id, "codes", "parts", "times"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            where, code = _entries(batch.column(2))
            tf = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(float)
            part = bm25(tf, batch.column(1).to_numpy(zero_copy_only=False)[where], average, 1.0)
            times = np.ones(len(code), np.int32)
            if held is not None:
                ids = pa.concat_arrays([held[0], ids])
                where, code = np.r_[np.zeros(len(held[1]), int), where + 1], np.r_[held[1], code]
                part, times = np.r_[held[2], part], np.r_[held[3], times]
            new = _changes(ids)
            number = (np.cumsum(new) - 1)[where]
            order = np.lexsort((code, number))
            number, code = number[order], code[order]
            firsts = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (code[1:] != code[:-1])])
            number, code = number[firsts], code[firsts]
            part, times = np.add.reduceat(part[order], firsts), np.add.reduceat(times[order], firsts, dtype=np.int32)
            ids = ids.take(pa.array(np.flatnonzero(new)))
            last = np.searchsorted(number, len(ids) - 1)
            held = (ids[-1:], code[last:], part[last:], times[last:])
            if len(ids) > 1:
                yield rows(ids[:-1], number[:last], code[:last], part[:last], times[:last])
        if held is not None:
            yield rows(held[0], np.zeros(len(held[1]), int), *held[1:])

    packed = counts.select(row_id, "length", "code", "tf").mapInArrow(pack, f"`{row_id}` {kind}, length int, codes array<long>, tfs array<long>")
    sorted_rows = packed.repartition(row_id).sortWithinPartitions(row_id)
    return written(sorted_rows.mapInArrow(merge, f"`{row_id}` {kind}, codes array<long>, parts array<double>, times array<int>"), "vectors")


class Queries:
    """A part of the queries for the workers: rows of (number of the query, code, weight), and the matches that each needs."""

    def __init__(self, number: np.ndarray, code: np.ndarray, weight: np.ndarray, need: np.ndarray):
        self.codes, term = np.unique(code, return_inverse=True)
        self.width = QUERIES
        order = np.lexsort((term, number // self.width))
        self.number, self.term, self.weight, self.need = number[order], term[order], weight[order], need
        self.tiles = -(-len(need) // self.width)
        self.cuts = np.searchsorted(self.number // self.width, np.arange(self.tiles + 1))

    def known(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The terms of some codes, and which of the codes are a query's."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return at, self.codes[at] == codes


class Tile:
    """Some queries: the matrices of their frequent terms, for every term the queries that have it, and the best documents so far."""

    def __init__(self, queries: Queries, tile: int, most: int, digits: int):
        rows = slice(*queries.cuts[tile : tile + 2])
        self.first = tile * queries.width
        self.number, self.term, self.weight = queries.number[rows] - self.first, queries.term[rows], queries.weight[rows]
        self.need = queries.need[self.first : self.first + queries.width]
        self.starts = np.searchsorted(self.term, np.arange(len(queries.codes) + 1))
        self.lengths = np.diff(self.starts)
        self.shares, self.dense = np.zeros(len(queries.codes)), np.zeros(0, int)
        self.choose(self.shares)
        self.most, self.scale = most, 10.0**digits
        self.floor = np.full(len(self.need), -np.inf)
        self.held: list[tuple] = []
        self.size = 0

    def choose(self, shares: np.ndarray) -> None:
        """The terms that are columns of the matrices, by the part of documents that have each; only the time depends on it."""
        self.shares = np.maximum(self.shares, shares)
        part = self.shares * self.lengths / len(self.need)
        dense = np.flatnonzero((part >= DENSE) & (part > 0))
        dense = np.sort(dense[np.argsort(-part[dense], kind="stable")[:COLUMNS]])
        if len(self.dense) and np.array_equal(dense, self.dense):
            return
        self.dense, self.column = dense, np.full(len(self.lengths), -1)
        self.column[dense] = np.arange(len(dense))
        own = self.column[self.term] >= 0
        at = self.column[self.term[own]], self.number[own]
        self.weights, self.times = np.zeros((len(dense), len(self.need))), np.zeros((len(dense), len(self.need)), np.float32)
        np.add.at(self.weights, at, self.weight[own])
        np.add.at(self.times, at, 1)

    def cells(self, n: int, where: np.ndarray, term: np.ndarray, part: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and matches of n documents (rows) and the queries (columns)."""
        if 2 * self.lengths[term[self.column[term] < 0]].sum() > n * len(self.need):
            self.choose(np.bincount(term, minlength=len(self.lengths)) / n)
        column = self.column[term]
        some = column >= 0
        left, left_times = np.zeros((n, len(self.dense))), np.zeros((n, len(self.dense)), np.float32)
        left[where[some], column[some]] = part[some]
        left_times[where[some], column[some]] = times[some]
        scores, matches = left @ self.weights, left_times @ self.times
        some = ~some & (self.lengths[term] > 0)
        where, term, part, times = where[some], term[some], part[some], times[some].astype(np.float32)
        lengths = self.lengths[term]
        ends = np.cumsum(lengths)
        at = 0
        while at < len(lengths):  # in pieces of about CELLS
            to = max(at + 1, int(np.searchsorted(ends, ends[at] - lengths[at] + CELLS, "right")))
            piece = slice(at, to)
            many, begun = lengths[piece], ends[piece] - lengths[piece]
            row = np.arange(begun[0], ends[to - 1]) + np.repeat(self.starts[term[piece]] - begun, many)
            cell = np.repeat(where[piece] * len(self.need), many) + self.number[row]
            np.add.at(scores.reshape(-1), cell, np.repeat(part[piece], many) * self.weight[row])
            np.add.at(matches.reshape(-1), cell, np.repeat(times[piece], many))
            at = to
        return scores, matches

    def add(self, ids: pa.Array, scores: np.ndarray, matches: np.ndarray) -> None:
        row, query = np.nonzero((scores >= self.floor) & (matches >= self.need))
        if len(row):
            self.held.append((query, scores[row, query], ids.take(pa.array(row))))
            self.size += len(row)
            if self.size > 8 * self.most * max(len(self.need), 64):
                self.prune()

    def prune(self) -> tuple[np.ndarray, np.ndarray, pa.Array] | None:
        """The best so far: higher rounded score first, then smaller id, null before all others."""
        if not self.held:
            return None
        query, score = (np.concatenate([h[k] for h in self.held]) for k in (0, 1))
        ids = pa.concat_arrays([h[2] for h in self.held])
        rounded = np.floor(score * self.scale + 0.5)
        rank = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False)
        order = np.lexsort((rank, -rounded, query))
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        last = order[place == self.most - 1]
        # a little under the rounding step: equal scores may differ in their last digits
        self.floor[query[last]] = (rounded[last] - 0.6) / self.scale
        order = order[place < self.most]
        kept = (query[order], score[order], ids.take(pa.array(order)))
        self.held, self.size = [kept], len(order)
        return kept


def best_documents(vectors: DataFrame, row_id: str, weights: DataFrame, query_id: str, most: int, digits: int) -> DataFrame:
    """``(query, id, _score)``: each task's ``most`` best documents of every query.

    ``weights`` are stored ``(query, code, weight, need)`` rows; a document is found by a query when its matched terms,
    repeated ones included, are at least ``need``.
    """
    spark = vectors.sparkSession
    kinds = [frame.schema[c].dataType.simpleString() for frame, c in ((weights, query_id), (vectors, row_id))]
    schema = f"`{query_id}` {kinds[0]}, `{row_id}` {kinds[1]}, _score double"
    asked, rows = weights.agg(F.count_distinct(F.struct(query_id)), F.count(F.lit(1))).head()
    parts = max(-(-asked // PART_QUERIES), -(-rows // PART_TERMS))
    # a task that reads many documents soon knows which scores are worth a look
    vectors = vectors.coalesce(2 * spark.sparkContext.defaultParallelism)
    found = [_best(vectors, row_id, weights.filter(F.pmod(F.xxhash64(query_id), F.lit(parts)) == part), query_id, most, digits, schema) for part in range(parts)]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def _best(vectors: DataFrame, row_id: str, weights: DataFrame, query_id: str, most: int, digits: int, schema: str) -> DataFrame:
    table = weights.select(query_id, "code", "weight", "need").toArrow()  # of bounded size
    names = pa.concat_arrays(table.column(0).chunks).dictionary_encode(null_encoding="encode")
    number = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    need = np.zeros(len(names.dictionary), np.float32)
    need[number] = table.column(3).to_numpy()
    part = Queries(number, table.column(1).to_numpy(), table.column(2).to_numpy(), need)
    held = vectors.sparkSession.sparkContext.broadcast((part, names.dictionary))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, asked = held.value
        tiles: list[Tile] = []
        for batch in batches:
            for first in range(0, batch.num_rows if queries.tiles else 0, DOCUMENTS):
                ids, codes, parts, times = batch.slice(first, DOCUMENTS).columns
                where, code = _entries(codes)
                term, known = queries.known(code)
                where, term = where[known], term[known]
                part, n = (x.flatten().to_numpy(zero_copy_only=False)[known] for x in (parts, times))
                tiles = tiles or [Tile(queries, k, most, digits) for k in range(queries.tiles)]
                for tile in tiles:
                    tile.add(ids, *tile.cells(len(ids), where, term, part, n))
        for tile in tiles:
            best = tile.prune()
            if best:
                yield pa.record_batch([asked.take(pa.array(best[0] + tile.first)), best[2], pa.array(best[1])], names=[query_id, row_id, "_score"])

    return vectors.mapInArrow(score, schema)
