"""Substring duplicates: windows of words that an earlier document has too.

Every window of ``width`` words gets a Rabin-Karp hash.  A task first settles windows that occur
in several of its own documents, so a hash leaves a chunk of documents once however often it
occurs there, and a passage of a third of all rows stays small.  The rest is shuffled by hash
range as packed arrays (about 8 bytes a window); each range says which windows have a smaller
document id elsewhere.  Positions found either way are dealt by id and text together, so that copies of one
text spread over all tasks, and merge into maximal intervals.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import (
    filter_bit, filter_bitmap, has_bit, mixed, prepared, rolling_hashes, runs, split_words, text_key, texts, word_hashes,
)
from tablelens.plans.runtime import written

WIDTH = 13
#: Windows of a chunk of documents that a task settles in memory, and characters of text per hash range.
CHUNK = 1 << 19
RANGE_CHARS = 1 << 23
NO_ID = np.iinfo(np.int64).max

#: Rows of a range: windows still to be compared, or (settled) the lost positions of one document.
_MARKS = pa.schema([("part", pa.int32()), ("settled", pa.bool_()), ("doc_id", pa.int64()), ("key", pa.int64()), ("packed", pa.binary())])
_MARKS_SQL = "part int, settled boolean, doc_id long, key long, packed binary"
#: Bytes of the batches that a task hands out, and hash ranges whose lost windows meet in one slice of documents.
OUT_BYTES = 1 << 20
RANGES_PER_SLICE = 8


def _ids(column) -> np.ndarray:
    """Null ids come after all others, so they never make another document lose words."""
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _by_document(docs: np.ndarray, positions: np.ndarray):
    """(document index, its positions) of parallel arrays."""
    order = np.argsort(docs, kind="stable")
    docs, positions = docs[order], positions[order]
    cuts = np.flatnonzero(docs[1:] != docs[:-1]) + 1
    for d, p in zip(docs[np.concatenate(([0], cuts))] if len(docs) else [], np.split(positions, cuts), strict=False):
        yield int(d), p


def dealt(ids: np.ndarray, keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each document, by its id and text: copies of a text have one key, but not one id."""
    spread = mixed(mixed(keys.astype(np.int64).view(np.uint64)) + ids.astype(np.int64).view(np.uint64))
    return (spread % np.uint64(parts)).astype(np.int64)


def settle(hashes: np.ndarray, docs: np.ndarray, ids: np.ndarray):
    """Windows that have an equal one in a document of a smaller id, and the others by hash.

    Returns two index arrays: the settled windows, and in order of hash those of the smallest id of each hash
    (which may still lose to another chunk).
    """
    if not len(hashes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(hashes)
    h, owner = hashes[order], ids[docs[order]]
    starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    least = np.repeat(np.minimum.reduceat(owner, starts), np.diff(np.append(starts, len(h))))
    lost = owner > least
    return order[lost], order[~lost]


class _Chunk:
    """Windows of consecutive documents of one task."""

    def __init__(self, width: int, ranges: int):
        self.width, self.ranges = width, ranges
        self.reset()

    def reset(self):
        self.ids, self.keys, self.hashes, self.n, self.held = [], [], [], 0, set()

    def add(self, doc_id: int, key: int, text: str):
        if (doc_id, key) in self.held:  # a repeated row, or a copy without an id, loses what the first one loses
            return
        h = rolling_hashes(word_hashes(text), self.width)
        if len(h):
            self.ids.append(doc_id)
            self.keys.append(key)
            self.hashes.append(h)
            self.n += len(h)
            self.held.add((doc_id, key))

    def rows(self):
        if not self.n:
            return
        lengths = np.array([len(h) for h in self.hashes], np.int64)
        ids, keys, hashes = np.array(self.ids, np.int64), np.array(self.keys, np.int64), np.concatenate(self.hashes)
        self.hashes = []
        starts = np.cumsum(lengths) - lengths
        docs = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        lost, carriers = settle(hashes, docs, ids)
        parts = dealt(ids, keys, self.ranges)
        for d, at in _by_document(docs[lost], lost):
            yield int(parts[d]), True, int(ids[d]), int(keys[d]), (at - starts[d]).astype("<u4").tobytes()
        h, d = hashes[carriers], docs[carriers]
        cuts = np.searchsorted(range_of(h, self.ranges), np.arange(self.ranges + 1))
        for k in range(self.ranges):
            a, b = cuts[k], cuts[k + 1]
            if a < b:
                used = np.unique(d[a:b])
                yield k, False, 0, 0, packed(h[a:b], carriers[a:b], ids[used], keys[used], starts[used])
        self.reset()


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Ascending with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)


def packed(h: np.ndarray, at: np.ndarray, ids: np.ndarray, keys: np.ndarray, starts: np.ndarray) -> bytes:
    """Hashes in order and the windows' places in their chunk, as planes of 16 bits (the high ones compress
    well), with ids, text keys and first places of the documents they come from."""
    planes = [(h >> np.uint64(s)).astype("<u2") for s in (48, 32, 16, 0)]
    places = at.astype("<u4")
    planes += [(places >> np.uint32(16)).astype("<u2"), places.astype("<u2")]
    head = np.array([len(h), len(ids)], "<u4")
    return b"".join(x.tobytes() for x in (head, ids.astype("<i8"), keys.astype("<i8"), starts.astype("<u4"), *planes))


def unpacked(data: bytes):
    """Hashes, document indexes, positions in the document, ids, keys."""
    n, m = np.frombuffer(data, "<u4", 2).tolist()
    at = 8

    def take(kind: str, count: int):
        nonlocal at
        found = np.frombuffer(data, kind, count, at)
        at += found.nbytes
        return found

    ids, keys, starts = take("<i8", m), take("<i8", m), take("<u4", m)
    h = np.zeros(n, np.uint64)
    for s in (48, 32, 16, 0):
        h |= take("<u2", n).astype(np.uint64) << np.uint64(s)
    places = take("<u2", n).astype(np.uint32) << np.uint32(16)
    places |= take("<u2", n)
    docs = (np.searchsorted(starts, places, "right") - 1).astype(np.int32)
    return h, docs, places - starts[docs], ids, keys


def repeated_windows(rows: DataFrame, width: int) -> DataFrame:
    """(doc_id, key, sorted packed positions) of windows that start in a smaller document too.

    One row per document; ``rows`` are (doc_id, text, key).
    """
    chars = rows.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).head()[0]
    ranges = max(16, -(-chars // RANGE_CHARS))

    def windows(batches):
        chunk, held, size = _Chunk(width, ranges), [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), _MARKS, strict=True)], schema=_MARKS)

        def rows_of():
            for b in batches:
                for doc_id, key, text in zip(_ids(b.column(0)).tolist(), b.column(2).to_pylist(), b.column(1).to_pylist(), strict=True):
                    chunk.add(doc_id, key, text)
                    if chunk.n >= CHUNK:
                        yield from chunk.rows()
            yield from chunk.rows()

        for row in rows_of():
            held.append(row)
            size += len(row[4])
            if size >= OUT_BYTES:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    slices = max(16, ranges // RANGES_PER_SLICE)

    def winners(table: pa.Table) -> pa.Table:
        """The lost windows of a hash range, by slice of documents: carriers of a chunk are the smallest
        there, the smallest of all is what counts; settled windows pass."""
        done = table.filter(table.column("settled"))
        ids, keys, docs, positions, at = [], [], [], [], 0
        if done.num_rows:
            held = [np.frombuffer(x.as_py(), "<u4") for x in done.column("packed")]
            ids.append(done.column("doc_id").to_numpy())
            keys.append(done.column("key").to_numpy())
            docs.append(np.repeat(np.arange(len(held), dtype=np.int32), [len(x) for x in held]))
            positions.append(np.concatenate(held))
            at = len(held)
        parts, base = [], at
        for value in table.filter(pc.invert(table.column("settled"))).column("packed"):
            h, d, p, i, k = unpacked(value.as_py())
            parts.append((h, d + np.int32(at - base), p))
            ids.append(i)
            keys.append(k)
            at += len(i)
        if parts:
            h, d, p = (np.concatenate(x) for x in zip(*parts, strict=True))
            parts.clear()
            lost, _ = settle(h, d, np.concatenate(ids[1:] if base else ids))
            docs.append(d[lost] + np.int32(base))
            positions.append(p[lost])
        rows = list(sliced(*(np.concatenate(x) for x in (ids, keys, docs, positions)), slices)) if docs else []
        return pa.table({"slice": pa.array([r[0] for r in rows], pa.int32()), "packed": pa.array([r[1] for r in rows], pa.binary())})

    def by_document(table: pa.Table) -> pa.Table:
        """The lost windows of a slice of documents, one row per document."""
        ids, keys, positions = (np.concatenate(x) for x in zip(*[unsliced(x.as_py()) for x in table.column("packed")], strict=True))
        order = np.lexsort((positions, keys, ids))
        ids, keys, positions = ids[order], keys[order], positions[order].astype("<u4")
        starts = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))))
        held = [x.tobytes() for x in np.split(positions, starts[1:])]
        return pa.table({"doc_id": pa.array(ids[starts], pa.int64()), "key": pa.array(keys[starts], pa.int64()), "packed": pa.array(held, pa.binary())})

    marks = prepared(rows).select("doc_id", "text", "key").mapInArrow(windows, _MARKS_SQL)
    lost = marks.groupBy("part").applyInArrow(winners, "slice int, packed binary")
    return lost.groupBy("slice").applyInArrow(by_document, "doc_id long, key long, packed binary")


def sliced(ids: np.ndarray, keys: np.ndarray, docs: np.ndarray, positions: np.ndarray, slices: int):
    """(slice, packed documents with their positions): documents are dealt by their id and text."""
    order = np.argsort(docs, kind="stable")
    docs, positions = docs[order], positions[order]
    used, counts = np.unique(docs, return_counts=True)
    part = dealt(ids[used], keys[used], slices)
    order = np.argsort(part, kind="stable")
    starts = np.cumsum(counts) - counts
    cuts = np.searchsorted(part[order], np.arange(slices + 1))
    for k in range(slices):
        mine = order[cuts[k] : cuts[k + 1]]
        if len(mine):
            where = np.repeat(starts[mine] - (np.cumsum(counts[mine]) - counts[mine]), counts[mine]) + np.arange(counts[mine].sum())
            columns = (np.array([len(mine)], "<u4"), ids[used[mine]].astype("<i8"), keys[used[mine]].astype("<i8"), counts[mine].astype("<u4"), positions[where].astype("<u4"))
            yield k, b"".join(x.tobytes() for x in columns)


def unsliced(data: bytes):
    """Document id, text key and position of each lost window."""
    m = int(np.frombuffer(data, "<u4", 1)[0])
    ids, keys = np.frombuffer(data, "<i8", m, 4), np.frombuffer(data, "<i8", m, 4 + 8 * m)
    counts = np.frombuffer(data, "<u4", m, 4 + 16 * m)
    return np.repeat(ids, counts), np.repeat(keys, counts), np.frombuffer(data, "<u4", -1, 4 + 20 * m)


def _answers(docs: DataFrame, width: int, doc_id: str, text: str, schema: pa.Schema, shape: str, answer) -> DataFrame:
    """Rows (doc_id, *answer(text, intervals to remove)), one per input row."""
    rows = texts(docs, doc_id, text).withColumn("key", text_key())
    marks = written(repeated_windows(rows, width), "marks")
    bitmap = rows.sparkSession.sparkContext.broadcast(filter_bitmap(marks, "key"))

    def batch_of(ids, found):
        columns = list(zip(*found, strict=True)) or [()] * (len(schema) - 1)
        return pa.RecordBatch.from_arrays([ids, *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]], schema=schema)

    def bare(batches):
        """Documents that lose nothing are answered where they lie."""
        for batch in batches:
            if batch.num_rows:
                mine = batch.filter(pa.array(~has_bit(bitmap.value, batch.column(2).to_numpy())))
                yield batch_of(mine.column(0), [answer(t, []) for t in mine.column(1).to_pylist()])

    def touched(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(has_bit(bitmap.value, batch.column(3).to_numpy())))

    def merged(batches):
        for batch in batches:
            found = []
            for t, positions in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found.append(answer(t, runs(np.frombuffer(positions or b"", "<u4").astype(np.int64), width)))
            yield batch_of(batch.column(0), found)

    untouched = prepared(rows.select("doc_id", "text", filter_bit("key").alias("bit"))).mapInArrow(bare, shape)
    candidates = rows.select("doc_id", "text", "key", filter_bit("key").alias("bit")).mapInArrow(touched, "doc_id long, text string, key long, bit int")
    joined = candidates.withColumn("id", F.coalesce("doc_id", F.lit(int(NO_ID)))).join(marks.withColumnsRenamed({"doc_id": "id"}), ["id", "key"], "left")
    return untouched.unionByName(joined.select("doc_id", "text", "packed").mapInArrow(merged, shape))


def removed_spans(docs: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, spans (array of [start, end) word intervals to remove).

    An interval is a maximal run of words covered by windows whose word sequence also starts in a
    document with a smaller id.  Null and empty texts have no words; a null id loses to every
    other; rows that share an id do not remove each other's words; an empty table gives no rows.
    """
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(span))])
    return _answers(
        docs, width, doc_id, text, schema, "doc_id long, n_words long, spans array<struct<start:int,end:int>>",
        lambda t, cuts: (len(split_words(t)), [{"start": a, "end": b} for a, b in cuts]),
    )


def kept_words(text: str, cuts: list[tuple[int, int]]) -> list[str]:
    words = split_words(text)
    for start, end in reversed(cuts):
        del words[start:end]
    return words


def without_repeats(docs: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text: the kept words of each row, joined by one space."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    return _answers(docs, width, doc_id, text, schema, "doc_id long, text string", lambda t, cuts: (" ".join(kept_words(t, cuts)),))


def kept_digest(docs: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of what ``without_repeats`` keeps) of each row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def answer(t: str, cuts: list[tuple[int, int]]):
        left, removed = kept_words(t, cuts), sum(b - a for a, b in cuts)
        return len(left) + removed, removed, hashlib.sha256(" ".join(left).encode("utf-8", "surrogatepass")).hexdigest()

    return _answers(docs, width, doc_id, text, schema, "doc_id long, n_words long, n_removed long, kept_sha256 string", answer)
