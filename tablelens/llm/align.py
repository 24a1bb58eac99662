"""Alignment of two tokenizers: which of their tokens stand for the same bytes, and how often over a corpus.

A text is encoded by both tokenizers.  Byte offsets where tokens of both end cut the tokens into groups; every token
of one side is linked with every token of the other in its group.  Neither tokenizer has a token
that goes on with a space or a line feed after other signs, so a text falls into segments at such places, no group
spans two of them, and a worker aligns every distinct segment once.

Texts are aligned once: a task writes each document's numbers, digest and distinct pairs, and next to them its own counts of
pairs (documents that hold a pair linked).  Over the distinct pairs of a hash range a minimal perfect hash is built, so that counts are dense vectors
without keys; vectors of many tasks are summed as a tree.  Next to the vector lie the keys in the order of the hash: a pair is
only answered after its key was compared.  Then the counts of the written documents' pairs are looked up.  Pairs of at least a fixed part of
all counts, a bounded number, are broadcast; all others are looked up where their hash range lies.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.llm.bpe import BYTE_SIGNS, VISIBLE
from tablelens.llm.common import mixed, prepared, texts
from tablelens.plans.runtime import written

#: Hash ranges of pairs; the pairs of two vocabularies of 50,000 and 32,000 are at most 6.3 million in each.
SHARDS = 256
#: Parts of a hash range that are summed or looked up by different tasks.
SALTS = 16
#: Pairs that a task gathers before it hands them on, and pairs expanded at once.
GATHER = 1 << 20
#: Frequent pairs that are broadcast, at most.
FREQUENT = 1 << 18
#: Aligned segments held by a worker, characters of one that is worth holding, of texts cut at a time,
#: and characters up to which a segment is aligned together with others.
HELD, HELD_CHARS, TOGETHER, SHORT = 600_000, 64, 1 << 20, 256

# ---------------------------------------------------------------- tokenizers


@cache
def byte_level(path: str):
    """Tokenizer A of a file, and the bytes of each id."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    signs = {chr(c): c for c in VISIBLE} | {chr(c): b for b, c in BYTE_SIGNS.items()}
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    entries = [tokenizer.id_to_token(i) or "" for i in range(size)]
    return tokenizer, [bytes(signs[c] for c in e) if all(c in signs for c in e) else e.encode() for e in entries]


@cache
def pieces(path: str):
    """Tokenizer B of a file, and the bytes of each id."""
    import sentencepiece

    tokenizer = sentencepiece.SentencePieceProcessor(model_file=path)
    found = []
    for i in range(tokenizer.get_piece_size()):
        piece = tokenizer.id_to_piece(i)
        found.append(bytes([int(piece[3:5], 16)]) if tokenizer.is_byte(i) else piece.replace("▁", " ").encode())
    return tokenizer, found


#: White space of any definition.
_WHITE = r"\s᠎​-‍﻿"
#: From the start on, up to a space or line feed after something else.
_SEGMENT = re.compile(rf"[{_WHITE}]*[^ \n]*(?:(?<=[{_WHITE}])[ \n][{_WHITE}]*[^ \n]*)*")


@cache
def splits(path_a: str, path_b: str) -> bool:
    """Whether no token of either side goes on with a space or line feed after other signs."""
    a, _ = byte_level(path_a)
    steps = json.loads(a.to_str())
    cut = steps["pre_tokenizer"] or {}
    if steps["normalizer"] or cut.get("type") != "ByteLevel" or not cut["use_regex"] or cut["add_prefix_space"] or steps["post_processor"]:
        return False
    b, spelled = pieces(path_b)
    probe = "ﬁ  x́ Ⅳ\n ab "
    if b.normalize(probe) != "▁" + probe.replace(" ", "▁"):
        return False
    return not any(b"\n" in s or re.search(rb"[^ ] ", s) for i, s in enumerate(spelled) if not b.is_byte(i))


# ---------------------------------------------------------------- alignment


class Aligned(NamedTuple):
    """A stretch of text that both tokenizers spell back; ``times`` is None where every key stands for one link."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    text: str
    keys: bytes
    times: bytes | None


def ids_of_b(path: str, stretches: list[str]) -> list[list[int]]:
    """Ids of stretches that start with a space or a line feed, without the space that the tokenizer adds."""
    tokenizer, _ = pieces(path)
    found = tokenizer.encode([s[1:] if s[0] == " " else s for s in stretches], num_threads=1)
    return [x if s[0] == " " else x[1:] if s != " " else x for s, x in zip(stretches, found, strict=True)]


@cache
def ranks(path: str):
    """Tokenizer A as ranks of byte strings, for many words at once; tests hold it against the library.

    Its ids are in the order of its merges, so the lowest id of a joined pair is the next merge.
    """
    import public_tokenizers
    import tiktoken

    spelled = byte_level(path)[1]
    special = set(byte_level(path)[0].get_added_tokens_decoder())
    held = {x: i for i, x in enumerate(spelled) if i not in special}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=held, special_tokens={})


#: Segments that can stand side by side in one text: each token ends where its segment does.
_SIDE_BY_SIDE = re.compile(rf"[ \n][^▁]*[^{_WHITE}▁]").fullmatch


def align_stretches(path_a: str, path_b: str, stretches: list[str]) -> list[Aligned | None]:
    """None where the tokens' bytes are not the text's."""
    (a, bytes_a), (b, bytes_b) = byte_level(path_a), pieces(path_b)
    out: list[Aligned | None] = [None] * len(stretches)
    short = [i for i, s in enumerate(stretches) if len(s) <= SHORT and _SIDE_BY_SIDE(s)] if splits(path_a, path_b) else []
    found = _short(path_a, path_b, [stretches[i] for i in short]) if short else []
    for i, x in zip(short, found, strict=False):
        out[i] = x
    done = set(short) if found else set()
    rest = [i for i in range(len(stretches)) if i not in done]
    blank = [b.piece_to_id("▁")]
    all_a = a.encode_batch_fast([stretches[i] for i in rest], add_special_tokens=False)
    for i, x, y in zip(rest, all_a, ids_of_b(path_b, [stretches[i] for i in rest]), strict=True):
        x, y = x.ids, blank if stretches[i] == " " else y
        spelled_a, spelled_b = [bytes_a[k] for k in x], [bytes_b[k] for k in y]
        if b"".join(spelled_a) == stretches[i].encode() == b"".join(spelled_b):
            out[i] = _long(x, y, spelled_a, spelled_b)
    return out


@cache
def lengths(path: str, of) -> np.ndarray:
    return np.array([len(x) for x in of(path)[1]], np.int64)


@cache
def names(path: str, of) -> list[str]:
    return [str(i) for i in range(len(of(path)[1]))]


def _short(path_a: str, path_b: str, stretches: list[str]) -> list[Aligned]:
    """Many stretches as one text: where one ends, tokens of both sides end, so no group spans two.

    Nothing, if the tokens do not spell this text or a stretch does not end with a token.
    """
    text = "".join(stretches)
    data, ends = text.encode(), np.cumsum([len(s.encode()) for s in stretches])
    list_a, list_b = ranks(path_a).encode_ordinary(text), ids_of_b(path_b, [text])[0]
    bytes_a, bytes_b = byte_level(path_a)[1], pieces(path_b)[1]
    if not b"".join([bytes_a[k] for k in list_a]) == data == b"".join([bytes_b[k] for k in list_b]):
        return []
    a, b = np.array(list_a, np.int64), np.array(list_b, np.int64)
    ends_a, ends_b = np.cumsum(lengths(path_a, byte_level)[a]), np.cumsum(lengths(path_b, pieces)[b])
    at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    if (ends_a[at_a] != ends).any() or (ends_b[at_b] != ends).any():
        return []
    common = ends_a[ends_b[np.searchsorted(ends_b, ends_a)] == ends_a]
    group_a = np.searchsorted(common, ends_a)
    cuts_a, cuts_b = np.searchsorted(ends_a, common, "right"), np.searchsorted(ends_b, common, "right")
    size_a, size_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
    n = size_b[group_a]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat((cuts_b - size_b)[group_a], n)
    keys = ((np.repeat(a, n) << 32) | b[at]).tobytes()
    last = np.searchsorted(common, ends)  # each stretch's last group
    groups = (last + 1).tolist()
    linked = np.cumsum(size_a * size_b)[last].tolist()
    written: list[str] = []
    name_a, name_b, i, j = names(path_a, byte_level), names(path_b, pieces), 0, 0
    x, y = [name_a[k] for k in list_a], [name_b[k] for k in list_b]
    for to_a, to_b in zip(cuts_a.tolist(), cuts_b.tolist(), strict=True):
        left = x[i] if to_a - i == 1 else ",".join(x[i:to_a])
        right = y[j] if to_b - j == 1 else ",".join(y[j:to_b])
        written.append(f"{left}|{right}")
        i, j = to_a, to_b
    n_a, n_b = np.diff(at_a, prepend=-1).tolist(), np.diff(at_b, prepend=-1).tolist()
    out, g, k = [], 0, 0
    for size_x, size_y, to_g, to_k in zip(n_a, n_b, groups, linked, strict=True):
        out.append(Aligned(size_x, size_y, to_g - g, to_k - k, ";".join(written[g:to_g]), keys[8 * k : 8 * to_k], None))
        g, k = to_g, to_k
    return out


def _long(a: list[int], b: list[int], spelled_a: list[bytes], spelled_b: list[bytes]) -> Aligned:
    ends_a, ends_b = (np.cumsum([len(x) for x in s], dtype=np.int64) for s in (spelled_a, spelled_b))
    common = np.intersect1d(ends_a, ends_b)
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    keys, times = links(np.array(a, np.int64), np.array(b, np.int64), group_a, group_b, len(common))
    cuts_a, cuts_b = (np.searchsorted(e, common, "right").tolist() for e in (ends_a, ends_b))
    written, i, j = [], 0, 0
    for x, y in zip(cuts_a, cuts_b, strict=True):
        written.append(f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}")
        i, j = x, y
    return Aligned(len(a), len(b), len(common), int(times.sum()), ";".join(written), keys.tobytes(), times.tobytes())


def links(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs as keys (first id in the upper half) and how often each is linked; at most GATHER are expanded at once."""
    size_a, size_b = (np.bincount(g, minlength=groups) for g in (group_a, group_b))
    parts, cut = Sums(), np.cumsum(size_a * size_b)
    starts_a, starts_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    g = 0
    while g < groups:
        done = int(cut[g - 1]) if g else 0
        to = max(g + 1, int(np.searchsorted(cut, done + GATHER, "right")))
        if to == g + 1 and size_a[g] * size_b[g] > GATHER:
            # one large group: distinct ids of both sides, and rows of their product
            (x, nx), (y, ny) = (np.unique(v[s : s + n], return_counts=True) for v, s, n in ((a, starts_a[g], size_a[g]), (b, starts_b[g], size_b[g])))
            rows = max(1, GATHER // len(y))
            for k in range(0, len(x), rows):
                parts.add(np.add.outer(x[k : k + rows] << 32, y).ravel(), np.multiply.outer(nx[k : k + rows], ny).ravel())
        else:
            first, last = starts_a[g], starts_a[to - 1] + size_a[to - 1]
            group = group_a[first:last]
            n = size_b[group]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts_b[group], n)
            keys = (np.repeat(a[first:last], n) << 32) | b[at]
            parts.add(keys, np.ones(len(keys), np.int64))
        g = to
    return parts.finish()


class Sums:
    """Keys and numbers, summed by key."""

    def __init__(self):
        self.keys, self.numbers, self.size = [], [], 0

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        self.keys.append(keys)
        self.numbers.append(numbers)
        self.size += len(keys)
        if self.size > 2 * GATHER:
            self.finish()
            self.size = len(self.keys[0]) // 2  # grows only as fast as the distinct keys

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate(self.keys) if self.keys else np.empty(0, np.int64)
        numbers = np.concatenate(self.numbers) if self.numbers else np.empty(0, np.int64)
        order = np.argsort(keys, kind="stable")
        keys, numbers = keys[order], numbers[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
        keys, numbers = keys[first], np.add.reduceat(numbers, first) if len(first) else numbers
        self.keys, self.numbers = [keys], [numbers]
        return keys, numbers


class Document:
    """A text's alignment, put together from its segments."""

    __slots__ = ("parts",)

    def __init__(self, parts: list[Aligned]):
        self.parts = parts

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs and how often each is linked."""
        if all([p.times is None for p in self.parts]) and 8 * GATHER > sum([len(p.keys) for p in self.parts]):
            return np.unique(np.frombuffer(b"".join([p.keys for p in self.parts]), np.int64), return_counts=True)
        sums, held, size = Sums(), [], 0
        for p in self.parts:
            if p.times is None:
                held.append(p.keys)
                size += len(p.keys)
            else:
                sums.add(_longs(p.keys), _longs(p.times))
            if size > 8 * GATHER:
                sums.add(*np.unique(_longs(b"".join(held)), return_counts=True))
                held, size = [], 0
        sums.add(*np.unique(_longs(b"".join(held)), return_counts=True))
        return sums.finish()

    def numbers(self) -> list[int]:
        """Tokens of both sides, groups and links."""
        return [sum([p[k] for p in self.parts]) for k in range(4)]

    def digest(self) -> str:
        return hashlib.sha256(";".join([p.text for p in self.parts]).encode()).hexdigest() if self.parts else ""


class Aligner:
    """Aligns texts; distinct segments are encoded once and held, the oldest half is given up when there are too many."""

    def __init__(self, path_a: str, path_b: str):
        self.paths, self.splits = (path_a, path_b), splits(path_a, path_b)
        self.held: dict[str, Aligned | None] = {}

    def documents(self, texts: list[str | None]) -> Iterator[Document]:
        """In order; some texts are cut at a time, and what is new in them is encoded together."""
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (size == 0 or size + len(texts[to] or "") <= TOGETHER):
                size += len(texts[to] or "")
                to += 1
            cut = [([s for s in _SEGMENT.findall(" " + t) if s] if self.splits else [" " + t]) if t else [] for t in texts[at:to]]
            if len(self.held) > HELD:
                for s in list(islice(self.held, len(self.held) // 2)):
                    del self.held[s]
            new = list(set().union(*cut).difference(self.held))
            long = [s for s in new if len(s) > HELD_CHARS]
            for k in range(0, len(new), 4096):
                self.held.update(zip(new[k : k + 4096], align_stretches(*self.paths, new[k : k + 4096]), strict=True))
            for text, x in zip(texts[at:to], cut, strict=True):
                parts = [*map(self.held.__getitem__, x)]
                if None in parts:
                    whole = align_stretches(*self.paths, [" " + text])[0] if len(x) > 1 else None
                    parts = [whole] if whole else []
                yield Document(parts)
            for s in long:  # met once, as a rule
                del self.held[s]
            at = to


# ---------------------------------------------------------------- minimal perfect hash


class Mph:
    """A minimal perfect hash of distinct keys: levels of bits, in which a key's bit is set where no other key of the level meets it.

    A key's number is the count of set bits before its own, over all levels.  Other keys get any number or -1.
    """

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> Mph:
        sizes, words = [], []
        while len(keys):
            size = -(-2 * len(keys) // 64) * 64
            at = cls.place(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            keys = keys[~alone[at]]
        return cls(sizes, np.concatenate(words) if words else np.empty(0, np.uint64))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        found, start = np.full(len(keys), -1, np.int64), 0
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = self.place(keys[left], level, size) + start
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) > 0
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            found[left[hit]] = (self.before[at >> 6] + np.bitwise_count(below).astype(np.int64))[hit]
            left, start = left[~hit], start + size
        return found

    def packed(self) -> bytes:
        return np.array([len(self.sizes), *self.sizes], "<i8").tobytes() + self.words.tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Mph:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", n, 8).tolist()
        return cls(sizes, np.frombuffer(data, np.uint64, offset=8 * (n + 1)))


class Table:
    """Counts by pair: the hash, the keys in its order, and their counts."""

    def __init__(self, mph: Mph, keys: np.ndarray, counts: np.ndarray | None = None):
        self.mph, self.keys, self.counts = mph, keys, counts

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray | None = None) -> Table:
        mph = Mph.of(keys)
        at = mph.numbers(keys)
        ordered = np.empty_like(keys)
        ordered[at] = keys
        if counts is None:
            return cls(mph, ordered)
        moved = np.empty_like(counts)
        moved[at] = counts
        return cls(mph, ordered, moved)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number, -1 for one that is not in the table."""
        at = self.mph.numbers(keys)
        if len(self.keys):
            at[self.keys[at] != keys] = -1
        return at


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """A worker's own, for all its tasks."""
    return Aligner(path_a, path_b)


def shard_of(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys.astype(np.uint64)) % np.uint64(SHARDS)).astype(np.int64)


def by_shard(keys: np.ndarray, numbers: np.ndarray):
    """(hash range, keys, numbers) for each range met."""
    shards = shard_of(keys)
    order = np.argsort(shards, kind="stable")
    shards, keys, numbers = shards[order], keys[order], numbers[order]
    cuts = np.flatnonzero(np.diff(shards)) + 1
    for s, k, n in zip(np.split(shards, cuts), np.split(keys, cuts), np.split(numbers, cuts), strict=True):
        if len(s):
            yield int(s[0]), k, n


# ---------------------------------------------------------------- counting


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _one(schema: pa.Schema, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def pair_type(size_a: int, size_b: int) -> str:
    """Type of a pair's place in the product of both vocabularies."""
    return "<u4" if size_a * size_b <= 1 << 32 else "<u8"


def packed_pairs(keys: np.ndarray, times: np.ndarray, size_b: int, kind: str) -> tuple[bytes, bytes]:
    """A document's pairs as places in the product of both vocabularies, and their links in a byte or eight each."""
    return ((keys >> 32) * size_b + (keys & 0xFFFFFFFF)).astype(kind).tobytes(), times.astype("<u1" if times.max(initial=0) < 256 else "<i8").tobytes()


def unpacked_pairs(pairs: list[bytes], times: list[bytes], size_b: int, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and links of some documents' pairs, and where each document ends."""
    at = np.frombuffer(b"".join(pairs), kind).astype(np.int64)
    sizes = [len(p) // int(kind[2:]) for p in pairs]
    numbers = [np.frombuffer(t, "<u1" if len(t) == n else "<i8") for t, n in zip(times, sizes, strict=True)]
    return (at // size_b << 32) | at % size_b, np.concatenate([np.empty(0, np.int64), *numbers]), np.cumsum(sizes, dtype=np.int64)


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
#: Rows of two kinds: a document, or with a hash range, some pairs that a task counted.
_WRITTEN = pa.schema([
    ("doc_id", pa.int64()), *[(n, pa.int64()) for n in NUMBERS[:4]], ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()),
    ("shard", pa.int32()), ("salt", pa.int32()), ("keys", pa.binary()), ("numbers", pa.binary()),
])
_WRITTEN_SQL = (
    f"doc_id long, {', '.join(f'{n} long' for n in NUMBERS[:4])}, groups_sha256 string, pairs binary, times binary, shard int, salt int, keys binary, numbers binary"
)


def aligned(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Every document's numbers, digest and pairs; and each task's distinct pairs with the number of its documents that hold them."""

    def gather(batches):
        found, sums = aligner(path_a, path_b), Sums()
        size_a, size_b = len(byte_level(path_a)[1]), len(pieces(path_b)[1])
        kind = pair_type(size_a, size_b)
        salt = TaskContext.get().partitionId() % SALTS

        def flush():
            for shard, keys, numbers in by_shard(*sums.finish()):
                yield _one(_WRITTEN, *[None] * 8, shard, salt, keys.tobytes(), numbers.tobytes())
            sums.__init__()

        def batch_of(documents):
            columns = [*zip(*documents, strict=True), *[[None] * len(documents)] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _WRITTEN, strict=True)], schema=_WRITTEN)

        for batch in batches:
            held = []
            for i, document in zip(batch.column(0).to_pylist(), found.documents(batch.column(1).to_pylist()), strict=True):
                keys, times = document.pairs()
                held.append((i, *document.numbers(), document.digest(), *packed_pairs(keys, times, size_b, kind)))
                sums.add(keys, np.ones(len(keys), np.int64))
                if sums.size > 2 * GATHER:
                    yield from flush()
            if held:
                yield batch_of(held)
        yield from flush()

    return written(prepared(rows).select("doc_id", "text").mapInArrow(gather, _WRITTEN_SQL), "aligned")


def _grouped(batches, key):
    """Rows of sorted batches, with whether a row starts a new group."""
    last = None
    for batch in batches:
        for row in batch.to_pylist():
            now = tuple(row[k] for k in key)
            yield now != last, row
            last = now


def pair_counts(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(shard, mph, keys, counts, total): a row per hash range with the documents of each of its pairs."""
    return summed_pairs(aligned(rows, path_a, path_b))


def summed_pairs(found: DataFrame) -> DataFrame:
    """``pair_counts`` of the rows of ``aligned``."""
    local = found.filter("shard is not null").select("shard", "salt", "keys", "numbers")
    keys_schema = pa.schema([("shard", pa.int32()), ("keys", pa.binary())])
    table_schema = pa.schema([("shard", pa.int32()), ("mph", pa.binary()), ("keys", pa.binary())])
    sum_schema = pa.schema([("shard", pa.int32()), ("counts", pa.binary())])

    def distinct(last: bool, key: list[str]):
        def run(batches):
            shard, sums = None, Sums()

            def done():
                keys = sums.finish()[0]
                if not last:
                    return _one(keys_schema, shard, keys.tobytes())
                table = Table.of(keys)
                return _one(table_schema, shard, table.mph.packed(), table.keys.tobytes())

            for new, row in _grouped(batches, key):
                if new and shard is not None:
                    yield done()
                    sums = Sums()
                shard = row["shard"]
                found = _longs(row["keys"])
                sums.add(found, np.ones(len(found), np.int64))
            if shard is not None:
                yield done()

        return run

    def sorted_by(df: DataFrame, *key: str) -> DataFrame:
        return df.repartition(*[k for k in key if k != "place"]).sortWithinPartitions(*key)

    keys = sorted_by(local.select("shard", "salt", "keys"), "shard", "salt").mapInArrow(distinct(False, ["shard", "salt"]), "shard int, keys binary")
    tables = written(sorted_by(keys, "shard").mapInArrow(distinct(True, ["shard"]), "shard int, mph binary, keys binary"), "hashes")

    def summed(batches):
        """A range's table comes first, then what tasks counted: sums are dense vectors in the order of the hash."""
        table, vector, shard = None, None, None
        for new, row in _grouped(batches, ["shard", "salt"]):
            if new:
                if vector is not None:
                    yield _one(sum_schema, shard, vector.tobytes())
                shard, table = row["shard"], Table(Mph.unpacked(row["mph"]), _longs(row["keys"]))
                vector = np.zeros(len(table.keys), np.int64)
                continue
            vector[table.find(_longs(row["keys"]))] += _longs(row["numbers"])
        if vector is not None:
            yield _one(sum_schema, shard, vector.tobytes())

    salts = local.select("shard", "salt").distinct()
    first = tables.join(salts, "shard").select("shard", "salt", F.lit(0).alias("place"), "mph", "keys", F.lit(None).cast("binary").alias("numbers"))
    then = local.select("shard", "salt", F.lit(1).alias("place"), F.lit(None).cast("binary").alias("mph"), "keys", "numbers")
    parts = sorted_by(first.unionByName(then), "shard", "salt", "place").mapInArrow(summed, "shard int, counts binary")
    total_schema = sum_schema.append(pa.field("total", pa.int64()))

    def whole(batches):
        shard, vector = None, None
        for new, row in _grouped(batches, ["shard"]):
            if new:
                if shard is not None:
                    yield _one(total_schema, shard, vector.tobytes(), int(vector.sum()))
                shard, vector = row["shard"], _longs(row["counts"]).copy()
            else:
                vector += _longs(row["counts"])
        if shard is not None:
            yield _one(total_schema, shard, vector.tobytes(), int(vector.sum()))

    counts = sorted_by(parts, "shard").mapInArrow(whole, "shard int, counts binary, total long")
    return written(tables.join(counts, "shard"), "counts")


def linked_pairs(counts: DataFrame) -> DataFrame:
    """(a, b, documents) of each pair of ``pair_counts``."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("documents", pa.int64())])

    def spread(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = _longs(row["keys"])
                yield pa.RecordBatch.from_arrays([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(_longs(row["counts"]))], schema=schema)

    return prepared(counts).select("keys", "counts").mapInArrow(spread, "a long, b long, documents long")


def frequent_table(counts: DataFrame) -> tuple[Table, bool]:
    """The pairs that are broadcast, FREQUENT at most, and whether these are all."""
    n, total = counts.agg(F.coalesce(F.sum(F.octet_length("keys") / 8), F.lit(0)).cast("long"), F.coalesce(F.sum("total"), F.lit(0))).head()
    least = 0 if n <= FREQUENT else total // FREQUENT  # fewer than FREQUENT pairs have more than this each
    schema = pa.schema([("keys", pa.binary()), ("counts", pa.binary())])

    def often(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, found = _longs(row["keys"]), _longs(row["counts"])
                yield _one(schema, keys[found > least].tobytes(), found[found > least].tobytes())

    rows = prepared(counts).select("keys", "counts").mapInArrow(often, "keys binary, counts binary").toArrow().to_pylist()
    keys, found = (np.concatenate([np.empty(0, np.int64), *[_longs(r[c]) for r in rows]]) for c in ("keys", "counts"))
    return Table.of(keys, found), n <= FREQUENT


def highest(counts: DataFrame, size: int) -> np.ndarray:
    """The highest count of each id of the first tokenizer, a number for each of its ids."""
    schema = pa.schema([("a", pa.int64()), ("most", pa.int64())])

    def most(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a, found = _longs(row["keys"]) >> 32, _longs(row["counts"])
                order = np.lexsort((found, a))
                last = np.flatnonzero(np.concatenate((a[order][1:] != a[order][:-1], [True])))
                yield pa.RecordBatch.from_arrays([pa.array(a[order][last]), pa.array(found[order][last])], schema=schema)

    rows = prepared(counts).select("keys", "counts").mapInArrow(most, "a long, most long").groupBy("a").agg(F.max("most").alias("most")).toArrow()
    out = np.zeros(size, np.int64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out


# ---------------------------------------------------------------- answers


def alignment(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts that a tokenizer does not spell back (signs it rewrites), have no
    tokens: zeros and an empty digest.  Repeated rows count as documents of their own and are answered each; an empty table gives no
    rows.  Texts of any length are aligned whole.
    """
    rows = texts(docs, doc_id, text)
    read = aligned(rows, path_a, path_b)
    counts = summed_pairs(read)
    table, is_all = frequent_table(counts)
    size_a, size_b = len(byte_level(path_a)[1]), len(pieces(path_b)[1])
    kind = pair_type(size_a, size_b)
    held = docs.sparkSession.sparkContext.broadcast((table, highest(counts, size_a)))
    schema = pa.schema([
        ("row", pa.int64()), ("doc_id", pa.int64()), *[(n, pa.int64()) for n in NUMBERS], ("groups_sha256", pa.string()),
        ("shard", pa.int32()), ("keys", pa.binary()), ("times", pa.binary()),
    ])
    shape = f"row long, doc_id long, {', '.join(f'{n} long' for n in NUMBERS)}, groups_sha256 string, shard int, keys binary, times binary"

    def look_up(batches):
        table, most = held.value
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            column = batch.to_pydict()
            keys, times, ends = unpacked_pairs(column["pairs"], column["times"], size_b, kind)
            at = table.find(keys)
            n = np.where(at >= 0, table.counts[at], 0) if len(table.counts) else np.zeros(len(keys), np.int64)
            sums = [np.concatenate(([0], np.cumsum(v)))[[0, *ends]] for v in (np.where((at >= 0) & (n == most[keys >> 32]), times, 0), times * n)]
            best, total = (np.diff(v).tolist() for v in sums)
            found, unknown, i = [], at < 0, 0
            for k, to in enumerate(ends.tolist()):
                number += 1
                found.append((number, column["doc_id"][k], *[column[c][k] for c in NUMBERS[:4]], best[k], total[k], column["groups_sha256"][k], None, None, None))
                mine = unknown[i:to]
                if not is_all and mine.any():
                    found += [(number, *[None] * 8, s, k.tobytes(), x.tobytes()) for s, k, x in by_shard(keys[i:to][mine], times[i:to][mine])]
                i = to
            columns = list(zip(*found, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    columns = ["doc_id", *NUMBERS, "groups_sha256"]
    found = prepared(read.filter("shard is null").drop("shard", "salt", "keys", "numbers")).mapInArrow(look_up, shape)
    if is_all:
        return found.select(*columns)
    found = written(found, "answers")
    rest = found.filter("shard is not null").select("shard", F.pmod(F.col("row"), F.lit(SALTS)).cast("int").alias("salt"), F.lit(1).alias("place"), "row", "keys", "times")
    nothing = F.lit(None).cast("binary")
    ask = rest.withColumn("mph", nothing).withColumn("counts", nothing)
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))
    first = counts.select("shard", salts.alias("salt"), F.lit(0).alias("place"), F.lit(0).cast("long").alias("row"), "keys", nothing.alias("times"), "mph", "counts")
    out = pa.schema([("row", pa.int64()), ("best", pa.int64()), ("counted", pa.int64())])

    def answer(batches):
        table, most = None, held.value[1]
        for new, row in _grouped(batches, ["shard", "salt"]):
            keys = _longs(row["keys"])
            if new:
                table = Table(Mph.unpacked(row["mph"]), keys, _longs(row["counts"]))
                continue
            at, times = table.find(keys), _longs(row["times"])
            if (at < 0).any():
                raise ValueError("a pair is missing in its table")
            n = table.counts[at]
            yield _one(out, row["row"], int(times[n == most[keys >> 32]].sum()), int(np.dot(times, n)))

    ordered = first.unionByName(ask).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "place")
    more = ordered.mapInArrow(answer, "row long, best long, counted long").groupBy("row").agg(F.sum("best").alias("best"), F.sum("counted").alias("counted"))
    whole = found.filter("shard is null").drop("shard", "keys", "times").join(more, "row", "left")
    for name, added in (("n_best", "best"), ("count_sum", "counted")):
        whole = whole.withColumn(name, F.col(name) + F.coalesce(added, F.lit(0)))
    return whole.select(*columns)


def token_groups(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and groups (arrays of the ids of both sides) of every row; no groups where ``alignment`` has no tokens."""
    ids = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("groups", pa.list_(pa.struct([("a", ids), ("b", ids)])))])

    def groups(batches):
        align = aligner(path_a, path_b)
        for batch in batches:
            found = []
            for aligned in align.documents(batch.column(1).to_pylist()):
                sides = [g.split("|") for p in aligned.parts for g in p.text.split(";")]
                found.append([{"a": [int(i) for i in a.split(",")], "b": [int(i) for i in b.split(",")]} for a, b in sides])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, schema.field("groups").type)], schema=schema)

    return prepared(texts(docs, doc_id, text)).mapInArrow(groups, "doc_id long, groups array<struct<a:array<bigint>,b:array<bigint>>>")
