"""BPE encoding and decoding, exact for texts of any length.

No token spans a space or a line feed, so a worker encodes every distinct word once.  What is left is
text without such splits.  A long text is cut into pieces that are encoded in parallel; a stretch
that runs over several pieces is put together as a tree: two encoded neighbours are joined by
encoding a window of text around the cut.  The window is right when its first token is the left
side's token at that place and one of its later tokens is the right side's; everything between is
then taken from the window.  Otherwise the window doubles, at the end to both whole sides.

Why agreement is enough: a token sequence is the encoding of its text exactly when each pair of
adjacent tokens is, and every pair of the joined sequence stands in one of the three encodings.
Tokens nearer than MARGIN characters to a cut never count as agreement, so that special tokens and
contractions that straddle it are always inside a window.  Normalisation reorders and composes marks within a
character and its marks, however many; so windows begin and end, and sides agree, only before a
character that no normalisation joins with what stands before it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import unicodedata
from array import array
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import prepared, text_key, texts

#: Characters of a piece; longer texts are cut.
PIECE = 1 << 15
MARGIN = 32
#: Byte-level tokenizers write a byte that is no visible Latin-1 sign as the next free one from 256 on.
VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in VISIBLE)}


@cache
def load(path: str):
    """The tokenizer of a file, once per worker; truncation and padding are off."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@cache
def _followers() -> frozenset[str]:
    """Characters that canonical composition can join to the one before: second parts of compositions, and vowels and finals of Hangul."""
    parts = (unicodedata.decomposition(chr(c)).split() for c in range(sys.maxunicode + 1))
    seconds = {chr(int(p[1], 16)) for p in parts if len(p) == 2 and not p[0].startswith("<")}
    return frozenset(seconds | {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))})


@lru_cache(1 << 16)
def joins(sign: str) -> bool:
    """Whether normalisation may reorder or compose a character with those before it; unknown ones may."""
    return unicodedata.combining(sign) > 0 or sign in _followers() or unicodedata.category(sign) == "Cn"


class Encoded:
    """Tokens of text[start:end]: ids and their character spans in the whole text."""

    def __init__(self, start: int, end: int, ids: np.ndarray, spans: np.ndarray):
        self.start, self.end, self.ids, self.spans = start, end, ids, spans


def encode(path: str, text: str, start: int, end: int) -> Encoded:
    found = load(path).encode(text[start:end], add_special_tokens=False)
    spans = np.array(found.offsets, np.int64).reshape(-1, 2) + start
    return Encoded(start, end, np.array(found.ids, np.uint32), spans)


def concat(path: str, text: str, left: Encoded, right: Encoded, margin: int = MARGIN) -> Encoded:
    """The encoding of two adjacent stretches of text, from their encodings."""
    cut, reach = left.end, 2 * margin
    while True:
        # the window starts at a token of the left side, at a character that no earlier token touches
        a = int(np.searchsorted(left.spans[:, 0], cut - reach, "right")) - 1
        while a > 0 and (left.spans[a - 1, 1] > left.spans[a, 0] or joins(text[left.spans[a, 0]])):
            a -= 1
        start = int(left.spans[a, 0]) if a > 0 else left.start
        end = min(right.end, cut + reach)
        while end < right.end and joins(text[end]):
            end += 1
        window = encode(path, text, start, end)
        left_agrees = a <= 0 or (
            len(window.ids) > 0 and window.ids[0] == left.ids[a] and (window.spans[0] == left.spans[a]).all()
        )
        if left_agrees:
            a = max(a, 0)
            if end == right.end:
                return _joined(left, a, window, len(window.ids), right, len(right.ids))
            # the last token of the window that the right side has too, away from the cut and from the window's end
            last = end - margin // 2
            for w in range(len(window.ids) - 1, 0, -1):
                if window.spans[w, 0] < cut + margin:
                    break
                if window.spans[w, 1] > last or window.spans[w - 1, 1] > window.spans[w, 0] or joins(text[window.spans[w, 0]]):
                    continue
                b = int(np.searchsorted(right.spans[:, 0], window.spans[w, 0]))
                if b > 0 and right.spans[b - 1, 1] > window.spans[w, 0]:
                    continue
                if b < len(right.ids) and right.ids[b] == window.ids[w] and (right.spans[b] == window.spans[w]).all():
                    return _joined(left, a, window, w, right, b)
        reach *= 2


def _joined(left: Encoded, a: int, window: Encoded, w: int, right: Encoded, b: int) -> Encoded:
    return Encoded(
        left.start,
        right.end,
        np.concatenate((left.ids[:a], window.ids[:w], right.ids[b:])),
        np.concatenate((left.spans[:a], window.spans[:w], right.spans[b:])),
    )


def tree(path: str, text: str, parts: list[Encoded], margin: int = MARGIN) -> Encoded:
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [concat(path, text, *pair, margin) if len(pair) == 2 else pair[0] for pair in pairs]
    return parts[0]


def word_pattern(tokenizer):
    """How the tokenizer cuts a word that it only lower-cases: its pattern's matches, if that is all its steps do to one; else None."""
    import regex

    steps = json.loads(tokenizer.to_str())
    before = (steps["normalizer"] or {}).get("normalizers", [])
    cut = (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
    if [s["type"] for s in before] != ["NFC", "Replace", "Lowercase"] or before[1]["pattern"] != {"Regex": "\\s+"}:
        return None
    if [s["type"] for s in cut] != ["Split", "ByteLevel"] or "Regex" not in cut[0]["pattern"]:
        return None
    if (cut[0]["behavior"], cut[0]["invert"], cut[1]["add_prefix_space"], cut[1]["use_regex"]) != ("Removed", True, False, False):
        return None
    return regex.compile(cut[0]["pattern"]["Regex"]).findall


class Words(dict):
    """Word to the bytes of its ids; bounded, emptied when full."""

    def __init__(self, path: str, limit: int = 300_000):
        super().__init__()
        self.tokenizer, self.limit = load(path), limit
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added_start = os.path.commonprefix(self.added)
        # words of ASCII signs and Latin-1 letters are cut by the tokenizer's own pattern without the library's detour
        self.cut, self.simple = word_pattern(self.tokenizer), re.compile("[!-~À-ÖØ-öø-ÿ]*").fullmatch

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.encoded(word)
        return value

    def encoded(self, word: str) -> bytes:
        tokenizer = self.tokenizer
        if self.added_start in word and any(t in word for t in self.added):
            return array("I", tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if not self.cut or not self.simple(word):
            cut = [x for x, _ in tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(word))]
            return b"".join([self.piece(x) for x in cut])
        lower = word.lower()
        if lower != word:
            return self[lower]
        if word.isalpha():  # one match of the pattern
            return self.piece(word if word.isascii() else signs(word))
        if word[-1:] in ".,;:!?" and word[:-1].isalpha():
            return self[word[:-1]] + self[word[-1]]
        return b"".join([self.piece(x if x.isascii() else signs(x)) for x in self.cut(word)])

    def piece(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()


def signs(piece: str) -> str:
    """The bytes of a piece as byte-level tokenizers write them."""
    return piece.encode().decode("latin-1").translate(BYTE_SIGNS)


@cache
def words_of(path: str) -> Words | None:
    """None unless the tokenizer drops spaces and line feeds, so that words can be encoded one by one."""
    tokenizer = load(path)
    if tokenizer.normalizer is None or tokenizer.pre_tokenizer is None or tokenizer.post_processor is not None:
        return None
    ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in ("a", "b.", " ", "a b.", " \na \n\n b. ")]
    return Words(path) if ids[2] == [] and ids[0] + ids[1] == ids[3] == ids[4] else None


def ids_of(path: str, text: str) -> bytes:
    """Ids of a text as little-endian 32-bit integers."""
    words = words_of(path)
    if words is None:
        return np.array(load(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    return b"".join(map(words.__getitem__, text.replace("\n", " ").split(" ")))


def decoded(path: str, ids: bytes) -> str:
    return load(path).decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


@cache
def spellings(path: str) -> list[bytes] | None:
    """Each id's own part of a decoded text, where decoding is the joining of tokens by one space."""
    tokenizer = load(path)
    if tokenizer.decoder is not None:
        return None
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    return [(tokenizer.id_to_token(i) or "").encode() for i in range(size)]


def decoded_bytes(path: str, ids: bytes) -> bytes:
    parts = spellings(path)
    if parts is None:
        return decoded(path, ids).encode()
    return b" ".join([parts[i] for i in np.frombuffer(ids, "<u4").tolist()])


#: What a piece of a long text becomes: the stretch before its first split, the ids of the words between
#: the splits, the stretch after the last; a piece without a split is one stretch, encoded with spans.
_PIECES = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("part", pa.int32()), ("head", pa.string()), ("ids", pa.binary()),
    ("tail", pa.string()), ("spans", pa.binary()),
])
_PIECES_SQL = "row long, doc_id long, part int, head string, ids binary, tail string, spans binary"


def _piece(path: str, text: str):
    words = words_of(path)
    if words is not None:
        first = min((i for i in (text.find(" "), text.find("\n")) if i >= 0), default=-1)
        if first >= 0:
            last = max(text.rfind(" "), text.rfind("\n"))
            return text[:first], ids_of(path, text[first:last]), text[last + 1 :], None
    found = encode(path, text, 0, len(text))
    return text, found.ids.astype("<u4").tobytes(), None, found.spans.astype("<i4").tobytes()


class _Stretch:
    """Text without a split, gathered over pieces."""

    def __init__(self):
        self.parts: list[tuple[str, bytes | None, bytes | None]] = []

    def add(self, text: str, ids: bytes | None = None, spans: bytes | None = None):
        if text:
            self.parts.append((text, ids, spans))

    def finish(self, path: str, piece: int, margin: int) -> bytes:
        whole, at, held = "".join(t for t, _, _ in self.parts), 0, []
        parts, self.parts = self.parts, []
        if len(whole) <= piece and len(parts) != 1:
            return ids_of(path, whole)
        for text, ids, spans in parts:
            if spans is None:
                held.append(encode(path, whole, at, at + len(text)))
            else:
                where = np.frombuffer(spans, "<i4").reshape(-1, 2).astype(np.int64) + at
                held.append(Encoded(at, at + len(text), np.frombuffer(ids, "<u4"), where))
            at += len(text)
        return tree(path, whole, held, margin).ids.astype("<u4").tobytes() if held else b""


def _encode(docs: DataFrame, path: str, doc_id: str, text: str, piece: int, margin: int, schema: pa.Schema, shape: str, answer) -> DataFrame:
    """Rows (doc_id, *answer(ids)), one per input row."""
    rows = prepared(texts(docs, doc_id, text))

    def batch_of(ids, found):
        columns = list(zip(*found, strict=True)) or [()] * (len(schema) - 1)
        return pa.RecordBatch.from_arrays([ids, *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]], schema=schema)

    def short(batches):
        for batch in batches:
            yield batch_of(batch.column(0).cast(pa.int64()), [answer(ids_of(path, t)) for t in batch.column(1).to_pylist()])

    def pieces(batches):
        for batch in batches:
            columns = list(zip(*[_piece(path, t) for t in batch.column(3).to_pylist()], strict=True)) or [()] * 4
            found = [pa.array(c, _PIECES.field(i + 3).type) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *found], schema=_PIECES)

    def joined(batches):
        """Sorted by row and part: the pieces of a text arrive one after another."""
        key, owner, ids, stretch = None, None, [], _Stretch()

        def finished():
            ids.append(stretch.finish(path, piece, margin))
            return batch_of(pa.array([owner], pa.int64()), [answer(b"".join(ids))])

        for batch in batches:
            for p in batch.to_pylist():
                if key is not None and p["row"] != key:
                    yield finished()
                    ids, stretch = [], _Stretch()
                key, owner = p["row"], p["doc_id"]
                if p["spans"] is not None:
                    stretch.add(p["head"], p["ids"], p["spans"])
                    continue
                stretch.add(p["head"])
                ids += [stretch.finish(path, piece, margin), p["ids"]]
                stretch.add(p["tail"])
        if key is not None:
            yield finished()

    is_long = F.char_length("text") > piece
    starts = F.sequence(F.lit(0), F.expr(f"cast((char_length(text) - 1) div {piece} as int)"))
    # an identity for each long row; it is only used within this one shuffle, on whose rows it is fixed
    cut = rows.filter(is_long).withColumn("row", F.xxhash64("doc_id", F.xxhash64("text"), F.monotonically_increasing_id()))
    cut = cut.select("row", "doc_id", "text", F.explode(starts).alias("part"))
    cut = cut.select("row", "doc_id", "part", F.substring("text", F.col("part") * piece + 1, F.lit(piece)).alias("text"))
    spread = cut.repartition("row", "part").mapInArrow(pieces, _PIECES_SQL)
    whole = spread.repartition("row").sortWithinPartitions("row", "part")
    return rows.filter(~is_long).mapInArrow(short, shape).unionByName(whole.mapInArrow(joined, shape))


def encode_documents(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", piece: int = PIECE, margin: int = MARGIN
) -> DataFrame:
    """One row per input row: doc_id and ids (little-endian unsigned 32-bit integers as binary).

    A null or empty text has no ids; repeated rows are encoded each; an empty table gives no rows.
    Texts above ``piece`` characters are cut, the pieces dealt over all tasks, and joined exactly.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
    return _encode(docs, path, doc_id, text, piece, margin, schema, "doc_id long, ids binary", lambda ids: (ids,))


def encode_decode(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", piece: int = PIECE, margin: int = MARGIN
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, encoded as ``encode_documents`` does."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def answer(ids: bytes):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded_bytes(path, ids)).hexdigest()

    return _encode(docs, path, doc_id, text, piece, margin, schema, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", answer)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of (doc_id, ids) rows, as the tokenizer decodes; null ids give an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def decode(batches):
        for batch in batches:
            found = [decoded(path, x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], schema=schema)

    return prepared(encoded).select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")
