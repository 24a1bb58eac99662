"""Secrets in texts: three patterns, and strings that a BPE vocabulary writes inefficiently.

Language packs many characters into a token; random strings do not.  A run of key characters that
needs more than one token for every ``MAX_RATIO`` characters is reported (for runs of small or of capital letters alone, ``ONE_KIND``),
unless it is a digest of a usual length, a UUID, a number, or a name: at least half of its characters stand in parts that are
numbers or that the vocabulary writes efficiently.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import prepared, texts

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: A long enough run from its first character on is what the open pattern with a length test finds.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KEYWORDS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LENGTH = 6

#: A run may follow an equals sign (KEY=value, ?sig=value), which is padding only at its end.
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
MAX_RATIO = 2.2
MIXED = ("[0-9]", "[a-z]", "[A-Z]")
#: Hex digits of md5, sha1, sha224, sha256, sha384, sha512.
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Characters a token for letters of one kind, under those of any word; about two in five random ones of 20 letters have as few.
ONE_KIND = 1.59


@cache
def vocabulary(path: str):
    """The ranks of a tiktoken file as an encoding, once per worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def is_known(run: str) -> bool:
    """Digests, UUIDs and numbers."""
    if len(run) in DIGEST_LENGTHS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run):
        return True
    return bool(UUID.fullmatch(run) or re.fullmatch(r"[-_/+=0-9]+", run))


def is_name(run: str, tokens: Callable[[str], int], max_ratio: float) -> bool:
    """Put together from parts such as words and numbers, as in build-2024-release or Section12/Part3."""
    parts = [p for p in re.split(r"[-_/+=]", run) if p]
    plain = sum(len(p) for p in parts if p.isdigit() or len(p) > max_ratio * tokens(p))
    return 2 * plain >= sum(map(len, parts))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns, in order."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_spans(text: str, path: str, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, int]]:
    found = []
    for m in RUN.finditer(text):
        run = m.group()
        if is_known(run):
            continue
        kinds = sum(bool(re.search(kind, run)) for kind in MIXED)

        def tokens(part: str) -> int:
            return len(vocabulary(path).encode_ordinary(part))

        if len(run) <= (max_ratio if kinds > 1 else min(ONE_KIND, max_ratio)) * tokens(run) and not is_name(run, tokens, max_ratio):
            found.append((m.start(), 3, m.end()))
    return found


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame, path: str, max_ratio: float = MAX_RATIO, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, spans (kind, start, end in code points, end exclusive; by start, then kind).

    Kinds: assign, access, hex (patterns) and random (token efficiency).  Null and empty texts have
    none; repeated rows are answered each; an empty table gives no rows.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])

    def scan(batches):
        for batch in batches:
            found = []
            for t in batch.column(1).to_pylist():
                spans = sorted(base_spans(t) + random_spans(t, path, max_ratio))
                found.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, schema.field("spans").type)], schema=schema)

    return prepared(texts(docs, doc_id, text)).mapInArrow(scan, f"doc_id long, spans {SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans as text."""

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = written(F.filter("spans", lambda s: s["kind"] != KINDS[3]))
    return found.select("doc_id", *[number(k) for k in KINDS[:3]], F.sha2(base.cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
