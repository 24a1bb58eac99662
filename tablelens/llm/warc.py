"""WARC archives with a two-level capture index.

Pages are sorted by index line: the URL with its host reversed (``com,example,www)/path``), the
capture date, and the record's id.  A task writes its range of lines as one archive (a gzip member per record) and,
beside it, that range's captures as compressed blocks, closed by a sparse directory with the first line of each
block.  A table with one row per archive is the top; it is the only thing that names files, so
what a lost task left behind is never read.

A search goes down by binary search: in the sorted first lines of the archives, in one archive's directory,
in one block.  Only then is a range of an archive read.  Payloads that were stored before are written as
revisits, and reading back finds what they refer to by that search.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import prepared
from tablelens.llm.urls import LOWER, UPPER
from tablelens.plans.runtime import fits_broadcast, join_sized, new_path, written

#: Captures of a block; bytes of neighbouring records that are read at once.
BLOCK, SPAN = 256, 8 << 20
#: Compressed bytes of archives that a task reads back.
TASK_BYTES = 32 << 20
#: Archives of one write, and characters of a first line in the top: both bound what a search broadcasts.
MAX_ARCHIVES, CLIP = 1 << 14, 256
#: A payload that more than one in so many rows have is frequent; so at most as many are.
FREQUENT = 1000
DATE = "2000-01-01T00:00:00Z"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: What a URL in a header line cannot hold.
CONTROLS = [chr(c) for c in (*range(0x21), 0x7F)]

TOP = "file string, first string, captures long, directory long, directory_bytes long, archive_bytes long"
_TOP = pa.schema([("file", pa.string()), ("first", pa.string()), *[(n, pa.int64()) for n in ("captures", "directory", "directory_bytes", "archive_bytes")]])


def header_url(url: Column) -> Column:
    """The URL with blanks and control characters percent-encoded; null stays null."""
    encoded = reduce(lambda c, x: F.replace(c, F.lit(x), F.lit(f"%{ord(x):02X}")), CONTROLS, url)
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), encoded).otherwise(url)


def url_key(url: Column) -> Column:
    """The reversed host in small letters, its port, ``)``, and the rest; a URL without :// is all rest."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.char_length(url))
    authority = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    name = F.translate(F.regexp_extract(authority, r"^(.*?)(:[0-9]*)?$", 1), UPPER, LOWER)
    port = F.regexp_extract(authority, r"^.*?(:[0-9]*)?$", 1)
    tail = F.substring(rest, F.char_length(authority) + 1, F.char_length(rest))
    host = F.array_join(F.reverse(F.split(name, r"\.")), ",")
    whole = F.concat(host, port, F.lit(")"), tail)
    return F.when(F.instr(url, "://") > 0, whole).otherwise(F.concat(F.lit(")"), F.coalesce(url, F.lit(""))))


def record_id(page_id: Column, url: Column, content: Column) -> Column:
    """The same for every row that repeats a page."""
    h = F.md5(F.concat_ws("\n", F.coalesce(page_id.cast("string"), F.lit("")), F.coalesce(url, F.lit("")), content).cast("binary"))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def index_line(url: Column, date: str, record: Column) -> Column:
    stamp = "".join(c for c in date if c.isdigit())
    return F.concat_ws(" ", url_key(url), F.lit(stamp), record)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---------------------------------------------------------------- records


def record_bytes(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers if v is not None], f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + END + block + END) + packer.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in small letters) and block of one record."""
    head, mark, rest = data.partition(END)
    lines = head.decode().split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    length = int(headers["content-length"])
    if rest[length:] != END:
        raise ValueError(f"record {headers.get('warc-record-id')} does not end where it says")
    return headers, rest[:length]


def capture_record(page_id, url, record, payload: bytes, digest: str, date: str, keep) -> bytes:
    """A response, or with ``keep`` (url and record id of the response) a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [
        ("WARC-Type", "revisit" if keep else "response"), ("WARC-Record-ID", f"<urn:uuid:{record}>"), ("WARC-Date", date),
        ("WARC-Target-URI", url), ("X-Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if not keep:
        return record_bytes(headers, http + payload)
    to_url, to_record = keep
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{to_record}>"), ("WARC-Refers-To-Target-URI", to_url), ("WARC-Refers-To-Date", date)]
    return record_bytes(headers, http)


def capture_of(data: bytes) -> dict:
    """What a record says; a response's payload is checked against its digest."""
    headers, block = parse_record(data)
    payload = block.partition(END)[2]
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response" and digest_of(payload) != digest:
        raise ValueError(f"record {headers['warc-record-id']}: payload and digest differ")

    def plain(name):
        return headers.get(name, "").removeprefix("<urn:uuid:").removesuffix(">") or None

    return {
        "page_id": headers.get("x-page-id"), "url": headers.get("warc-target-uri"), "record": plain("warc-record-id"), "record_type": kind,
        "payload_digest": digest, "payload_bytes": len(payload) if kind == "response" else None, "payload": payload if kind == "response" else None,
        "to_url": headers.get("warc-refers-to-target-uri"), "to_record": plain("warc-refers-to"), "to_date": headers.get("warc-refers-to-date"),
    }


# ---------------------------------------------------------------- archives


def decided(pages: DataFrame, min_bytes: int, page_id: str, url: str, html: str) -> DataFrame:
    """page_id (as text), url, record, payload, and for revisits url and record id of the response.

    Only hashes are grouped.  Payloads that more than a thousandth of the rows have are at most a thousand
    and are broadcast; all other rows shuffle by their hash, of which none is frequent.
    """
    payload = F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{page_id}`").alias("id"), header_url(F.col(f"`{url}`")).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("content"))
    alike = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("content")
    groups = alike.agg(F.max(F.struct("id", "url")).alias("keep"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = written(groups, "payloads")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    often = F.broadcast(groups.filter(F.col("n") * FREQUENT > total).select("content", F.col("keep").alias("often")))
    seldom = groups.filter(F.col("n") * FREQUENT <= total).select(F.col("content").alias("key"), F.col("keep").alias("seldom"))
    rows = rows.join(often, "content", "left")
    # rows that are settled are dealt by themselves
    own = F.concat(F.lit("-"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")))
    rows = rows.withColumn("key", F.when(F.col("often").isNull(), F.col("content")).otherwise(own))
    rows = rows.join(seldom, "key", "left").withColumn("keep", F.coalesce("often", "seldom"))
    again = F.col("keep").isNotNull() & ~F.col("keep.id").eqNullSafe(F.col("id"))
    return rows.select(
        F.col("id").cast("string").alias("page_id"), "url", record_id(F.col("id"), F.col("url"), F.col("content")).alias("record"), "payload",
        again.alias("again"), F.when(again, F.col("keep.url")).alias("to_url"),
        F.when(again, record_id(F.col("keep.id"), F.col("keep.url"), F.col("content"))).alias("to_record"),
    )


def write_archives(
    pages: DataFrame, folder: str | None = None, min_bytes: int = 0, date: str = DATE, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """The top of the index, a row per archive: file, first line, captures, and where its directory is.

    ``folder`` must be reachable by every task through pyarrow's file systems; by default it is a new one in the session's shared
    folder.  Of rows with equal payloads of at least ``min_bytes`` those with the largest page_id are responses,
    all others revisits of it; nulls count as the smallest id, and a group without ids is all responses.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    rows = decided(pages, min_bytes, page_id, url, html).withColumn("line", index_line(F.col("url"), date, F.col("record")))
    archives = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_ARCHIVES)
    ordered = rows.repartitionByRange(archives, "line").sortWithinPartitions("line")

    def write(batches):
        rows = (r for batch in batches for r in batch.to_pylist())
        first = next(rows, None)
        if first is None:
            return
        files, place = FileSystem.from_uri(folder)
        files.create_dir(place, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"  # of this attempt alone
        directory, lines, captures, offset, end = [], [], 0, 0, 0
        with files.open_output_stream(f"{place}/{name}", compression=None) as archive, files.open_output_stream(f"{place}/{name}.cdx") as index:

            def close_block():
                nonlocal end
                packed = zlib.compress("".join(lines).encode())
                index.write(packed)
                directory.append((lines[0].rsplit(" ", 3)[0], end, len(packed)))
                end += len(packed)
                lines.clear()

            info = record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            archive.write(info)
            offset += len(info)
            last = first
            for r in (x for part in ((first,), rows) for x in part):
                payload = r["payload"]
                keep = (r["to_url"], r["to_record"]) if r["again"] else None
                data = capture_record(r["page_id"], r["url"], r["record"], payload, digest_of(payload), date, keep)
                archive.write(data)
                lines.append(f"{r['line']} {'revisit' if keep else 'response'} {offset} {len(data)}\n")
                offset, captures, last = offset + len(data), captures + 1, r
                if len(lines) == BLOCK:
                    close_block()
            if lines:
                close_block()
            packed = zlib.compress(json.dumps(directory).encode())
            index.write(packed)
        row = [[f"{folder}/{name}"], [first["line"]], [captures], [end], [len(packed)], [offset]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _TOP, strict=True)], schema=_TOP)

    return written(prepared(ordered).mapInArrow(write, TOP), "archives")


class Reader:
    """Ranges of archives and their indexes, a few of them held."""

    def __init__(self, most: int = 16):
        self.most, self.files, self.held = most, {}, OrderedDict()

    def range(self, path: str, start: int, size: int) -> bytes:
        if path not in self.files:
            if len(self.files) >= 64:
                self.files.popitem()[1].close()
            files, place = FileSystem.from_uri(path)
            self.files[path] = files.open_input_file(place)
        data = self.files[path].read_at(size, start)
        if len(data) != size:
            raise ValueError(f"{path} ends before {start + size}")
        return data

    def kept(self, key: tuple, make):
        if key in self.held:
            self.held.move_to_end(key)
        else:
            self.held[key] = make()
            if len(self.held) > self.most:
                self.held.popitem(last=False)
        return self.held[key]

    def directory(self, path: str, start: int, size: int) -> list[list]:
        """[first line, offset, bytes] of each block, in order."""
        return self.kept((path, start), lambda: json.loads(zlib.decompress(self.range(f"{path}.cdx", start, size))))

    def block(self, path: str, start: int, size: int) -> tuple[list[str], list[tuple[str, int, int]]]:
        """A block's lines in order, and for each its type, offset and size."""

        def make():
            rows = [x.rsplit(" ", 3) for x in zlib.decompress(self.range(f"{path}.cdx", start, size)).decode().split("\n")[:-1]]
            return [r[0] for r in rows], [(r[1], int(r[2]), int(r[3])) for r in rows]

        return self.kept((path, start), make)

    def record(self, path: str, start: int, size: int) -> bytes:
        return zlib.decompress(self.range(path, start, size), 31)


class Top:
    """The archives in order of their whole first lines, for searches."""

    def __init__(self, rows: list[dict], clip: int):
        self.clip, self.rows = clip, rows
        self.firsts = [r["first"] for r in self.rows]

    def find(self, reader: Reader, line: str) -> tuple[str, int, int] | None:
        """File, offset and size of a line's record."""
        clipped = line[: self.clip]
        at = bisect_right(self.firsts, clipped) - 1
        while at >= 0:
            row = self.rows[at]
            directory = reader.directory(row["file"], row["directory"], row["directory_bytes"])
            k = bisect_right(directory, line, key=lambda d: d[0]) - 1
            if k >= 0:
                lines, places = reader.block(row["file"], directory[k][1], directory[k][2])
                i = bisect_left(lines, line)
                if i < len(lines) and lines[i] == line:
                    return row["file"], *places[i][1:]
            if self.firsts[at] < clipped:
                return None
            at -= 1  # first lines that are alike as far as the top holds them
        return None


_CAPTURE = pa.schema([
    ("page_id", pa.string()), ("url", pa.string()), ("record", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("to_url", pa.string()), ("to_record", pa.string()), ("to_date", pa.string()),
])
CAPTURE = "page_id string, url string, record string, record_type string, payload_digest string, payload_bytes long, payload binary, to_url string, to_record string, to_date string"


def _fields(schema: pa.Schema, payload: bool) -> pa.Schema:
    return pa.schema([f for f in schema if payload or f.name != "payload"])


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append({n: row[n] for n in schema.names})
        size += len(row.get("payload") or b"") if "payload" in schema.names else 0
        if len(held) >= 1024 or size >= SPAN:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def read_archives(top: DataFrame, payload: bool = False) -> DataFrame:
    """Every capture of the archives as its record says, payloads of responses if asked for.

    The directories are read first and their blocks dealt over all tasks; a block's records lie side by side and are read by few ranges.
    """
    shape = "file string, start long, size long"
    blocks = pa.schema([("file", pa.string()), ("start", pa.int64()), ("size", pa.int64())])
    schema = _fields(_CAPTURE, payload)

    def list_blocks(batches):
        reader = Reader()
        for batch in batches:
            for r in batch.to_pylist():
                found = reader.directory(r["file"], r["directory"], r["directory_bytes"])
                yield pa.RecordBatch.from_arrays([pa.array([r["file"]] * len(found)), pa.array([d[1] for d in found], pa.int64()), pa.array([d[2] for d in found], pa.int64())], schema=blocks)

    def captures(batches):
        reader = Reader()
        for batch in batches:
            for r in batch.to_pylist():
                places = [p[1:] for p in reader.block(r["file"], r["start"], r["size"])[1]]
                at = 0
                while at < len(places):
                    to = at + 1
                    while to < len(places) and places[to][0] + places[to][1] - places[at][0] <= SPAN and places[to - 1][0] + places[to - 1][1] == places[to][0]:
                        to += 1
                    start = places[at][0]
                    data = reader.range(r["file"], start, places[to - 1][0] + places[to - 1][1] - start)
                    for offset, size in places[at:to]:
                        yield capture_of(zlib.decompress(data[offset - start : offset - start + size], 31))
                    at = to

    # few bytes stand for many: the tasks are counted by what the archives hold
    archives, size = top.agg(F.count(F.lit(1)), F.coalesce(F.sum("archive_bytes"), F.lit(0))).head()
    tasks = max(top.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    dealt = prepared(top).select("file", "directory", "directory_bytes").repartition(max(1, min(archives, tasks)), "file")
    dealt = dealt.mapInArrow(list_blocks, shape).repartition(tasks, "file", "start")
    names = ", ".join(x for x in CAPTURE.split(", ") if payload or not x.startswith("payload binary"))
    return dealt.mapInArrow(lambda batches: _batches(captures(batches), schema), names)


def look_up(top: DataFrame, lines: DataFrame, payload: bool = False) -> DataFrame:
    """``line`` and its capture, for a table with a column ``line``; what no archive has gives no row.

    The top has a row per archive, MAX_ARCHIVES at most, and is broadcast with first lines of CLIP characters.
    Lines are sorted over the tasks, so a task reads neighbouring directories and blocks, each once.
    """
    rows = top.orderBy("first", "file").select("file", F.substring("first", 1, CLIP).alias("first"), "directory", "directory_bytes").toArrow().to_pylist()
    held = top.sparkSession.sparkContext.broadcast(Top(rows, CLIP))
    schema = pa.schema([("line", pa.string()), *_fields(_CAPTURE, payload)])

    def find(batches):
        reader, archives = Reader(), held.value
        for batch in batches:
            for line in batch.column(0).to_pylist():
                place = archives.find(reader, line)
                if place:
                    yield {"line": line, **capture_of(reader.record(*place))}

    names = ", ".join(x for x in CAPTURE.split(", ") if payload or not x.startswith("payload binary"))
    asked = prepared(lines).select("line").filter("line is not null").repartitionByRange("line").sortWithinPartitions("line")
    return asked.mapInArrow(lambda batches: _batches(find(batches), schema), f"line string, {names}")


def stored_files(folder: str) -> list[str]:
    """Archives of a folder, for readers of other kinds."""
    from pyarrow.fs import FileSelector

    files, place = FileSystem.from_uri(folder)
    return [f.path for f in files.get_file_info(FileSelector(place)) if f.type == FileType.File and f.path.endswith(".warc.gz")]


def round_trip(pages: DataFrame, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from archives.

    Null pages are empty payloads and null URLs have an index line of their own; repeated rows are written
    and answered each, those that repeat the response's id as responses; an empty table gives no rows.
    """
    kind = pages.schema[page_id].dataType.simpleString()
    top = write_archives(pages, None, min_bytes, DATE, page_id, url, html)
    captures = written(read_archives(top), "captures")
    line = index_line(F.col("to_url"), DATE, F.col("to_record"))
    again = captures.filter("record_type = 'revisit'").withColumn("line", line).select("page_id", "payload_digest", "record_type", "line")
    found = look_up(top, again.select("line").distinct())
    found = written(found.select("line", F.col("page_id").alias("refers_to"), "payload_bytes", F.col("payload_digest").alias("stored")), "responses")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    answered = join_sized(again, found, "line", fits_broadcast(found))
    same = F.when(F.col("payload_digest") == F.col("stored"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a revisit's digest is not its response's")))
    answered = answered.withColumn("payload_digest", same).select(*columns)
    whole = captures.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("string")).select(*columns).unionByName(answered)
    return whole.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))
