"""Archives written, searched and read back."""

import gzip
import hashlib
import io
import random
from base64 import b32encode

import pytest

from tablelens.llm import warc
from tablelens.plans.runtime import new_path

SCHEMA = "page_id long, url string, html string, record string, line string, payload string"


def pages(seed=3, n=120):
    rng = random.Random(seed)
    bodies = ["", "same", "é" * 40, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", *(f"<p>{k}</p>" for k in range(60))]
    hosts = ["www.example.com", "Example.org:8080", "a.b.c.example.net", "m.example.com"]
    rows = [(i, f"https://{rng.choice(hosts)}/{rng.choice('abc')}/{rng.randint(0, 9)}?q={i}#x", rng.choice(bodies)) for i in range(n)]
    rows += [(500, None, "null url"), (501, "", None), (502, "no scheme at all", "z"), (503, "http://h.example/a b\r\nX: y\x00", "controls"), (504, "http://", "same")]
    rows += [(None, "http://n.example/", "same"), (None, "http://n.example/", "only nulls"), (None, None, "only nulls")]
    rows += [rows[5], rows[5], (600, "http://r.example/", "repeated winner"), (600, "http://r.example/", "repeated winner"), (601, "http://long.example/" + "x" * 3000, "y" * 300_000)]
    rows += [(700 + k, "http://hot.example/same", "hot") for k in range(90)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "l", "p") for r in rows], SCHEMA).repartition(4)


def wanted(rows, min_bytes=0):
    best = {}
    for i, _, t in rows:
        best[t or ""] = max((best.get(t or "", -1), -1 if i is None else i))
    out = []
    for i, _, t in rows:
        body, keep = (t or "").encode(), best[t or ""]
        again = len(body) >= min_bytes and keep >= 0 and i != keep
        digest = b32encode(hashlib.sha1(body).digest()).decode()
        out.append((i, len(body), digest, "revisit" if again else "response", keep if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, min_bytes, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 7)
    found = warc.round_trip(frame(spark, pages()), min_bytes)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert dict(found.dtypes)["refers_to"] == "bigint"
    assert sorted(map(tuple, found.collect()), key=repr) == wanted(pages(), min_bytes)


def test_empty(spark):
    assert warc.round_trip(frame(spark, pages()).limit(0)).collect() == []


def test_files_are_warc(spark):
    """An archive read from start to end by a plain reader: every record where its length says, gzip members one each."""
    folder = new_path(spark, "plain")
    top = warc.write_archives(frame(spark, pages()), folder)
    records = 0
    for path in warc.stored_files(folder):
        data = gzip.open(path).read()
        stream = io.BytesIO(data)
        kinds = []
        while line := stream.readline():
            assert line == b"WARC/1.1\r\n"
            headers = {}
            while (line := stream.readline()) != b"\r\n":
                k, _, v = line.decode().partition(": ")
                assert k not in headers
                headers[k] = v.removesuffix("\r\n")
            body = stream.read(int(headers["Content-Length"]))
            assert stream.read(4) == b"\r\n\r\n"
            kinds.append(headers["WARC-Type"])
            if kinds[-1] == "response":
                payload = body.partition(b"\r\n\r\n")[2]
                assert headers["WARC-Payload-Digest"] == "sha1:" + b32encode(hashlib.sha1(payload).digest()).decode()
        assert kinds[0] == "warcinfo" and "warcinfo" not in kinds[1:]
        records += len(kinds) - 1
    assert records == len(pages()) == top.agg({"captures": "sum"}).head()[0]


def test_search(spark, monkeypatch):
    """Lines are found by any depth of the index: blocks of three, and first lines clipped until many are alike."""
    monkeypatch.setattr(warc, "BLOCK", 3)
    monkeypatch.setattr(warc, "CLIP", 8)
    top = warc.write_archives(frame(spark, pages()))
    all_of = warc.read_archives(top, payload=True)
    line = warc.index_line(all_of.url, warc.DATE, all_of.record)
    rows = {r.line: r for r in all_of.withColumn("line", line).collect()}
    lines = [(x,) for x in rows] + [("com,example)/none 20000101000000 x",), ("",), ("zz",), (None,)]
    found = warc.look_up(top, spark.createDataFrame(lines, "line string"), payload=True).collect()
    assert {r.line for r in found} == set(rows) and len(found) == len(rows)
    for r in found:
        assert (r.page_id, r.record, r.payload) == (rows[r.line].page_id, rows[r.line].record, rows[r.line].payload)
    order = [r["first"] for r in top.orderBy("first").collect()]
    assert order == sorted(order)


def test_keys(spark):
    urls = ["https://www.Example.com/A?b#c", "http://example.org:8080", "x://a.b/?q", "none", None, "http://"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    found = [r[0] for r in df.select(warc.url_key(df.u)).collect()]
    assert found == ["com,example,www)/A?b#c", "org,example:8080)", "b,a)/?q", ")none", ")", ")"]


def test_broken_archives_are_refused():
    data = warc.record_bytes([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Payload-Digest", "sha1:NONE")], b"HTTP/1.1 200 OK\r\n\r\nbody")
    import zlib

    with pytest.raises(ValueError, match="digest differ"):
        warc.capture_of(zlib.decompress(data, 31))
    with pytest.raises(ValueError, match="does not end"):
        warc.parse_record(zlib.decompress(data, 31)[:-1])
    with pytest.raises(ValueError, match="no WARC"):
        warc.parse_record(b"text")
