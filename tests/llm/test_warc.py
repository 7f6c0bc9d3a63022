"""WARC: what is written comes back, transactions are joined, and foreign archives are read."""

from __future__ import annotations

import gzip
import hashlib
import random
import time

import pytest

from plaintide.llm.queries import op1_warc
from plaintide.llm.warc import Reader, archived, assemble, payload_report, read_archives
from tests.conftest import SF_DIR


def plain(rows):
    data = {i: (h or "").encode() for i, _, h in rows}
    first = {}
    for i in sorted(data):
        if len(data[i]) >= 100:
            first.setdefault(data[i], i)
    out = []
    for i, raw in data.items():
        to = first.get(raw, i)
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if to == i else "revisit", None if to == i else to))
    return sorted(out)


def test_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    whole = archived(pages)
    assert sorted(map(tuple, payload_report(whole).collect())) == plain(rows)
    html = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    for r in whole.collect():
        fields = bytes(r.metadata[0].block).decode()
        page = int(fields.split(":")[1])
        assert r.request.block.startswith(b"GET ") and len(r.metadata) == 1
        assert r.response.payload is None if r.response.type == "revisit" else bytes(r.response.payload) == html[page]


def test_edges(spark):
    long = "é\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 20
    rows = [(1, "http://a/\r\nX: y z", None), (2, None, ""), (3, "u", "x" * 99), (4, "u", "x" * 99), (9, "u", long), (5, "v", long), (7, "w", long), (8, "u", "y" * 100), (10, "u", "z\x00" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as slice", "3 as capture")
    assert sorted(map(tuple, payload_report(archived(pages)).collect())) == plain(rows)
    assert archived(pages.limit(0)).collect() == []
    again = spark.createDataFrame([(1, "u", "q" * 200), (1, "u", "q" * 200), (None, "u", "q" * 200)], pages.schema[:3])
    got = payload_report(archived(again)).collect()
    assert sorted([(r.page_id, r.record_type, r.refers_to) for r in got], key=repr) == [(1, "response", None), (None, "revisit", 1)]


def text_of(kind, id, block=b"", **fields):
    head = [f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {id}\r\ncontent-length: {len(block)}"]
    head += [f"{n.replace('_', '-')}: {v}" for n, v in fields.items()]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("pack", [lambda parts: b"".join(parts), lambda parts: b"".join(map(gzip.compress, parts))])
def test_foreign_archives(spark, tmp_path, pack):
    """The response names the request, the metadata names the request, bytes are not UTF-8, one request is alone."""
    http = b"HTTP/1.1 200 OK\r\ncontent-length: 4\r\n\r\n\xff\r\n\r\n"
    parts = [
        text_of("warcinfo", "<i>", b"software: x\r\n"),
        text_of("request", "<q>", b"GET / HTTP/1.1\r\n\r\n"),
        text_of("response", "<r>", http, WARC_Concurrent_To="<q>", WARC_Target_URI="http://a/?x:y"),
        text_of("metadata", "<m1>", b"a: 1", WARC_Concurrent_To="<q>"),
        text_of("metadata", "<m2>", b"b: 2", WARC_Concurrent_To="<r>"),
        text_of("request", "<lost>", b"GET", WARC_Concurrent_To="<gone>"),
    ]
    (tmp_path / "part-0.warc").write_bytes(pack(parts))
    (row,) = assemble(read_archives(spark, str(tmp_path))).collect()
    assert row.record_id == "<r>" and row.request.record_id == "<q>" and [m.record_id for m in row.metadata] == ["<m1>", "<m2>"]
    assert bytes(row.response.payload) == b"\xff\r\n\r\n" and row.response.target_uri == "http://a/?x:y"


def test_query_returns_every_row(spark, tmp_path):
    """Equal rows of a response, of its revisit, and of a page too short to be referred to."""
    rows = [(1, "u", "q" * 200)] * 2 + [(2, "v", "q" * 200)] * 3 + [(3, "w", "short")] * 2 + [(4, "x", "z" * 200)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted([(r.page_id, r.record_type, r.refers_to) for r in op1_warc(spark, str(tmp_path)).collect()], key=repr)
    assert got == [(1, "response", None)] * 2 + [(2, "revisit", 1)] * 3 + [(3, "response", None)] * 2 + [(4, "response", None)]


def archive(records):
    parts = []
    for i, block in enumerate(records):
        head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <{i}>\r\nContent-Length: {len(block)}\r\n\r\n"
        parts.append(head.encode() + block + b"\r\n\r\n")
    return parts


def test_reader_on_any_compression():
    """One member, a member a record, members cut anywhere, and none; blocks hold ends of headers and exceed what is kept."""
    r = random.Random(8)
    blocks = [r.randbytes(n) for n in (0, 1, 70_000, 3 << 20, 5)] + [b"\r\n\r\n" * 20_000, b"a" * (2 << 20)] + [r.randbytes(40) for _ in range(400)]
    parts = archive(blocks)
    whole = b"".join(parts)
    cuts = sorted(r.randrange(len(whole)) for _ in range(20))
    members = [whole[a:b] for a, b in zip([0, *cuts], [*cuts, len(whole)], strict=True)]
    for content in (whole, gzip.compress(whole), b"".join(map(gzip.compress, parts)), b"".join(map(gzip.compress, members))):
        assert [block for _, block in Reader(content).records()] == blocks
    assert list(Reader(b"").records()) == []


def test_reader_takes_time_in_proportion():
    """Eight times the records take about eight times as long without compression, not sixty-four times."""

    def seconds(n):
        content = b"".join(archive([b"x" * 2000] * n))
        start = time.perf_counter()
        assert sum(1 for _ in Reader(content).records()) == n
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(32_000) < 24 * max(min(seconds(4000) for _ in range(3)), 0.01)
