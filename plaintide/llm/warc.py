"""WARC archives: writing captures as records, reading them back, and assembling transactions.

A capture is a response record (or a revisit of an earlier response with the same payload), a request and a
metadata record. Archives are written by Spark's text writer, whose line separator is the one that ends a WARC
record, so files lie wherever Spark can write; they are gzip files of RECORDS records each. They are read as
binary files, one file after another in a task, record by record by their Content-Length, so that payloads may hold
any bytes.

Transaction assembly joins the records through WARC-Concurrent-To. A request may name its response or be named by
it, and a metadata record may name either; a record of any other type, or one that names nothing known, stands
alone and is no capture. Every join is on record ids. A capture has few records, so no key is hot but the
response that many revisits refer to: that join is dealt over slices.

Payloads are equal if their SHA-256 is. A null payload is empty. Of equal payloads of at least ``least`` bytes the
one with the smallest page_id (null last) is the response. Rows that agree in page_id, url and html are one
capture and give one row, or as many as were archived with ``every``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintide.llm.shared import shared_folder, ship_package, slice_of, spread_totals, stored

LEAST = 100
RECORDS = 2000
DATE = "1970-01-01T00:00:00Z"
LINE = "\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def header(*fields: tuple[str, Column]) -> Column:
    """The fields that are not null, one a line."""
    return F.concat_ws(LINE, F.lit("WARC/1.1"), *[F.concat(F.lit(f"{n}: "), v) for n, v in fields])


def record(kind: Column, id: Column, block: Column, content_type: str, **more: Column) -> Column:
    """A record without the end that the writer adds."""
    fields = [(n.replace("_", "-"), c) for n, c in more.items()]
    head = header(
        ("WARC-Type", kind), ("WARC-Record-ID", id), ("WARC-Date", F.lit(DATE)), *fields,
        ("Content-Type", F.lit(content_type)), ("Content-Length", F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit(END), block)


def captures(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, bytes, digest, capture, refers_to): refers_to is the capture that a revisit repeats."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"bytes": F.octet_length("payload"), "digest": F.sha2(F.col("payload").cast("binary"), 256), "slice": slice_of("page_id", "url")}
    )
    own = F.format_string("%s-%016x", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.xxhash64("page_id", "url", "payload"))
    rows = rows.withColumn("capture", own)
    order = F.struct(F.col("page_id").isNull().alias("absent"), "page_id", "capture")
    partial = rows.filter(F.col("bytes") >= least).groupBy("digest", "slice").agg(F.min(order).alias("first"))
    firsts = spread_totals(partial, ["digest"], {"first": F.min("first")}).select("digest", "slice", F.col("first.capture").alias("first"))
    rows = rows.join(firsts.hint("shuffle_hash"), ["digest", "slice"], "left")
    return rows.withColumn("refers_to", F.when(F.col("first") != F.col("capture"), F.col("first"))).drop("first", "slice")


def write_archives(pages: DataFrame, folder: str, least: int = LEAST) -> None:
    """Three records per page, next to each other."""
    urn = lambda capture, part: F.concat(F.lit("<urn:capture:"), capture, F.lit(f":{part}>"))
    # Characters that would end a header field or a request line.
    uri = F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20")
    answer, revisit = urn(F.col("capture"), "response"), F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "), F.col("bytes").cast("string"), F.lit(END)
    )
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    full = record(F.lit("response"), answer, F.concat(http, F.col("payload")), "application/http; msgtype=response",
                  WARC_Target_URI=uri, WARC_Payload_Digest=digest)
    again = record(F.lit("revisit"), answer, http, "application/http; msgtype=response",
                   WARC_Target_URI=uri, WARC_Payload_Digest=digest, WARC_Profile=F.lit(PROFILE), WARC_Refers_To=urn(F.col("refers_to"), "response"))
    request = record(F.lit("request"), urn(F.col("capture"), "request"), F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(f" HTTP/1.1{END}")),
                     "application/http; msgtype=request", WARC_Target_URI=uri, WARC_Concurrent_To=answer)
    fields = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(LINE))
    metadata = record(F.lit("metadata"), urn(F.col("capture"), "metadata"), fields, "application/warc-fields",
                      WARC_Target_URI=uri, WARC_Concurrent_To=urn(F.col("capture"), "request"))
    values = captures(pages, least).select(F.explode(F.array(F.when(revisit, again).otherwise(full), request, metadata)).alias("value"))
    values.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(folder)


class Reader:
    """Bytes of one archive, inflated as far as they are asked for; a place in them moves on, so no rest is copied."""

    KEEP = 1 << 20

    def __init__(self, content: bytes) -> None:
        self.zipped = content[:2] == b"\x1f\x8b"
        self.content, self.at = content, 0
        self.ready, self.place = bytearray() if self.zipped else content, 0
        self.inflate = zlib.decompressobj(31)

    def more(self) -> bool:
        if not self.zipped or self.at >= len(self.content):
            return False
        if self.place > self.KEEP:
            del self.ready[: self.place]
            self.place = 0
        step = self.content[self.at : self.at + (1 << 16)]
        self.at += len(step)
        self.ready += self.inflate.decompress(step)
        while self.inflate.eof and self.inflate.unused_data:
            left, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            self.ready += self.inflate.decompress(left)
        return True

    def until(self, end: bytes) -> bytes | None:
        looked = self.place
        while (at := self.ready.find(end, looked)) < 0:
            unseen, before = max(len(self.ready) - len(end) + 1, self.place), self.place
            if not self.more():
                return None
            looked = unseen - (before - self.place)
        found = bytes(self.ready[self.place : at])
        self.place = at + len(end)
        return found

    def take(self, size: int) -> bytes:
        while len(self.ready) - self.place < size and self.more():
            pass
        found = bytes(self.ready[self.place : self.place + size])
        self.place += len(found)
        return found

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """(header fields by lower-case name, block) of every record."""
        while (head := self.until(END.encode())) is not None:
            lines = head.decode("utf-8", "replace").lstrip().split(LINE)
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no WARC record: {lines[0][:40]}")
            fields = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines[1:])}
            yield fields, self.take(int(fields.get("content-length", 0)))
            self.take(len(END))


RECORD = (
    "record_id string, type string, target_uri string, concurrent_to string, refers_to string, digest string, "
    "http_length long, payload_bytes long, payload_sha256 string, payload binary, block binary"
)


def http_parts(block: bytes) -> tuple[int | None, bytes]:
    """The content length that an HTTP message names, and its body."""
    head, _, body = block.partition(END.encode())
    for line in head.split(LINE.encode())[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value), body
    return None, body


def parser(payloads: bool):
    names = [f.split()[0] for f in RECORD.split(", ")]
    types = [pa.int64() if "long" in f else pa.binary() if "binary" in f else pa.string() for f in RECORD.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def row(fields: dict[str, str], block: bytes) -> tuple:
        kind = fields.get("warc-type")
        whole = kind == "response"
        length, body = http_parts(block) if kind in ("response", "revisit") else (None, None)
        return (
            fields.get("warc-record-id"), kind, fields.get("warc-target-uri"), fields.get("warc-concurrent-to"),
            fields.get("warc-refers-to"), fields.get("warc-payload-digest"), length,
            len(body) if whole else None, hashlib.sha256(body).hexdigest() if whole else None,
            body if whole and payloads else None, None if whole else block,
        )

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in Reader(content.as_py()).records():
                    rows.append(row(fields, block))
                    size += len(block)
                    if size > 1 << 22:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return parsed


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of all archives of a folder; payloads are read and digested, and returned if wanted."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*part-*").load(folder)
    return files.select("content").mapInArrow(parser(payloads), RECORD)


def assemble(records: DataFrame, every: bool = False) -> DataFrame:
    """One nested row per capture: record_id, response, request (null if absent), metadata (a list).

    With ``every``, a capture whose response is there more than once gives a row for each.
    """
    copies = records.filter("type in ('response', 'revisit')").groupBy("record_id").agg(F.count("*").alias("copies"))
    records = records.dropDuplicates(["record_id"])
    answers = records.filter("type in ('response', 'revisit')")
    named = answers.select(F.col("record_id").alias("named"), F.col("record_id").alias("anchor")).unionByName(
        answers.filter("concurrent_to is not null").select(F.col("concurrent_to").alias("named"), F.col("record_id").alias("anchor"))
    )

    def anchored(rows: DataFrame, links: DataFrame) -> DataFrame:
        """The rows with the response that they name, or that names them."""
        links = links.groupBy("named").agg(F.min("anchor").alias("anchor"))
        through = links.select(F.col("named").alias("concurrent_to"), F.col("anchor").alias("to"))
        back = links.select(F.col("named").alias("record_id"), F.col("anchor").alias("by"))
        found = rows.join(through, "concurrent_to", "left").join(back, "record_id", "left")
        return found.withColumn("anchor", F.coalesce("to", "by")).drop("to", "by").filter("anchor is not null")

    small = F.struct("record_id", "target_uri", "block")
    requests = anchored(records.filter("type = 'request'").drop("payload"), named)
    links = named.unionByName(requests.select(F.col("record_id").alias("named"), "anchor"))
    metadata = anchored(records.filter("type = 'metadata'").drop("payload"), links)
    asked = requests.groupBy(F.col("anchor").alias("record_id")).agg(F.min(small).alias("request"))
    told = metadata.groupBy(F.col("anchor").alias("record_id")).agg(F.sort_array(F.collect_list(small)).alias("metadata"))
    whole = answers.join(asked, "record_id", "left").join(told, "record_id", "left")
    response = F.struct("type", "target_uri", "refers_to", "digest", "http_length", "payload_bytes", "payload_sha256", "payload")
    if every:
        times = F.array_repeat(F.lit(0), F.coalesce(F.col("copies"), F.lit(1)).cast("int"))
        whole = whole.join(copies.filter("copies > 1"), "record_id", "left").withColumn("copy", F.explode(times)).drop("copies", "copy")
    none = F.array().cast(whole.schema["metadata"].dataType)
    return whole.select("record_id", response.alias("response"), "request", F.coalesce("metadata", none).alias("metadata"))


def payload_report(assembled: DataFrame) -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type, refers_to (the page_id of the response)."""
    page = F.regexp_extract(F.decode(F.col("metadata")[0]["block"], "UTF-8"), "page-id: (-?\\d+)", 1)
    rows = assembled.select(
        "record_id",
        F.when(page != "", page).cast("long").alias("page_id"),
        F.coalesce("response.payload_bytes", "response.http_length").alias("payload_bytes"),
        F.coalesce("response.payload_sha256", F.expr("substring_index(response.digest, ':', -1)")).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("first"),
    ).withColumn("slice", slice_of("record_id"))
    first = rows.select(F.col("record_id").alias("first"), F.col("page_id").alias("refers_to")).dropDuplicates(["first"])
    spread = rows.filter("first is not null").select("first", "slice").distinct().join(first, "first")
    return rows.join(spread, ["first", "slice"], "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def archived(pages: DataFrame, folder: str | None = None, least: int = LEAST, payloads: bool = True, every: bool = False) -> DataFrame:
    """The captures of ``pages``, written to archives and read back; without ``payloads`` their digests only.

    With ``every``, each row of ``pages`` gives one.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    write_archives(pages, folder, least)
    return assemble(stored(read_archives(spark, folder, payloads), "records"), every)
