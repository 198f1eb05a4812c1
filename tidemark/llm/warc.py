"""WARC archives as a chunked record table.

Payloads go to the archives, and come back from them, as rows of record and chunk number: nothing that writes or reads an
archive holds more of a payload than a chunk, and both carry the digest along and compare it with the header at the end.
Only the row of pages itself has its payload whole, and it is neither sorted nor shuffled while few payloads repeat. A payload that equals a later one is written as a revisit of it.
Archives are gzipped record by record and lie in the folder that driver and executors share; a written table lists those
that were finished, so the remains of a lost task are never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import join_narrow, materialize
from tidemark.storage import run_dir

CHUNK = 256 * 1024
ARCHIVE = 128 << 20  # bytes after which a task begins another archive
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "record string, type string, uri string, refers_to string, chunk int, data binary, bytes bigint, sha1 string, length bigint, last boolean"


def _name(record: str | None) -> str:
    return f"<urn:record:{quote(record or '', safe='')}>"


def _record(name: str | None) -> str | None:
    return unquote(name[len("<urn:record:") : -1]) or None if name else None


def _head(r: dict) -> bytes:
    digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
    lines = ["WARC/1.0", f"WARC-Type: {r['type']}", f"WARC-Record-ID: {_name(r['record'])}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {r['length']}"]
    if r["uri"] is not None:
        lines.append(f"WARC-Target-URI: {quote(r['uri'], safe=':/?#[]@!$&()*+,;=%~')}")
    if r["type"] == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(r['refers_to'])}"]
    else:
        lines.append("Content-Type: application/http; msgtype=response")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['length']}\r\n\r\n" if r["type"] == "response" else ""
    lines.append(f"Content-Length: {len(http) + r['length'] if http else 0}")
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


class _Archive:
    """An archive being written: one gzip member for each record."""

    def __init__(self, folder: str) -> None:
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        self.out, self.size, self.records, self.zip = fs.open_output_stream(f"{path}/{self.uri.rpartition('/')[2]}", compression=None), 0, 0, None

    def put(self, data: bytes) -> None:
        self.size += self.out.write(data) or len(data)

    def begin(self, r: dict) -> None:
        self.records += 1
        self.head, self.sha1 = r, hashlib.sha1()
        self.zip = zlib.compressobj(4, zlib.DEFLATED, 31)
        self.put(self.zip.compress(_head(r)))

    def add(self, data: bytes) -> None:
        self.sha1.update(data)
        self.put(self.zip.compress(data))

    def end(self) -> None:
        if self.head["type"] == "response" and self.sha1.hexdigest() != self.head["sha1"]:
            raise ValueError(f"record {self.head['record']}: its chunks are not its payload")
        self.put(self.zip.compress(b"\r\n\r\n") + self.zip.flush())


def write_archives(pages: DataFrame, folder: str, min_revisit: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", chunk: int = CHUNK) -> DataFrame:
    """A record per row of pages; gives the written list of archives: uri, records, bytes.

    Of rows with equal payloads of at least min_revisit bytes, those with the largest id are responses and the others
    revisit it; smaller payloads, and payloads of which no row has an id, are all responses. A null payload is an empty
    one; a null url gives no target; extra columns are left out. An empty table writes no archive. Rows that repeat an id are
    records each, with one WARC-Record-ID; of those with the largest id and equal payloads all are responses.
    """
    payload = F.coalesce(pages[payload_col], F.lit("")).cast("binary")
    rows = pages.select(pages[id_col].alias("id"), pages[url_col].cast("string").alias("uri"), payload.alias("payload"))
    keyed = rows.select("*", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("length"))
    # Payloads are equal if SHA-1, SHA-256 and length are: known pairs of files share the first. The digests alone are grouped;
    # those that repeat go to the payloads.
    keyed = keyed.withColumn("sha256", F.sha2("payload", 256))
    groups = keyed.groupBy("sha1", "sha256", "length").agg(F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1").drop("n")
    groups = materialize(groups, "repeated-payloads")
    revisit = (F.col("length") >= min_revisit) & F.col("keep").isNotNull() & ~F.col("id").eqNullSafe(F.col("keep"))
    records = join_narrow(keyed, groups, ["sha1", "sha256", "length"], "left", spread=F.xxhash64("id", "uri")).select(F.col("id").cast("string").alias("record"), F.when(revisit, "revisit").otherwise("response").alias("type"), "uri", F.when(revisit, F.col("keep").cast("string")).alias("refers_to"), "sha1", "length", F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"))
    starts = F.sequence(F.lit(0), F.greatest(F.octet_length("payload") - 1, F.lit(0)), F.lit(chunk))
    chunks = records.withColumn("at", F.explode(starts)).select("record", "type", "uri", "refers_to", "sha1", "length", F.col("at"), F.substring("payload", F.col("at") + 1, F.lit(chunk)).alias("data"), (F.col("at") + chunk >= F.octet_length("payload")).alias("last"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None

        def finished(a: _Archive) -> pa.RecordBatch:
            a.out.close()
            return pa.RecordBatch.from_pylist([{"uri": a.uri, "records": a.records, "bytes": a.size}], schema=pa.schema([("uri", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for b in batches:
            for k in range(len(b)):  # a chunk at a time
                r = b.slice(k, 1).to_pylist()[0]
                archive = archive or _Archive(folder)
                if r["at"] == 0:
                    archive.begin(r)
                archive.add(r["data"])
                if r["last"]:
                    archive.end()
                    if archive.size >= ARCHIVE:
                        yield finished(archive)
                        archive = None
        if archive:
            yield finished(archive)

    return materialize(chunks.mapInArrow(run, "uri string, records bigint, bytes bigint"), "archives")


class _Parser:
    """Takes decompressed bytes as they come and gives chunk rows."""

    def __init__(self, chunk: int) -> None:
        self.chunk, self.buffer, self.head, self.left = chunk, b"", None, 0

    def feed(self, data: bytes) -> Iterator[dict]:
        self.buffer += data
        while True:
            if self.head is None:
                text, found, rest = self.buffer.partition(b"\r\n\r\n")
                if not found:
                    return
                if not text:  # the end of the record before
                    self.buffer = rest
                    continue
                fields = dict(x.split(": ", 1) for x in text.decode().split("\r\n")[1:] if ": " in x)
                uri = fields.get("WARC-Target-URI")
                self.head = {"record": _record(fields["WARC-Record-ID"]), "type": fields["WARC-Type"], "uri": None if uri is None else unquote(uri), "refers_to": _record(fields.get("WARC-Refers-To"))}
                self.stated, self.length = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                self.left, self.number, self.bytes, self.sha1 = int(fields["Content-Length"]), 0, 0, hashlib.sha1()
                self.http = self.head["type"] == "response"
                self.buffer = rest
            if self.http:  # the block's own header stands before the payload
                text, found, rest = self.buffer.partition(b"\r\n\r\n")
                if not found:
                    return
                self.left -= len(text) + 4
                self.http, self.buffer = False, rest
            if self.left > len(self.buffer) < self.chunk:
                return
            part = self.buffer[: min(self.left, self.chunk)]
            self.buffer = self.buffer[len(part) :]
            self.left -= len(part)
            self.bytes += len(part)
            self.sha1.update(part)
            digest, last = base64.b32encode(self.sha1.digest()).decode(), self.left == 0
            if last and self.head["type"] == "response" and (digest, self.bytes) != (self.stated, self.length):
                raise ValueError(f"record {self.head['record']}: its payload is not what its header says")
            revisit = self.head["type"] == "revisit"
            yield self.head | {"chunk": self.number, "data": part, "bytes": self.bytes, "sha1": self.stated if revisit else digest, "length": self.length, "last": last}
            self.number += 1
            if last:
                self.head = None


def read_archives(archives: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """archives: uri. A row for each chunk of each record: record, type, uri, refers_to, chunk, data, and, as of this chunk, bytes and sha1 (base32) of the payload; length as the header says; whether it is the last. A revisit has one chunk without data, with the digest and length of what it revisits. A payload that isn't what its header says stops the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("record", pa.string()), ("type", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()), ("chunk", pa.int32()), ("data", pa.binary()), ("bytes", pa.int64()), ("sha1", pa.string()), ("length", pa.int64()), ("last", pa.bool_())])
        for b in batches:
            for uri in b.column("uri").to_pylist():
                fs, path = pafs.FileSystem.from_uri(uri)
                rows, held, parser, unzip = [], 0, _Parser(chunk), None
                with fs.open_input_stream(path, compression=None) as stream:
                    while data := stream.read(chunk):
                        while data:
                            unzip = unzip or zlib.decompressobj(31)
                            for row in parser.feed(unzip.decompress(data, chunk)):
                                rows.append(row)
                                held += len(row["data"])
                                if held >= 8 * chunk or len(rows) >= 2000:
                                    yield pa.RecordBatch.from_pylist(rows, schema=kind)
                                    rows, held = [], 0
                            data = unzip.unconsumed_tail or unzip.unused_data
                            if unzip.eof:
                                unzip = None
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kind)

    n = max(1, archives.count())
    return archives.select("uri").repartition(n).mapInArrow(run, CHUNKS)


def round_trip(spark: SparkSession, pages: DataFrame, min_revisit: int = 0, **columns: str) -> DataFrame:
    """Writes pages to archives in the shared folder and gives the chunk table that is read back from them."""
    return read_archives(write_archives(pages, f"{run_dir(spark)}/warc-{uuid.uuid4().hex}", min_revisit, **columns))
