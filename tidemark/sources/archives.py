"""Zip archives by member: an archive's directory says where its members lie, and each is read from there by a task of its own.

No task and no row holds an archive; members stream through a buffer. Files are opened through pyarrow's file systems (local,
hdfs, s3, gs), at the paths under which Spark lists them.
"""

from __future__ import annotations

import codecs
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.storage import materialize, run_dir

BUFFER = 1 << 20
STORED, DEFLATED = 0, 8
MEMBERS = "archive string, member string, offset bigint, packed bigint, size bigint, method bigint, crc bigint"
HELD = 5000


def listed(spark: SparkSession, paths: str | list[str], glob: str = "*") -> DataFrame:
    """path, length of the files below folders, of files, and of what patterns name, in any mix and at any depth, whose names fit `glob`. Contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(paths).select("path", "length")


def _opened(path: str) -> pa.NativeFile:
    where, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if "://" in path or path.startswith("file:") else f"file://{path}")
    return where.open_input_file(name)


def members(archives: DataFrame, wanted: str = r".*") -> DataFrame:
    """archives: path. A row for each member whose whole name fits `wanted`: where its header begins, its bytes packed and unpacked, how it is packed, and its checksum. Of an archive only the directory at its end is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                with _opened(path) as f, zipfile.ZipFile(f) as z:
                    found = [i for i in z.infolist() if not i.is_dir() and re.fullmatch(wanted, i.filename)]
                rows = [{"archive": path, "member": i.filename, "offset": i.header_offset, "packed": i.compress_size, "size": i.file_size, "method": i.compress_type, "crc": i.CRC} for i in found]
                for lo in range(0, len(rows), HELD):
                    yield pa.RecordBatch.from_pylist(rows[lo : lo + HELD])

    return archives.select("path").mapInArrow(run, MEMBERS)


def _unpacked(f: pa.NativeFile, offset: int, packed: int, method: int) -> Iterator[bytes]:
    """The bytes of a member, a buffer at a time."""
    f.seek(offset)
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"no member begins at {offset}")
    f.seek(offset + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
    if method not in (STORED, DEFLATED):
        raise ValueError(f"packed by method {method}: only stored and deflated members can be streamed")
    inflate = zlib.decompressobj(-15) if method == DEFLATED else None
    left = packed
    while left > 0:
        data = f.read(min(BUFFER, left))
        if not data:
            raise ValueError("the archive ends inside a member")
        left -= len(data)
        while inflate and data:
            yield inflate.decompress(data, BUFFER)
            data = inflate.unconsumed_tail
        if data:
            yield data
    if inflate:
        yield inflate.flush()


def lines(of: DataFrame, contains: str | None = None, tasks: int | None = None) -> DataFrame:
    """of: members. archive, member, n (from 0), line: lines end at newlines, with or without a carriage return; what isn't UTF-8 becomes U+FFFD. `contains` drops lines before they leave the task.

    Members are dealt to as many tasks as there are members, up to `tasks` (by default twice the cores). A checksum that doesn't fit is an error.
    An empty member has no lines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m in b.to_pylist():
                held: list[dict] = []
                for n, line in enumerate(_lines(m)):
                    if contains is None or contains in line:
                        held.append({"archive": m["archive"], "member": m["member"], "n": n, "line": line})
                    if len(held) >= HELD:
                        yield pa.RecordBatch.from_pylist(held)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held)

    parts = tasks or 2 * of.sparkSession.sparkContext.defaultParallelism
    return of.repartition(parts).mapInArrow(run, "archive string, member string, n bigint, line string")


def _lines(m: dict) -> Iterator[str]:
    decode, rest, crc = codecs.getincrementaldecoder("utf-8")("replace"), "", 0
    with _opened(m["archive"]) as f:
        for data in _unpacked(f, m["offset"], m["packed"], m["method"]):
            crc = zlib.crc32(data, crc)
            *whole, rest = (rest + decode.decode(data)).split("\n")
            yield from (x.removesuffix("\r") for x in whole)
    if crc != m["crc"]:
        raise ValueError(f"{m['member']} of {m['archive']} doesn't fit its checksum")
    rest += decode.decode(b"", True)
    if rest:
        yield rest.removesuffix("\r")


def _crc_joined(a: int, b: int, n: int) -> int:
    """The CRC-32 of bytes with the CRC a followed by n bytes with the CRC b: a times x to the power of 8 n, modulo the polynomial, and b."""

    def times(u: int, v: int) -> int:
        out = 0
        for k in range(31, -1, -1):
            if u >> k & 1:
                out ^= v
            v = v >> 1 ^ (0xEDB88320 if v & 1 else 0)
        return out

    power = 1 << 23
    while n:
        if n & 1:
            a = times(power, a)
        power, n = times(power, power), n >> 1
    return a ^ b


def _pieces(dealt: DataFrame, folder: str) -> DataFrame:
    """dealt: member, line, in the order in which they are to be written. A row for each member of each partition: which file has its lines packed, from where on, and what they come to. Packed pieces end at a byte and without a last block, so that they can be put one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path = f"{folder}/{part:06}-{TaskContext.get().taskAttemptId()}"
        where, name = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        done, now, deflate = [], None, None
        with where.open_output_stream(name) as sink:

            def add(packed: bytes) -> None:
                sink.write(packed)
                now["packed"] += len(packed)

            for b in batches:
                for m, text in zip(b.column("member").to_pylist(), b.column("line").to_pylist(), strict=True):
                    if now is None or m != now["member"]:
                        if now:
                            add(deflate.flush(zlib.Z_FULL_FLUSH))
                        now, deflate = {"member": m, "part": part, "path": path, "offset": sink.tell(), "packed": 0, "size": 0, "crc": 0, "lines": 0}, zlib.compressobj(wbits=-15)
                        done.append(now)
                    data = text.encode() + b"\n"
                    add(deflate.compress(data))
                    now["size"], now["crc"], now["lines"] = now["size"] + len(data), zlib.crc32(data, now["crc"]), now["lines"] + 1
            if now:
                add(deflate.flush(zlib.Z_FULL_FLUSH))
        for lo in range(0, len(done), HELD):
            yield pa.RecordBatch.from_pylist(done[lo : lo + HELD])

    return dealt.select("member", "line").mapInArrow(run, "member string, part bigint, path string, offset bigint, packed bigint, size bigint, crc bigint, lines bigint")


#: Bytes of lines that one task packs.
PIECE = 64 << 20
LAST_BLOCK = b"\x03\x00"


def write(rows: DataFrame, folder: str, member: str, order: list[str], line: str, archives: int, piece: int = PIECE) -> DataFrame:
    """Writes lines to members of so many zip files in a folder that the tasks share, each member whole in one of them; path, members and lines of each.

    Lines are dealt by ranges of member and `order`, about `piece` bytes to a task, and packed there, a large member by many
    tasks; a task for each archive then copies what is packed, a buffer at a time. A task that is lost writes its file anew.
    """
    local, held = folder.removeprefix("file://"), f"{run_dir(rows.sparkSession)}/pieces-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/part-{TaskContext.get().partitionId():05}.zip"
        where, name = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        n_members, n_lines = 0, 0
        with where.open_output_stream(name) as sink, zipfile.ZipFile(sink, "w") as z:
            for b in batches:
                for m in b.to_pylist():
                    info = zipfile.ZipInfo(m["member"])
                    info.compress_type, info.header_offset = zipfile.ZIP_DEFLATED, z.fp.tell()
                    for p in m["pieces"]:
                        info.CRC, info.file_size, info.compress_size = _crc_joined(info.CRC, p["crc"], p["size"]) if info.file_size else p["crc"], info.file_size + p["size"], info.compress_size + p["packed"]
                    info.compress_size += len(LAST_BLOCK)
                    z.fp.write(info.FileHeader(zip64=True))
                    for p in m["pieces"]:
                        with _opened(p["path"]) as f:
                            f.seek(p["offset"])
                            for lo in range(0, p["packed"], BUFFER):
                                z.fp.write(f.read(min(BUFFER, p["packed"] - lo)))
                    z.fp.write(LAST_BLOCK)
                    z.filelist.append(info)
                    z.start_dir = z.fp.tell()
                    n_members, n_lines = n_members + 1, n_lines + sum(p["lines"] for p in m["pieces"])
        yield pa.RecordBatch.from_pylist([{"path": path, "members": n_members, "lines": n_lines}])

    for d in (folder, held):
        fs.FileSystem.from_uri(d if "://" in d else f"file://{d}")[0].create_dir(d.removeprefix("file://"), recursive=True)
    dealt = rows.select(F.col(member).cast("string").alias("member"), F.coalesce(F.col(line), F.lit("")).alias("line"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(order)]).where("member is not null")
    size = dealt.agg(F.sum(F.octet_length("line").cast("bigint") + 1)).first()[0] or 0
    by = ["member", *[f"_{i}" for i in range(len(order))]]
    dealt = dealt.repartitionByRange(max(archives, -(-size // piece)), *by).sortWithinPartitions(*by)
    packed = materialize(_pieces(dealt, held), "pieces")
    whole = packed.groupBy("member").agg(F.sort_array(F.collect_list(F.struct("part", *[c for c in packed.columns if c not in ("member", "part")]))).alias("pieces"))
    return whole.repartition(archives, "member").sortWithinPartitions("member").mapInArrow(run, "path string, members bigint, lines bigint")
