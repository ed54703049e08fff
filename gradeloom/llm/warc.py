"""WARC archives as a Spark data source, for reading and writing.

Writing: each task rolls files of gzip members, one member a record, with the member's
length in an extra field of its header ("sl", skip lengths). Files become visible at the
commit only, so a lost or repeated task leaves no record twice.

Reading: a partition is one file: every ``.warc`` and ``.warc.gz`` below the path, or the file that
the path names. Files are plain, gzip members of a record each, or gzip of any other layout. Filters on the record type and on named headers are
taken over from Spark. A record's headers are parsed first, from the beginning of its
member; if the record is not wanted, the rest of the member is neither read nor decoded. Of
plain files the rest is passed over by seeking; of gzip without lengths it is inflated, not kept.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from gradeloom.llm.common import shared_folder, written

ROLL_BYTES = 128 << 20
HEAD_BYTES = 4096
BATCH_BYTES = 8 << 20
BATCH_ROWS = 512
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:page:"

#: Columns of a record, and the header each stands for.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "declared_digest": "WARC-Payload-Digest",
    "declared_bytes": "X-Payload-Length",
}
RECORDS = ", ".join(f"{c} string" for c in HEADERS) + ", payload binary, payload_digest string, payload_bytes long"
INPUT = "record_id string, record_type string, target_uri string, date string, refers_to string, payload binary"


def payload_digest(payload: bytes) -> str:
    """Base32 of the SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


# ---- members


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """One gzip member whose header says how long it and its content are."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    length = 12 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", 12)
    extra = b"sl" + struct.pack("<HII", 8, length & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record_bytes(row: dict) -> bytes:
    """A whole WARC record: named headers, then an HTTP response head, then (for a response) the payload."""
    payload = row["payload"] or b""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + (payload if row["record_type"] == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}"]
    for column in ("record_id", "target_uri", "date", "refers_to"):
        if row[column] is not None:
            value = row[column].replace("\r", "%0D").replace("\n", "%0A")
            lines.append(f"{HEADERS[column]}: {'<' + value + '>' if column in ('record_id', 'refers_to') else value}")
    lines += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", f"X-Payload-Length: {len(payload)}"]
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse_headers(head: bytes) -> dict[str, str]:
    """Named headers by lower-case name; a later line of the same name replaces an earlier one."""
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def read_sequence(source, wanted: Callable[[dict[str, str]], bool]) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of the wanted records that stand one after another in a file of bytes."""
    while line := source.readline():
        if not line.strip():
            continue  # between two records
        if not line.startswith(b"WARC/"):
            raise ValueError("no record begins where one should")
        head = [line]
        while (line := source.readline()).strip():
            head.append(line)
        headers = parse_headers(b"\r\n".join(x.rstrip(b"\r\n") for x in head))
        size = int(headers["content-length"])
        if not wanted(headers):
            source.seek(size, io.SEEK_CUR)
            continue
        block = source.read(size)
        if len(block) < size:
            raise ValueError("a record ends before its length")
        yield headers, block


def read_members(stream, wanted: Callable[[dict[str, str]], bool]) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of the wanted records of one file of gzip members.

    Members that tell their length hold one record each; unwanted ones are passed over by
    seeking. From the first member without a length on, the file is read as one sequence of
    records, wherever its members begin and end; nothing of an unwanted record is kept.
    """
    at, size = 0, stream.size()
    while at < size:
        stream.seek(at)
        raw = stream.read(HEAD_BYTES)
        if raw[:4] != b"\x1f\x8b\x08\x04" or raw[12:14] != b"sl":
            stream.seek(at)
            yield from read_sequence(gzip.GzipFile(fileobj=stream), wanted)
            return
        length = struct.unpack_from("<I", raw, 16)[0]
        inflate = zlib.decompressobj(31)
        data = inflate.decompress(raw)
        fed = len(raw)

        def more(n: int) -> bool:
            nonlocal data, fed
            chunk = stream.read(n)
            fed += len(chunk)
            data += inflate.decompress(chunk)
            return bool(chunk)

        while b"\r\n\r\n" not in data and not inflate.eof and more(HEAD_BYTES):
            pass
        head, _, block = data.partition(b"\r\n\r\n")
        headers = parse_headers(head)
        if wanted(headers):
            while not inflate.eof and more(max(HEAD_BYTES, min(length - fed, BATCH_BYTES))):
                pass
            if not inflate.eof:
                raise ValueError("a record ends before its length")
            block = data[len(head) + 4 :]
            yield headers, block[: int(headers.get("content-length", len(block)))]
        at += length


def read_records(stream, wanted: Callable[[dict[str, str]], bool]) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of the wanted records of one file, plain or gzip."""
    packed = stream.read(2) == b"\x1f\x8b"
    stream.seek(0)
    return read_members(stream, wanted) if packed else read_sequence(io.BufferedReader(stream), wanted)


# ---- the data source


@dataclass
class Archive(InputPartition):
    path: str
    size: int


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


def _bare(value: str | None) -> str | None:
    return value[1:-1] if value and value[0] == "<" and value[-1] == ">" else value


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "full")
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list) -> Iterable:
        """Take over equality, membership, prefix and presence tests on header columns; return the rest to Spark."""
        for f in filters:
            column = ".".join(getattr(f, "attribute", ()))
            if column in HEADERS and isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.tests.append((column, "in", (f.value,)))
            elif column in HEADERS and isinstance(f, In) and None not in f.value:
                self.tests.append((column, "in", tuple(f.value)))
            elif column in HEADERS and isinstance(f, StringStartsWith):
                self.tests.append((column, "prefix", (f.value,)))
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.tests.append((column, "present", ()))
            else:
                yield f

    def wanted(self, headers: dict[str, str]) -> bool:
        for column, how, values in self.tests:
            value = _bare(headers.get(HEADERS[column].lower()))
            if value is None or how == "in" and value not in values or how == "prefix" and not value.startswith(values):
                return False
        return True

    def partitions(self) -> list[Archive]:
        fs, root = file_system(self.path)
        infos = [fs.get_file_info(root)]
        if infos[0].type != pafs.FileType.File:
            found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True))
            hidden = lambda path: any(part[:1] in "._" for part in path[len(root) :].strip("/").split("/"))
            infos = [i for i in found if i.is_file and i.path.endswith((".warc", ".warc.gz")) and not hidden(i.path)]
        return [Archive(i.path, i.size) for i in infos] or [Archive("", 0)]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = file_system(self.path)
        rows, held = [], 0
        with fs.open_input_file(partition.path) as stream:
            for headers, block in read_records(stream, self.wanted):
                body = block.partition(b"\r\n\r\n")[2]
                row = {c: _bare(headers.get(h.lower())) for c, h in HEADERS.items()}
                if self.payload != "none" and row["record_type"] == "response":
                    row |= {"payload_digest": payload_digest(body), "payload_bytes": len(body)}
                    if self.payload == "full":
                        row["payload"] = body
                        held += len(body)
                rows.append(row)
                if held > BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[dict]) -> pa.RecordBatch:
        kinds = {"payload": pa.binary(), "payload_bytes": pa.int64()}
        names = [c.split()[0] for c in RECORDS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], kinds.get(c, pa.string())) for c in names], names=names)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.roll = int(options.get("roll_bytes", ROLL_BYTES))
        self.pending = f"_pending-{uuid.uuid4().hex}"  # of this write alone; its tasks share it

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = file_system(self.path)
        fs.create_dir(f"{root}/{self.pending}", recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                for begin in range(0, batch.num_rows, BATCH_ROWS):
                    for row in batch.slice(begin, BATCH_ROWS).to_pylist():
                        if out is None:
                            files.append(f"{uuid.uuid4().hex}.warc.gz")
                            out, size = fs.open_output_stream(f"{root}/{self.pending}/{files[-1]}", compression=None), 0
                        member = gzip_member(record_bytes(row))
                        out.write(member)
                        size += len(member)
                        if size >= self.roll:
                            out.close()
                            out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        for message in messages:
            for name in message.files if message else ():
                fs.move(f"{root}/{self.pending}/{name}", f"{root}/{name}")
        self._clear(fs, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*file_system(self.path))

    def _clear(self, fs: pafs.FileSystem, root: str) -> None:
        if fs.get_file_info(f"{root}/{self.pending}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.pending}")


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``; option ``payload``: full (default), digest or none."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, payload: str = "full") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)


def write_warc(records: DataFrame, path: str) -> None:
    """Write rows of ``record_id, record_type, target_uri, date, refers_to, payload``; other columns are ignored."""
    register(records.sparkSession)
    columns = [c.split()[0] for c in INPUT.split(", ")]
    records.select(*columns).write.format("warc").mode("append").save(path)


def page_records(pages: DataFrame, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """A record per row of ``pages``: of equal payloads the one with the smallest page_id is the response.

    A null html is an empty payload. Rows that repeat the smallest page_id are responses
    too; rows without an id are responses, and no revisit refers to them.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    sized = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    # written, so that the join below reads both sides by shuffle and hot digests can be split
    owners = written(
        sized.groupBy("digest").agg(F.min("page_id").alias("owner"), F.count("*").alias("copies")).where("copies > 1"),
        "warc-owners",
    ).drop("copies")
    again = (F.col("page_id") != F.col("owner")) & (F.octet_length("payload") >= min_revisit_bytes)
    return (
        sized.join(owners, "digest", "left")
        .withColumn("again", F.coalesce(again, F.lit(False)))
        .select(
            F.concat(F.lit(PAGE_URN), F.coalesce(F.col("page_id").cast("string"), F.lit(""))).alias("record_id"),
            F.when(F.col("again"), "revisit").otherwise("response").alias("record_type"),
            F.col("url").alias("target_uri"),
            F.lit(date).alias("date"),
            F.when(F.col("again"), F.concat(F.lit(PAGE_URN), F.col("owner").cast("string"))).alias("refers_to"),
            "payload",
        )
    )


def archive_pages(pages: DataFrame, path: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as WARC below the shared folder, read them back, and tell what each record holds.

    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``: figures of a
    response are measured on the payload read, those of a revisit come from its headers.
    """
    spark = pages.sparkSession
    path = path or shared_folder(spark, "warc")
    write_warc(page_records(pages, min_revisit_bytes), path)
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    return read_warc(spark, path, "digest").select(
        number("record_id").alias("page_id"),
        F.col("target_uri").alias("url"),
        F.coalesce("payload_bytes", F.col("declared_bytes").cast("long")).alias("payload_bytes"),
        F.coalesce("payload_digest", F.regexp_replace("declared_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
