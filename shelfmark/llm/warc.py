"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading. Files are planned into partitions by their sizes. A record's headers are parsed first; the
record type and every header can be tested there, by filters that Spark pushes down. The payload of
a record that fails, or whose payload no column asks for, is not decoded: in plain files it is
skipped by its length, in compressed ones by the length that the record's gzip header tells (field
``sl``); only where an archive lacks that field it is inflated, piece by piece, to find its end.

Writing. Each task writes files of its own, named for this attempt. The job is committed by one list
of the files of the attempts that succeeded, so files that a lost executor leaves behind are never
read, and the data that was there before stays until the list is in place.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull,
    StringStartsWith, WriterCommitMessage,
)

from ..sources.shared import stored
from .common import bounded_batches, column

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
# Fixed values of the format: columns of the source and the headers that hold them. Any other
# column is the header of that name, with - for _.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "record_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "profile": "WARC-Profile",
    "content_type": "Content-Type",
    "block_length": "Content-Length",
}
VERSION = b"WARC/1.1\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"
SCHEMA = "record_type string, record_id string, target_uri string, record_date string, payload_digest string, refers_to string, block_length long, payload binary"
PARTITION_BYTES = 64 << 20
FILE_BYTES = 512 << 20
# Bytes read at first, for the headers of a record, and inflated at a time.
PIECE = 8 << 10
BATCH_BYTES = 4 << 20
BATCH_ROWS = 1000


def header_of(name: str) -> str:
    return HEADERS.get(name) or name.replace("_", "-")


def digest(payload: bytes) -> str:
    """Base-32 SHA-1, as archives write it after ``sha1:``."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Where Spark and Arrow both reach ``path``: shared folders, HDFS or an object store."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def encoded(headers: dict[str, str], block: bytes, level: int) -> bytes:
    """One record as a gzip member that knows its own lengths."""
    lines = [VERSION]
    for name, value in headers.items():
        value = value.replace("\r", "%0D").replace("\n", "%0A")
        lines.append(f"{name}: {value}\r\n".encode())
    plain = b"".join([*lines, f"Content-Length: {len(block)}\r\n\r\n".encode(), block, b"\r\n\r\n"])
    press = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = press.compress(plain) + press.flush()
    # 10 bytes of header, 2 + 12 of the extra field, the body, 8 of trailer.
    extra = struct.pack("<HccHII", 12, b"s", b"l", 8, (len(body) + 32) & 0xFFFFFFFF, len(plain) & 0xFFFFFFFF)
    return (
        b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + extra + body
        + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)
    )


def _member_length(head: bytes) -> int | None:
    """The length of a gzip member, if its header tells."""
    if len(head) < 12 or not head[3] & 4:
        return None
    end = 12 + struct.unpack_from("<H", head, 10)[0]
    at = 12
    while at + 4 <= min(end, len(head)):
        size = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"sl" and size == 8 and at + 12 <= len(head):
            return struct.unpack_from("<I", head, at + 4)[0] or None
        at += 4 + size
    return None


class _Member:
    """The bytes of one compressed record, inflated as far as they are asked for."""

    def __init__(self, file, start: int):
        self.file, self.start = file, start
        file.seek(start)
        head = file.read(PIECE)
        self.length = _member_length(head)
        self.inflate = zlib.decompressobj(31)
        self.left = head
        self.plain = bytearray()

    def more(self) -> bytes:
        """The next inflated bytes, none at the end."""
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.left or self.file.read(PIECE * 8)
            if not data:
                raise ValueError(f"the record at {self.start} is cut off")
            self.left = b""
            out = self.inflate.decompress(data, PIECE * 8)
            if out:
                return out
        return b""

    def until(self, size: int) -> bytes:
        while len(self.plain) < size:
            out = self.more()
            if not out:
                raise ValueError(f"the record at {self.start} is cut off")
            self.plain += out
        return bytes(self.plain[:size])

    def end(self) -> int:
        """Where the next record begins; nothing is inflated for it if the length is known."""
        if self.length is not None:
            return self.start + self.length
        while self.more():
            pass
        return self.file.tell() - len(self.inflate.unused_data)


class _Plain:
    """The bytes of one record of a file without compression."""

    def __init__(self, file, start: int):
        self.file, self.start = file, start
        self.plain = bytearray()
        file.seek(start)

    def until(self, size: int) -> bytes:
        if len(self.plain) < size:
            self.plain += self.file.read(max(PIECE, size - len(self.plain)))
        if len(self.plain) < size:
            raise ValueError(f"the record at {self.start} is cut off")
        return bytes(self.plain[:size])


def _headers(record, size: int) -> tuple[dict[str, str], int]:
    """The headers of a record, names in lower case, and where its block begins."""
    have = PIECE
    while True:
        try:
            head = record.until(min(have, size))
        except ValueError:
            head = bytes(record.plain)
        stop = head.find(b"\r\n\r\n")
        if stop >= 0 or len(head) < have:
            break
        have *= 2
    if not head.startswith(b"WARC/") or stop < 0:
        raise ValueError(f"no record at {record.start}")
    fields: dict[str, str] = {}
    last = None
    for line in head[:stop].decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        last = name.strip().lower()
        fields[last] = value.strip()
    return fields, stop + 4


def records(file, size: int, wanted, with_payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers, and payload if asked for, of the records whose headers are ``wanted``."""
    at = 0
    while at < size:
        file.seek(at)
        packed = file.read(2) == b"\x1f\x8b"
        record = _Member(file, at) if packed else _Plain(file, at)
        fields, begin = _headers(record, 1 << 62 if packed else size - at)
        length = int(fields.get("content-length", 0))
        if wanted(fields):
            payload = None
            if with_payload:
                payload = record.until(begin + length)[begin:]
                if fields.get("content-type", "").startswith("application/http"):
                    payload = payload.partition(b"\r\n\r\n")[2]
            yield fields, payload
        at = record.end() if packed else at + begin + length + 4


@dataclass
class Files(InputPartition):
    paths: list[tuple[str, int]]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path = options["path"]
        self.limit = int(options.get("partition_bytes", PARTITION_BYTES))
        self.verify = str(options.get("verify", "false")).lower() == "true"
        self.schema = schema
        self.tests: list[tuple[str, str, object]] = []

    def files(self) -> list[tuple[str, int]]:
        """Files and sizes: those the lists of committed jobs name or, without a list, all archives."""
        fs, root = file_system(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File:
            return [(root, info.size)]
        there = {f.base_name: f for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.is_file}
        lists = [f for f in there.values() if f.base_name.startswith("_files-") and f.extension == "txt"]
        if not lists:
            names = [n for n in there if n.endswith((".warc", ".warc.gz")) and n[0] not in "_."]
        else:
            names = []
            for f in lists:
                with fs.open_input_stream(f.path) as stream:
                    names += stream.read().decode().split()
        missing = [n for n in names if n not in there]
        if missing:
            raise ValueError(f"{self.path} lacks {missing[:3]}")
        return [(there[n].path, there[n].size) for n in sorted(names)]

    def partitions(self) -> list[Files]:
        """Files in order, as many to a partition as stay within its size."""
        plan: list[Files] = []
        room = 0
        for path, size in self.files():
            if not plan or size > room:
                plan.append(Files([]))
                room = self.limit
            plan[-1].paths.append((path, size))
            room -= size
        return plan or [Files([])]

    def wanted(self, fields: dict[str, str]) -> bool:
        for kind, name, value in self.tests:
            have = fields.get(name)
            if have is None:
                return False
            if kind == "in" and have not in value or kind == "starts" and not have.startswith(value):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(self.schema)
        names = [(f.name, header_of(f.name).lower(), isinstance(f.dataType, T.LongType)) for f in self.schema]
        with_payload = any(name == "payload" for name, _, _ in names)
        fs, _ = file_system(self.path)
        rows: list[list] = [[] for _ in names]
        held = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, arrow)], schema=arrow)

        for path, size in partition.paths:
            with fs.open_input_file(path) as file:
                for fields, payload in records(file, size, self.wanted, with_payload):
                    told = fields.get("warc-payload-digest", "")
                    if self.verify and payload is not None and told and fields.get("warc-type") != "revisit":
                        if told != "sha1:" + digest(payload):
                            raise ValueError(f"a payload of {path} differs from its digest {told}")
                    for kept, (name, header, number) in zip(rows, names):
                        value = payload if name == "payload" else fields.get(header)
                        kept.append(int(value) if number and value is not None else value)
                    held += 200 * len(names) + len(payload or b"")
                    if held >= BATCH_BYTES or len(rows[0]) >= BATCH_ROWS:
                        yield batch()
                        rows, held = [[] for _ in names], 0
        if rows and rows[0]:
            yield batch()


class PushingWarcReader(WarcReader):
    """The reader for sessions that push filters down to Python data sources."""

    def pushFilters(self, filters: list[Filter]):
        """Take what the headers can tell: equal to, one of, begins with, is there."""
        strings = {f.name for f in self.schema if isinstance(f.dataType, T.StringType)}
        for test in filters:
            name = test.attribute[0] if len(getattr(test, "attribute", ())) == 1 else None
            header = header_of(name).lower() if name in strings else None
            if header is None:
                yield test
            elif isinstance(test, EqualTo):
                self.tests.append(("in", header, frozenset([test.value])))
            elif isinstance(test, In):
                self.tests.append(("in", header, frozenset(test.value)))
            elif isinstance(test, StringStartsWith):
                self.tests.append(("starts", header, test.value))
            elif isinstance(test, IsNotNull):
                self.tests.append(("there", header, None))
            else:
                yield test


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.limit = int(options.get("file_bytes", FILE_BYTES))
        self.level = int(options.get("level", 4))
        self.date = options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        self.job = uuid4().hex
        self.names = [f.name for f in schema]

    def _record(self, row: dict) -> bytes:
        payload = row.pop("payload", None)
        if isinstance(payload, str):
            payload = payload.encode()
        kind = row.get("record_type") or "resource"
        row = {"record_type": kind, "record_id": f"<urn:uuid:{uuid4()}>", "record_date": self.date} | {
            k: v for k, v in row.items() if v is not None and k != "block_length"
        }
        block = payload or b""
        if kind in ("response", "revisit"):
            row["content_type"] = HTTP
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(block)}\r\n\r\n"
            block = head.encode() + block
        return encoded({header_of(k): str(v) for k, v in row.items()}, block, self.level)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        attempt = uuid4().hex
        names: list[str] = []
        out, size = None, 0
        try:
            for batch in batches:
                for i in range(batch.num_rows):
                    if out is None or size >= self.limit:
                        if out is not None:
                            out.close()
                        names.append(f"part-{attempt}-{len(names):04d}.warc.gz")
                        out, size = fs.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                        out.write(encoded(
                            {
                                "WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid4()}>", "WARC-Date": self.date,
                                "WARC-Filename": names[-1], "Content-Type": "application/warc-fields",
                            }, b"format: WARC File Format 1.1\r\n", self.level,
                        ))
                    data = self._record({n: batch.column(k)[i].as_py() for k, n in enumerate(self.names)})
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        before = [f for f in fs.get_file_info(pafs.FileSelector(root)) if f.is_file] if self.overwrite else []
        names = [n for m in messages if m is not None for n in m.names]
        with fs.open_output_stream(f"{root}/_files-{self.job}.tmp") as out:
            out.write("\n".join(names).encode())
        fs.move(f"{root}/_files-{self.job}.tmp", f"{root}/_files-{self.job}.txt")
        lists = [f for f in before if f.base_name.startswith("_files-") and f.base_name != f"_files-{self.job}.txt"]
        for f in lists + [f for f in before if f.base_name.endswith(".warc.gz") and f.base_name not in set(names)]:
            fs.delete_file(f.path)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        for name in (n for m in messages if m is not None for n in m.names):
            fs.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    """``option("path")``, ``partition_bytes``, ``verify``, ``pushdown`` to read; ``file_bytes``, ``level``, ``date`` to write."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        pushing = str(self.options.get("pushdown", "false")).lower() == "true"
        return (PushingWarcReader if pushing else WarcReader)(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(dict(self.options), schema, overwrite)


@contextmanager
def pushing_down(spark: SparkSession):
    """Filters reach Python data sources for what runs inside; the session's setting is put back after."""
    before = spark.conf.get(PUSHDOWN)
    spark.conf.set(PUSHDOWN, "true")
    try:
        yield
    finally:
        spark.conf.set(PUSHDOWN, before)


def read_warc(spark: SparkSession, path: str, schema: str = SCHEMA, verify: bool = False) -> DataFrame:
    """Records of the archives under ``path``.

    ``schema`` names the columns: those of ``SCHEMA``, and any other string or long for the header of
    that name. Without ``payload`` no payload is decoded. Inside ``pushing_down`` filters on string
    columns are tested on the headers. ``verify`` fails on a payload that differs from its digest.
    A header that a record lacks is null; a file that breaks off fails the read.
    """
    spark.dataSource.register(WarcSource)
    pushdown = spark.conf.get(PUSHDOWN)
    options = {"pushdown": pushdown, "verify": str(verify).lower()}
    return spark.read.format("warc").options(**options).schema(schema).load(path)


def write_warc(records: DataFrame, path: str, mode: str = "append", **options: object) -> None:
    """Write records: ``payload``, columns of ``SCHEMA``, any others as headers; null ones are left out."""
    records.sparkSession.dataSource.register(WarcSource)
    bounded_batches(records).write.format("warc").mode(mode).options(**options).save(path)


def _expanded(rows: DataFrame, copies: str) -> DataFrame:
    """Each row as often as ``copies`` says, with its number ``copy``, in two steps of bounded lists."""
    step = 1 << 16
    parts = rows.withColumn("_part", F.explode(F.sequence(F.lit(0), F.expr(f"({copies} - 1) div {step}"))))
    here = F.least(F.lit(step), F.col(copies) - F.col("_part") * step)
    numbered = parts.withColumn("_place", F.explode(F.sequence(F.lit(1), here.cast("int"))))
    return numbered.withColumn("copy", F.col("_part") * step + F.col("_place")).drop("_part", "_place", copies)


def page_records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0
) -> DataFrame:
    """Records of pages: of equal payloads of ``least`` bytes or more one response, revisits for the others.

    The response is the page of the smallest id (a null id is larger than all; of equal ids that of
    the smallest url, then any). Shorter payloads are all responses. Null html is an empty payload.
    Only ids, urls and digests are joined; of the payloads, one for each digest and task is shuffled.
    """
    page = pages.select(
        column(page_id).alias("page_id"), column(url).cast("string").alias("target_uri"),
        F.coalesce(column(html).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    size = F.octet_length("payload").cast("long")
    # Equality is decided by SHA-256; the digest that archives carry is SHA-1.
    marked = page.withColumns({
        "same": F.unhex(F.sha2("payload", 256)), "sha1": F.sha1("payload"), "payload_length": size,
    })
    keys = ["same", "sha1", "payload_length", "page_id", "target_uri"]
    counted = stored(marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")), "warc-pages")
    large = F.col("payload_length") >= least
    # One order for both branches: ids, null ids last, then urls.
    best = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "target_uri")).alias("first")
    firsts = counted.where(large).groupBy("same").agg(best, F.sum("copies").alias("all")).where("all > 1").drop("all")
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("target_uri").eqNullSafe(F.col("first.target_uri"))
    again = counted.where(large).join(firsts, "same").withColumn("copies", F.col("copies") - is_first.cast("long"))
    revisits = _expanded(again.where("copies > 0"), "copies").select(
        "page_id", "target_uri", "sha1", "payload_length", F.lit("revisit").alias("record_type"),
        F.lit(None).cast("binary").alias("payload"), "copy",
        F.col("first.page_id").alias("refers_to_page"), F.col("first.target_uri").alias("refers_to_uri"),
    )
    order = Window.partitionBy("same").orderBy(F.col("page_id").asc_nulls_last(), F.col("target_uri").asc_nulls_first())
    one = marked.where(large).withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")
    responses = one if least <= 0 else one.unionByName(marked.where(~large))
    responses = responses.select(
        "page_id", "target_uri", "sha1", "payload_length", F.lit("response").alias("record_type"), "payload",
        F.lit(0).cast("long").alias("copy"), F.lit(None).cast(dict(page.dtypes)["page_id"]).alias("refers_to_page"),
        F.lit(None).cast("string").alias("refers_to_uri"),
    )

    def urn(kind, key, uri, copy):
        h = F.md5(F.concat_ws("\n", kind, F.coalesce(key.cast("string"), F.lit("")), F.coalesce(uri, F.lit("")), copy.cast("string")))
        parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    is_revisit = F.col("record_type") == "revisit"
    target = urn(F.lit("response"), F.col("refers_to_page"), F.col("refers_to_uri"), F.lit(0))
    return responses.unionByName(revisits.withColumn("copy", F.col("copy").cast("long"))).select(
        "record_type", urn(F.col("record_type"), F.col("page_id"), F.col("target_uri"), F.col("copy")).alias("record_id"),
        "target_uri", _base32(F.col("sha1")).alias("payload_digest"),
        F.when(is_revisit, target).alias("refers_to"), F.when(is_revisit, F.lit(SAME_PAYLOAD)).alias("profile"),
        F.col("page_id").cast("string").alias("page_id"), F.col("payload_length").cast("string").alias("payload_length"),
        F.col("refers_to_page").cast("string").alias("refers_to_page"), "payload",
    )


def _base32(sha1):
    """``sha1:`` and the base-32 form of a hexadecimal SHA-1: five digits make four characters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = [F.lit("sha1:")]
    for start in range(1, 41, 5):
        value = F.conv(F.substring(sha1, start, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            out.append(F.substring(letters, F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*out)


def archive_pages(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0,
    **options: object,
) -> None:
    """Write the records of pages (see ``page_records``) to archives under ``path``."""
    write_warc(page_records(pages, page_id, url, html, least), path, **options)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """What archives of pages hold: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Payloads of responses are read and checked against their digests; of revisits the headers are
    enough. The type is tested before a payload is decoded. The result is stored.
    """
    with pushing_down(spark):
        bare = F.substring_index("payload_digest", ":", -1).alias("payload_digest")
        key = F.col("page_id").cast("long").alias("page_id")
        responses = read_warc(
            spark, path, "record_type string, page_id string, payload_digest string, payload binary", verify=True
        ).where("record_type = 'response'").select(
            key, F.octet_length("payload").cast("long").alias("payload_bytes"), bare, "record_type",
            F.lit(None).cast("long").alias("refers_to"),
        )
        revisits = read_warc(
            spark, path, "record_type string, page_id string, payload_digest string, payload_length long, refers_to_page string"
        ).where("record_type = 'revisit'").select(
            key, F.col("payload_length").alias("payload_bytes"), bare, "record_type",
            F.col("refers_to_page").cast("long").alias("refers_to"),
        )
        return stored(responses.unionByName(revisits), "warc-read")
