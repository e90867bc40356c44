"""WARC archives as a Spark data source, and pages written to them without repeated payloads.

Archives hold one gzip member for each record; a member states its compressed length
in its header, so a reader can step over it. A scan plans its partitions from the
files' sizes, takes filters on record type and the other header columns, reads a
record's header first, and inflates the payload only if the record is wanted and the
requested schema has a payload column. Archives without compression (``.warc``) are read
likewise, and a block that isn't wanted is stepped over by its length. Files are reached through ``pyarrow.fs``, so a
path may be in any store that it knows; it must be one that all executors reach.

``write_pages``: a null html is an empty payload, a null url leaves out the header,
and columns besides page_id, url and html are ignored. Of equal payloads the record
of the smallest page_id is a response and the others revisit it; rows that repeat
that smallest id are responses too. A null page_id is larger than any other; if a
payload has no other, all its records are responses. An empty table writes no file.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from roamrank.llm.batches import bound_batches
from roamrank.operators.joins import lookup_join
from roamrank.workspace import new_path, write_table

#: What an archive row holds; a reader may ask for any of these columns.
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, "
    "payload_digest string, payload_length bigint, payload binary"
)
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROLL_BYTES = 256 << 20  # an archive file is closed beyond this size
PARTITION_BYTES = 64 << 20  # files smaller than this share a partition
BATCH_BYTES = 8 << 20
MANIFEST = "archives.json"
PAGE = "urn:x-page:"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


def _bracketed(value: str) -> str:
    return f"<{value}>"


def member(record: bytes) -> bytes:
    """One gzip member whose extra field ``sl`` has its compressed and its plain length."""
    squeezer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = squeezer.compress(record) + squeezer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record_bytes(row: dict) -> bytes:
    """A response or revisit record; a revisit states the payload's length in its HTTP header alone."""
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_length']}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {_bracketed(row['record_id'])}",
        f"WARC-Date: {row['date']}",
        f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["target_uri"] is not None:
        safe = quote(row["target_uri"], safe="!#$%&'()*+,/:;=?@[]~-._")
        lines.insert(3, f"WARC-Target-URI: {safe}")
    if revisit:
        lines[2:2] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_bracketed(row['refers_to'])}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files of its own; the manifest written at commit names those that count."""

    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size > ROLL_BYTES:
                        if out is not None:
                            out.close()
                        files.append(f"{uuid.uuid4().hex}.warc.gz")
                        out, size = store.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
                    data = member(record_bytes(row))
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        names = sorted(f for m in messages if m is not None for f in m.files)
        # One for each commit, so that a later one adds to what is there.
        with store.open_output_stream(f"{folder}/{MANIFEST}-{uuid.uuid4().hex}", compression=None) as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list) -> None:
        store, folder = _store(self.path)
        for m in messages:
            for name in m.files if m is not None else ():
                store.delete_file(f"{folder}/{name}")


class Input:
    """Bytes of a file from the place reached, read a block at a time."""

    def __init__(self, file) -> None:
        self.file, self.data, self.at = file, b"", 0

    def fill(self, least: int) -> bool:
        while len(self.data) - self.at < least:
            more = self.file.read(1 << 20)
            if not more:
                return False
            self.data, self.at = self.data[self.at :] + more, 0
        return True

    def skip(self, n: int) -> None:
        left = len(self.data) - self.at
        if n <= left:
            self.at += n
        else:
            self.file.seek(self.file.tell() + n - left)
            self.data, self.at = b"", 0


def _header(head: bytes) -> dict:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _payload(header: dict, block: bytes, whole: int) -> bytes:
    """What of a record's payload is in ``block``, the begin of ``whole`` bytes; its length goes to the header."""
    http, end, payload = block.partition(b"\r\n\r\n")
    told = re.search(rb"(?im)^content-length: *(\d+)", http)
    header["payload-length"] = int(told[1]) if told else whole - len(http) - len(end)
    return payload


def plain_records(file, wanted, with_payload: bool) -> Iterator[tuple[dict, bytes | None]]:
    """``records`` of an archive without compression."""
    source = Input(file)
    while source.fill(1):
        while (end := source.data.find(b"\r\n\r\n", source.at)) < 0:
            if not source.fill(len(source.data) - source.at + 1):
                raise ValueError("a record without a header")
        header = _header(source.data[source.at : end])
        source.at = end + 4
        limit = int(header["content-length"])
        if wanted(header):
            have = limit if with_payload else min(limit, 4096)
            whole = source.fill(have)
            while whole and have < limit and b"\r\n\r\n" not in source.data[source.at : source.at + have]:
                have = min(limit, 2 * have)
                whole = source.fill(have)
            if not whole:
                raise ValueError("an archive ends within a record")
            payload = _payload(header, source.data[source.at : source.at + have], limit)
            yield header, (payload if with_payload else None)
        source.skip(limit)
        if not source.fill(4) or source.data[source.at : source.at + 4] != b"\r\n\r\n":
            raise ValueError("an archive ends within a record")
        source.at += 4


def records(file, wanted, with_payload: bool) -> Iterator[tuple[dict, bytes | None]]:
    """The header of every wanted record, and its payload if asked for.

    ``wanted`` sees the header alone. Of other records nothing beyond the header is
    inflated if the member tells its length.
    """
    source = Input(file)
    while source.fill(10):
        length = 0
        if source.data[source.at + 3] & 4 and source.fill(24):
            extra = source.data[source.at + 10 : source.at + 24]
            if extra[2:4] == b"sl":
                length = struct.unpack("<I", extra[6:10])[0]
        inflater, text, fed = zlib.decompressobj(31), b"", 0

        def more(limit: int) -> bytes:
            """Up to ``limit`` more bytes of the record, none at its end."""
            nonlocal fed
            while not inflater.eof:
                if inflater.unconsumed_tail:
                    out = inflater.decompress(inflater.unconsumed_tail, limit)
                else:
                    if not source.fill(1):
                        raise ValueError("an archive ends within a record")
                    chunk = source.data[source.at : source.at + 65536]
                    source.at += len(chunk)
                    fed += len(chunk)
                    out = inflater.decompress(chunk, limit)
                if out:
                    return out
            return b""

        while b"\r\n\r\n" not in text:
            got = more(2048)
            if not got:
                raise ValueError("a record without a header")
            text += got
        head, _, rest = text.partition(b"\r\n\r\n")
        header = _header(head)
        take = wanted(header)
        if take:
            limit = int(header["content-length"])
            parts = [rest]
            have = len(rest)
            # A revisit's block is an HTTP header, which tells the payload's length.
            while have < limit and (with_payload or b"\r\n\r\n" not in b"".join(parts)):
                parts.append(more(1 << 16))
                if not parts[-1]:
                    raise ValueError("a record is shorter than its header says")
                have += len(parts[-1])
            payload = _payload(header, b"".join(parts)[:limit], limit)
            yield header, (payload if with_payload else None)
        if inflater.eof:
            source.at -= len(inflater.unused_data)
        elif length:
            back = fed - length
            if back >= 0:
                source.at -= back
            else:
                source.skip(-back)
        else:
            while more(1 << 20):
                pass
            source.at -= len(inflater.unused_data)


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType) -> None:
        self.path, self.schema = path, schema
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, (EqualTo, In, StringStartsWith, IsNotNull)):
                self.tests.append((type(f).__name__, name, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        store, folder = _store(self.path)
        found = store.get_file_info(pafs.FileSelector(folder))
        manifests = [f for f in found if f.base_name.startswith(MANIFEST)]
        found = [f for f in found if f.path.endswith((".warc.gz", ".warc"))]
        if manifests:
            names: set[str] = set()
            for manifest in manifests:
                with store.open_input_stream(manifest.path, compression=None) as f:
                    names.update(json.loads(f.read()))
            missing = names - {f.base_name for f in found}
            if missing:
                raise FileNotFoundError(f"{self.path} lacks {len(missing)} archives, {min(missing)} among them")
            found = [f for f in found if f.base_name in names]
        planned, size = [], 0
        for f in sorted(found, key=lambda f: f.path):
            if not planned or size + f.size > PARTITION_BYTES:
                planned.append(Files([]))
                size = 0
            planned[-1].paths.append(f.path)
            size += f.size
        return planned or [Files([])]

    def _wanted(self, header: dict) -> bool:
        for kind, name, value in self.tests:
            own = _column(header, name)
            if own is None:
                return False
            if kind == "EqualTo" and own != value or kind == "In" and own not in value:
                return False
            if kind == "StringStartsWith" and not own.startswith(value):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        schema = to_arrow_schema(self.schema)
        with_payload = "payload" in schema.names
        rows, size = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as file:
                read = records if path.endswith(".gz") else plain_records
                for header, payload in read(file, self._wanted, with_payload):
                    if payload is not None and header["warc-type"] == "response":
                        # The header is optional, and other digests are as good.
                        kind, _, told = header.get("warc-payload-digest", "").partition(":")
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if kind.lower() == "sha1" and len(told) == len(digest) and told.upper() != digest:
                            raise ValueError(f"{header['warc-record-id']} doesn't match its digest")
                    elif payload is not None:
                        payload = None  # a revisit has none of its own
                    rows.append([payload if n == "payload" else _column(header, n) for n in schema.names])
                    size += 300 + len(payload or b"")
                    if size > BATCH_BYTES:
                        yield _batch(rows, schema)
                        rows, size = [], 0
        yield _batch(rows, schema)


def _column(header: dict, name: str):
    if name == "payload_length":
        return header["payload-length"]
    value = header.get(HEADERS[name])
    if value is not None and name in ("record_id", "refers_to"):
        return value[1:-1]
    if value is not None and name == "payload_digest":
        return value.partition(":")[2]
    return value


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


class Warc(DataSource):
    """``spark.read.format("warc")``; the path is that of a folder."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def scan(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Read archives; without ``payload`` among the columns no payload is inflated.

    Registers the data source and turns on the session's filter pushdown for Python
    data sources, which this reader needs.
    """
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    kinds = dict(x.split() for x in SCHEMA.split(", "))
    asked = ", ".join(f"{c} {kinds[c]}" for c in columns or kinds)
    return spark.read.format("warc").schema(asked).load(path)


def page_records(pages: DataFrame, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """The record of every page; ``date`` is when they were fetched."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    firsts = own.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # Only digests that occur more than once are looked up, so payloads are shuffled only if those are many.
    repeated = write_table(firsts.where("n > 1").select("sha1", "first"), "repeated")
    joined = lookup_join(own, repeated, "sha1", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit(PAGE), F.coalesce(c.cast("string"), F.lit("")))
    return joined.select(
        urn(F.col("page_id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").cast("string").alias("target_uri"),
        F.lit(date).alias("date"),
        F.when(again, urn(F.col("first"))).alias("refers_to"),
        _base32(F.col("sha1")).alias("payload_digest"),
        F.length("payload").cast("bigint").alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def _base32(hexed: Column) -> Column:
    """40 hexadecimal digits as 32 base-32 ones: every five make four."""
    parts = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: hexed.substr(i * 5 + 1, F.lit(5)))
    padded = F.transform(parts, lambda p: F.lpad(F.conv(p, 16, 32), 4, "0"))
    return F.translate(F.array_join(padded, ""), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_pages(pages: DataFrame, path: str | None = None) -> str:
    """Write all pages to archives under ``path``, by default in the shared folder, and return the path."""
    spark = pages.sparkSession
    bound_batches(spark)
    path = path or new_path(spark, "warc")
    spark.dataSource.register(Warc)
    page_records(pages).write.format("warc").mode("append").save(path)
    return path


def page_id(urn: Column) -> Column:
    """The page_id in a record id, null if it had none."""
    digits = F.regexp_extract(urn, f"^{PAGE}(-?[0-9]+)$", 1)
    return F.when(digits != "", digits.cast("bigint"))
