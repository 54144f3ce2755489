"""WARC archives as a PySpark data source: one gzip member per record, written and read in parallel.

Writing: every task rolls its records into files of its own; only files of tasks that succeeded are listed in the
manifest a commit adds, so a lost executor or a second attempt leaves nothing a reader would see. An archive is all its
manifests together; an overwriting commit names those it replaces.

Reading: manifests also say where some records start, so that files are planned into even parts, about one per core
and none too large. In a folder without manifests every ``*.warc`` and ``*.warc.gz`` is read, each whole. A member carries its own length in the gzip extra field
that the format's annex reserves for skipping. A reader inflates a record's headers first, tests them against the
pushed-down record type and header filters, and steps over an unwanted member without inflating its payload. Members
without that field, and plain archives, are read too, at the price of inflating what is skipped.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)

from clinicpulse.llm.frames import bounded_batches, quoted
from clinicpulse.operators.staging import new_folder, stage

_ROLL = 256 << 20
_PLAN = 128 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MARK = 4 << 20
_MANIFESTS = "_manifests"
# The columns of ``read``; header filters may name the text ones among them.
SCHEMA = T.StructType(
    [
        *[
            T.StructField(name, T.StringType())
            for name in ("record_type", "record_id", "target_uri", "date", "refers_to", "payload_digest")
        ],
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
_HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}


def _clean(value: str) -> str:
    """Header values hold no line breaks."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def member(record: bytes) -> bytes:
    """A gzip member whose extra field ``sl`` tells its own and the record's length."""
    packer = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    length = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + struct.pack("<I", 0) + b"\x00\xff" + struct.pack("<H", 12)
    extra = b"sl" + struct.pack("<HII", 8, length, len(record) & 0xFFFFFFFF)
    return head + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{name}: {_clean(value)}" for name, value in headers], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(row: dict, date: str) -> bytes:
    """A response with its payload, or a revisit that keeps the response's HTTP headers only."""
    revisit = row["record_type"] == "revisit"
    payload = b"" if revisit else row["payload"] or b""
    size = row["payload_bytes"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", date),
        ("WARC-Target-URI", row["target_uri"] or ""),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", row["refers_to"])]
    return record(headers, http + payload)


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """The files of a task, each with its size and the offsets of some records' starts."""

    files: list[tuple[str, int, list[int]]]


def _manifests(store: fs.FileSystem, folder: str) -> dict[str, dict]:
    """The manifests that count, by name: those no other one replaces."""
    found = store.get_file_info(fs.FileSelector(f"{folder}/{_MANIFESTS}", allow_not_found=True))
    read = {}
    for info in found:
        if info.base_name.endswith(".json"):
            with store.open_input_file(info.path) as source:
                read[info.base_name] = json.loads(source.read())
    replaced = {name for m in read.values() for name in m["replaces"]}
    return {name: m for name, m in sorted(read.items()) if name not in replaced}


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite = path, overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, folder = _place(self.path)
        store.create_dir(folder, recursive=True)
        date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        files, out, name, size, marks = [], None, "", 0, []
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is not None and size >= _ROLL:
                        out.close()
                        files.append((name, size, marks))
                        out = None
                    if out is None:
                        name, size, marks = f"pages-{uuid.uuid4().hex}.warc.gz", 0, [0]
                        out = store.open_output_stream(f"{folder}/{name}", compression=None)
                    if size - marks[-1] >= _MARK:
                        marks.append(size)
                    data = member(page_record(row, date))
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        if out is not None:
            files.append((name, size, marks))
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = _place(self.path)
        store.create_dir(f"{folder}/{_MANIFESTS}", recursive=True)
        files = sorted(f for m in messages if m is not None for f in m.files)
        replaces = sorted(_manifests(store, folder)) if self.overwrite else []
        name = f"{folder}/{_MANIFESTS}/{uuid.uuid4().hex}"
        with store.open_output_stream(f"{name}.part", compression=None) as out:
            out.write(json.dumps({"files": files, "replaces": replaces}).encode())
        store.move(f"{name}.part", f"{name}.json")

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = _place(self.path)
        for name, _, _ in [f for m in messages if m is not None for f in m.files]:
            store.delete_file(f"{folder}/{name}")


@dataclass
class Files(InputPartition):
    """Parts of files: name, and the offsets between which the records to read start."""

    parts: list[tuple[str, int, int]]


class _Stream:
    """A file read forward, with steps over what is not wanted."""

    def __init__(self, source) -> None:
        self.source, self.size = source, source.size()

    def at(self, offset: int, length: int) -> bytes:
        return self.source.read_at(min(length, max(self.size - offset, 0)), offset)


def _inflated(stream: _Stream, offset: int, start: int, enough: bytes | None) -> tuple[bytes, int]:
    """Inflate a member from its deflate data at ``start``; stop once ``enough`` shows up. Returns data and end."""
    unpack, data, at = zlib.decompressobj(-15), bytearray(), start
    while not unpack.eof:
        chunk = stream.at(at, 1 << 14 if enough else 1 << 20)
        if not chunk:
            raise ValueError(f"a record ends too early at {offset}")
        at += len(chunk)
        data += unpack.decompress(chunk)
        if enough and enough in data:
            return bytes(data), -1
    return bytes(data), at - len(unpack.unused_data) + 8


def _member_start(stream: _Stream, offset: int) -> tuple[int, int | None]:
    """Where a member's deflate data begin, and its length if the extra field tells it."""
    head = stream.at(offset, 1 << 10)
    flags, at, length = head[3], 10, None
    if flags & 4:
        size = struct.unpack_from("<H", head, at)[0]
        extra, at = stream.at(offset + at + 2, size), at + 2 + size
        place = 0
        while place + 4 <= len(extra):
            name, n = extra[place : place + 2], struct.unpack_from("<H", extra, place + 2)[0]
            if name == b"sl" and n >= 8:
                length = struct.unpack_from("<I", extra, place + 4)[0]
            place += 4 + n
    for flag in (8, 16):
        if flags & flag:
            while stream.at(offset + at, 1) not in (b"\0", b""):
                at += 1
            at += 1
    return offset + at + (2 if flags & 2 else 0), length


def _headers(data: bytes) -> dict[str, str]:
    lines = data.split(b"\r\n\r\n", 1)[0].decode("utf-8", "replace").split("\r\n")
    pairs = (line.split(":", 1) for line in lines[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def records(
    stream: _Stream, wanted, payloads: bool, offset: int = 0, stop: int | None = None
) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, block) of the wanted records that start between two offsets; the block is the HTTP headers only if
    payloads are not asked for."""
    end = b"\r\n\r\n"
    stop = stream.size if stop is None else stop
    while offset < stop:
        if stream.at(offset, 2) == b"\x1f\x8b":
            start, length = _member_start(stream, offset)
            data, after = _inflated(stream, offset, start, end)
            headers = _headers(data)
            take = wanted(headers)
            if take and payloads and after < 0:
                data, after = _inflated(stream, offset, start, None)
            elif after < 0 and length is None:
                after = _inflated(stream, offset, start, None)[1]
            elif after < 0:
                if take:
                    data = _inflated_upto(stream, offset, start, data)
                after = offset + length
            block = data.split(end, 1)[1][: int(headers["content-length"])]
        else:
            data, take_upto = stream.at(offset, 1 << 14), 1 << 14
            while end not in data and take_upto < stream.size - offset:
                take_upto *= 2
                data = stream.at(offset, take_upto)
            headers = _headers(data)
            begin, size = data.index(end) + 4, int(headers["content-length"])
            take = wanted(headers)
            block = stream.at(offset + begin, size if payloads else min(size, 1 << 14)) if take else None
            after = offset + begin + size + 4
        if take:
            yield headers, block
        offset = after


def _inflated_upto(stream: _Stream, offset: int, start: int, data: bytes) -> bytes:
    """Enough of a record to hold its HTTP headers too."""
    if data.count(b"\r\n\r\n") >= 2:
        return data
    return _inflated(stream, offset, start, None)[0]


class WarcReader(DataSourceReader):
    """Takes equality and membership filters on header columns, and leaves the others to Spark."""

    def __init__(self, path: str, payloads: bool, tasks: int = 1) -> None:
        self.path, self.payloads, self.tasks = path, payloads, tasks
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            values = set(f.value) if isinstance(f, In) else {f.value} if isinstance(f, EqualTo) else set()
            if name in _HEADERS and name != "payload_digest" and name != "refers_to" and None not in values:
                kept = self.wanted.get(name)
                self.wanted[name] = values if kept is None else kept & values
            else:
                yield f

    def _files(self) -> list[tuple[str, int, list[int]]]:
        """Names, sizes and known record starts."""
        store, folder = _place(self.path)
        manifests = _manifests(store, folder)
        if manifests:
            return [(name, size, marks) for m in manifests.values() for name, size, marks in m["files"]]
        top = store.normalize_path(folder).rstrip("/")
        found = store.get_file_info(fs.FileSelector(top, recursive=True))
        names = [(i.path[len(top) :].lstrip("/"), i.size) for i in found if i.path.endswith((".warc", ".warc.gz"))]
        return [(n, size, [0]) for n, size in sorted(names) if not any(p[0] in "._" for p in n.split("/"))]

    def partitions(self) -> list[Files]:
        files = self._files()
        most = min(_PLAN, max(1, -(-sum(size for _, size, _ in files) // self.tasks)))
        planned, held, total = [], [], 0
        for name, size, marks in files:
            for start, stop in zip(marks, [*marks[1:], size]):
                if held and total + stop - start > most:
                    planned.append(Files(held))
                    held, total = [], 0
                if held and held[-1][0] == name and held[-1][2] == start:
                    held[-1] = (name, held[-1][1], stop)
                else:
                    held.append((name, start, stop))
                total += stop - start
        return [*planned, Files(held)] if held or not planned else planned

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, folder = _place(self.path)
        wanted = {_HEADERS[c].lower(): values for c, values in self.wanted.items()}
        test = lambda headers: all(headers.get(n) in values for n, values in wanted.items())
        rows, size = [], 0
        for name, start, stop in partition.parts:
            with store.open_input_file(f"{folder}/{name}") as source:
                for headers, block in records(_Stream(source), test, self.payloads, start, stop):
                    rows.append(self._row(headers, block))
                    size += len(block)
                    if size >= 1 << 23 or len(rows) >= 5000:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)

    def _row(self, headers: dict[str, str], block: bytes) -> dict:
        row = {c: headers.get(name.lower()) for c, name in _HEADERS.items()}
        is_http = headers.get("content-type", "").startswith("application/http")
        http, parted, payload = block.partition(b"\r\n\r\n") if is_http else (b"", b"", block)
        if row["record_type"] == "revisit":
            # The payload is elsewhere; its length is what the HTTP headers say.
            said = _headers(http + b"\r\n\r\n").get("content-length", "")
            row["payload_bytes"] = int(said) if said.isdecimal() else len(payload)
        else:
            row["payload_bytes"] = int(headers["content-length"]) - len(http) - len(parted)
        digest = row["payload_digest"] or ""
        row["payload_digest"] = digest.removeprefix("sha1:") or None
        row["payload"] = payload if self.payloads and row["record_type"] != "revisit" else None
        return row


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    names = SCHEMA.fieldNames()
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names
    )


class WarcSource(DataSource):
    """``spark.read.format("warc").option("payloads", "false").load(folder)``; see ``SCHEMA``. ``tasks`` is how many
    parts a small archive is read in."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        tasks = int(self.options.get("tasks", "1"))
        return WarcReader(self.options["path"], self.options.get("payloads", "true") == "true", tasks)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def _record_id(page: Column, digest: Column) -> Column:
    return F.format_string("<urn:page:%s:%s>", F.coalesce(page.cast("string"), F.lit("")), digest)


def archive(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 1000, mode: str = "append"
) -> None:
    """Write a record per row of ``pages`` under ``path``, beside what is there or, with mode ``overwrite``, in its place.

    The payload is the html in UTF-8, empty if null. Of rows with one payload of ``least`` bytes or more, those with
    the largest page id are responses and the others revisit it; smaller payloads are all responses, as is a row
    without a page id. Other columns are not read.
    """
    bounded_batches(pages.sparkSession)
    register(pages.sparkSession)
    # An absolute name for the payload keeps clear of whatever else the pages hold.
    source = pages.select(
        quoted(page_id).cast("bigint").alias("page_id"),
        quoted(url).cast("string").alias("target_uri"),
        F.coalesce(quoted(html).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    large = source.filter((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull())
    # Digests alone are compared; the pages themselves move once, to meet their own record's fate.
    last = large.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("kept"), F.min("page_id").alias("other"))
    last = stage(last.filter("kept <> other").select("payload_digest", "payload_bytes", "kept"), "responses")
    repeats = large.select("page_id", "payload_digest", "payload_bytes").join(last, ["payload_digest", "payload_bytes"])
    repeats = repeats.filter("page_id <> kept").select("page_id", "payload_digest", "kept").distinct()
    known = source.join(repeats, ["page_id", "payload_digest"], "left")
    revisit = F.col("kept").isNotNull()
    rows = known.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        _record_id(F.col("page_id"), F.col("payload_digest")).alias("record_id"),
        "target_uri",
        F.when(revisit, _record_id(F.col("kept"), F.col("payload_digest"))).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )
    rows.write.format("warc").mode(mode).save(path)


def new_archive(spark: SparkSession) -> str:
    """A folder for archives that every executor can reach."""
    return new_folder(spark, "warc")


def page_number(record_id: Column) -> Column:
    """The page id inside a record id that ``archive`` made."""
    return F.nullif(F.split_part(record_id, F.lit(":"), F.lit(3)), F.lit("")).cast("bigint")


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    register(spark)
    tasks = spark.sparkContext.defaultParallelism
    return spark.read.format("warc").option("payloads", str(payloads).lower()).option("tasks", tasks).load(path)
