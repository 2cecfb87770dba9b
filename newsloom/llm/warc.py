"""WARC archives as a Spark data source, and de-duplicated archives of pages.

Writing gives one gzip member per record. Its header says how long the member
is (the ``sl`` field of the format's annex), so a reader can step over it.
Reading plans partitions from the file list, parses the headers of a record
first, tests them against the predicates Spark pushed down, and inflates the
rest only of records that pass. Files of other origin, without ``sl`` or
without compression, are read as well.

Files are opened with ``pyarrow.fs``, by the address they are given.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from newsloom.llm.common import pick
from newsloom.sources.writers import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Columns that are headers of a record, and their names in the file.
HEADERS = {
    "warc_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "warc_date": "warc-date",
    "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest",
}
READ_SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload_bytes long, payload binary"
READ_ARROW = pa.schema([*[(c, pa.string()) for c in HEADERS], ("payload_bytes", pa.int64()), ("payload", pa.binary())])
MANIFEST = "_records.json"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 1 << 30
PARTITION_BYTES = 64 << 20
PIECE = 1 << 16
LEVEL = 4


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _clean(value: str) -> str:
    """A header value on one line; control characters and non-ASCII letters are percent-encoded."""
    return "".join(c if " " <= c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record_bytes(row: dict) -> bytes:
    """One record: response with the payload, or revisit with its HTTP headers only."""
    payload = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = http + payload if row["warc_type"] == "response" else http
    lines = [
        "WARC/1.1", f"WARC-Type: {row['warc_type']}", f"WARC-Record-ID: <{_clean(row['record_id'])}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
    ]
    if row.get("target_uri") is not None:
        lines.append(f"WARC-Target-URI: {_clean(row['target_uri'])}")
    if row.get("refers_to") is not None:
        lines += [f"WARC-Refers-To: <{_clean(row['refers_to'])}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """A gzip member whose header holds its own length and that of the record."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    if max(total, len(record)) >> 32:
        head = b"\x1f\x8b\x08\x00" + bytes(4) + b"\x00\xff"
    else:
        head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total, len(record))
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, base = _open(self.path)
        files.create_dir(base, recursive=True)
        names, out, size = [], None, 0
        for rows in iterator:
            for row in rows.to_pylist():
                if out is None or size > FILE_BYTES:
                    if out is not None:
                        out.close()
                    # every attempt of a task has files of its own; only committed ones are listed
                    names.append([f"records-{uuid.uuid4().hex}.warc.gz", 0])
                    out, size = files.open_output_stream(f"{base}/{names[-1][0]}", compression=None), 0
                packed = member(record_bytes(row))
                out.write(packed)
                size += len(packed)
                names[-1][1] = size
        if out is not None:
            out.close()
        message = WriterCommitMessage()
        object.__setattr__(message, "names", names)
        return message

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, base = _open(self.path)
        files.create_dir(base, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        if not self.overwrite:
            names = _listed(self.path, names_only=True) + names
        with files.open_output_stream(f"{base}/{MANIFEST}") as out:
            out.write(json.dumps(sorted(names)).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, base = _open(self.path)
        for m in messages:
            for name, _ in m.names if m is not None else []:
                files.delete_file(f"{base}/{name}")


def _listed(path: str, names_only: bool = False) -> list[list]:
    """[name, size] of the files of an archive: those of its manifest, or all that look like one."""
    files, base = _open(path)
    info = files.get_file_info(base)
    if info.type == fs.FileType.File:
        return [["", info.size]]
    if info.type == fs.FileType.NotFound:
        return []
    if files.get_file_info(f"{base}/{MANIFEST}").type == fs.FileType.File:
        with files.open_input_stream(f"{base}/{MANIFEST}") as f:
            return json.loads(f.read())
    if names_only:
        return []
    found = files.get_file_info(fs.FileSelector(base, recursive=True))
    return sorted([f.path.removeprefix(base).lstrip("/"), f.size] for f in found if f.path.endswith((".warc", ".warc.gz")))


class WarcPartition(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Source:
    """A file with look-ahead, so that what is stepped over need not be read."""

    def __init__(self, handle):
        self.handle, self.at, self.buffer = handle, 0, b""

    def peek(self, n: int) -> bytes:
        if len(self.buffer) < n:
            self.handle.seek(self.at + len(self.buffer))
            self.buffer += self.handle.read(max(PIECE, n - len(self.buffer)))
        return self.buffer[:n]

    def take(self, n: int) -> bytes:
        found = self.peek(n)
        self.jump(self.at + len(found))
        return found

    def jump(self, to: int) -> None:
        step = to - self.at
        self.buffer = self.buffer[step:] if step >= 0 else b""
        self.at = to


class _Member:
    """The text of the gzip member at which a source stands; at its end the source stands behind it."""

    def __init__(self, source: _Source):
        self.source, self.packer, self.start = source, zlib.decompressobj(31), source.at
        head = source.peek(24)
        # the length of the member, where its header tells
        self.length = struct.unpack("<I", head[16:20])[0] if len(head) == 24 and head[3] == 4 and head[12:14] == b"sl" else None

    def read(self, limit: int) -> bytes:
        while not self.packer.eof:
            data = self.packer.unconsumed_tail or self.source.take(PIECE)
            if not data:
                raise ValueError("the last record of the file is cut off")
            out = self.packer.decompress(data, limit)
            if self.packer.eof:
                self.source.jump(self.source.at - len(self.packer.unused_data))
            if out:
                return out
        return b""

    def leave(self) -> None:
        """Step over the rest; nothing of it is inflated if the length is known."""
        if self.length is not None:
            self.source.jump(self.start + self.length)
        while self.length is None and self.read(1 << 20):
            pass


def _headers(text: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a line that starts with white space continues the one before."""
    found, last = {}, None
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            found[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            found[last] = value.strip()
    return found


def _values(headers: dict[str, str]) -> dict:
    row = {c: headers.get(name) for c, name in HEADERS.items()}
    for c in ("record_id", "refers_to"):
        row[c] = row[c].strip("<>") if row[c] is not None else None
    return row


def _finish(row: dict, block: bytes, headers: dict[str, str], verify: bool) -> dict:
    """Add the payload: what follows the HTTP headers, or the whole block of a record of another kind."""
    http, payload = {}, block
    if headers.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = _headers(head)
    row["payload"] = payload
    row["payload_bytes"] = len(payload)
    if row["warc_type"] == "revisit":
        length = http.get("content-length", "")
        row["payload"], row["payload_bytes"] = None, int(length) if length.isdigit() else None
    digest = row["payload_digest"]
    if verify and row["payload"] is not None and digest and digest.startswith("sha1:"):
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest[5:].upper():
            raise ValueError(f"payload of record {row['record_id']} does not fit its digest")
    return row


def _read_member(source: _Source, wanted: Callable[[dict], bool], verify: bool) -> Iterator[dict]:
    """Records of one member: one where its header tells the length, any number in archives of other origin."""
    member_, data = _Member(source), b""
    while True:
        data = data.lstrip(b"\r\n")
        while (end := data.find(b"\r\n\r\n")) < 0 and (more := member_.read(2048)):
            data = (data + more).lstrip(b"\r\n")
        if end < 0:
            return
        headers = _headers(data[:end])
        row, left = _values(headers), int(headers.get("content-length", "0"))
        data, alone = data[end + 4 :], member_.length is not None
        if wanted(row):
            pieces, have = [data], len(data)
            while (alone or have < left) and (more := member_.read(1 << 20)):
                pieces.append(more)
                have += len(more)
            data = b"".join(pieces)
            yield _finish(row, data[:left], headers, verify)
        elif alone:
            member_.leave()
        if alone:
            return
        while len(data) < left and (more := member_.read(1 << 20)):
            left, data = left - len(data), more
        data = data[left:]


def _read_plain(source: _Source, wanted: Callable[[dict], bool], verify: bool) -> Iterator[dict]:
    size = 4096
    while (end := source.peek(size).find(b"\r\n\r\n")) < 0:
        if len(source.peek(size)) < size:
            raise ValueError("the last record of the file is cut off")
        size *= 2
    headers = _headers(source.take(end + 4)[:end])
    length, row = int(headers.get("content-length", "0")), _values(headers)
    if wanted(row):
        yield _finish(row, source.take(length), headers, verify)
    else:
        source.jump(source.at + length)
    while source.peek(2) == b"\r\n":
        source.jump(source.at + 2)


def read_records(handle, wanted: Callable[[dict], bool] = lambda row: True, verify: bool = True) -> Iterator[dict]:
    """Rows of the records of one open file whose headers pass ``wanted``."""
    source = _Source(handle)
    while source.peek(1):
        yield from (_read_member if source.peek(2) == b"\x1f\x8b" else _read_plain)(source, wanted, verify)


def _test(kind: str, value):
    """A test of one header value; null fails all but the test for null, as in SQL."""
    return {
        "EqualTo": lambda v: v is not None and v == value,
        "In": lambda v: v is not None and v in value,
        "IsNull": lambda v: v is None,
        "IsNotNull": lambda v: v is not None,
        "StringStartsWith": lambda v: v is not None and v.startswith(value),
        "StringEndsWith": lambda v: v is not None and v.endswith(value),
        "StringContains": lambda v: v is not None and value in v,
    }[kind]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payloads = options.get("payloads", "true").lower() == "true"
        self.verify = options.get("verify", "true").lower() == "true"
        self.size = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):  # noqa: N802
        kinds = (EqualTo, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains)
        for f in filters:
            if isinstance(f, kinds) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.tests.append((type(f).__name__, f.attribute[0], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[WarcPartition]:
        """Files in order; small ones share a partition, a file is never split."""
        packed, room = [], 0
        for name, size in _listed(self.path):
            if size > room or not packed:
                packed.append([])
                room = self.size
            packed[-1].append(f"{self.path.rstrip('/')}/{name}" if name else self.path)
            room -= size
        return [WarcPartition(p) for p in packed] or [WarcPartition([])]

    def read(self, partition: WarcPartition) -> Iterator[pa.RecordBatch]:
        tests = [(column, _test(kind, tuple(value) if kind == "In" else value)) for kind, column, value in self.tests]

        def wanted(row: dict) -> bool:
            return all(test(row[column]) for column, test in tests)

        for path in partition.paths:
            files, inner = _open(path)
            rows, size = [], 0
            with files.open_input_file(inner) as handle:
                for row in read_records(handle, wanted, self.verify):
                    size += len(row["payload"] or b"")
                    rows.append(row if self.payloads else row | {"payload": None})
                    if len(rows) >= 2000 or size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, READ_ARROW)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, READ_ARROW)


class WarcDataSource(DataSource):
    """``format("warc")``. Options of a read: ``payloads`` (false: headers only), ``verify`` (digests), ``partitionBytes``.

    A write takes the columns ``warc_type, record_id, target_uri, refers_to,
    payload_digest`` (bare base32), ``payload_bytes`` and ``payload``.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def _base32(digests):
    @F.arrow_udf("string")
    def of(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else base64.b32encode(bytes.fromhex(v)).decode() for v in values.to_pylist()], pa.string())

    return of(digests)


def _urn(page_id):
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")))


def write_pages(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0
) -> None:
    """One record per page under ``path``; repeated payloads become revisits.

    Of pages whose payloads (html in UTF-8, null empty) are equal and have at
    least ``least_bytes`` bytes, those with the smallest identifier are responses
    and the others revisit it. Payloads are equal if SHA-1 and length are. A row
    that repeats the smallest identifier is a response as well. Null identifiers
    revisit one that is not null; among themselves they are all responses. Null
    addresses are left out of the record; extra columns are ignored. An empty
    table writes an archive without files.
    """
    register(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col).select(
        "page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("payload_bytes")
    )
    # only payloads that occur again; staged, so that Spark knows the size when it plans the join
    repeated = stage(
        rows.where(F.col("payload_bytes") >= least_bytes).groupBy("digest", "payload_bytes")
        .agg(F.min("page_id").alias("keep_id"), F.count("*").alias("n")).where("n > 1 and keep_id is not null").drop("n"),
        "repeated-payloads",
    )
    revisit = F.col("keep_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep_id"))
    (
        rows.join(repeated, ["digest", "payload_bytes"], "left")
        .select(
            F.when(revisit, "revisit").otherwise("response").alias("warc_type"),
            _urn(F.col("page_id")).alias("record_id"),
            F.col("url").cast("string").alias("target_uri"),
            F.when(revisit, _urn(F.col("keep_id"))).alias("refers_to"),
            _base32(F.col("digest")).alias("payload_digest"),
            "payload_bytes",
            F.when(~revisit, F.col("payload")).alias("payload"),
        )
        .write.format("warc").mode("append").save(path)
    )


def read_warc(spark: SparkSession, path: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)
