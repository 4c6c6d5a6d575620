"""WARC archives as a Spark data source, and pages archived with revisit records.

Reading plans partitions from the sizes of the files. A record's header comes first: tests
on the record type and other header fields are made on it, and the block of a record that
fails them, or whose payload nobody asked for, is passed over without being decoded. In a
plain file that is a seek; in a compressed file, whose records are gzip members, bytes are
inflated and thrown away.

Writing makes one file or more per task. Names of finished files go into a list at commit, so
that files of failed or repeated tasks are never read and nothing has to be renamed.
"""

from __future__ import annotations

import gzip
import io
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewinnow.llm.common import ensure_checkpoint_dir, read
from tablewinnow.operators.matching import KeySet, attach

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "profile": "WARC-Profile",
    "content_type": "Content-Type",
}

SCHEMA = (
    ", ".join(f"{name} string" for name in FIELDS)
    + ", content_length long, http_status int, payload_bytes long, payload binary"
)
# Columns that are known from the record's header alone, and from its HTTP header.
_IN_HEADER = {*FIELDS, "content_length"}
_IN_HTTP = {"http_status", "payload_bytes"}

_LISTED, _STARTED = "_committed", "_started"
# Bytes of files that a task reads, and at which a task begins another file.
PARTITION_BYTES = 128 << 20
FILE_BYTES = 256 << 20
# Bytes of values in a batch on their way to Spark.
_BATCH_BYTES = 8 << 20
_BATCH_ROWS = 2000
_HEADER_BYTES = 1 << 20


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system a folder is in, and its path there."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


# ---- records ------------------------------------------------------------------------


class MalformedArchive(ValueError):
    """A file that is no WARC archive, or ends within a record."""


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Header lines by lower-case name; a line that begins with a blank continues the one
    before. Of repeated fields the first counts."""
    found: dict[str, str] = {}
    last = ""
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in " \t" and last:
            found[last] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        last = name.strip().lower()
        found.setdefault(last, value.strip())
    return found


def _lines(stream: io.BufferedIOBase) -> list[bytes]:
    """Lines up to an empty one; an empty list at the end of the file."""
    lines, size = [], 0
    while line := stream.readline(_HEADER_BYTES):
        stripped = line.rstrip(b"\r\n")
        size += len(line)
        if not line.endswith(b"\n") or size > _HEADER_BYTES:
            raise MalformedArchive("a header has no end")
        if not stripped:
            return lines
        lines.append(stripped)
    if lines:
        raise MalformedArchive("the file ends within a header")
    return lines


def _pass_over(stream: io.BufferedIOBase, size: int) -> None:
    if size > 0:
        stream.seek(size, io.SEEK_CUR)


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and text.isascii() and text.isdigit() else None


@dataclass
class Wanted:
    """Columns to fill, and tests of columns that decide which records are of use."""

    columns: list[str]
    tests: list[ds.Filter] = field(default_factory=list)

    def __post_init__(self) -> None:
        tested = [t for t in self.tests if tested_column(t) in _IN_HTTP]
        self.early = [t for t in self.tests if tested_column(t) in _IN_HEADER]
        self.late = tested
        self.payload = "payload" in self.columns
        self.http = self.payload or bool(tested) or bool(_IN_HTTP & set(self.columns))


def records(stream: io.BufferedIOBase, wanted: Wanted) -> Iterator[dict]:
    """The records of a file that pass the tests, with the wanted columns."""
    while True:
        lines = _lines(stream)
        if not lines:
            # Some writers end a file with more empty lines than there should be.
            if not stream.read(1):
                return
            stream.seek(-1, io.SEEK_CUR)
            continue
        if not lines[0].startswith(b"WARC/"):
            raise MalformedArchive(f"expected a record, found {lines[0][:40]!r}")
        header = _fields(lines[1:])
        length = _number(header.get("content-length"))
        if length is None:
            raise MalformedArchive("a record has no length")
        record: dict = {name: header.get(own.lower()) for name, own in FIELDS.items()}
        record["content_length"] = length
        rest = length
        passed = all(holds(test, record) for test in wanted.early)
        if passed and wanted.http:
            rest -= _read_http(stream, record, header, length)
            passed = all(holds(test, record) for test in wanted.late)
        if passed and wanted.payload:
            record["payload"] = stream.read(rest)
            if len(record["payload"]) < rest:
                raise MalformedArchive("the file ends within a payload")
            rest = 0
        _pass_over(stream, rest)
        # At the end of a file a seek goes too far without a word; this does not.
        if stream.read(4) != b"\r\n\r\n":
            raise MalformedArchive("a record does not end where its length says")
        if passed:
            yield {name: record.get(name) for name in wanted.columns}


def _read_http(stream: io.BufferedIOBase, record: dict, header: dict, length: int) -> int:
    """Fill in what the HTTP header in a block says; the bytes it takes. A block without
    one is all payload."""
    kind = (header.get("content-type") or "").replace(" ", "").lower()
    if not kind.startswith("application/http"):
        record["payload_bytes"] = length
        return 0
    lines, size = [], 0
    while size < length:
        line = stream.readline(min(_HEADER_BYTES, length - size))
        if not line:
            raise MalformedArchive("the file ends within a block")
        size += len(line)
        stripped = line.rstrip(b"\r\n")
        if not stripped:
            break
        lines.append(stripped)
    status = lines[0].split(b" ") if lines else []
    record["http_status"] = _number(status[1].decode("ascii", "replace")) if len(status) > 1 else None
    record["payload_bytes"] = length - size
    if record["record_type"] == "revisit":
        # The payload is elsewhere; its length is what the server said.
        record["payload_bytes"] = _number(_fields(lines[1:]).get("content-length"))
    return size


def _one_line(text: str) -> str:
    """Text for a header field: control characters are percent-encoded."""
    return re.sub(
        "[\x00-\x1f\x7f]", lambda found: "".join(f"%{b:02X}" for b in found[0].encode()), text
    )


def record_bytes(row: dict) -> bytes:
    """A record as it stands in a file. Columns that are null or missing are left out.

    A response's payload follows an HTTP header; a revisit has the HTTP header alone, with
    the length of the payload; other records consist of their payload.
    """
    payload = row.get("payload") or b""
    size = row.get("payload_bytes")
    kind = row.get("record_type") or "resource"
    if kind in ("response", "revisit"):
        told = len(payload) if size is None else size
        block = (
            f"HTTP/1.1 {row.get('http_status') or 200} OK\r\n"
            f"Content-Type: text/html; charset=utf-8\r\nContent-Length: {told}\r\n\r\n"
        ).encode()
        block += payload if kind == "response" else b""
        content = "application/http;msgtype=response"
    else:
        block, content = payload, row.get("content_type") or "application/octet-stream"
    told = {
        **row,
        "record_type": kind,
        "record_id": row.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>",
        "date": row.get("date") or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "content_type": content,
        "profile": row.get("profile") or (REVISIT_PROFILE if kind == "revisit" else None),
    }
    lines = [f"{own}: {_one_line(told[n])}" for n, own in FIELDS.items() if told.get(n) is not None]
    head = b"\r\n".join([VERSION, *(line.encode() for line in lines)])
    return head + f"\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


# ---- predicates ---------------------------------------------------------------------

_TESTS = {
    ds.EqualTo: lambda own, value: own == value,
    ds.In: lambda own, value: own in value,
    ds.GreaterThan: lambda own, value: own > value,
    ds.GreaterThanOrEqual: lambda own, value: own >= value,
    ds.LessThan: lambda own, value: own < value,
    ds.LessThanOrEqual: lambda own, value: own <= value,
    ds.StringStartsWith: lambda own, value: own.startswith(value),
    ds.StringEndsWith: lambda own, value: own.endswith(value),
    ds.StringContains: lambda own, value: value in own,
}


def tested_column(test: ds.Filter) -> str | None:
    """The column a test is about, if it is one that can be made while reading."""
    if isinstance(test, ds.Not):
        return tested_column(test.child)
    known = isinstance(test, (*_TESTS, ds.IsNull, ds.IsNotNull, ds.EqualNullSafe))
    return test.attribute[0] if known and len(test.attribute) == 1 else None


def _outcome(test: ds.Filter, record: dict) -> bool | None:
    if isinstance(test, ds.Not):
        inner = _outcome(test.child, record)
        return None if inner is None else not inner
    own = record.get(test.attribute[0])
    if isinstance(test, ds.IsNull):
        return own is None
    if isinstance(test, ds.IsNotNull):
        return own is not None
    if isinstance(test, ds.EqualNullSafe):
        return own == test.value
    if own is None or test.value is None:
        return None
    if isinstance(test, ds.In) and own not in test.value and None in test.value:
        return None
    return _TESTS[type(test)](own, test.value)


def holds(test: ds.Filter, record: dict) -> bool:
    """Whether a test is true as in SQL: neither false nor unknown."""
    return _outcome(test, record) is True


# ---- the source ---------------------------------------------------------------------


@dataclass
class Files(ds.InputPartition):
    """Files that one task reads."""

    names: list[str]


class WarcReader(ds.DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, partition_bytes: int):
        self.path, self.schema, self.partition_bytes = path, schema, partition_bytes
        unknown = set(schema.names) - _IN_HEADER - _IN_HTTP - {"payload"}
        if unknown:
            raise ValueError(f"no such columns in an archive: {sorted(unknown)}")
        self.tests: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for test in filters:
            if tested_column(test) in _IN_HEADER | _IN_HTTP:
                self.tests.append(test)
            else:
                yield test

    def partitions(self) -> list[Files]:
        """Files in order of name, as many to a task as its bytes allow, at least one."""
        planned: list[Files] = []
        held = 0
        for name, size in archive_files(self.path):
            if not planned or held + size > self.partition_bytes:
                planned.append(Files([]))
                held = 0
            planned[-1].names.append(name)
            held += size
        return planned

    def read(self, partition: Files | None) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        wanted = Wanted(list(self.schema.names), self.tests)
        rows, held = [], 0
        for name in partition.names if partition else []:
            with open_archive(self.path, name) as stream:
                try:
                    for record in records(stream, wanted):
                        rows.append(record)
                        held += len(record.get("payload") or b"")
                        if held >= _BATCH_BYTES or len(rows) >= _BATCH_ROWS:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                except MalformedArchive as cause:
                    raise MalformedArchive(f"{name}: {cause}") from cause
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def archive_files(path: str) -> list[tuple[str, int]]:
    """Names and sizes of a folder's archives: those that were committed, if it was written
    here, else all files that are named like archives."""
    system, folder = open_folder(path)
    found = {
        posixpath.basename(info.path): info.size
        for info in system.get_file_info(fs.FileSelector(folder))
        if info.type == fs.FileType.File
    }
    if _LISTED in found:
        with system.open_input_stream(posixpath.join(folder, _LISTED)) as stream:
            names = stream.read().decode().split()
        return [(name, found[name]) for name in sorted(names)]
    if _STARTED in found:
        raise MalformedArchive(f"{path} was begun and never completed")
    return sorted(x for x in found.items() if x[0].endswith((".warc", ".warc.gz")))


def open_archive(path: str, name: str) -> io.BufferedReader:
    system, folder = open_folder(path)
    file = system.open_input_file(posixpath.join(folder, name))
    if name.endswith(".gz"):
        return io.BufferedReader(gzip.GzipFile(fileobj=file), 1 << 20)
    return io.BufferedReader(file, 1 << 20)


@dataclass
class Written(ds.WriterCommitMessage):
    names: list[str]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, path: str, compress: bool, file_bytes: int):
        self.path, self.compress, self.file_bytes = path, compress, file_bytes
        system, folder = open_folder(path)
        system.create_dir(folder, recursive=True)
        if system.get_file_info(fs.FileSelector(folder)):
            raise FileExistsError(f"{path} is not empty")
        system.open_output_stream(posixpath.join(folder, _STARTED)).close()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """A file begins with the first row, so that a task without rows writes none."""
        system, folder = open_folder(self.path)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        names: list[str] = []
        stream, held = None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if stream is None or held >= self.file_bytes:
                        if stream is not None:
                            stream.close()
                        suffix = "warc.gz" if self.compress else "warc"
                        names.append(f"part-{part:06d}-{len(names):04d}-{attempt}.{suffix}")
                        stream, held = (
                            system.open_output_stream(posixpath.join(folder, names[-1]), compression=None),
                            0,
                        )
                    data = record_bytes(row)
                    if self.compress:
                        data = gzip.compress(data, 3, mtime=0)
                    stream.write(data)
                    held += len(data)
        finally:
            if stream is not None:
                stream.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        names = sorted(name for m in messages if m is not None for name in m.names)
        system, folder = open_folder(self.path)
        with system.open_output_stream(posixpath.join(folder, _LISTED)) as stream:
            stream.write("\n".join(names).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing is listed, so nothing will be read; what is there goes."""
        system, folder = open_folder(self.path)
        for info in system.get_file_info(fs.FileSelector(folder)):
            if posixpath.basename(info.path) != _STARTED:
                system.delete_file(info.path)


class WarcSource(ds.DataSource):
    """``spark.read.format("warc")``: columns are those of ``SCHEMA``, or the ones named with
    ``schema()``. Options: partitionBytes; for writing compress (true) and fileBytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        size = int(self.options.get("partitionBytes", PARTITION_BYTES))
        return WarcReader(self.options["path"], schema, size)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are not overwritten; write to a new folder")
        compress = self.options.get("compress", "true").lower() == "true"
        size = int(self.options.get("fileBytes", FILE_BYTES))
        return WarcWriter(self.options["path"], compress, size)


_PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def read_archives(
    spark: SparkSession, path: str, columns: str | None = None, **options: object
) -> DataFrame:
    """The records of a folder of archives; ``columns`` is a schema of those that are wanted.

    Spark hands predicates to a Python source only where the session allows it, at the time
    a query is planned, so the setting is switched on and stays on. A folder without archives gives no
    rows; a folder whose writing was never completed, a damaged or shortened file and an unknown column are errors.
    """
    spark.dataSource.register(WarcSource)
    if spark.conf.get(_PUSHDOWN, "false") != "true":
        spark.conf.set(_PUSHDOWN, "true")
    reader = spark.read.format("warc").options(**options)
    return (reader.schema(columns) if columns else reader).load(path)


def write_archives(records: DataFrame, path: str, **options: object) -> None:
    """Write rows with columns of ``SCHEMA`` as records into a new folder; others are ignored."""
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode("append").options(**options).save(path)


# ---- pages --------------------------------------------------------------------------


def base32_of_hex(digest: Column) -> Column:
    """A hex digest whose bits are a multiple of 20, in base 32: five digits make four."""

    def four(i: Column) -> Column:
        value = F.conv(digest.substr(i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        digits = [F.shiftright(value, shift).bitwiseAND(F.lit(31)) for shift in (15, 10, 5, 0)]
        return F.concat(*[F.lit(BASE32).substr(d + 1, F.lit(1)) for d in digits])

    chunks = F.sequence(F.lit(0), F.floor(F.length(digest) / 5).cast("int") - 1)
    return F.array_join(F.transform(chunks, four), "")


def _page_id(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def page_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages as records. Of those with equal payloads of at least ``least_bytes`` bytes, the one with the
    largest page_id is a response and the others revisit it; smaller ones are all responses.

    The payload is the html in UTF-8, nothing for null. Rows that share the largest page_id are
    all responses. Null ids are smaller than any other; if a payload has no other, all are
    responses. Payloads of equal SHA-1 and length count as equal. A null url leaves its field out. Other
    columns are not read. The keys of repeated payloads are grouped without the payloads, broadcast as
    measured, and joined by shuffle beyond the limit.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("target_uri"),
        html.alias("payload"),
        F.sha1(html).alias("sha1"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
    )
    key = ["sha1", "payload_bytes"]
    repeated = (
        rows.where(F.col("payload_bytes") >= least_bytes)
        .groupBy(*key)
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    joined = attach(rows, KeySet(repeated), key)
    revisit = F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))

    def urn(number: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(number.cast("string"), F.lit("")), F.lit(">"))

    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        urn(F.col("page_id")).alias("record_id"),
        "target_uri",
        F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1"))).alias("payload_digest"),
        F.when(revisit, urn(F.col("kept"))).alias("refers_to"),
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """What archives written from ``page_records`` say of each page: page_id, payload_bytes,
    payload_digest, record_type, refers_to.

    Responses are read with their payloads, of which length and digest are taken; of revisits only the
    headers are read.
    """
    responses = read_archives(spark, path, "record_type string, record_id string, payload binary")
    revisits = read_archives(
        spark,
        path,
        "record_type string, record_id string, refers_to string, payload_digest string, "
        "payload_bytes long",
    )
    page = _page_id(F.col("record_id")).alias("page_id")
    return (
        responses.where(F.col("record_type") == "response")
        .select(
            page,
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            base32_of_hex(F.sha1("payload")).alias("payload_digest"),
            "record_type",
            F.lit(None).cast("long").alias("refers_to"),
        )
        .unionByName(
            revisits.where(F.col("record_type") == "revisit").select(
                page,
                "payload_bytes",
                F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
                "record_type",
                _page_id(F.col("refers_to")).alias("refers_to"),
            )
        )
    )


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(page_records(read(spark, sf_dir, "pages")), folder)
    return archived_pages(spark, folder)


ORACLE = f"""
WITH hashed AS (
    SELECT page_id, sha1(coalesce(html, '')) AS sha, strlen(coalesce(html, '')) AS bytes
    FROM pages
), kept AS (
    SELECT *, max(page_id) OVER (PARTITION BY sha, bytes) AS kept FROM hashed
)
SELECT page_id, bytes::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('{BASE32}', 1 + (
        (('0x' || substr(sha, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '')
        AS payload_digest,
    CASE WHEN page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM kept
"""
