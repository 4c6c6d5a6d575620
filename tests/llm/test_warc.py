"""Archives: exact round trips, predicates, partitions, damage, and pages against brute force."""

import base64
import gzip
import hashlib
import io
import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablewinnow.llm import warc
from tablewinnow.llm.common import ensure_checkpoint_dir

ROWS = [
    ("response", "<urn:a>", "http://x.org/\r\n?q=ä", None, 0, b""),
    ("response", "<urn:b>", "http://x.org/b", None, None, b"WARC/1.1\r\n\r\n\r\n\r\nWARC/1.0 inside"),
    ("revisit", "<urn:c>", "http://y.org/c", "<urn:b>", 31, None),
    ("metadata", "<urn:d>", None, None, None, bytes(range(256)) * 300),
    ("response", "<urn:e>", "http://y.org/e", None, None, b"\n" * 5000),
]
SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, "
    "payload_bytes long, payload binary"
)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def folder(spark, request):
    return f"{ensure_checkpoint_dir(spark)}/{abs(hash(request.node.name))}"


def local(folder):
    return folder.removeprefix("file:")


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip(spark, rows, folder, compress):
    warc.write_archives(rows, folder, compress=compress)
    found = {r.record_id: r for r in warc.read_archives(spark, folder).collect()}
    assert len(found) == len(ROWS)
    for kind, name, uri, refers_to, size, payload in ROWS:
        got = found[name]
        assert (got.record_type, got.refers_to) == (kind, refers_to)
        assert got.target_uri == (uri and uri.replace("\r\n", "%0D%0A"))
        assert bytes(got.payload) == (payload or b"")
        assert got.payload_bytes == (size if kind == "revisit" else len(payload))
        assert got.http_status == (None if kind == "metadata" else 200)


@pytest.mark.parametrize(
    "condition",
    [
        "record_type = 'response'",
        "record_type in ('revisit', 'metadata')",
        "target_uri like 'http://y.org/%' and record_type = 'response'",
        "target_uri is null",
        "refers_to is not null",
        "refers_to <=> null",
        "not record_type = 'response'",
        "payload_bytes > 30",
        "content_length >= 100 and http_status = 200",
        "record_type in ('revisit', null)",
        "target_uri like '%org/b' or record_type = 'metadata'",
    ],
)
def test_predicates(spark, rows, folder, condition):
    warc.write_archives(rows, folder)
    archive = warc.read_archives(spark, folder)
    kept = spark.createDataFrame(archive.collect(), archive.schema).where(condition)
    expected = {r.record_id for r in kept.collect()}
    assert {r.record_id for r in archive.where(condition).collect()} == expected


class Counting(io.BytesIO):
    """Counts the bytes that are read, as against passed over."""

    taken = 0

    def read(self, size=-1):
        data = super().read(size)
        self.taken += len(data)
        return data


def test_payloads_of_other_records_are_passed_over():
    big = b"x" * 1_000_000
    data = b"".join(
        warc.record_bytes({"record_type": kind, "record_id": f"<{kind}>", "payload": big})
        for kind in ("response", "metadata", "response")
    )
    test = warc.ds.EqualTo(("record_type",), "metadata")
    stream = Counting(data)
    found = list(warc.records(stream, warc.Wanted(["record_id", "payload"], [test])))
    assert [r["record_id"] for r in found] == ["<metadata>"] and found[0]["payload"] == big
    assert stream.taken < 1_010_000
    stream = Counting(data)
    assert len(list(warc.records(stream, warc.Wanted(["record_id", "payload_bytes"])))) == 3
    assert stream.taken < 10_000


def test_predicates_reach_the_reader():
    reader = warc.WarcReader("x", warc.T._parse_datatype_string("record_id string, payload binary"), 1)
    payload = warc.ds.EqualTo(("payload",), b"")
    header = warc.ds.EqualTo(("record_type",), "response")
    assert list(reader.pushFilters([payload, header])) == [payload]
    assert reader.tests == [header]


def test_partitions_follow_file_sizes(spark, rows, folder):
    warc.write_archives(rows.union(rows).repartition(5), folder, fileBytes=1, compress=False)
    files = warc.archive_files(folder)
    assert len(files) == 10
    assert warc.read_archives(spark, folder, partitionBytes=1).rdd.getNumPartitions() == 10
    assert warc.read_archives(spark, folder).rdd.getNumPartitions() == 1
    assert warc.read_archives(spark, folder, partitionBytes=1).count() == 10


def test_failed_write_leaves_nothing_to_read(spark, rows, folder):
    failing = rows.repartition(5).withColumn(
        "target_uri",
        F.when(F.col("record_type") == "metadata", F.raise_error(F.lit("no")).cast("string")).otherwise("u"),
    )
    with pytest.raises(Exception, match="no"):
        warc.write_archives(failing, folder)
    assert [f for f in os.listdir(local(folder)) if not f.startswith((".", "_"))] == []
    with pytest.raises(Exception, match="never completed"):
        warc.read_archives(spark, folder).collect()
    with pytest.raises(Exception, match="not empty"):
        warc.write_archives(rows, folder)


def test_uncommitted_files_are_not_read(spark, rows, folder):
    warc.write_archives(rows, folder, compress=False)
    name = warc.archive_files(folder)[0][0]
    with open(f"{local(folder)}/{name}", "rb") as file:
        data = file.read()
    with open(f"{local(folder)}/part-999999-0000-late.warc", "wb") as file:
        file.write(data)
    assert warc.read_archives(spark, folder).count() == len(ROWS)


@pytest.mark.parametrize("cut", [-1, -40, 30])
def test_damaged_files_are_errors(spark, rows, folder, cut):
    whole = b"".join(warc.record_bytes({"record_type": "metadata", "payload": b"p" * 90}) for _ in "ab")
    os.makedirs(local(folder))
    with open(f"{local(folder)}/a.warc", "wb") as file:
        file.write(whole[:cut])
    for columns in (None, "record_type string"):
        with pytest.raises(Exception, match="MalformedArchive"):
            warc.read_archives(spark, folder, columns).collect()


def test_archives_from_elsewhere(spark, folder):
    """Other versions, folded and repeated fields, no HTTP header, many members, spare lines."""
    record = (
        b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Target-URI: http://a\r\n\tb\r\n"
        b"X-Other: 1\r\nWARC-Type: twice\r\ncontent-length: 3\r\n\r\nabc\r\n\r\n"
    )
    os.makedirs(local(folder))
    with open(f"{local(folder)}/a.warc.gz", "wb") as file:
        file.write(gzip.compress(record) + gzip.compress(record + b"\r\n\r\n"))
    with open(f"{local(folder)}/b.txt", "wb") as file:
        file.write(b"no archive")
    found = warc.read_archives(spark, folder).collect()
    assert [(r.record_type, r.target_uri, bytes(r.payload)) for r in found] == [
        ("resource", "http://a b", b"abc")
    ] * 2


def test_unknown_columns_and_empty_folders(spark, folder):
    os.makedirs(local(folder))
    assert warc.read_archives(spark, folder).collect() == []
    with pytest.raises(Exception, match="no such columns"):
        warc.read_archives(spark, folder, "colour string").collect()


PAGES = [
    (1, "http://a/", "same", "x"),
    (2, "http://b/", "same", "x"),
    (2, "http://b/", "same", "x"),
    (3, None, "other", "x"),
    (4, "http://c/", None, "x"),
    (5, "http://d/", "", "x"),
    (None, "http://e/", "same", "x"),
    (None, "http://f/", "nobody", "x"),
    (None, "http://f/", "nobody", "x"),
    (6, "http://g/\n", "é " * 100_000, "x"),
    (-7, "http://g/", "WARC/1.1\r\n\r\n", "x"),
]


def brute(rows, least):
    groups = defaultdict(list)
    for page, _, html, _ in rows:
        groups[(html or "").encode()].append(page)
    result = []
    for payload, pages in groups.items():
        largest = max((p for p in pages if p is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for page in pages:
            revisit = page != largest and len(payload) >= least
            kind = "revisit" if revisit else "response"
            result.append((page, len(payload), digest, kind, largest if revisit else None))
    return sorted(result, key=repr)


@pytest.mark.parametrize("least", [0, 1, 5])
def test_pages(spark, folder, join_path, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, sha1 string")
    warc.write_archives(warc.page_records(pages.repartition(3), least), folder + join_path)
    found = warc.archived_pages(spark, folder + join_path).collect()
    assert sorted(map(tuple, found), key=repr) == brute(PAGES, least)


def test_no_pages(spark, folder):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(warc.page_records(pages), folder)
    assert warc.archived_pages(spark, folder).collect() == []
