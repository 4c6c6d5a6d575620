"""Dumps: round trips, files from elsewhere, ranges that cut lines, damage."""

import gzip
import os
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablewinnow.sources import dumps
from tablewinnow.sources.dumps import Dump, MalformedDump, write_dump
from tablewinnow.sources.tableset import Database, clone_tables

ODD = [
    None, "", "\\N", "\\", "\\\\", "\\n", "a\tb", "line\nnext", "\r", "\b\f\v", "\\.", "é🙂", "N",
    "COPY public.x (a) FROM stdin;", "tail\\", "\\\t\\\n", "CREATE TABLE x (", ");", "x" * 5000,
]


@pytest.fixture(scope="module")
def tables(spark):
    texts = spark.createDataFrame([(i, t, t) for i, t in enumerate(ODD)], 'id long, t string, `odd "name` string')
    kinds = spark.createDataFrame(
        [
            (True, 1, 2, 1.5, Decimal("1.20"), date(2024, 2, 29), datetime(2024, 1, 2, 3, 4, 5, 6), b"\x00\\\xff", [1]),
            (False, -1, None, float("nan"), None, None, None, b"", []),
            (None,) * 9,
            (None, 0, 0, -1e300, Decimal("0.00"), date(1, 1, 1), datetime(1970, 1, 1), None, None),
        ],
        "b boolean, i int, s short, d double, n decimal(10,2), day date, ts timestamp_ntz, x binary, a array<int>",
    )
    return {
        "texts": texts.repartition(3),
        "kinds": kinds.repartition(2),
        "one column": spark.createDataFrame([("",), (None,), ("a",)], "v string"),
        "sys.empty": spark.createDataFrame([], "id long, name string"),
    }


@pytest.mark.parametrize("compress", [False, True])
def test_round_trip(spark, tables, tmp_path, compress):
    dump = Dump(spark, write_dump(tables, str(tmp_path / "d"), compress))
    assert dump.names() == sorted(tables)
    for name, df in tables.items():
        found = dump.read(name)
        expected = df.withColumn("a", F.to_json("a")) if name == "kinds" else df
        assert found.dtypes == expected.dtypes
        assert list(map(repr, rows(found))) == list(map(repr, rows(expected)))


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_ranges_may_cut_anywhere(spark, tmp_path, size):
    draw = random.Random(size)
    lines = ["".join(draw.choice("ab\t\\.\u00e9") for _ in range(draw.randrange(12))) for _ in range(200)]
    table = spark.createDataFrame(list(enumerate(lines)), "id int, t string").coalesce(1)
    folder = write_dump({"t": table, "u": table.limit(3)}, str(tmp_path / "d"))
    # Blocks are found in large ranges, read in small ones.
    found = Dump(spark, folder)
    small = Dump(spark, folder, range_bytes=size)
    small.__dict__["contents"] = found.contents
    df = small.read("t").coalesce(4)
    assert rows(df) == rows(table)
    assert small.read("t").rdd.getNumPartitions() > (1 if size > 500 else 5)


@pytest.mark.parametrize("size", [40, 333, 5000])
def test_blocks_are_found_whatever_the_ranges(spark, tables, tmp_path, size):
    folder = write_dump({n: t for n, t in tables.items() if n != "kinds"}, str(tmp_path / "d"))
    if size == 40:
        tables = {"one column": tables["one column"]}
        folder = write_dump(tables, str(tmp_path / "e"))
    found = Dump(spark, folder, range_bytes=size).contents
    assert found == Dump(spark, folder).contents


SCRIPT = r"""--
-- A dump from elsewhere
SET client_encoding = 'UTF8';
CREATE TABLE public.users (
    id bigint NOT NULL,
    "user" character varying(255) DEFAULT 'x'::character varying,
    active boolean DEFAULT false,
    score numeric(8,3),
    tags text[],
    created timestamp with time zone,
    CONSTRAINT positive CHECK ((id > 0))
);


CREATE FUNCTION f() RETURNS void AS $$ BEGIN RETURN; END $$;

COPY public.users (id, "user", active, score, tags, created) FROM stdin;
1	ann	t	1.500	{a,b}	2024-01-02 03:04:05+00
2	COPY public.users (id) FROM stdin;	f	\N	\N	\N
3	a\\b\tc\nd	\N	-0.001	\N	2024-01-02 03:04:05.25+02
4	CREATE TABLE public.other (	t	0.000	\N	\N
\.


COPY audit.log (line) FROM stdin;

\\.
\N
plain
\.

CREATE TABLE bare (
    id integer
);
COPY bare FROM stdin;
7
\.
SELECT pg_catalog.setval('public.s', 1, false);
"""
USERS = [
    (1, "ann", True, Decimal("1.500"), "{a,b}", datetime(2024, 1, 2, 3, 4, 5)),
    (2, "COPY public.users (id) FROM stdin;", False, None, None, None),
    (3, "a\\b\tc\nd", None, Decimal("-0.001"), None, datetime(2024, 1, 2, 1, 4, 5, 250000)),
    (4, "CREATE TABLE public.other (", True, Decimal("0.000"), None, None),
]


@pytest.mark.parametrize("suffix", [".sql", ".sql.gz"])
def test_a_script_from_elsewhere(spark, tmp_path, suffix):
    path = str(tmp_path / f"db{suffix}")
    with (gzip.open if suffix.endswith("gz") else open)(path, "wb") as file:
        file.write(SCRIPT.encode())
    dump = Dump(spark, path)
    assert dump.names() == ["audit.log", "bare", "users"]
    users = dump.read("users")
    assert [t for _, t in users.dtypes] == [
        "bigint", "string", "boolean", "decimal(8,3)", "string", "timestamp",
    ]
    assert rows(users.withColumn("created", F.to_utc_timestamp("created", "UTC"))) == sorted(USERS, key=repr)
    assert rows(dump.read("audit.log")) == sorted([("",), ("\\.",), (None,), ("plain",)], key=repr)
    assert rows(dump.read("bare")) == [(7,)]
    target = Database(spark, new_database(spark, tmp_path))
    clone_tables(dump, target, exclude_schemas=["audit"])
    assert target.names() == ["bare", "users"] and rows(target.read("bare")) == [(7,)]


def new_database(spark, tmp_path):
    name = f"dumped_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    return name


def test_a_large_table_is_read_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "big.sql")
    with open(path, "w") as file:
        file.write("COPY a (id, v) FROM stdin;\n")
        file.writelines(f"{i}\t{'v' * (i % 50)}\n" for i in range(200_000))
        file.write("\\.\nCOPY b (id) FROM stdin;\n1\n\\.\n")
    dump = Dump(spark, path, range_bytes=200_000)
    table = dump.read("a")
    assert table.rdd.getNumPartitions() > 20
    total = table.selectExpr("count(*)", "sum(cast(id AS long))", "sum(length(v))").first()
    assert tuple(total) == (200_000, sum(range(200_000)), sum(i % 50 for i in range(200_000)))
    assert dump.read("b").rdd.getNumPartitions() == 1 and rows(dump.read("b")) == [("1",)]


def test_a_block_without_an_end_is_an_error(spark, tmp_path):
    path = tmp_path / "cut.sql"
    path.write_text(SCRIPT[: SCRIPT.index("COPY audit") - 4])
    with pytest.raises(MalformedDump, match="no end"):
        Dump(spark, str(path)).names()


def test_a_failed_dump_is_not_read(spark, tables, tmp_path):
    folder = str(tmp_path / "d")
    failing = spark.range(9).repartition(3).select(
        F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.lit("x")).alias("v")
    )
    with pytest.raises(Exception, match="no"):
        write_dump({**tables, "failing": failing}, folder)
    with pytest.raises(MalformedDump, match="never completed"):
        Dump(spark, folder).names()
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        write_dump(tables, folder)
    assert os.path.isdir(folder)
