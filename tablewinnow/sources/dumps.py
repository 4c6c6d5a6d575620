"""Database dumps as text: SQL files whose tables are ``COPY ... FROM stdin`` blocks.

``Dump`` reads a file, or a folder of files, as a table set. Files are searched for blocks in
byte ranges, by as many tasks as there are ranges, and a table's blocks are read in ranges that
begin and end at line ends, so that a large table is read by many tasks and other tables not at
all. A compressed file cannot be entered in the middle: one task reads it, up to the end of the
table.

``write_dump`` writes a table set as such a folder. Each file has whole blocks, so that the files
are valid scripts one by one and in any order, after the one with the table definitions. Lines are
made and taken apart by expressions; only finding them takes Python.
"""

from __future__ import annotations

import gzip
import io
import json
import posixpath
import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property, partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewinnow.settings import concurrently
from tablewinnow.sources.tableset import DEFAULT_SCHEMA, MANIFEST

# How a dump marks null, the end of a block, and characters that would end a
# field or a line.
NULL, END = "\\N", "\\."
ESCAPES = {"\b": "b", "\f": "f", "\n": "n", "\r": "r", "\t": "t", "\v": "v"}

# Types of a dump's table definitions, and what they are here; others are text.
TYPES = {
    "bigint": "bigint",
    "integer": "int",
    "smallint": "smallint",
    "boolean": "boolean",
    "double precision": "double",
    "real": "float",
    "date": "date",
    "timestamp without time zone": "timestamp_ntz",
    "timestamp with time zone": "timestamp",
    "bytea": "binary",
    "text": "string",
}
_NAMES = {short: long for long, short in TYPES.items()}

# Bytes that a task searches or reads, and that it holds at a time.
RANGE_BYTES = 64 << 20
_CHUNK = 8 << 20
# A table's definition or the head of a block takes no more.
_STATEMENT = 1 << 20

_IDENTIFIER = r'(?:"(?:[^"\n]|"")*"|[^\s".(]+)'
_TABLE = rf"(?:{_IDENTIFIER}\.)?{_IDENTIFIER}"
_HEAD = re.compile(rf"COPY ({_TABLE}) (?:\((.*)\) )?FROM stdin;")
_DEFINITION = re.compile(rf"CREATE (?:UNLOGGED )?TABLE ({_TABLE}) \(\n(.*?)\n\)", re.DOTALL)
_MARKS = re.compile(
    rb"^(?:COPY [^\n]* FROM stdin;|\\\.|CREATE (?:UNLOGGED )?TABLE [^\n]* \(\n(?:[^\n]*\n)*?\)[^\n]*)$",
    re.MULTILINE,
)


class MalformedDump(ValueError):
    """A block without an end, or a folder that was never completed."""


# ---- lines --------------------------------------------------------------------------


def _text(column: Column, kind: T.DataType) -> Column:
    """A value as a dump writes it, before escaping."""
    if isinstance(kind, T.BooleanType):
        return F.when(column, "t").when(~column, "f")
    if isinstance(kind, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(column)))
    if isinstance(kind, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        whole = F.to_json(F.struct(column.alias("v")))  # {"v":...}
        return F.when(column.isNotNull(), F.substring(whole, F.lit(6), F.length(whole) - 6))
    return column.cast("string")


def copy_line(df: DataFrame) -> Column:
    """A row as a line of a block: fields between tabs, null as ``\\N``, what would end a field
    or a line escaped."""

    def field(column: T.StructField) -> Column:
        text = F.replace(_text(F.col(f"`{column.name}`"), column.dataType), F.lit("\\"), F.lit("\\\\"))
        for character, letter in ESCAPES.items():
            text = F.replace(text, F.lit(character), F.lit("\\" + letter))
        return F.coalesce(text, F.lit(NULL))

    return F.concat_ws("\t", *[field(column) for column in df.schema.fields])


def _plain(field: Column) -> Column:
    """A field's text. Pieces between escaped backslashes are unescaped by themselves, so that a
    backslash that stands for itself escapes nothing."""

    def piece(text: Column) -> Column:
        for character, letter in ESCAPES.items():
            text = F.replace(text, F.lit("\\" + letter), F.lit(character))
        # Before any other character a backslash says nothing.
        return F.replace(text, F.lit("\\"), F.lit(""))

    pieces = F.transform(F.split(field, r"\\\\", -1), piece)
    unescaped = F.when(F.contains(field, F.lit("\\")), F.array_join(pieces, "\\")).otherwise(field)
    return F.when(field != NULL, unescaped)


def fields_of(line: Column, columns: Mapping[str, str]) -> list[Column]:
    """The columns (name and type) of a block's line."""

    def value(at: int, kind: str) -> Column:
        text = _plain(F.get(F.split(line, "\t", -1), F.lit(at)))
        return F.unhex(F.substring(text, 3, 1 << 30)) if kind == "binary" else text.cast(kind)

    return [value(at, kind).alias(name) for at, (name, kind) in enumerate(columns.items())]


# ---- names and types ----------------------------------------------------------------


def _unquoted(identifier: str) -> str:
    return identifier[1:-1].replace('""', '"') if identifier.startswith('"') else identifier


def _quoted(identifier: str) -> str:
    plain = re.fullmatch("[a-z_][a-z0-9_]*", identifier)
    return identifier if plain else '"' + identifier.replace('"', '""') + '"'


def _table_name(written: str) -> str:
    """A table's name, with its schema if that is not the default one."""
    parts = [_unquoted(p) for p in re.findall(_IDENTIFIER, written)]
    return parts[-1] if len(parts) == 1 or parts[0] == DEFAULT_SCHEMA else ".".join(parts)


def _spark_type(written: str) -> str:
    decimal = re.match(r"numeric\((\d+),\s*(\d+)\)", written)
    if decimal and int(decimal[1]) <= 38:
        return f"decimal({decimal[1]},{decimal[2]})"
    return next((kind for name, kind in TYPES.items() if re.match(rf"{name}\b(?!\[)", written)), "string")


def _sql_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"numeric({kind.precision},{kind.scale})"
    if isinstance(kind, T.ByteType):
        return "smallint"
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return "jsonb"
    return _NAMES.get(kind.simpleString(), "text")


def definition(name: str, schema: T.StructType) -> str:
    """The statement that makes a table."""
    columns = ",\n".join(f"    {_quoted(f.name)} {_sql_type(f.dataType)}" for f in schema.fields)
    return f"CREATE TABLE {_written_name(name)} (\n{columns}\n);"


def _written_name(name: str) -> str:
    schema, _, table = name.rpartition(".")
    return f"{_quoted(schema or DEFAULT_SCHEMA)}.{_quoted(table)}"


def _defined(body: str) -> dict[str, str]:
    """Columns and types of a definition; its constraints are left out."""
    found = {}
    for line in body.split("\n"):
        own = re.match(rf"\s+({_IDENTIFIER}) (\S.*?),?$", line)
        if own and own[1] not in ("CONSTRAINT", "PRIMARY", "UNIQUE", "CHECK", "FOREIGN", "EXCLUDE"):
            found[_unquoted(own[1])] = _spark_type(own[2])
    return found


# ---- finding blocks -----------------------------------------------------------------


def _located(path: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _opened(path: str) -> io.BufferedIOBase:
    system, own = _located(path)
    file = system.open_input_file(own)
    return io.BufferedReader(gzip.GzipFile(fileobj=file) if path.endswith(".gz") else file, 1 << 20)


def _files(path: str) -> list[tuple[str, int]]:
    """The dump's files and their sizes."""
    system, own = _located(path)
    root = system.get_file_info(own)
    if root.type == fs.FileType.File:
        return [(path, root.size)]
    infos = system.get_file_info(fs.FileSelector(own, recursive=True))
    names = {info.path[len(root.path) :].strip("/"): info for info in infos if info.is_file}
    if not any(name.startswith(f"{MANIFEST}/") for name in names):
        raise MalformedDump(f"{path} has no {MANIFEST}: it was never completed")
    shown = [
        (f"{path.rstrip('/')}/{name}", info.size)
        for name, info in sorted(names.items())
        if not name.startswith(MANIFEST) and not posixpath.basename(name).startswith((".", "_"))
    ]
    return [x for x in shown if x[1]]


def _marks(path: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """Heads and ends of blocks and definitions of tables that begin in a byte range, as (start,
    end, text). Some may be data that looks like it; ``_blocks`` knows."""
    with _opened(path) as file:
        if path.endswith(".gz"):
            yield from _marks_of_lines(file)
            return
        before = 1 if start else 0
        file.seek(start - before)
        data = file.read(end - start + before + _STATEMENT)
        # A match may begin at the range's first byte only if a line does.
        for m in _MARKS.finditer(data, 0, len(data)):
            at = start - before + m.start()
            if start <= at < end:
                yield at, start - before + m.end() + 1, m[0].decode("utf-8", "replace")


def _marks_of_lines(file: Iterable[bytes]) -> Iterator[tuple[int, int, str]]:
    at, statement = 0, []
    for line in file:
        begin, at = at, at + len(line)
        if statement:
            statement.append(line)
            if line.startswith(b")"):
                text = b"".join(statement)
                yield at - len(text), at, text.decode("utf-8", "replace").rstrip("\n")
            if line.startswith(b")") or sum(map(len, statement)) > _STATEMENT:
                statement = []
        elif line.startswith((b"COPY ", b"\\.\n")):
            yield begin, at, line.decode("utf-8", "replace").rstrip("\n")
        elif line.startswith((b"CREATE TABLE ", b"CREATE UNLOGGED TABLE ")):
            statement = [line]


@dataclass(frozen=True)
class Block:
    """The lines of a table between two bytes of a file."""

    file: str
    start: int
    end: int


@dataclass(frozen=True)
class Contents:
    """Per table its columns with their types, and its blocks."""

    columns: Mapping[str, Mapping[str, str]]
    blocks: Mapping[str, tuple[Block, ...]]


def _contents(marks: Iterable[tuple[str, int, int, str]]) -> Contents:
    """What marks (file, start, end, text), in order, say. Between a block's head and its end all
    is data, whatever it looks like."""
    defined: dict[str, dict[str, str]] = {}
    heads: dict[str, list[str] | None] = {}
    blocks: dict[str, list[Block]] = {}
    inside: tuple[str, str, int] | None = None
    for file, start, end, text in marks:
        if inside and inside[0] != file:
            raise MalformedDump(f"{inside[0]}: the data of {inside[1]} have no end")
        if inside:
            if text == END:
                blocks[inside[1]].append(Block(file, inside[2], start))
                inside = None
            continue
        made = _DEFINITION.match(text)
        head = _HEAD.fullmatch(text)
        if made:
            defined[_table_name(made[1])] = _defined(made[2])
        elif head:
            name = _table_name(head[1])
            names = re.findall(_IDENTIFIER.replace("(]", "(,]"), head[2]) if head[2] else None
            heads[name] = [_unquoted(n) for n in names] if names is not None else None
            blocks.setdefault(name, [])
            inside = file, name, end
    if inside:
        raise MalformedDump(f"{inside[0]}: the data of {inside[1]} have no end")
    columns = {}
    for name in {**defined, **heads}:
        types = defined.get(name, {})
        listed = heads.get(name)
        if listed is None and not types:
            raise MalformedDump(f"the columns of {name} are not named anywhere")
        columns[name] = {c: types.get(c, "string") for c in listed or types}
    return Contents(columns, {name: tuple(blocks.get(name, ())) for name in columns})


# ---- the source ---------------------------------------------------------------------


@dataclass
class Ranges(ds.InputPartition):
    """Ranges of a block's lines that one task reads: file, block's start, start, end."""

    parts: list[tuple[str, int, int, int]]


class _LineReader(ds.DataSourceReader):
    def __init__(self, blocks: list[Block], range_bytes: int):
        self.blocks, self.range_bytes = blocks, range_bytes

    def partitions(self) -> list[Ranges]:
        """Large blocks are cut into ranges; small ones are put together."""
        planned, held = [Ranges([])], 0
        for block in self.blocks:
            whole = block.file.endswith(".gz")
            step = max(1, block.end - block.start if whole else self.range_bytes)
            for start in range(block.start, block.end, step):
                end = min(block.end, start + step)
                if planned[-1].parts and (whole or held + end - start > self.range_bytes):
                    planned.append(Ranges([]))
                    held = 0
                planned[-1].parts.append((block.file, block.start, start, end))
                held += end - start
        return planned

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for file, first, start, end in partition.parts:
            for lines in _lines(file, first, start, end):
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()).cast(pa.string())], ["line"])


def _lines(path: str, first: int, start: int, end: int) -> Iterator[list[bytes]]:
    """The lines that begin in a range of a block that begins at ``first``. The last of them
    may end beyond the range, but not beyond its block."""
    with _opened(path) as file:
        at = start
        if start > first:
            # The line that the byte before the range belongs to is the task's before.
            file.seek(start - 1)
            at = start - 1 + len(file.readline())
        else:
            file.seek(start)
        while at < end:
            data = file.read(min(_CHUNK, end - at))
            if not data.endswith(b"\n"):
                data += file.readline()
            if not data:
                raise MalformedDump(f"{path}: a block is shorter than it was")
            at += len(data)
            yield data[:-1].split(b"\n")


class DumpSource(ds.DataSource):
    """``spark.read.format("dump_lines")``: the lines of the blocks given as JSON."""

    @classmethod
    def name(cls) -> str:
        return "dump_lines"

    def schema(self) -> str:
        return "line string"

    def reader(self, schema: T.StructType) -> _LineReader:
        blocks = [Block(*b) for b in json.loads(self.options["blocks"])]
        return _LineReader(blocks, int(self.options["rangeBytes"]))


@dataclass(frozen=True)
class Dump:
    """The tables of a dump: a file, plain or compressed (``.gz``), or a folder of ``write_dump``.

    Columns have the types of the table definitions, as far as ``TYPES`` has them; without
    definitions they are text. Statements other than definitions and blocks are not looked at. Text
    is UTF-8. Where the same table has several blocks, its rows are those of all.
    """

    spark: SparkSession
    path: str
    range_bytes: int = RANGE_BYTES

    @cached_property
    def contents(self) -> Contents:
        files = _files(self.path)
        ranges = [
            (name, start, min(size, start + self.range_bytes))
            for name, size in files
            for start in range(0, size, size if name.endswith(".gz") else self.range_bytes)
        ]

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    marks = list(_marks(name, start, end))
                    columns = list(zip(*marks)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(marks), pa.string()),
                            pa.array(columns[0], pa.int64()),
                            pa.array(columns[1], pa.int64()),
                            pa.array(columns[2], pa.string()),
                        ],
                        ["file", "start", "end", "text"],
                    )

        if not ranges:
            return Contents({}, {})
        given = self.spark.createDataFrame(ranges, "file string, start long, end long")
        # Ranges are dealt one by one; they are large, their marks are few.
        tasks = min(len(ranges), 10_000)
        marks = given.repartition(tasks, "file", "start").mapInArrow(
            search, "file string, start long, end long, text string"
        )
        return _contents(sorted(map(tuple, marks.collect())))

    def names(self) -> list[str]:
        return sorted(self.contents.columns)

    def read(self, name: str) -> DataFrame:
        columns, blocks = self.contents.columns[name], self.contents.blocks[name]
        self.spark.dataSource.register(DumpSource)
        given = json.dumps([(b.file, b.start, b.end) for b in blocks])
        lines = (
            self.spark.read.format("dump_lines")
            .options(blocks=given, rangeBytes=self.range_bytes)
            .load()
        )
        return lines.select(*fields_of(F.col("line"), columns))


# ---- writing ------------------------------------------------------------------------


def _with_head_and_end(df: DataFrame, name: str) -> DataFrame:
    """The lines of a table, those of each partition as a whole block."""
    head = f"COPY {_written_name(name)} ({', '.join(map(_quoted, df.columns))}) FROM stdin;"

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines(texts: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([texts], ["value"])

        begun = False
        for batch in batches:
            if batch.num_rows and not begun:
                begun = True
                yield lines(pa.array([head]))
            yield lines(batch.column(0))
        if begun:
            yield lines(pa.array([END]))

    return df.select(copy_line(df).alias("value")).mapInArrow(wrap, "value string")


def write_dump(tables: Mapping[str, DataFrame], folder: str, compress: bool = False) -> str:
    """Write tables as a dump, a new folder of SQL files.

    Files of a table are written side by side, and a list of the tables last: a folder without
    it was never completed and is not read. In the order of their paths the files are one
    script. Arrays, maps, structs and variants become JSON text.
    """
    spark = next(iter(tables.values())).sparkSession
    options = {"compression": "gzip"} if compress else {}
    texts = [definition(name, df.schema) for name, df in tables.items()]
    statements = spark.createDataFrame([("\n\n".join(texts) + "\n",)], "value string")

    def write(number: int, name: str) -> None:
        lines = _with_head_and_end(tables[name], name)
        place = f"{folder}/{number:06d}_{re.sub('[^A-Za-z0-9_.]', '_', name)}"
        lines.write.mode("errorifexists").options(**options).text(place)

    statements.coalesce(1).write.mode("errorifexists").text(f"{folder}/000000_tables")
    concurrently(*[partial(write, n, name) for n, name in enumerate(tables, 1)])
    manifest = spark.createDataFrame([(name,) for name in tables], "name string")
    manifest.coalesce(1).write.mode("errorifexists").json(f"{folder}/{MANIFEST}")
    return folder
