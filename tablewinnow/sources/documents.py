"""One large JSON document, read by many tasks.

A metadata document is a single object of lists of objects. To cut it, a place in the file must be
known to lie outside strings, and how deep. Both are prefix sums over byte ranges: a range tells
whether it has an odd number of quotes, and by how much it changes the depth if it begins
outside a string and if it begins inside one. From these few numbers follows how each range
really begins. Then each task cuts the objects that begin in its range, reading on to the end of
the last. What comes out are JSON lines in the shared folder, a list each, which Spark reads like
any others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tablewinnow.settings import ensure_checkpoint_dir
from tablewinnow.sources.dumps import _located

RANGE_BYTES = 16 << 20
_MORE = 1 << 20
# A key at the top level is looked for in so many bytes before its value.
_KEY_BYTES = 1 << 16

_QUOTE, _BACKSLASH = 0x22, 0x5C
_CHANGE = np.zeros(256, np.int8)
_CHANGE[[ord("{"), ord("[")]] = 1
_CHANGE[[ord("}"), ord("]")]] = -1
_SPECIAL = _CHANGE != 0
_SPECIAL[_QUOTE] = True


class MalformedDocument(ValueError):
    """Text that is not one JSON object of balanced brackets."""


@dataclass(frozen=True)
class Range:
    """Bytes of a file, and how they begin: inside a string or not, how deep, and in which of the
    lists, if in any."""

    number: int
    start: int
    end: int
    quoted: int = 0
    depth: int = 0
    inside: int = -1


def _escaped(data: np.ndarray, place: int, before: bytes) -> bool:
    """Whether an odd number of backslashes comes before a place."""
    n = 0
    while place > n and data[place - n - 1] == _BACKSLASH:
        n += 1
    if place == n:
        n += len(before) - len(before.rstrip(b"\\"))
    return n % 2 == 1


def _specials(data: bytes, before: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of brackets and of quotes that are not escaped, the bytes there, and how many such
    quotes there were up to each."""
    array = np.frombuffer(data, np.uint8)
    places = np.flatnonzero(_SPECIAL[array])
    bytes_ = array[places]
    quotes = np.flatnonzero(bytes_ == _QUOTE)
    previous = array[np.maximum(places[quotes] - 1, 0)]
    previous[places[quotes] == 0] = before[-1] if before else 0
    doubtful = quotes[previous == _BACKSLASH]
    dropped = [i for i in doubtful.tolist() if _escaped(array, int(places[i]), before)]
    if dropped:
        kept = np.ones(len(places), bool)
        kept[dropped] = False
        places, bytes_ = places[kept], bytes_[kept]
    return places, bytes_, np.cumsum(bytes_ == _QUOTE)


def _changes(bytes_: np.ndarray, quotes: np.ndarray, quoted: int) -> np.ndarray:
    """By how much each special byte changes the depth, if the data begin so."""
    return np.where((quotes + quoted) % 2 == 0, _CHANGE[bytes_], 0).astype(np.int64)


class _File:
    def __init__(self, path: str):
        system, own = _located(path)
        self._file = system.open_input_file(own)

    def read(self, start: int, size: int) -> bytes:
        self._file.seek(start)
        return self._file.read(size)

    def before(self, start: int) -> bytes:
        """The byte before a place, with all backslashes before it if it is one."""
        size = 64
        while True:
            data = self.read(max(0, start - size), min(size, start))
            if len(data) < size or data.strip(b"\\"):
                return data[len(data.rstrip(b"\\")) :] or data[-1:]
            size *= 2

    def __enter__(self) -> _File:
        return self

    def __exit__(self, *_: object) -> None:
        self._file.close()


def _totals(file: _File, own: Range) -> tuple[int, int, int]:
    """Whether a range has an odd number of quotes, and the change of depth if it begins
    outside a string and inside one."""
    data = file.read(own.start, own.end - own.start)
    _, bytes_, quotes = _specials(data, file.before(own.start))
    odd = int(quotes[-1]) % 2 if len(quotes) else 0
    return odd, int(_changes(bytes_, quotes, 0).sum()), int(_changes(bytes_, quotes, 1).sum())


def is_object(path: str) -> bool:
    """Whether a file begins as a JSON object does."""
    with _File(path) as file:
        return file.read(0, _KEY_BYTES).lstrip(b" \t\r\n\xef\xbb\xbf").startswith(b"{")


def _key(text: bytes) -> str | None:
    """The key that ends a text, before its colon."""
    text = text.rstrip(b" \t\r\n")
    if not text.endswith(b":"):
        return None
    text = text[:-1].rstrip(b" \t\r\n")
    at = text.rfind(b'"', 0, len(text) - 1)
    while at > 0 and _escaped(np.frombuffer(text, np.uint8), at, b""):
        at = text.rfind(b'"', 0, at)
    return json.loads(text[at:]) if at >= 0 and text.endswith(b'"') else None


def _openings(file: _File, own: Range) -> Iterator[tuple[int, str | None, bool, bool]]:
    """Values of the top level that open in a range: place, key, whether a list, and whether it has
    something else than objects in this range; and the last of these of what was open before, at
    place -1."""
    data = file.read(own.start, own.end - own.start)
    places, bytes_, quotes = _specials(data, file.before(own.start))
    depth = own.depth + np.cumsum(_changes(bytes_, quotes, own.quoted))
    outside = (quotes + own.quoted) % 2 == 0
    opening = np.flatnonzero(outside & (_CHANGE[bytes_] == 1) & (depth == 2))
    # What lies at depth 2 goes from a bracket that leads there to the next special byte.
    began = [(-1, None, True, False)]
    for i in opening.tolist():
        place = int(places[i])
        reach = min(own.start + place, _KEY_BYTES)
        key = _key(file.read(own.start + place - reach, reach))
        began.append((own.start + place, key, bytes_[i] == ord("["), False))
    gaps = np.flatnonzero(outside & (_CHANGE[bytes_] != 0) & (depth == 2))
    starts = [(0, 0)] if own.depth == 2 and not own.quoted else []
    starts += [(int(places[i]) + 1, int(i) + 1) for i in gaps.tolist()]
    odd = set()
    for at, following in starts:
        end = int(places[following]) if following < len(places) else len(data)
        opened = int(np.searchsorted(places[opening], at, "left"))
        scalar = data[at:end].strip(b" \t\r\n,nul")
        other = following < len(places) and bytes_[following] in b'["' and _outside_before(quotes, own, following)
        if scalar or other:
            odd.add(opened)
    for n, (place, key, is_list, _) in enumerate(began):
        yield place, key, is_list, n in odd


def _outside_before(quotes: np.ndarray, own: Range, i: int) -> bool:
    """Whether the special byte before ``i`` leaves the text outside a string."""
    return (int(quotes[i - 1] if i else 0) + own.quoted) % 2 == 0


def _objects(file: _File, own: Range, places_of: list[int]) -> Iterator[tuple[int, bytes]]:
    """The objects at depth 2 that begin in a range, each with the number of the value of the top
    level that it is in."""
    data, before = file.read(own.start, own.end - own.start), file.before(own.start)
    begun, at, quoted, depth = None, 0, own.quoted, own.depth
    piece, offset = data, 0
    while True:
        places, bytes_, quotes = _specials(piece, before)
        after = depth + np.cumsum(_changes(bytes_, quotes, quoted))
        outside = (quotes + quoted) % 2 == 0
        edges = outside & (((bytes_ == ord("{")) & (after == 3)) | ((bytes_ == ord("}")) & (after == 2)))
        for i in np.flatnonzero(edges).tolist():
            place = offset + int(places[i])
            if bytes_[i] == ord("{"):
                if place >= own.end - own.start:
                    return
                begun = place
            elif begun is not None:
                inside = int(np.searchsorted(places_of, own.start + begun, "right")) - 1
                yield inside, data[begun : place + 1]
                begun = None
                if place >= own.end - own.start:
                    return
        if begun is None:
            return
        quoted = (int(quotes[-1]) + quoted) % 2 if len(quotes) else quoted
        depth = int(after[-1]) if len(after) else depth
        before = piece[len(piece.rstrip(b"\\")) :] or piece[-1:]
        offset = len(data)
        piece = file.read(own.start + offset, _MORE)
        if not piece:
            raise MalformedDocument("the document ends within an object")
        data += piece


def _over_ranges(spark: SparkSession, path: str, ranges: list[Range], work, schema: str) -> DataFrame:
    """The rows that ``work(file, range)`` makes of each range, one task for each."""
    rows = [(r.number, r.start, r.end, r.quoted, r.depth, r.inside) for r in ranges]
    given = spark.createDataFrame(
        rows, "number int, start long, end long, quoted int, depth int, inside int"
    ).repartition(min(len(ranges), 10_000), "number")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with _File(path) as file:
                    held: list[tuple] = []
                    for found in work(file, Range(*row)):
                        held.append(found)
                        if len(held) >= 1000:
                            yield _rows(held, types, names)
                            held = []
                    if held:
                        yield _rows(held, types, names)

    return given.mapInArrow(run, schema)


def _rows(held: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    arrays = [pa.array(c, t) for c, t in zip(zip(*held), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _begun(totals: list[tuple], ranges: list[Range]) -> list[Range]:
    """The ranges with how they begin, by running sums over what each changes."""
    quoted = depth = 0
    known = []
    for own, (_, odd, outside, inside) in zip(ranges, sorted(totals), strict=True):
        known.append(Range(own.number, own.start, own.end, quoted, depth))
        depth += inside if quoted else outside
        quoted ^= odd
        if depth < 0:
            raise MalformedDocument("brackets close that were never opened")
    if depth or quoted:
        raise MalformedDocument("the document has no end")
    return known


def lists_of_objects(
    spark: SparkSession, path: str, size: int, range_bytes: int = RANGE_BYTES
) -> dict[str, DataFrame]:
    """One table per list of objects of the JSON object that the file of ``size`` bytes is.

    Lists that are empty or have other values than objects and null are left out, null elements too;
    of lists of the same name the rows are put together. The text is UTF-8. The ranges' numbers,
    a few per range, and the keys of the top level reach the driver.
    """
    ranges = [
        Range(n, start, min(size, start + range_bytes))
        for n, start in enumerate(range(0, size, range_bytes))
    ]

    def totals(file: _File, own: Range) -> Iterator[tuple]:
        yield (own.number, *_totals(file, own))

    summed = _over_ranges(spark, path, ranges, totals, "number int, odd int, outside int, inside int")
    known = _begun([tuple(r) for r in summed.collect()], ranges)

    def opened(file: _File, own: Range) -> Iterator[tuple]:
        for place, key, is_list, odd in _openings(file, own):
            yield own.number, place, key, bool(is_list), odd

    schema = "number int, place long, key string, list boolean, odd boolean"
    found = _over_ranges(spark, path, known, opened, schema).collect()
    openings = sorted((r for r in found if r.place >= 0), key=lambda r: r.place)
    places = [r.place for r in openings]
    odd = {i for i, r in enumerate(openings) if r.odd}
    for r in found:
        if r.place < 0 and r.odd:
            # Of the value that was open where the range begins.
            odd.add(int(np.searchsorted(places, known[r.number].start, "left")) - 1)
    names = {i: r.key for i, r in enumerate(openings) if r.list and i not in odd}
    numbers = {name: n for n, name in enumerate(dict.fromkeys(names.values()))}
    listed = {i: numbers[name] for i, name in names.items()}

    def cut(file: _File, own: Range) -> Iterator[tuple]:
        for inside, text in _objects(file, own, places):
            if inside in listed:
                # Line ends are blanks: inside strings JSON has none.
                line = text.replace(b"\r", b" ").replace(b"\n", b" ")
                yield listed[inside], line.decode()

    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/document-{uuid.uuid4().hex}"
    lines = _over_ranges(spark, path, known, cut, "number int, value string")
    lines.write.partitionBy("number").text(folder)
    written = {r[0] for r in spark.read.text(folder).select("number").distinct().collect()} if listed else set()
    return {
        name: spark.read.json(f"{folder}/number={n}") for name, n in numbers.items() if n in written
    }
