"""Finding periodic runs of words: tiles per octave of periods, solved apart and stitched.

A run is a stretch of words with a smallest period q that is as long as it can be, at least
``max(12, 2q)`` words. Periods are taken by octaves, from 2^k to 2^(k+1) - 1. In an octave every
2^k-th word is a boundary; a run of one of its periods q has a boundary within its first q
words, and around a boundary c it reaches as far forwards as the words from c and from c + q
agree (a Z-function of the words from c), and as far backwards as those before c and c + q do
(a Z-function of their mirror image). Tiles of neighbouring boundaries overlap by more than
two periods, so fragments of one run overlap by a period or more, and those of different runs
do not: that is how they are told apart when they are stitched.

A document becomes rows of tiles, a section each: boundaries of small octaves travel together,
longer octaves have sections of their own. Sections are dealt over all tasks, solved there, and
the fragments are shuffled by document and period. Only documents in which six words in a
row come twice are cut into tiles: no other can have a run.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewinnow.llm.common import cells, materialise, read

LEAST = 12
# A run of LEAST words or more repeats at least this many words in a row.
REPEATED = LEAST // 2
# Words whose boundaries travel together, and how long a longer octave's sections are in
# its shortest periods.
SECTION = 1 << 16
SPREAD = 8
# Words that are solved at once, but for a single longer section.
SOLVED = 1 << 18


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, with the repetition that the contract writes into every tenth document by
    the hash of its id. A null id has none."""
    n = len(words)
    hashed = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if hashed % 10 or not n:
        return words
    g = hashed // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    repeated = words[a : a + p]
    return words[:a] + (repeated * -(-(n - a) // p))[: n - a]


def _numbers(words: list[bytes]) -> np.ndarray:
    """The same number for the same word, from 0 on."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int32)


def _repeats(numbers: np.ndarray, length: int = REPEATED) -> bool:
    """Whether some ``length`` words in a row may come twice: never wrong where it says no."""
    n = len(numbers) - length + 1
    if n < 2:
        return False
    mixed = np.zeros(n, np.uint64)
    for i in range(length):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + numbers[i : i + n].astype(np.uint64)
        mixed ^= mixed >> np.uint64(29)
    mixed.sort()
    return bool((mixed[1:] == mixed[:-1]).any())


def sections(n: int, section: int = SECTION) -> Iterator[tuple[int, int, int, int]]:
    """(first octave, last octave, start, end) of the sections of a document of n words. In
    an octave neighbouring sections overlap by three of its longest periods."""
    octaves = (n // 2).bit_length()  # the longest period is n // 2
    together = max(1, (section // SPREAD).bit_length())
    for first, last in [(0, together), *((k, k + 1) for k in range(together, octaves))]:
        last = min(last, octaves)
        core = max(section, SPREAD << (last - 1)) if last else 0
        overlap = 3 << last
        for start in range(0, n if first < last else 0, max(core, 1)):
            if start == 0 or start + (2 << first) <= n:
                yield first, last - 1, start, min(n, start + core + overlap)


# ---- solving ------------------------------------------------------------------------


@functools.lru_cache(maxsize=4)
def _least_factors(size: int) -> np.ndarray:
    """The least prime factor of every number below ``size``, a power of two."""
    factors = np.arange(size)
    for i in range(2, int(size**0.5) + 1):
        if factors[i] == i:
            rest = factors[i * i :: i]
            rest[rest == np.arange(i * i, size, i)] = i
    return factors


class Blocks:
    """Names of the blocks of 2^j words: equal names, equal words. The Z-functions of all
    boundaries are read off them, longest blocks first."""

    def __init__(self, numbers: np.ndarray):
        self.n = len(numbers)
        self.names = [numbers]

    def reach(self, level: int) -> None:
        """Name blocks up to 2^level words; a block that would leave the text has a name of
        its own."""
        while len(self.names) <= level:
            half = 1 << (len(self.names) - 1)
            below = self.names[-1]
            names = -1 - np.arange(self.n, dtype=np.int64)
            if self.n > half:
                pairs = below[:-half].astype(np.int64) * (self.n + 1) + below[half:]
                whole = (below[:-half] >= 0) & (below[half:] >= 0)
                at = np.flatnonzero(whole)
                names[at] = np.unique(pairs[at], return_inverse=True)[1]
            self.names.append(names)

    def same(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the blocks from i and from j agree; not where one leaves the text."""
        names, last = self.names[level], self.n - (1 << level)
        inside = (i >= 0) & (j >= 0) & (i <= last) & (j <= last)
        i, j = np.where(inside, i, 0), np.where(inside, j, 0)
        return inside & (names[i] == names[j]) & (names[i] >= 0)

    def forwards(self, i: np.ndarray, j: np.ndarray, level: int) -> np.ndarray:
        """How many words from i and from j on agree, up to 2^(level + 1) - 1."""
        length = np.zeros(len(i), np.int64)
        for up in range(level, -1, -1):
            length += self.same(up, i + length, j + length).astype(np.int64) << up
        return length

    def backwards(self, i: np.ndarray, j: np.ndarray, level: int) -> np.ndarray:
        """How many words before i and before j agree."""
        length = np.zeros(len(i), np.int64)
        for up in range(level, -1, -1):
            size = 1 << up
            length += self.same(up, i - length - size, j - length - size).astype(np.int64) << up
        return length


def stitch(keys: np.ndarray, period: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Fragments of equal key and period that overlap by a period or more, made one."""
    order = np.lexsort((start, period, keys))
    keys, period, start, end = keys[order], period[order], start[order], end[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (period[1:] != period[:-1])
    # The largest end so far, within a key and period.
    lift = (np.cumsum(fresh) - 1) * (int(end.max(initial=0)) + 1)
    reached = np.maximum.accumulate(end + lift) - lift
    fresh[1:] |= start[1:] + period[1:] > reached[:-1]
    first = np.flatnonzero(fresh)
    ends = np.maximum.reduceat(end, first) if len(first) else end
    return keys[first], period[first], start[first], ends


def solve(texts: list[np.ndarray], octaves: list[tuple[int, int]]):
    """Fragments of runs in several sections: (section, period, start, end), of at least two
    periods, each with its smallest period. Sections are laid end to end, each followed by a
    mark that equals nothing."""
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    most = max((int(t.max(initial=0)) for t in texts), default=0) + 1
    laid = np.empty(int((lengths + 1).sum()), np.int64)
    for i, (text, begin) in enumerate(zip(texts, begins)):
        laid[begin : begin + len(text)] = text
        laid[begin + len(text)] = most + i
    blocks = Blocks(np.unique(laid, return_inverse=True)[1].astype(np.int64))
    found: list[tuple[np.ndarray, ...]] = []
    for k in range(max((last for _, last in octaves), default=-1) + 1):
        size = 1 << k
        blocks.reach(k + 1)
        for i, (first, last) in enumerate(octaves):
            if not first <= k <= last or lengths[i] < 2 * size:
                continue
            for c, q in _boundaries(blocks, int(begins[i]), int(lengths[i]), k):
                fragments = _fragments(blocks, c, q, k, int(begins[i]))
                found.append((np.full(len(fragments[0]), i), *fragments))
    if not found:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing
    return stitch(*(np.concatenate(part) for part in zip(*found)))


def _boundaries(blocks: Blocks, begin: int, length: int, k: int):
    """Boundaries c and periods q of octave k that may have a run: its Z-functions sum to q or
    more, so one of them is at least 2^(k-1)."""
    size, half = 1 << k, max(0, k - 1)
    names, step = blocks.names[half], 1 << half
    at_once = max(1, (1 << 20) // size)
    boundaries = np.arange(begin, begin + length - size, size)
    periods = np.arange(size, 2 * size)
    top = len(names) - 1
    for at in range(0, len(boundaries), at_once):
        c = boundaries[at : at + at_once, None]
        ahead = np.minimum(c + periods, top)
        before = np.maximum(c - step, 0)
        maybe = (names[c] == names[ahead]) | (names[before] == names[np.maximum(ahead - step, 0)])
        maybe &= c + periods < begin + length
        row, q = np.nonzero(maybe)
        if len(row):
            yield boundaries[at + row], periods[q]


def _fragments(blocks: Blocks, c: np.ndarray, q: np.ndarray, k: int, begin: int):
    """(period, start, end) in the section of the fragments around c that have period q."""
    start = c - blocks.backwards(c, c + q, k + 1)
    end = c + q + blocks.forwards(c, c + q, k + 1)
    long = end - start >= 2 * q
    c, q, start, end = c[long], q[long], start[long], end[long]
    # A smaller period of two periods' words divides q: try q over each of its prime factors.
    left, right = c - np.maximum(start, c - 2 * q), np.minimum(end, c + 2 * q) - c
    smallest = np.ones(len(q), bool)
    rest, factors = q.copy(), _least_factors(2 << k)
    while (rest > 1).any():
        on = np.flatnonzero((rest > 1) & smallest)
        if not len(on):
            break
        factor = factors[rest[on]]
        p = q[on] // factor
        whole = blocks.forwards(c[on], c[on] + p, k + 1) >= right[on] - p
        whole &= blocks.backwards(c[on], c[on] + p, k + 1) >= left[on]
        smallest[on[whole]] = False
        rest[on] //= factor
    return q[smallest], start[smallest] - begin, end[smallest] - begin


def runs_of(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one text, by the same steps without Spark."""
    n = len(numbers)
    cut = list(sections(n))
    keys, period, start, end = solve([numbers[s:e] for _, _, s, e in cut], [x[:2] for x in cut])
    shift = np.array([s for _, _, s, _ in cut], np.int64)[keys]
    _, period, start, end = stitch(keys * 0, period, start + shift, end + shift)
    long = end - start >= np.maximum(LEAST, 2 * period)
    found = zip(start[long].tolist(), (end - start)[long].tolist(), period[long].tolist())
    return sorted(found)


# ---- on Spark -----------------------------------------------------------------------

_SPLIT = "part int, row long, doc_id long, n long, words binary, digest string"
_SECTIONS = "part int, row long, first int, last int, start long, n long, numbers binary"
_FRAGMENTS = "part int, row long, period long, start long, end long"
_RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, n_words long"
)


def _batch(schema: str, columns: list[list]) -> pa.RecordBatch:
    kinds = {
        "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()
    }
    fields = [field.split() for field in schema.split(", ")]
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _columns(rows: list[tuple], schema: str) -> list[list]:
    return [list(c) for c in zip(*rows)] if rows else [[] for _ in schema.split(", ")]


def split_documents(docs: DataFrame) -> DataFrame:
    """Per document a key of its own, its number of words, and either its words, if it may
    have runs, or the digest of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for doc_ids, texts in cells(batches, ("doc_id", "text")):
            rows = []
            for doc_id, text in zip(doc_ids, texts, strict=True):
                words = planted((text or b"").split(), doc_id)
                joined = b" ".join(words)
                if _repeats(_numbers(words)):
                    rows.append((part, row, doc_id, len(words), joined, None))
                else:
                    digest = hashlib.sha256(joined).hexdigest()
                    rows.append((part, row, doc_id, len(words), None, digest))
                row += 1
            yield _batch(_SPLIT, _columns(rows, _SPLIT))

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("text"),
    ).mapInArrow(run, _SPLIT)


def sections_of(documents: DataFrame, section: int) -> DataFrame:
    """The sections of documents with words, dealt over as many tasks as a shuffle has: they are
    few bytes and much work, so adaptive execution must not join them."""
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, keys, texts in cells(batches, ("part", "row", "words")):
            for part, key, text in zip(parts, keys, texts, strict=True):
                numbers = _numbers(text.split())
                n = len(numbers)
                kind = "<u2" if numbers.max(initial=0) < 1 << 16 else "<i4"
                rows = [
                    (part, key, first, last, start, n, numbers[start:end].astype(kind).tobytes())
                    for first, last, start, end in sections(n, section)
                ]
                for row in rows:
                    yield _batch(_SECTIONS, _columns([row], _SECTIONS))

    return (
        documents.select("part", "row", "words")
        .mapInArrow(run, _SECTIONS)
        .repartition(tasks, "part", "row", "first", "start")
    )


def fragments_of(cut: DataFrame, section: int) -> DataFrame:
    """Fragments of runs; those that neither are long enough nor meet an end of their section
    inside the document are no runs and are left out."""

    def solved(held: list[tuple]) -> pa.RecordBatch:
        texts = [numbers for *_, numbers in held]
        keys, period, start, end = solve(texts, [(first, last) for _, _, first, last, *_ in held])
        shift = np.array([h[4] for h in held], np.int64)[keys]
        size = np.array([len(t) for t in texts], np.int64)[keys]
        n = np.array([h[5] for h in held], np.int64)[keys]
        open_ = ((start == 0) & (shift > 0)) | ((end == size) & (shift + size < n))
        kept = np.flatnonzero(open_ | (end - start >= LEAST))
        keys, shift = keys[kept], shift[kept]
        part, row = np.array([h[0] for h in held]), np.array([h[1] for h in held])
        return _batch(
            _FRAGMENTS,
            [part[keys], row[keys], period[kept], start[kept] + shift, end[kept] + shift],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = [], 0
        names = [c.split()[0] for c in _SECTIONS.split(", ")]
        for columns in cells(batches, names):
            for *key, start, n, data in zip(*columns, strict=True):
                first, last = key[2], key[3]
                size = next(e - s for f, _, s, e in sections(n, section) if (f, s) == (first, start))
                numbers = np.frombuffer(data, f"<u{len(data) // size}").astype(np.int64)
                held.append((*key, start, n, numbers))
                words += size
                if words >= SOLVED:
                    yield solved(held)
                    held, words = [], 0
        if held:
            yield solved(held)

    return cut.mapInArrow(run, _FRAGMENTS)


def stitched(fragments: DataFrame) -> DataFrame:
    """part, row, runs: per document its runs as (start, period, length), in that order.
    Fragments are stitched by document and period: those of one run overlap by a period."""
    ordered = Window.partitionBy("part", "row", "period").orderBy("start", "end")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    fresh = before.isNull() | (F.col("start") + F.col("period") > before)
    runs = (
        fragments.withColumn("fresh", fresh.cast("int"))
        .withColumn("run", F.sum("fresh").over(ordered))
        .groupBy("part", "row", "period", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .withColumn("length", F.col("end") - F.col("start"))
        .where(F.col("length") >= F.greatest(F.lit(LEAST), 2 * F.col("period")))
    )
    return runs.groupBy("part", "row").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs")
    )


def summary(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """The result's columns after doc_id, from runs (start, period, length) in order."""
    written = "".join(f"{start},{length},{period}\n" for start, period, length in runs)
    top = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
    change = np.zeros(len(words) + 1, np.int64)
    for start, period, length in runs:
        change[start + period] += 1
        change[start + length] -= 1
    dropped = np.cumsum(change[:-1]) > 0
    kept = [w for w, d in zip(words, dropped.tolist()) if not d] if runs else words
    longest = (top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4
    return (
        len(runs),
        *longest,
        hashlib.sha256(written.encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept)).hexdigest(),
        len(words),
    )


def find_runs(docs: DataFrame, section: int = SECTION) -> DataFrame:
    """Per document: doc_id, n_runs, the longest run's start, length, period and
    exponent_milli (null without runs; ties: the smaller start, then period), runs_sha256,
    collapsed_sha256 (the words without the repetitions in runs), n_words.

    Null and empty texts, and texts of blanks, have no words and no runs. Every row is a
    document of its own, also where doc_id repeats or is null; a null id plants nothing. An
    empty table gives no rows. Other columns are not read, whatever their names. A section
    takes a few hundred bytes of memory a word; the sections of the longest periods hold ``SPREAD``
    of those and more, up to a whole document, as its halves have to be compared.
    """
    documents = materialise(split_documents(docs))
    candidates = documents.where(F.col("words").isNotNull())
    runs = stitched(fragments_of(sections_of(candidates, section), section))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts, found in cells(batches, ("doc_id", "words", "runs")):
            rows = []
            for doc_id, text, own in zip(doc_ids, texts, found, strict=True):
                own = [(r["start"], r["period"], r["length"]) for r in own or ()]
                rows.append((doc_id, *summary(text.split(), own)))
            yield _batch(_RESULT, _columns(rows, _RESULT))

    with_words = (
        candidates.select("part", "row", "doc_id", "words")
        .join(runs, ["part", "row"], "left")
        .select("doc_id", "words", "runs")
        .mapInArrow(describe, _RESULT)
    )
    nothing = [F.lit(None).cast("long").alias(c) for c in ("start", "length", "period", "exponent_milli")]
    plain = documents.where(F.col("words").isNull()).select(
        "doc_id",
        F.lit(0).cast("long").alias("n_runs"),
        *nothing,
        F.lit(hashlib.sha256(b"").hexdigest()).alias("runs_sha256"),
        F.col("digest").alias("collapsed_sha256"),
        F.col("n").alias("n_words"),
    )
    return plain.unionByName(with_words)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_runs(read(spark, sf_dir, "documents"))
