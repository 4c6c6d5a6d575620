"""Aligning the tokens of two tokenizers by coalescing their byte ranges.

Both tokenizers cut the same bytes. All tokens of A and B are sorted by start, the largest
end so far is carried along, and a group breaks where a start reaches it: there tokens of
both end. Inside a group the overlaps are expanded to links. That is done in numpy, on
the documents of a batch at once, next to the tokenizers.

How many documents link a pair of ids is a count over the corpus. Each document keeps its
distinct pairs; partitions count theirs before the shuffle. Pairs follow a power law, so the
frequent ones, at most ``FREQUENT``, are broadcast and looked up in place, and only documents'
other pairs are shuffled, none of which is in many documents.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewinnow.llm.common import cells, materialise, read

# Pairs that are broadcast, 17 bytes each.
FREQUENT = 1 << 20
# Characters whose tokens are aligned at once, but for a single longer text.
CHUNK = 1_000_000
# Pairs counted at once in a partition.
COUNTED = 1 << 22

# Where both libraries for A were found to cut every text alike.
_COMMON = re.compile("[\x00-ɏ‐-›€]*")
_TOKENS = (
    "part int, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, codes binary, times binary"
)
_DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"


@dataclass(frozen=True)
class Vocabularies:
    """Files of the tokenizers: A as ``tokenizers`` reads it and as ranks, B as a piece model."""

    a: str
    a_ranks: str
    b: str


def vocabularies() -> Vocabularies:
    import public_tokenizers as given

    return Vocabularies(
        given.path("byte_bpe_50k.json"),
        given.path("byte_bpe_50k.tiktoken"),
        given.path("piece_bpe_32k.model"),
    )


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable bytes stand for
    themselves, the others are numbered from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers and, per id, the bytes of its token."""

    def __init__(self, files: Vocabularies):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self._exact = Tokenizer.from_file(files.a)
        self._exact.encode_special_tokens = True
        with open(files.a_ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding(
            "a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=files.b)

        byte_of = _byte_of()
        entries = self._exact.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            known = all(c in byte_of for c in entry)
            self.a_bytes[i] = bytes(byte_of[c] for c in entry) if known else entry.encode()
        self.b_bytes = [self._piece(i) for i in range(self._pieces.get_piece_size())]
        self.a_size, self.b_size = len(self.a_bytes), len(self.b_bytes)
        # Codes of pairs: a * size of B + b.
        self.code = "<u4" if self.a_size * self.b_size <= 1 << 32 else "<u8"
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        # Ids in decimal with what may follow them, as fixed-width bytes.
        most = max(self.a_size, self.b_size)
        self.written = np.array(
            [f"{i}{mark}".encode() for mark in (",", "|", ";", "") for i in range(most)]
        ).reshape(4, most)

    def _piece(self, i: int) -> bytes:
        piece = self._pieces.id_to_piece(i)
        if self._pieces.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def a_ids(self, text: str) -> list[int]:
        if _COMMON.fullmatch(text):
            return self._fast.encode_ordinary(" " + text)
        return self._exact.encode(" " + text, add_special_tokens=False).ids

    def both(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of A and B for each text, empty where their bytes are not the text's."""
        for text, b in zip(texts, self._pieces.encode(texts, num_threads=1), strict=True):
            a, own = self.a_ids(text) if text else [], b" " + text.encode()
            same = (
                text
                and b"".join([self.a_bytes[i] for i in a]) == own
                and b"".join([self.b_bytes[i] for i in b]) == own
            )
            yield (a, b) if same else ([], [])


@functools.cache
def tokenizers(files: Vocabularies) -> Tokenizers:
    return Tokenizers(files)


@dataclass
class Aligned:
    """Of each document: tokens, groups, links, digest of the groups, and its distinct
    pairs as a * size of B + b with the number of links of each."""

    n_a: list[int]
    n_b: list[int]
    n_groups: list[int]
    n_links: list[int]
    digests: list[str]
    codes: list[np.ndarray]
    times: list[np.ndarray]


def align(both: list[tuple[list[int], list[int]]], known: Tokenizers) -> Aligned:
    """Interval coalescing over the tokens of several documents laid end to end."""
    n = len(both)
    n_a = np.array([len(a) for a, _ in both], np.int64)
    n_b = np.array([len(b) for _, b in both], np.int64)
    a = np.fromiter((i for ids, _ in both for i in ids), np.int64, n_a.sum())
    b = np.fromiter((i for _, ids in both for i in ids), np.int64, n_b.sum())
    a_end, b_end = np.cumsum(known.a_length[a]), np.cumsum(known.b_length[b])
    a_start, b_start = a_end - known.a_length[a], b_end - known.b_length[b]

    # Coalesce: sort by start, carry the largest end, break where a start reaches it.
    starts, ends = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    of_b = np.repeat([0, 1], [len(a), len(b)])
    order = np.lexsort((of_b, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    a_group, b_group = group[: len(a)], group[len(a) :]
    groups = int(breaks.sum())
    a_in, b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    a_first, b_first = np.cumsum(a_in) - a_in, np.cumsum(b_in) - b_in

    # Expand: all of a group with one token on a side, else where the ranges overlap.
    low, high = b_first[a_group], (b_first + b_in)[a_group]
    mixed = np.flatnonzero((a_in[a_group] > 1) & (b_in[a_group] > 1))
    low[mixed] = np.searchsorted(b_end, a_start[mixed], "right")
    high[mixed] = np.searchsorted(b_start, a_end[mixed], "left")
    own = high - low
    before = np.cumsum(own) - own
    linked_a = np.repeat(np.arange(len(a)), own)
    linked_b = np.arange(len(linked_a)) + np.repeat(low - before, own)
    a_doc = np.repeat(np.arange(n), n_a)
    doc = a_doc[linked_a]
    pairs = known.a_size * known.b_size
    keys = np.sort(doc * pairs + a[linked_a] * known.b_size + b[linked_b])
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    times = np.diff(new, append=len(keys))
    key_doc = keys[new] // pairs
    bounds = np.searchsorted(key_doc, np.arange(n + 1))
    codes = keys[new] - key_doc * pairs

    # Write the groups: all of A's ids, then all of B's, group after group.
    at_a = np.arange(len(a)) + b_first[a_group]
    at_b = np.arange(len(b)) + (a_first + a_in)[b_group]
    text = np.empty(len(a) + len(b), known.written.dtype)
    last_a = (a_first + a_in - 1)[a_group] == np.arange(len(a))
    last_b = np.where((b_first + b_in - 1)[b_group] == np.arange(len(b)), 2, 0)
    doc_end_b = np.cumsum(n_b)[n_b > 0] - 1
    last_b[doc_end_b] = 3
    text[at_a] = known.written[last_a.astype(np.int64), a]
    text[at_b] = known.written[last_b, b]
    cuts = np.concatenate([[0], np.cumsum(n_a + n_b)])
    digests = [
        hashlib.sha256(text[i:j].tobytes().translate(None, b"\0")).hexdigest() if j > i else ""
        for i, j in zip(cuts[:-1], cuts[1:])
    ]
    group_doc = a_doc[a_first] if groups else a_doc[:0]
    return Aligned(
        n_a.tolist(),
        n_b.tolist(),
        np.bincount(group_doc, minlength=n).tolist(),
        np.bincount(doc, minlength=n).tolist(),
        digests,
        [codes[i:j] for i, j in zip(bounds[:-1], bounds[1:])],
        [times[i:j] for i, j in zip(bounds[:-1], bounds[1:])],
    )


def _chunks(docs: Iterable[tuple], size: int) -> Iterator[list[tuple]]:
    """Rows of (doc_id, text) in lists of about ``size`` characters."""
    chunk, held = [], 0
    for row in docs:
        chunk.append(row)
        held += len(row[1])
        if held >= size:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def _narrowest(values: np.ndarray) -> bytes:
    """``values`` in the narrowest unsigned type that holds them."""
    most = int(values.max(initial=0))
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if most <= np.iinfo(k).max)
    return values.astype(kind).tobytes()


def _pairs(codes: bytes, times: bytes, code: str) -> tuple[np.ndarray, np.ndarray]:
    """A document's distinct pairs and how often it links each."""
    found = np.frombuffer(codes, code).astype(np.int64)
    width = len(times) // len(found) if len(found) else 1
    return found, np.frombuffer(times, f"<u{width}").astype(np.int64)


def tokens_of(docs: DataFrame, files: Vocabularies) -> DataFrame:
    """One row per document: its key, counts, digest, and distinct pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, row = tokenizers(files), TaskContext.get().partitionId(), 0
        rows = (
            (doc_id, text or "")
            for columns in cells(batches, ("doc_id", "text"))
            for doc_id, text in zip(*columns, strict=True)
        )
        for chunk in _chunks(rows, CHUNK):
            found = align(list(known.both([text for _, text in chunk])), known)
            n = len(chunk)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * n, pa.int32()),
                    pa.array(range(row, row + n), pa.int64()),
                    pa.array([doc_id for doc_id, _ in chunk], pa.int64()),
                    *(
                        pa.array(c, pa.int64())
                        for c in (found.n_a, found.n_b, found.n_groups, found.n_links)
                    ),
                    pa.array(found.digests, pa.string()),
                    pa.array([c.astype(known.code).tobytes() for c in found.codes], pa.binary()),
                    pa.array([_narrowest(t) for t in found.times], pa.binary()),
                ],
                [c.split()[0] for c in _TOKENS.split(", ")],
            )
            row += n

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, _TOKENS
    )


def pair_counts(tokens: DataFrame, known: Tokenizers) -> DataFrame:
    """code, documents (that link the pair), best (whether no pair of its A id is in more)."""
    kind = known.code

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> pa.RecordBatch:
            codes, documents = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(codes.astype(np.int64)), pa.array(documents.astype(np.int64))],
                ["code", "documents"],
            )

        held: list[np.ndarray] = []
        for (codes,) in cells(batches, ("codes",)):
            held += [np.frombuffer(c, kind) for c in codes]
            if sum(map(len, held)) >= COUNTED:
                yield counted()
                held = []
        if held:
            yield counted()

    counts = materialise(
        tokens.select("codes")
        .mapInArrow(count, "code long, documents long")
        .groupBy("code")
        .agg(F.sum("documents").alias("documents"))
        .withColumn("a", F.floor(F.col("code") / F.lit(known.b_size)).cast("long"))
    )
    # One row per id of A: no more than its vocabulary has.
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return counts.join(F.broadcast(most), "a").select(
        "code", "documents", (F.col("documents") == F.col("most")).alias("best")
    )


def least_frequent(pairs: DataFrame, limit: int) -> int | None:
    """The least count, a power of two, that at most ``limit`` pairs reach; None if more
    pairs than that have a count as large as any, within a factor of two."""
    sizes = pairs.groupBy(F.floor(F.log2("documents")).alias("size")).count().collect()
    reached, least = 0, None
    for size, count in sorted(((r["size"], r["count"]) for r in sizes), reverse=True):
        reached += count
        if reached > limit:
            return least
        least = 1 << size
    return least if sizes else 1


def align_documents(
    docs: DataFrame, files: Vocabularies, frequent: int = FREQUENT
) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair no other
    pair of the same A id exceeds in documents), count_sum (documents of the pair, over
    links), groups_sha256.

    Null and empty texts, and texts whose tokens do not spell them, have zeros and ''. Every
    row is a document of its own, also where doc_id repeats or is null: it has a row, and it
    counts in the corpus. Ties for the highest count are all best. An empty table gives no
    rows. Other columns are not read, whatever their names. A chunk of texts takes about a
    hundred bytes of memory a character; a text longer than a chunk is a chunk by itself.
    """
    known = tokenizers(files)
    tokens = materialise(tokens_of(docs, files))
    pairs = pair_counts(tokens, known)
    least = least_frequent(pairs, frequent)
    if least is None:
        top = pairs.limit(0).toArrow()
    else:
        top = pairs.where(F.col("documents") >= least).orderBy("code").toArrow()
    table = tokens.sparkSession.sparkContext.broadcast(
        tuple(top.column(c).to_numpy() for c in ("code", "documents", "best"))
    )
    kind = known.code

    def find(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the codes are in the broadcast table, and whether they are."""
        listed = table.value[0]
        if not len(listed):
            return np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
        at = np.minimum(np.searchsorted(listed, codes), len(listed) - 1)
        return at, listed[at] == codes

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, total = [], []
            for codes, times in cells([batch], ("codes", "times")):
                for own, often in map(lambda c, t: _pairs(c, t, kind), codes, times):
                    at, there = find(own)
                    at, often = at[there], often[there]
                    best.append(int(often[table.value[2][at]].sum()) if len(at) else 0)
                    total.append(int((often * table.value[1][at]).sum()) if len(at) else 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(best, pa.int64()), pa.array(total, pa.int64())],
                [*batch.schema.names[:-2], "n_best", "count_sum"],
            )

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, rows, codes, times in cells(batches, ("part", "row", "codes", "times")):
            for part, row, c, t in zip(parts, rows, codes, times, strict=True):
                own, often = _pairs(c, t, kind)
                rest = ~find(own)[1]
                n = int(rest.sum())
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part] * n, pa.int32()),
                            pa.array([row] * n, pa.int64()),
                            pa.array(own[rest]),
                            pa.array(often[rest]),
                        ],
                        ["part", "row", "code", "times"],
                    )

    shown = [c.split()[0] for c in _DIGEST.split(", ")] + ["groups_sha256"]
    scored = tokens.mapInArrow(
        score,
        "part int, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, n_best long, count_sum long",
    )
    if least == 1:
        return scored.select(*shown)
    rare = pairs if least is None else pairs.where(F.col("documents") < least)
    added = (
        tokens.select("part", "row", "codes", "times")
        .mapInArrow(others, "part int, row long, code long, times long")
        .join(rare.hint("merge"), "code")
        .groupBy("part", "row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("documents")).alias("more_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return (
        scored.join(added, ["part", "row"], "left")
        .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", zero))
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", zero))
        .select(*shown)
    )


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read(spark, sf_dir, "documents"), vocabularies())
