"""Packing documents into sequences of fixed length: concatenate and cut.

Tokens of all documents form one long stream. A first pass tokenizes each partition
and keeps, next to the ids, where a document starts inside its partition. Prefix sums
over the partitions' totals, one row per partition, turn that into its place in the
whole stream, and a second pass cuts each document where the stream crosses a multiple
of the sequence length. No document is moved, so no key can be hot; the only padding
is after the last token.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewinnow.llm.common import materialise, prefix_sums, read

SEQUENCE = 1024
END_ID = 0
SPECIAL = {"<|endoftext|>": 50256}

# Where both libraries were found to cut every text alike; other texts go through the
# slower one (see ``token_ids``).
_COMMON = re.compile("[\x00-\u024f\u2010-\u203a\u20ac]*")


def vocabulary_paths() -> tuple[str, str]:
    """The tokenizer's file and the same vocabulary as ranks."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _ranks(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
    )


def token_ids(text: str, paths: tuple[str, str]) -> np.ndarray:
    """The ids ``tokenizers`` gives with ``add_special_tokens=False``.

    ``tiktoken`` gives the same ids from the same vocabulary in a fifth of the time and
    takes the texts whose characters are in blocks where that was tested exhaustively.
    """
    tokenizer, ranks = paths
    if ranks and _COMMON.fullmatch(text):
        if any(special in text for special in SPECIAL):
            return np.array(_ranks(ranks).encode(text, allowed_special="all"), np.uint32)
        return np.array(_ranks(ranks).encode_ordinary(text), np.uint32)
    return np.array(_tokenizer(tokenizer).encode(text, add_special_tokens=False).ids, np.uint32)


def tokenize(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """part, start (tokens before it in its part), doc_id, n, ids (unsigned 16 or 32 bits)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, sizes, ids = [], [], []
            for text in batch.column("text").to_pylist():
                found = np.append(token_ids(text or "", paths), np.uint32(END_ID))
                starts.append(start)
                sizes.append(len(found))
                start += len(found)
                ids.append((found.astype("<u2") if found.max() < 65536 else found).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(ids), pa.int32()),
                    pa.array(starts, pa.int64()),
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["part", "start", "doc_id", "n", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        encode, "part int, start long, doc_id long, n long, ids binary"
    )


def pack(docs: DataFrame, paths: tuple[str, str], length: int = SEQUENCE) -> DataFrame:
    """Pieces of documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``start`` counts the document's tokens before the piece, ``offset`` the sequence's.
    Null texts count as empty, and an empty text is its end token alone. Every row is a
    document of its own, also where doc_id repeats or is null. Order is that of the input's
    partitions. An empty table gives no rows. Other columns are not read.
    """
    tokens = materialise(tokenize(docs, paths))
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n"))
    before = prefix_sums(totals, "part", "n", "before")
    placed = tokens.join(F.broadcast(before), "part").select(
        (F.col("before") + F.col("start")).alias("place"), "doc_id", "n", "ids"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [], [])
            for place, doc_id, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(place + start, length)
                    size = min(n - start, length - offset)
                    crc = zlib.crc32(found[start : start + size])
                    for out, value in zip(
                        rows, (doc_id, start, size, crc, n, sequence, offset), strict=True
                    ):
                        out.append(value)
                    start += size
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.int64()) for values in rows], list(names)
            )

    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    return placed.mapInArrow(cut, ", ".join(f"`{name}` long" for name in names))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), vocabulary_paths())
