"""What the operators share: reading tables, small sums over partitions, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewinnow.settings import BROADCAST_BYTES, ensure_checkpoint_dir, materialise, setting

__all__ = [
    "WORDS",
    "cells",
    "drawn",
    "ensure_checkpoint_dir",
    "label_table",
    "materialise",
    "measured",
    "prefix_sums",
    "ranked",
    "read",
]

# What counts as a word everywhere in this package: the separators are the ASCII
# blank and the control characters from tab to carriage return, which is also
# what ``bytes.split()`` splits at.
WORDS = r"[^\x20\x09-\x0D]+"

# Rows per Arrow batch, unless the session says otherwise: texts can be long, and
# a Python worker holds a batch or two at a time.
BATCH_ROWS = "1000"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table."""
    bound_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)


def measured(df: DataFrame, width: Column | int = 64) -> DataFrame:
    """``df``, marked for broadcast if its rows take no more bytes than the limit
    for broadcasts. ``df`` should be cheap to read twice."""
    size = df.agg(F.sum(F.lit(width).cast("long") if isinstance(width, int) else width)).first()[0]
    return F.broadcast(df) if (size or 0) <= setting(df.sparkSession, BROADCAST_BYTES) else df


def prefix_sums(totals: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """For each row of ``totals``, the sum of ``value`` over smaller keys. There is
    one row per partition, so the window holds as many rows as there are tasks."""
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(key, F.coalesce(F.sum(value).over(before), F.lit(0)).alias(name))


def ranked(df: DataFrame, order: Column, name: str) -> DataFrame:
    """``df`` with the zero-based rank of each row, without one task sorting all:
    rows are dealt into ranges, ranked inside, and shifted by the rows of the
    ranges before."""
    dealt = materialise(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    shift = prefix_sums(dealt.groupBy("_range").count(), "_range", "count", "_shift")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return (
        dealt.join(F.broadcast(shift), "_range")
        .withColumn(name, (F.col("_shift") + inside - 1).cast("long"))
        .drop("_range", "_shift")
    )


def label_table(labels: DataFrame) -> DataFrame:
    """One row per labelled document: repeated labels count by their largest value."""
    return (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    )


def cells(batches: Iterator[pa.RecordBatch], columns: Iterable[str]) -> Iterator[tuple[list, ...]]:
    """The named columns of each non-empty batch as lists; text comes as it is."""
    names = list(columns)
    for batch in batches:
        if batch.num_rows:
            yield tuple(batch.column(name).to_pylist() for name in names)


# ---- bounded samples of distinct values ---------------------------------------------

_DRAWN = "kind string, value string, level int, floor int, low long, high long"


class _Levels:
    """Of each kind the distinct values of the highest levels, so many at most, with the least and
    the greatest context each was met in. A value's level is the number of zero bits its hash
    ends in: half of all values reach each further level, and which they are depends on the
    values alone."""

    def __init__(self, most: int):
        self.most = most
        self.held: dict[str, dict[str, list[int]]] = {}
        self.floor: dict[str, int] = {}

    def add(self, kind: str, value: str, context: int) -> None:
        own = self.held.setdefault(kind, {})
        known = own.get(value)
        if known:
            known[1] = min(known[1], context)
            known[2] = max(known[2], context)
            return
        hashed = xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"))
        level = (hashed & -hashed).bit_length() - 1 if hashed else 64
        if level < self.floor.get(kind, 0):
            return
        own[value] = [level, context, context]
        while len(own) > self.most:
            self.floor[kind] = self.floor.get(kind, 0) + 1
            own = {v: known for v, known in own.items() if known[0] >= self.floor[kind]}
            self.held[kind] = own

    def rows(self) -> Iterator[tuple]:
        for kind, own in self.held.items():
            for value, (level, low, high) in own.items():
                yield kind, value, level, self.floor.get(kind, 0), low, high


def drawn(
    texts: DataFrame, found: Callable[[str], Iterable[tuple[str, str, int]]], most: int
) -> dict[str, dict[str, bool]]:
    """Of the (kind, value, context) found in all ``texts`` (text), distinct values of each
    kind, in order, and whether they were met in more than one context: all values, or a sample
    by their hash of at most ``most`` and, where there are many, about half of that or more.

    Every text is searched. A task keeps and sends at most ``most`` values of a kind, and no more
    reach the driver. Which values are drawn depends neither on ids nor on how often a value
    occurs, nor on partitions. There should be few kinds. Null texts have nothing.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Levels(most)
        for (own,) in cells(batches, ("text",)):
            for text in own:
                for kind, value, context in found(text) if text else ():
                    kept.add(kind, value, context)
        rows = list(kept.rows())
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        names = [c.split()[0] for c in _DRAWN.split(", ")]
        for at in range(0, len(rows), 1000):
            columns = zip(*rows[at : at + 1000])
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = materialise(texts.select("text").mapInArrow(search, _DRAWN))
    floors = {r.kind: r.floor for r in rows.groupBy("kind").agg(F.max("floor").alias("floor")).collect()}
    # From the highest floor of any task on nothing is missing.
    values = rows.groupBy("kind", "value").agg(
        F.first("level").alias("level"), (F.min("low") < F.max("high")).alias("several")
    )
    counts = values.groupBy("kind", "level").count().collect()
    chosen = F.lit(False)
    for kind, floor in floors.items():
        levels = {r["level"]: r["count"] for r in counts if r["kind"] == kind and r["level"] >= floor}
        while sum(levels.values()) > most:
            levels.pop(floor, None)
            floor += 1
        chosen = chosen | ((F.col("kind") == kind) & (F.col("level") >= floor))
    sample: dict[str, dict[str, bool]] = {}
    for row in sorted(values.where(chosen).collect(), key=lambda r: r["value"]):
        sample.setdefault(row["kind"], {})[row["value"]] = row["several"]
    return sample
