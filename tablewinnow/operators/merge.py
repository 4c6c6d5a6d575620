"""Importing metadata: create what is new, update what exists.

An existing row takes each non-null attribute of the source and keeps its own
value otherwise. Source rows with a null key, and repeats of a key beyond the
first, are ignored; of repeated rows the greatest in column order is used, so
that the result does not depend on how the source is partitioned.

Several sources merged in turn give the same as one upsert of all their rows, with the number
of each row's source: an attribute takes the last non-null value, a key is new to the first source
that has it. So the target is read as often for a hundred sources as for one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewinnow.operators.matching import (
    KeySet,
    attach,
    drop_matching,
    flag_matching,
    keep_matching,
    key_set,
)

_SOURCE = "_tw_source"
_PRESENT = "_tw_present"
_NUMBER = "_tw_number"
_ROWS = "_tw_rows"
_SOURCES = "_tw_sources"


def _one_row_per_key(source: DataFrame, key: str) -> KeySet:
    row = F.max_by(F.struct(*source.columns), _order(source, source.columns))
    return KeySet(source.dropna(subset=[key]).groupBy(key).agg(row.alias(_SOURCE)))


def _order(source: DataFrame, columns: Sequence[str]) -> Column:
    """Maps and variants have no order; their text stands for them."""
    kinds = {c: source.schema[c].dataType for c in columns}
    return F.struct(
        *[
            F.to_json(F.struct(c)).alias(c) if _unordered(kind) else F.col(c)
            for c, kind in kinds.items()
        ]
    )


def _unordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_unordered(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def _present(target: DataFrame, keys: KeySet, key: str) -> KeySet:
    """Keys of the source that the target has. The target is only reduced to
    them, so a large target is not shuffled for a small import."""
    return key_set(keep_matching(target.select(key), keys, key), key)


def merge_metadata(target: DataFrame, source: DataFrame, key: str = "id") -> DataFrame:
    """The target after the import. Its columns and their types are kept: columns
    the source lacks keep their value, columns only the source has are left out."""
    shared = [c for c in target.columns if c in source.columns]
    source = source.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in shared])
    rows = _one_row_per_key(source, key)
    updated = attach(target, rows, key).select(
        *[
            F.coalesce(F.col(_SOURCE)[c], F.col(c)).alias(c) if c in shared else F.col(c)
            for c in target.columns
        ]
    )
    created = drop_matching(rows.frame, _present(target, rows, key), key).select(f"{_SOURCE}.*")
    return updated.unionByName(created, allowMissingColumns=True)


def merge_summary(target: DataFrame, source: DataFrame, key: str = "id") -> DataFrame:
    """One row: total, created, updated, deleted and ignored source rows."""
    counts = KeySet(source.groupBy(key).agg(F.count(F.lit(1)).alias("n")))
    marked = flag_matching(counts.frame, _present(target, counts, key), key, _PRESENT)
    has_key = F.col(key).isNotNull()
    repeats = F.when(has_key, F.col("n") - 1).otherwise(F.col("n"))

    def total(column):
        return F.coalesce(F.sum(column), F.lit(0)).cast("long")

    return marked.agg(
        total(F.col("n")).alias("total"),
        F.count_if(has_key & ~F.col(_PRESENT)).alias("created"),
        F.count_if(has_key & F.col(_PRESENT)).alias("updated"),
        F.lit(0).cast("long").alias("deleted"),
        total(repeats).alias("ignored"),
    )


def _numbered(target: DataFrame, sources: Sequence[DataFrame], shared: Sequence[str]) -> DataFrame:
    """The rows of all sources in the target's types, each with the number of its source."""

    def shaped(number: int, source: DataFrame) -> DataFrame:
        columns = [
            (F.col(c) if c in source.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c)
            for c in shared
        ]
        return source.select(F.lit(number).alias(_NUMBER), *columns)

    return reduce(DataFrame.unionAll, [shaped(n, s) for n, s in enumerate(sources)])


def _last_values(rows: DataFrame, key: str, shared: Sequence[str]) -> KeySet:
    """One row per key: the last non-null value of each attribute over the sources, and the
    sources that have the key, with the number of their rows. Rows without a key are counted
    only."""
    per_source = rows.groupBy(key, _NUMBER).agg(
        F.max_by(F.struct(*shared), _order(rows, shared)).alias(_SOURCE),
        F.count(F.lit(1)).alias(_ROWS),
    )

    def last(column: str) -> Column:
        value = F.col(_SOURCE)[column]
        return F.max_by(value, F.when(value.isNotNull(), F.col(_NUMBER))).alias(column)

    per_key = per_source.groupBy(key).agg(
        F.struct(*[last(c) for c in shared]).alias(_SOURCE),
        F.sort_array(F.collect_list(F.struct(_NUMBER, _ROWS))).alias(_SOURCES),
    )
    return KeySet(per_key)


def merge_all(
    target: DataFrame, sources: Sequence[DataFrame], key: str = "id"
) -> tuple[DataFrame, list[dict[str, int]]]:
    """The target after importing the sources in turn, and what each import did, as
    ``merge_summary`` tells it. The target is read once for its keys and once for the result."""
    shared = [c for c in target.columns if any(c in s.columns for s in sources)]
    rows = _last_values(_numbered(target, sources, shared), key, shared)
    present = _present(target, rows, key)
    updated = attach(target, rows, key).select(
        *[
            F.coalesce(F.col(_SOURCE)[c], F.col(c)).alias(c) if c in shared else F.col(c)
            for c in target.columns
        ]
    )
    new = drop_matching(rows.frame.dropna(subset=[key]), present, key).select(f"{_SOURCE}.*")
    merged = updated.unionByName(new, allowMissingColumns=True)
    return merged, _counts_by_source(rows, present, key, len(sources))


def _counts_by_source(rows: KeySet, present: KeySet, key: str, count: int) -> list[dict[str, int]]:
    marked = flag_matching(rows.frame.select(key, _SOURCES), present, key, _PRESENT)
    each = marked.select(key, _PRESENT, F.posexplode(_SOURCES).alias("place", "source"))
    has_key = F.col(key).isNotNull()
    # The target or an earlier source has the key already.
    known = F.col(_PRESENT) | (F.col("place") > 0)
    n = F.col(f"source.{_ROWS}")
    found = each.groupBy(F.col(f"source.{_NUMBER}").alias("number")).agg(
        F.sum(n).alias("total"),
        F.count_if(has_key & ~known).alias("created"),
        F.count_if(has_key & known).alias("updated"),
        F.sum(F.when(has_key, n - 1).otherwise(n)).alias("ignored"),
    )
    by_number = {row["number"]: row for row in found.collect()}

    def counts(number: int) -> dict[str, int]:
        row = by_number.get(number)
        names = ("total", "created", "updated", "deleted", "ignored")
        return {n: row[n] if row and n != "deleted" else 0 for n in names}

    return [counts(number) for number in range(count)]
