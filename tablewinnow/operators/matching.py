"""Joins of a large table with a key set of unknown size.

Every prune and access operator comes down to one of three questions about the
rows of a large table: which match a key set (semi), which do not (anti), and
which marks does a row's key carry (left outer). The key set comes out of data,
so nothing is assumed about its size. It is computed once, kept in the shared
checkpoint folder and measured:

* within the limit it is broadcast, and the large table is streamed past it
  without a shuffle;
* beyond it, ids that lie close together are broadcast as bitmaps, one bit each, if those are
  within the limit: a semi or anti join looks up its row's bit, again without a shuffle;
* beyond that, both sides are shuffled by key, once, or not at all where they are
  bucketed by it. Adaptive execution splits large partitions of the streamed side,
  those of hot keys and of rows without a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewinnow.settings import broadcast_limit, materialise

ROW_OVERHEAD = 32
FIXED_WIDTH = 16
# Bytes of a bitmap's row, which stands for 32,768 ids.
BITMAP_BYTES = 4256

_BUCKET = "_tw_bucket"
_POSITION = "_tw_position"
_BITS = "_tw_bits"
_IDS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _width(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + FIXED_WIDTH
    if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, _IDS):
        return F.coalesce(F.size(column), F.lit(0)) * 8 + FIXED_WIDTH
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        text = F.to_json(F.struct(column))
        return F.coalesce(F.octet_length(text), F.lit(0)) + FIXED_WIDTH
    return F.lit(FIXED_WIDTH)


def row_bytes(df: DataFrame) -> Column:
    """In-memory size of a row of ``df``."""
    total = F.lit(ROW_OVERHEAD)
    for field in df.schema.fields:
        total = total + _width(field)
    return total.cast("long")


class KeySet:
    """Keys, or marks by key, computed once and measured in the same pass.

    What is broadcast is exactly what was measured, and using the set for several
    tables computes it once. A task that runs twice can only make the set look
    larger than it is.
    """

    def __init__(self, df: DataFrame):
        observation = Observation()
        sums = [F.sum(row_bytes(df)).alias("bytes"), F.count(F.lit(1)).alias("rows")]
        # The only column, if it holds ids.
        self.ids = df.columns[0] if len(df.columns) == 1 and _holds_ids(df, *df.columns) else None
        if self.ids:
            sums.append(F.approx_count_distinct(_bucket(self.ids)).alias("buckets"))
        self.frame = materialise(df.observe(observation, *sums))
        self.size = observation.get["bytes"] or 0
        self.rows = observation.get["rows"]
        self.buckets = observation.get.get("buckets", 0)

    @property
    def empty(self) -> bool:
        return self.size == 0

    @property
    def small(self) -> bool:
        return self.size <= broadcast_limit(self.frame.sparkSession)

    @property
    def bitmap(self) -> KeySet | None:
        """The ids as bits, one row for 32,768 of them; None where the keys are no ids, or
        where the rows of bits would not be small either."""
        limit = broadcast_limit(self.frame.sparkSession)
        # The count of rows is an estimate; what is broadcast is measured.
        if not self.ids or self.buckets * BITMAP_BYTES > 1.2 * limit:
            return None
        return self._bitmap if self._bitmap.small else None

    @cached_property
    def _bitmap(self) -> KeySet:
        """Ids are brought together first: a task that has few of each bucket's ids would
        otherwise pass on a whole bitmap for each."""
        places = self.frame.select(
            _bucket(self.ids).alias(_BUCKET), _position(self.ids).alias(_POSITION)
        )
        bits = F.bitmap_construct_agg(F.col(_POSITION)).alias(_BITS)
        rows = places.dropna().repartition(_BUCKET).groupBy(_BUCKET).agg(bits)
        words = F.transform(
            F.sequence(F.lit(0), F.lit(511)),
            lambda i: F.conv(F.hex(F.substring(_BITS, i * 8 + 1, F.lit(8))), 16, -10).cast("long"),
        )
        return KeySet(rows.select(_BUCKET, words.alias(_BITS)))

    def _as(self, frame: DataFrame) -> KeySet:
        """The same rows in another shape, neither recomputed nor remeasured."""
        other = KeySet.__new__(KeySet)
        other.frame = frame
        other.size, other.rows = self.size, self.rows
        other.buckets, other.ids = self.buckets, None
        return other

    def renamed(self, old: str, new: str) -> KeySet:
        other = self._as(self.frame.withColumnRenamed(old, new))
        other.ids = new if self.ids == old else None
        return other

    def flagged(self, flag: str) -> KeySet:
        return self._as(self.frame.withColumn(flag, F.lit(True)))


def _holds_ids(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, _IDS)


def _bucket(column: str) -> Column:
    return F.bitmap_bucket_number(F.col(f"`{column}`").cast("long"))


def _position(column: str) -> Column:
    return F.bitmap_bit_position(F.col(f"`{column}`").cast("long"))


def _flag_by_bit(df: DataFrame, bitmap: KeySet, on: str, flag: str) -> DataFrame:
    """``df`` with a column that tells whether a row's id has its bit set."""
    place = _position(on)
    word = F.get(F.col(_BITS), F.shiftright(place, 6).cast("int"))
    # Eight bytes make a word, the first of them its highest.
    byte = F.shiftright(place, 3).bitwiseAND(F.lit(7))
    shift = ((7 - byte) * 8 + place.bitwiseAND(F.lit(7))).cast("int")
    found = F.coalesce(F.getbit(word, shift) == 1, F.lit(False))
    marked = df.withColumn(_BUCKET, _bucket(on)).join(F.broadcast(bitmap.frame), _BUCKET, "left")
    return marked.select(*df.columns, found.alias(flag))


def _bits_for(df: DataFrame, keys: KeySet, on: Sequence[str]) -> KeySet | None:
    """The bitmap to look rows of ``df`` up in, if there is one."""
    fits = len(on) == 1 and keys.ids == on[0] and _holds_ids(df, on[0])
    return keys.bitmap if fits and not keys.small else None


def key_set(df: DataFrame, *on: str) -> KeySet:
    """The distinct non-null keys of ``df``."""
    return KeySet(df.select(*on).dropna().distinct())


def _join(left: DataFrame, keys: KeySet, on: Sequence[str], how: str) -> DataFrame:
    on = list(on)
    right = keys.frame
    added = [c for c in right.columns if c not in on] if how == "left" else []
    columns = [*left.columns, *added]
    if keys.small:
        return left.join(F.broadcast(right), on, how).select(*columns)

    if how != "left":
        bits = _bits_for(left, keys, on)
        if bits is not None:
            marked = _flag_by_bit(left, bits, on[0], _POSITION)
            wanted = F.col(_POSITION) if how == "left_semi" else ~F.col(_POSITION)
            return marked.filter(wanted).select(*columns)
        right = right.select(*on).distinct()
    # Measured to be large, so an estimate must not make it a broadcast after all.
    return left.join(right.hint("merge"), on, how).select(*columns)


def _settled(keys: DataFrame | KeySet, on: Sequence[str]) -> KeySet:
    return keys if isinstance(keys, KeySet) else key_set(keys, *on)


def keep_matching(
    df: DataFrame, keys: DataFrame | KeySet, on: str | Sequence[str]
) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``; rows keep their multiplicity."""
    on = [on] if isinstance(on, str) else list(on)
    return _join(df, _settled(keys, on), on, "left_semi")


def drop_matching(
    df: DataFrame, keys: DataFrame | KeySet, on: str | Sequence[str]
) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys``. A null key, on either side,
    matches nothing, so such rows stay."""
    on = [on] if isinstance(on, str) else list(on)
    return _join(df, _settled(keys, on), on, "left_anti")


def attach(
    df: DataFrame,
    marks: KeySet,
    on: str | Sequence[str],
) -> DataFrame:
    """Add the columns of ``marks`` to the rows of ``df``, null where the key has
    none. ``marks`` must hold one row per key: rows of ``df`` are not repeated."""
    return _join(df, marks, [on] if isinstance(on, str) else on, "left")


def flag_matching(df: DataFrame, keys: DataFrame | KeySet, on: str, flag: str) -> DataFrame:
    """All rows of ``df`` with a boolean column telling whether their key is in
    ``keys``. A ``KeySet`` passed here must hold each key once."""
    settled = _settled(keys, [on])
    bits = _bits_for(df, settled, [on])
    if bits is not None:
        return _flag_by_bit(df, bits, on, flag)
    marked = attach(df, settled.flagged(flag), on)
    return marked.withColumn(flag, F.col(flag).isNotNull())
