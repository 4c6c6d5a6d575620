"""Mixing sources to target weights by thresholds on a hash.

Every document gets a hash of its id and text. A source that gives a share of its words
gives the documents whose hash is below a threshold. The threshold is found
without sorting: words are summed by source and the hash's top bits, the bucket in
which the sum crosses the budget is the boundary, and only that bucket is summed
again by the next bits, until it holds one hash. Rows that share it, equal in id and text, are
numbered, and the first of them are taken.

Thresholds are nested: a larger budget takes the documents of a smaller one and more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewinnow.llm.common import WORDS, materialise, measured, ranked, read

HASH_BITS = 60
BITS = 10  # of the hash, told apart in one histogram
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3


def row_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of the MD5 of the id's text, a unit separator, and the text; null counts
    as empty."""
    nothing, parts = F.lit(""), (doc_id.cast("string"), F.lit("\x1f"), text.cast("string"))
    digest = F.md5(F.concat(*[F.coalesce(p, nothing) for p in parts]))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def weigh_in_turn(sources: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Sources by code point, null last, with ``weight`` repeating ``weights``."""
    turn = F.col("_rank") % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    ranks = ranked(sources, F.col("source").asc_nulls_last(), "_rank")
    return ranks.withColumn("weight", weight).drop("_rank")


def targets(sources: DataFrame, most: int) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``: all words shared by
    weight, none above ``most`` times its source, what is cut off shared again.

    Each round fixes the sources above their limit; only sums reach the driver."""
    limit, weight = F.col("source_size") * most, F.col("weight")
    level, fixed = 0.0, -1
    while True:
        full = weight * F.lit(level) > limit
        words, given, weights, n = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, weight)), F.lit(0)),
            F.count(F.when(full, 1)),
        ).first()
        if n == fixed or not weights:
            break
        level, fixed = (words - given) / weights, n
    return sources.withColumn(
        "target", F.least(weight * F.lit(float(level)), limit.cast("double"))
    )


def thresholds(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size, target) with ``whole``, the times each document
    is taken, ``below``: documents whose hash is below are taken once more, and ``extra``:
    as many of those that have just this hash are too."""
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    state = sources.withColumn("whole", whole.cast("long")).select(
        "*",
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("bucket"),
        F.lit(0).cast("long").alias("under"),
        F.lit(None).cast("long").alias("below"),
        F.lit(0).cast("long").alias("extra"),
    )
    state = state.withColumn("below", F.when(F.col("budget") <= 0, F.lit(0).cast("long")))
    state = materialise(state)
    for shift in range(HASH_BITS - BITS, -1, -BITS):
        still = state.where(F.col("below").isNull())
        if still.isEmpty():
            break
        state = materialise(_refined(sized, state, shift))
    return state


def _refined(sized: DataFrame, state: DataFrame, shift: int) -> DataFrame:
    """``state`` after the boundary bucket of each open source was summed by further bits."""
    still = state.where(F.col("below").isNull()).select(
        F.col("source").alias("of"), F.col("bucket").alias("within"), "budget", "under"
    )
    bucket = F.shiftright("hash", shift)
    histogram = (
        sized.join(
            _small(still),
            F.col("source").eqNullSafe(F.col("of"))
            & (F.shiftright("hash", shift + BITS) == F.col("within")),
        )
        .groupBy("of", "budget", "under", bucket.alias("next"))
        .agg(
            F.sum("size").alias("words"),
            F.min("hash").alias("low"),
            F.max("hash").alias("high"),
            F.max("size").alias("size"),
        )
    )
    upto = Window.partitionBy("of").orderBy("next")
    crossing = (
        histogram.withColumn("reached", F.col("under") + F.sum("words").over(upto))
        .where(F.col("reached") > F.col("budget"))
        .groupBy("of")
        .agg(F.min_by(F.struct("next", "words", "low", "high", "reached", "size"), "next").alias("at"))
        .select("of", "at.*")
    )
    joined = state.join(crossing, F.col("source").eqNullSafe(F.col("of")), "left")
    start = F.col("reached") - F.col("words")
    # Without a crossing the budget is the whole source, up to rounding.
    none = F.lit(1 << HASH_BITS)
    single = F.col("low") == F.col("high")
    found = F.when(F.col("next").isNull(), none).when(single, F.col("low"))
    # Rows of one hash are of one size; so many of them come nearest to the budget.
    most = F.col("words") / F.col("size")
    nearest = F.ceil((F.col("budget") - start) / F.col("size") - 0.5)
    extra = F.when(single, F.least(F.greatest(nearest, F.lit(0)), most)).cast("long")
    return joined.select(
        "source", "source_size", "target", "whole", "budget",
        F.coalesce("next", "bucket").alias("bucket"),
        F.coalesce(start, "under").cast("long").alias("under"),
        F.coalesce("below", found).alias("below"),
        F.coalesce(extra, "extra").alias("extra"),
    )


def _sized(docs: DataFrame) -> DataFrame:
    return materialise(
        docs.select(
            "doc_id", "source",
            n_words(F.col("text")).alias("size"),
            row_hash(F.col("doc_id"), F.col("text")).alias("hash"),
        )
    )


def _small(state: DataFrame) -> DataFrame:
    return measured(state, F.octet_length(F.coalesce("of", F.lit(""))) + F.lit(64))


def plan(sized: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """of (the source), source_size, target, whole, below, extra."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    planned = targets(materialise(weigh_in_turn(sources, weights)), most).drop("weight")
    return thresholds(sized, planned).select(
        F.col("source").alias("of"), "source_size", "target", "whole", "below", "extra"
    )


def _decided(rows: DataFrame, hashed: Column) -> DataFrame:
    """``rows``, joined with the plan of their sources as ``_mix``, with ``_copies``.

    Rows with a source's boundary hash are numbered: those of a partition by themselves, which
    holds no more of them than it has rows, and partitions by their counts. They are equal in all
    that decides, so it does not matter which of them are taken.
    """
    at_edge = (hashed == F.col("_mix.below")) & (F.col("_mix.extra") > 0)
    # A null id or text has a hash, so this is never null.
    more = (hashed < F.col("_mix.below")).cast("long")
    others = rows.where(~at_edge).withColumn("_copies", F.col("_mix.whole") + more)
    edge = materialise(
        rows.where(at_edge)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id())
    )
    source = F.col("_mix.of")
    counts = edge.groupBy(source.alias("_of"), F.col("_part").alias("_of_part")).count()
    before = Window.partitionBy("_of").orderBy("_of_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(source, "_part").orderBy("_place"))
    chosen = (
        edge.withColumn("_inside", inside)
        .join(shift, source.eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_of_part")))
        .withColumn("_taken", F.col("_before") + F.col("_inside") <= F.col("_mix.extra"))
        .withColumn("_copies", F.col("_mix.whole") + F.col("_taken").cast("long"))
    )
    return others.unionByName(chosen.select(*others.columns))


def _with_plan(rows: DataFrame, state: DataFrame) -> DataFrame:
    columns = ("of", "source_size", "target", "whole", "below", "extra")
    return rows.join(
        _small(state).select(F.struct(*columns).alias("_mix")),
        F.col("source").eqNullSafe(F.col("_mix.of")),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """How often the mix takes each document: doc_id, source, size, source_size, target,
    copies, taken; one row per row of ``docs`` (doc_id, source, text).

    Null and empty texts have size 0. Null sources are one source, the last. Null and repeated
    doc_ids decide nothing by themselves, as the hash is of id and text; of rows that are equal in
    both, as many get a last copy as come nearest to the target. A source without words has
    target 0 and copies 0. An empty table gives no rows. Other columns are not read.
    """
    sized = _sized(docs)
    state = plan(sized, weights, most)
    return _decided(_with_plan(sized, state), F.col("hash")).select(
        "doc_id", "source", "size",
        F.col("_mix.source_size").alias("source_size"),
        F.col("_mix.target").alias("target"),
        F.col("_copies").alias("copies"),
        (F.col("size") * F.col("_copies")).alias("taken"),
    )


def repeated(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (see ``mix``).

    Copies follow from the plan of the sources, which is small; rows are neither joined with
    each other nor moved, but for those that share a source's boundary hash."""
    sized = _sized(docs)
    state = plan(sized, weights, most)
    decided = _decided(_with_plan(docs, state), row_hash(F.col("doc_id"), F.col("text")))
    return (
        decided.withColumn("_time", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))))
        .select(*docs.columns)
    )


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '') || chr(31) || COALESCE(text, '')), 1, 15) AS BIGINT) AS hash
  FROM documents),
sources AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, SUM(source_size) OVER () AS words, SUM(weight) OVER () AS weights,
         COALESCE(SUM(3 * source_size) OVER before, 0) AS given,
         COALESCE(SUM(weight) OVER before, 0) AS used
  FROM sources
  WINDOW before AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
judged AS (
  SELECT *, 3 * source_size * (weights - used) < (words - given) * weight AS is_full FROM ordered),
level AS (
  SELECT CAST(MAX(words) - SUM(CASE WHEN is_full THEN 3 * source_size ELSE 0 END) AS DOUBLE)
         / CAST(SUM(CASE WHEN is_full THEN 0 ELSE weight END) AS DOUBLE) AS height
  FROM judged),
planned AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE) ELSE weight * height END AS target
  FROM judged, level),
wanted AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM planned),
budgets AS (SELECT *, target - whole * source_size AS budget FROM wanted),
hashes AS (
  SELECT source, hash, SUM(size) AS words, MAX(size) AS size, COUNT(*) AS n FROM sized GROUP BY source, hash),
summed AS (
  SELECT h.source, h.hash, h.words, h.size, h.n, b.budget,
         SUM(h.words) OVER (PARTITION BY h.source ORDER BY h.hash) AS reached
  FROM hashes h JOIN budgets b ON h.source IS NOT DISTINCT FROM b.source),
crossing AS (
  SELECT source, hash,
         least(greatest(ceil((budget - (reached - words)) / size - 0.5), 0), n) AS extra,
         row_number() OVER (PARTITION BY source ORDER BY hash) AS nth
  FROM summed WHERE reached > budget AND budget > 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source, hash) AS place FROM sized),
decided AS (
  SELECT s.doc_id, s.size, b.source_size, b.target,
         b.whole + CASE WHEN b.budget <= 0 THEN 0
                        WHEN c.hash IS NULL OR s.hash < c.hash OR (s.hash = c.hash AND s.place <= c.extra) THEN 1
                        ELSE 0 END AS copies
  FROM numbered s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
  LEFT JOIN crossing c ON s.source IS NOT DISTINCT FROM c.source AND c.nth = 1)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
       CAST(copies AS BIGINT) AS copies
FROM decided
"""  # noqa: E501
