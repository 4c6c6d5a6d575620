"""SimHash fingerprints of documents, and a search for near ones, in built-in functions.

The terms of a text are its pairs of neighbouring words. A term's 64-bit hash votes on
each bit, with the term's length as weight: long terms are rare ones. A bit is set where
more than half of the weight votes for it.

Votes are counted in lanes: four 16-bit counters share one long, so that 16 sums hold the
64 counters and stay in generated code. A lane holds the votes of ``CHUNK`` words at most;
the chunks of longer texts are unpacked and added in wider lanes.

The search splits fingerprints into blocks. Two that differ in at most ``radius`` bits
agree in all blocks but ``radius``, so each choice of the agreeing blocks makes a table
whose key is those blocks, and a pair meets in at least one table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewinnow.llm.common import materialise, read

BITS = 64
SPACE = r"[\x20\x09-\x0D]+"
# A lane counts to 2**15 - 1, as the highest must not reach the sign.
CHUNK = 2048
MOST_WEIGHT = 15
RADIUS = 3
KEPT_BLOCKS = 2  # of RADIUS + KEPT_BLOCKS
QUERY_STEP = 50

_NIBBLE = (1 << 45) | (1 << 30) | (1 << 15) | 1  # spreads four bits over four lanes
_LANES = (1 << 48) | (1 << 32) | (1 << 16) | 1
_BUCKET_ROWS = 256
_MOST_BUCKETS = 100_000
_SHA_DIGITS = 13  # of the 64, that a long holds


def with_next(docs: DataFrame) -> DataFrame:
    """row, doc_id, text, next_row, next_text of ``docs`` (doc_id, text): the next document
    by doc_id, the first after the last. Nulls come last, equal ids as they are read.

    Ids are cut into ranges of equal width, about ``_BUCKET_ROWS`` rows each where ids are
    dense. Each text moves once; only the first of a range is also sent to the range before."""
    n, low, high = docs.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    buckets = min(_MOST_BUCKETS, max(1, n // _BUCKET_ROWS))
    width = max(1.0, (float(high or 0) - float(low or 0) + 1) / buckets)
    # Division by a double is monotonous, also where it rounds.
    place = F.coalesce(F.floor(F.col("doc_id") / F.lit(width)), F.lit(2**62)).cast("long")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        place.alias("bucket"),
    )
    firsts = docs.groupBy(place.alias("bucket")).agg(F.min("doc_id").alias("first"))
    order = Window.orderBy("bucket")  # of at most _MOST_BUCKETS rows and one for nulls
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("bucket").over(order), F.last("bucket").over(every))
    firsts = firsts.select("bucket", "first", before.alias("before"))
    own = F.struct(F.col("bucket").alias("in"), F.lit(False).alias("is_copy"))
    copy = F.struct(F.col("before").alias("in"), F.lit(True).alias("is_copy"))
    dealt = rows.join(F.broadcast(firsts), "bucket").select(
        "row",
        "doc_id",
        "text",
        F.explode(
            F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.array(own, copy)).otherwise(
                F.array(own)
            )
        ).alias("at"),
    )
    # One window for both: fields taken out first, as a window by a field of a struct is
    # taken for another one and would deal out all texts again.
    dealt = dealt.select("row", "doc_id", "text", "at.in", "at.is_copy")
    along = Window.partitionBy("in").orderBy("is_copy", F.col("doc_id").asc_nulls_last(), "row")
    return (
        dealt.select(
            "*",
            F.lead("row").over(along).alias("next_row"),
            F.lead("text").over(along).alias("next_text"),
        )
        .where(~F.col("is_copy"))
        .drop("in", "is_copy")
    )


def edited(text: Column, other: Column) -> Column:
    """``text`` with its second half replaced by as much of the start of ``other``."""
    n = F.char_length(text)
    half = F.floor(n / F.lit(2)).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))


def fingerprints(texts: DataFrame, key: str, text: str, carried: list[str]) -> DataFrame:
    """key, carried..., fingerprint (long): one row per ``key``, a unique long; ``carried``
    are longs. Texts must not be null; a text without words has fingerprint 0."""
    words = texts.select(key, *carried, F.split(text, SPACE).alias("_words"))
    terms = words.select(key, *carried, "_words", F.posexplode_outer("_words").alias("_at", "_word"))
    following = F.coalesce(F.get("_words", F.col("_at") + 1), F.lit(""))
    length = F.char_length("_word") + F.char_length(following)
    terms = terms.select(
        key,
        *carried,
        F.shiftright(F.col("_at"), CHUNK.bit_length() - 1).alias("_chunk"),
        F.xxhash64("_word", following).alias("_hash"),
        F.least(length, F.lit(MOST_WEIGHT)).cast("long").alias("_weight"),
    )

    def lanes(i: int) -> Column:
        nibble = F.shiftright("_hash", 4 * i).bitwiseAND(F.lit(15))
        return (nibble * F.lit(_NIBBLE)).bitwiseAND(F.lit(_LANES)) * F.col("_weight")

    carry = [F.max(name).alias(name) for name in carried]
    chunks = terms.groupBy(key, "_chunk").agg(
        F.sum("_weight").alias("_total"),
        *[F.sum(lanes(i)).alias(f"_v{i}") for i in range(BITS // 4)],
        *carry,
    )
    # Two lanes of 32 bits: lanes 0 and 2, then lanes 1 and 3, of each sum.
    pair = F.lit(0x0000_FFFF_0000_FFFF)
    wide = [
        F.sum(F.shiftright(f"_v{i}", 16 * odd).bitwiseAND(pair)).alias(f"_w{i}_{odd}")
        for i in range(BITS // 4)
        for odd in (0, 1)
    ]
    votes = chunks.groupBy(key).agg(F.sum("_total").alias("_total"), *wide, *carry)

    counts = F.array(*[f"_w{i}_{odd}" for i in range(BITS // 4) for odd in (0, 1)])

    def with_bit(value: Column, b: Column) -> Column:
        lane = b % 4
        held = F.get("_counts", F.floor(b / 4).cast("int") * 2 + lane % 2)
        count = F.call_function("shiftright", held, F.floor(lane / 2).cast("int") * 32)
        is_set = count.bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > F.col("_total")
        one = F.call_function("shiftleft", F.lit(1).cast("long"), b)
        return value.bitwiseOR(F.when(is_set, one).otherwise(F.lit(0).cast("long")))

    every = F.sequence(F.lit(0), F.lit(BITS - 1))
    value = F.aggregate(every, F.lit(0).cast("long"), with_bit)
    return votes.select(key, *carried, "_total", counts.alias("_counts")).select(
        key, *carried, value.alias("fingerprint")
    )


def digits(fingerprint: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))


def differing(a: Column | str, b: Column | str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)) if isinstance(a, str) else a.bitwiseXOR(b))


def likeness(a: str, b: str) -> Column:
    """Share of equal bits."""
    return 1.0 - differing(a, b) / F.lit(float(BITS))


def block_masks(radius: int, kept: int = KEPT_BLOCKS) -> list[int]:
    """For each table, the bits its key consists of, as signed longs."""
    n = radius + kept
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(blocks, kept)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def near(queries: DataFrame, all_of: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fingerprint, other, differing: each pair of ``queries`` and ``all_of`` (distinct
    fingerprints) that differ in at most ``radius`` bits, once, found in the first of the
    tables it meets in."""
    masks = block_masks(radius)

    def keyed(df: DataFrame, name: str) -> DataFrame:
        keys = [
            F.struct(F.lit(i).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(masks)
        ]
        return df.select(
            F.col("fingerprint").alias(name), F.explode(F.array(*keys)).alias("k")
        ).select(name, F.col("k.table").alias(f"{name}_t"), F.col("k.key").alias(f"{name}_k"))

    x = F.col("q").bitwiseXOR(F.col("o"))
    first = F.coalesce(
        *[F.when(x.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)]
    )
    met = keyed(queries, "q").join(
        keyed(all_of, "o"),
        (F.col("q_t") == F.col("o_t"))
        & (F.col("q_k") == F.col("o_k"))
        & (F.bit_count(x) <= radius)
        & (first == F.col("q_t")),
    )
    return met.select(
        F.col("q").alias("fingerprint"), F.col("o").alias("other"), F.bit_count(x).alias("differing")
    )


def fingerprint_documents(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """For each row of ``docs`` (doc_id, text) the columns of the query below.

    Null texts count as empty; an empty text has fingerprint zero, and so is near to other
    empty ones. Rows that repeat a doc_id, or lack one, are documents of their own (see
    ``with_next``); a single document follows itself. n_near is the number of other
    documents whose fingerprint differs in at most ``radius`` bits, for queries: documents
    whose id is divisible by 50; null for all others. An empty table gives no rows. Other
    columns are not read.
    """
    pairs = with_next(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    both = pairs.select(
        "row", "doc_id", "next_row", "text",
        F.char_length("text").cast("long").alias("n_chars"),
        edited(F.col("text"), F.col("next_text")).alias("edited"),
    )
    sha = F.sha2(F.col("edited"), 256)
    pieces = range(-(-64 // _SHA_DIGITS))
    both = both.withColumn("sha", sha).select(
        "row", "doc_id", "next_row", "n_chars", "text", "edited",
        *[
            F.conv(F.substring("sha", 1 + _SHA_DIGITS * i, _SHA_DIGITS), 16, 10)
            .cast("long").alias(f"sha{i}")
            for i in pieces
        ],
    )
    carried = ["doc_id", "next_row", "n_chars", *[f"sha{i}" for i in pieces]]
    texts = both.select(
        "row", *carried, F.posexplode(F.array("text", "edited")).alias("kind", "either")
    ).withColumn("key", F.col("row") * 2 + F.col("kind"))
    found = fingerprints(texts, "key", "either", carried)
    kind = F.col("key") % 2
    rows = materialise(
        found.groupBy(F.shiftright("key", 1).alias("row")).agg(
            *[F.max(name).alias(name) for name in carried],
            F.max(F.when(kind == 0, F.col("fingerprint"))).alias("fingerprint"),
            F.max(F.when(kind == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
        )
    )
    after = rows.select(F.col("row").alias("next_row"), F.col("fingerprint").alias("next"))
    is_query = F.coalesce(F.col("doc_id") % QUERY_STEP == 0, F.lit(False))
    distinct = rows.groupBy("fingerprint").agg(
        F.count("*").alias("n"), F.max(is_query).alias("asked")
    )
    asked = distinct.where("asked").select("fingerprint")
    counts = (
        near(asked, distinct.select("fingerprint"), radius)
        .join(distinct.select(F.col("fingerprint").alias("other"), "n"), "other")
        .groupBy("fingerprint")
        .agg((F.sum("n") - 1).alias("n_near"))
    )
    compared = rows.join(after, "next_row")
    answered = compared.where(is_query).join(counts, "fingerprint", "left")
    rest = compared.where(~is_query).withColumn("n_near", F.lit(None).cast("long"))
    widths = [min(_SHA_DIGITS, 64 - _SHA_DIGITS * i) for i in pieces]
    sha_text = F.concat(*[F.lpad(F.hex(f"sha{i}"), w, "0") for i, w in zip(pieces, widths, strict=True)])
    return answered.unionByName(rest).select(
        "doc_id", "n_chars",
        F.lower(sha_text).alias("edited_sha256"),
        digits("fingerprint").alias("fingerprint"),
        digits("edited_fingerprint").alias("edited_fingerprint"),
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next").alias("near_next"),
        "n_near",
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(read(spark, sf_dir, "documents"))
