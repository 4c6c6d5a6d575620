"""Near duplicates by SimHash fingerprints and vantage-point trees.

Equal fingerprints are grouped first, so copies cost nothing further. The distinct ones
are partitioned by a vantage-point tree: a node keeps what is within ``mu`` bits of its
vantage point inside, the rest outside. By the triangle inequality two fingerprints within
the radius lie on the same side, unless the outer one is within ``mu + radius`` of the
vantage point; such a one is copied inside. So any linked pair meets in a leaf, which is
searched exactly. Of a leaf only its links' spanning stars leave the task, and the stars of
all leaves are joined to components.

The tree is fitted to a hash sample of at most about ``TREE_SAMPLE`` fingerprints and so
has at most about ``TREE_SAMPLE / LEAF_SAMPLE`` leaves. Leaves that are larger than
``LEAF_MOST`` get trees of their own, of their own samples, and so on, level by level, so that work
grows with the number of fingerprints. A leaf that a tree does not divide, as its points are all
near each other, is dealt out as pairs of chunks, which are compared exactly as well.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewinnow.llm.common import materialise, measured, read
from tablewinnow.settings import BROADCAST_BYTES, setting

SHINGLE = 3
RADIUS = 2
SEED = 42

TREE_SAMPLE = 65_536
SAMPLE_STEP = 32  # at least one in so many fingerprints is looked at by the tree
LEAF_SAMPLE = 16
LEAF_MOST = 8192
# Fingerprints of a large leaf that its tree is fitted to, about, and levels of trees.
LEAF_TREE_SAMPLE = 4096
LEVELS = 8
# A tree is used if its leaves hold at most so many copies of a point and so large a share.
MOST_COPIES, MOST_SHARE = 2.0, 0.75
_CANDIDATES = 8
_BLOCK = 256

_MIX, _ONE, _ALL = np.uint64(0x9E3779B97F4A7C15), np.uint64(1), (1 << 64) - 1

# The eight bits of each byte value, lowest first.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_BYTE_PLACE = np.arange(8, dtype=np.intp) * 256


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint: ASCII letters in lower case, shingles of words joined by a
    blank (of all words, if there are fewer), repeats included; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        digest = xxhash.xxh64_intdigest
        hashes = [
            digest(joined[a:b], SEED)
            for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        ]
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros((8, 256), np.int64)
    for at in range(0, len(octets), 1 << 20):
        place = octets[at : at + (1 << 20)] + _BYTE_PLACE
        counts += np.bincount(place.ravel(), minlength=2048).reshape(8, 256)
    votes = (counts @ _BYTE_BITS.astype(np.int64)).ravel()
    return int.from_bytes(np.packbits(2 * votes > len(octets), bitorder="little").tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint_column(text, shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield pd.Series([_signed(simhash(t, shingle)) for t in series], dtype="int64")

    return fingerprint(text)


@dataclass
class VantageTree:
    """Nodes as arrays. Children of node i are ``inner[i]`` and ``outer[i]``; a leaf has
    itself as both and ``mu`` -1."""

    vantage: np.ndarray
    mu: np.ndarray
    inner: np.ndarray
    outer: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, radius: int, leaf: int = LEAF_SAMPLE) -> VantageTree:
        rng = np.random.default_rng(SEED)
        vantage, mu, inner, outer = [0], [-1], [0], [0]
        todo = [(0, np.unique(sample.astype(np.uint64)))]
        while todo:
            node, own = todo.pop()
            split = cls._split(own, radius, rng) if len(own) > leaf else None
            if split is None:
                continue
            point, limit, inside = split
            children = len(vantage), len(vantage) + 1
            vantage[node], mu[node] = int(point), int(limit)
            inner[node], outer[node] = children
            for child, part in zip(children, (own[inside], own[~inside]), strict=True):
                vantage.append(0)
                mu.append(-1)
                inner.append(child)
                outer.append(child)
                todo.append((child, part))
        return cls(np.array(vantage, np.uint64), np.array(mu), np.array(inner), np.array(outer))

    @staticmethod
    def _split(own: np.ndarray, radius: int, rng: np.random.Generator):
        """The vantage point and limit that copy the fewest, among limits that leave at
        least a quarter on either side; without any, the most even one."""
        best = None
        for point in rng.choice(own, min(_CANDIDATES, len(own)), replace=False):
            distance = np.bitwise_count(own ^ point)
            upto = np.cumsum(np.bincount(distance, minlength=65 + radius)) / len(own)
            for limit in range(64):
                share = min(upto[limit], 1 - upto[limit])
                if share <= 0:
                    continue
                copied = upto[min(limit + radius, 64)] - upto[limit]
                rank = (share >= 0.25, -copied if share >= 0.25 else share)
                if best is None or rank > best[0]:
                    best = rank, point, limit
        if best is None:
            return None
        return best[1], best[2], np.bitwise_count(own ^ best[1]) <= best[2]

    def leaves(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of ``points`` and the leaf of each; a point may be in several."""
        row, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        rows, found = [], []
        while len(row):
            mu = self.mu[node]
            done = mu < 0
            rows.append(row[done])
            found.append(node[done])
            row, node, mu = row[~done], node[~done], mu[~done]
            distance = np.bitwise_count(points[row] ^ self.vantage[node]).astype(np.int64)
            outside = distance > mu
            copied = outside & (distance <= mu + radius)
            node, row = (
                np.concatenate(
                    [np.where(outside, self.outer[node], self.inner[node]), self.inner[node[copied]]]
                ),
                np.concatenate([row, row[copied]]),
            )
        return np.concatenate(rows), np.concatenate(found)


def local_stars(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of the components that links within ``radius`` make of ``points``, and for
    each the least member, for all that are not the least themselves."""
    linked = np.zeros(len(points), bool)
    for at in range(0, len(points), _BLOCK):
        near = np.bitwise_count(points[at : at + _BLOCK, None] ^ points[None, :]) <= radius
        linked[at : at + _BLOCK] = near.sum(axis=1) > 1
    rest, members, roots = np.sort(points[linked]), [], []
    while len(rest):
        root, frontier, rest = rest[0], rest[:1], rest[1:]
        while len(frontier) and len(rest):
            hit = np.zeros(len(rest), bool)
            for at in range(0, len(frontier), _BLOCK):
                left = np.flatnonzero(~hit)
                block = frontier[at : at + _BLOCK, None] ^ rest[left][None, :]
                hit[left] = (np.bitwise_count(block) <= radius).any(axis=0)
            frontier, rest = rest[hit], rest[~hit]
            members.append(frontier)
            roots.append(np.full(len(frontier), root))
    if not members:
        return points[:0], points[:0]
    return np.concatenate(members), np.concatenate(roots)


def _split_large(placed: DataFrame, radius: int, level: int) -> DataFrame | None:
    """``placed`` (leaf, fingerprint) with the leaves of more than ``LEAF_MOST`` points divided
    by trees of their own; None if no leaf is that large or can be divided.

    Trees are fitted side by side to samples of about ``LEAF_TREE_SAMPLE`` points. They are few
    kilobytes each and are broadcast, in turns if they take more than the limit together.
    """
    spark, most = placed.sparkSession, LEAF_MOST
    large = materialise(placed.groupBy("leaf").count().where(F.col("count") > most))
    if large.isEmpty():
        return None
    step = F.greatest(F.lit(1), F.floor(F.col("count") / LEAF_TREE_SAMPLE)).alias("step")
    salt = F.lit(level + 2)
    sample = placed.join(measured(large.select("leaf", "count", step), 32), "leaf").where(
        F.pmod(F.xxhash64("fingerprint", salt), F.col("step")) == 0
    )

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        points = frame["fingerprint"].to_numpy(np.int64).view(np.uint64)
        # A leaf of the tree is to hold half of what a leaf may hold.
        each = int(np.ceil(len(points) * most / 2 / frame["count"].iloc[0]))
        tree = VantageTree.fit(points, radius, max(2, min(each, len(points))))
        rows, leaves = tree.leaves(points, radius)
        largest = np.bincount(leaves).max() / len(points)
        if len(rows) > MOST_COPIES * len(points) or largest > MOST_SHARE:
            return pd.DataFrame({"leaf": pd.Series([], dtype="int64"), "tree": []})
        return pd.DataFrame({"leaf": [int(frame["leaf"].iloc[0])], "tree": [pickle.dumps(tree)]})

    trees = materialise(sample.groupBy("leaf").applyInPandas(fit, "leaf long, tree binary"))
    size = trees.agg(F.sum(F.octet_length("tree") + 64)).first()[0]
    if not size:
        return None
    turns = -(-size * 2 // setting(spark, BROADCAST_BYTES))
    turn = F.pmod(F.xxhash64("leaf"), F.lit(turns))
    dealt = placed.join(measured(trees.select("leaf", turn.alias("turn")), 24), "leaf", "left")
    parts = [dealt.where(F.col("turn").isNull()).select("leaf", "fingerprint")]
    for number in range(turns):
        own = trees.where(turn == number).collect()
        shared = spark.sparkContext.broadcast({r["leaf"]: r["tree"] for r in own})

        def divide(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            known: dict[int, VantageTree] = {}
            for frame in frames:
                for leaf, part in frame.groupby("leaf"):
                    if leaf not in known:
                        known[leaf] = pickle.loads(shared.value[leaf])
                    points = part["fingerprint"].to_numpy(np.int64)
                    row, child = known[leaf].leaves(points.view(np.uint64), radius)
                    # Should two leaves ever get the same name, they are searched together.
                    name = (np.uint64(leaf & _ALL) * _MIX + child.astype(np.uint64) + _ONE) * _MIX
                    yield pd.DataFrame({"leaf": name.view(np.int64), "fingerprint": points[row]})

        mine = dealt.where(F.col("turn") == number).select("leaf", "fingerprint")
        parts.append(mine.mapInPandas(divide, "leaf long, fingerprint long"))
    divided = parts[0]
    for part in parts[1:]:
        divided = divided.unionAll(part)
    return materialise(divided)


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """u, v: edges between ``distinct`` fingerprints that connect exactly what chains of
    links within ``radius`` bits connect; at most one per fingerprint and leaf."""
    n = distinct.count()
    step = max(SAMPLE_STEP, n // TREE_SAMPLE)
    picked = F.pmod(F.xxhash64("fingerprint"), F.lit(step)) == 0
    sample = distinct.where(picked).toPandas()["fingerprint"].to_numpy(np.int64)
    tree = VantageTree.fit(sample.view(np.uint64), radius)

    def to_leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = frame["fingerprint"].to_numpy(np.int64)
            row, leaf = tree.leaves(points.view(np.uint64), radius)
            yield pd.DataFrame({"leaf": leaf, "fingerprint": points[row]})

    placed = materialise(
        distinct.select("fingerprint").mapInPandas(to_leaves, "leaf long, fingerprint long")
    )
    for level in range(LEVELS):
        split = _split_large(placed, radius, level)
        if split is None:
            break
        placed = split
    sizes = placed.groupBy("leaf").count()
    chunks = measured(
        sizes.select("leaf", F.ceil(F.col("count") / LEAF_MOST).cast("int").alias("chunks"))
        .where("chunks > 1"),
        16,
    )
    own = F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.col("chunks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(
            F.least(F.col("own"), other).alias("a"), F.greatest(F.col("own"), other).alias("b")
        ),
    )
    tasks = (
        placed.join(chunks, "leaf", "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("own", own)
        .select("leaf", "fingerprint", F.explode(pairs).alias("pair"))
        .select("leaf", "pair.a", "pair.b", "fingerprint")
    )

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        points = frame["fingerprint"].to_numpy(np.int64).view(np.uint64)
        members, roots = local_stars(points, radius)
        return pd.DataFrame({"u": members.view(np.int64), "v": roots.view(np.int64)})

    return tasks.groupBy("leaf", "a", "b").applyInPandas(search, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """u, v: each node of ``edges`` (u, v) but the least of a component, and that least one.

    Large and small stars in turn: every node's larger neighbours, then all its smaller
    ones, are tied to the least it knows, until nothing changes. A node's neighbours are
    never gathered, only their least is computed, by partial aggregation."""

    def ordered(df: DataFrame) -> DataFrame:
        return (
            df.where(F.col("u") != F.col("v"))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct()
        )

    def least_of(df: DataFrame) -> DataFrame:
        least = materialise(df.groupBy("u").agg(F.min("v").alias("m")))
        return measured(least.withColumnRenamed("u", "of"), 24)

    def state(df: DataFrame) -> tuple:
        mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
        return tuple(df.agg(F.count("*"), F.sum(mixed)).first())

    current = materialise(ordered(edges))
    last = state(current)
    while last[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = least_of(both)
        large = (
            both.join(least, F.col("u") == F.col("of"))
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        )
        large = materialise(ordered(large))
        least = least_of(large)
        joined = large.join(least, F.col("u") == F.col("of"))
        small = joined.select("u", F.col("m").alias("v")).union(
            joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        current = materialise(ordered(small))
        now = state(current)
        if now == last:
            break
        last = now
    return current


def labels(printed: DataFrame, radius: int) -> DataFrame:
    """fingerprint, root, component_id for each distinct fingerprint of ``printed``
    (doc_id, fingerprint). The root names the component; component_id is its least doc_id."""
    groups = materialise(printed.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    stars = components(links(groups, radius))
    rooted = materialise(
        groups.join(stars, F.col("fingerprint") == F.col("u"), "left").select(
            "fingerprint", "least_id", F.col("v").alias("up")
        )
    )
    linked = rooted.where(F.col("up").isNotNull())
    roots = linked.select(F.col("up").alias("root")).distinct()
    own = rooted.join(roots, F.col("fingerprint") == F.col("root")).select("root", "least_id")
    least = materialise(
        own.union(linked.select("up", "least_id")).groupBy("root").agg(F.min("least_id").alias("first"))
    ).withColumnRenamed("root", "of")
    root = F.coalesce("up", "fingerprint")
    return rooted.withColumn("root", root).join(
        measured(least, 24), F.col("root") == F.col("of"), "left"
    ).select(
        "fingerprint", "root",
        F.when(F.col("of").isNull(), F.col("least_id")).otherwise(F.col("first")).alias("component_id"),
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (signed long), root, component_id for each row of ``docs``.

    Null, empty and blank texts have fingerprint zero and so are one group. Rows are joined
    by fingerprint alone: a doc_id that repeats gets one row per row, each with its own
    component; a null doc_id counts for no component's least id, which is null where all
    are. An empty table gives no rows. Other columns are not read.
    """
    printed = materialise(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            fingerprint_column(F.col("text"), shingle).alias("fingerprint"),
        )
    )
    named = materialise(labels(printed, radius)).withColumnRenamed("fingerprint", "of")
    return printed.join(measured(named, 40), F.col("fingerprint") == F.col("of")).select(
        "doc_id", "fingerprint", "root", "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each component does: the one with the
    least doc_id, null last; of rows that share it, the least in all columns in order."""
    grouped = materialise(near_duplicates(docs, shingle, radius))
    staying = materialise(
        grouped.groupBy("root").agg(F.min("doc_id").alias("_id"))
    )
    rows = grouped.groupBy("doc_id").count()
    repeated = materialise(
        rows.where((F.col("count") > 1) | F.col("doc_id").isNull()).select(F.col("doc_id").alias("_id"))
    )
    lone = staying.join(repeated, "_id", "left_anti").where(F.col("_id").isNotNull())
    kept = docs.join(
        measured(materialise(lone.select("_id")), 24), F.col("doc_id") == F.col("_id"), "left_semi"
    )
    if repeated.isEmpty():
        return kept
    same_id = F.col("doc_id").eqNullSafe(F.col("_id"))
    several = docs.join(measured(repeated, 24), same_id, "left_semi").withColumn(
        "_print", fingerprint_column(F.col("text"), shingle)
    )
    root_of = grouped.select(F.col("fingerprint").alias("_of"), F.col("root").alias("_root")).distinct()
    chosen = staying.select(F.col("root").alias("_root"), "_id")
    whole = F.struct(F.col("doc_id").isNull().alias("_last"), *[F.col(c) for c in docs.columns])
    several = (
        several.join(materialise(root_of), F.col("_print") == F.col("_of"))
        .join(chosen, "_root")
        .where(same_id)
        .groupBy("_root")
        .agg(F.min(whole).alias("_row"))
        .select(*[F.col(f"_row.{c}") for c in docs.columns])
    )
    return kept.unionByName(several)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    hexadecimal = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", hexadecimal.alias("fingerprint"), "component_id")
