"""Quality rules: counts per document, and isolation forests on statistics of them.

A tree splits a small sample at random values of random statistics; a document that ends
after few splits is unlike the others. Each group of rules has a forest of its own, fitted to
a bounded hash sample, as one odd statistic does not show among many others. The score
from which a group rejects a document is calibrated on all labelled rows, as the lowest that
rejects at most a given share of the good ones; a group that does not reject a much larger
share of the bad ones rejects nothing.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewinnow.llm.common import label_table, materialise, read

WINDOW = 8
FEWEST_WORDS = 20
MOST_REPEATED = 30  # per cent of words
SYMBOLS = "#*$%&|<>"
SEPARATORS = " \t\n\v\f\r"

TREES = 128
SUBSAMPLE = 64
SAMPLE = 16_384  # rows the trees draw from, about
MOST_GOOD_REJECTED = 0.001  # by a group
LEAST_GAIN = 5  # times the share of good rows that a group may reject
# Without labelled rows of both kinds.
DEFAULT_THRESHOLD = 0.8
_BINS = 2000

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits",
    "punctuation", "distinct", "line_words", "entropy",
)
GROUPS = {
    "symbols": ("symbols", "punctuation"),
    "repetition": ("dup_lines", "repeats", "distinct"),
    "letters": ("word_length", "upper"),
    "numbers": ("digits", "entropy"),
    "length": ("log_words", "line_words"),
}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in a window of ``window`` words that occurs twice or more. A rolling sum of
    hashes finds windows that may repeat; those are compared word by word."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for k in range(window):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    order = np.sort(rolled)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    suspects = np.flatnonzero(np.isin(rolled, twice)).tolist()
    counts = Counter(tuple(words[i : i + window]) for i in suspects)
    starts = [i for i in suspects if counts[tuple(words[i : i + window])] > 1]
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, np.array(starts, np.int64) + window, -1)
    return int((np.cumsum(depth) > 0).sum())


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier one."""
    lines = [line for line in text.split("\n") if line.strip(SEPARATORS)]
    return len(lines), len(lines) - len(set(lines))


def rule_statistics(text: str | None) -> tuple[list[int], list[float]]:
    """``BASE`` counts and ``FEATURES`` of a text; null counts as empty."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SEPARATORS))
    n_symbols = sum(map(text.count, SYMBOLS))
    n_lines, n_dup = duplicate_lines(text)
    n_repeat = repeated_words(words)
    octets = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower = octets[65:91].sum(), octets[97:123].sum()
    digits = octets[48:58].sum()
    ascii_words = octets[33:127].sum()
    share = octets[octets > 0] / max(1, len(data))
    chars = max(1, word_chars)
    features = [
        math.log1p(n),
        word_chars / max(1, n),
        n_symbols / chars,
        n_dup / max(1, n_lines),
        n_repeat / max(1, n),
        upper / max(1, upper + lower),
        digits / chars,
        (ascii_words - upper - lower - digits) / chars,
        len(set(words)) / max(1, n) * math.log1p(n),
        math.log1p(n / max(1, n_lines)),
        float(-(share * np.log2(share)).sum()) if len(data) else 0.0,
    ]
    return [n, word_chars, n_symbols, n_dup, n_repeat], [float(f) for f in features]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, ``BASE`` and ``features`` of each row of ``docs`` (doc_id, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [rule_statistics(t) for t in batch.column("text").to_pylist()]
            base = [pa.array([f[0][i] for f in found], pa.int64()) for i in range(len(BASE))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *base,
                    pa.array([f[1] for f in found], pa.list_(pa.float64())),
                ],
                ["doc_id", *BASE, "features"],
            )

    types = ", ".join(f"{name} long" for name in ("doc_id", *BASE))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        count, f"{types}, features array<double>"
    )


@dataclass
class Forest:
    """Trees as arrays, one row per tree. Node i's children are 2i+1 and 2i+2; a leaf has
    feature -1 and ``depth``, its depth with the mean depth of a tree of its size added."""

    feature: np.ndarray
    value: np.ndarray
    depth: np.ndarray
    usual: float

    @classmethod
    def fit(
        cls,
        rows: np.ndarray,
        weights: np.ndarray | None = None,
        trees: int = TREES,
        subsample: int = SUBSAMPLE,
    ) -> Forest:
        """Trees of subsamples of ``rows``; with ``weights`` a row stands for so many equal ones,
        and may be drawn as often."""
        rng = np.random.default_rng(11)
        chance = None if weights is None or not len(rows) else weights / weights.sum()
        size = min(subsample, len(rows) if chance is None else int(weights.sum()))
        levels = max(1, math.ceil(math.log2(max(2, size))))
        nodes = 2 ** (levels + 1) - 1
        feature = np.full((trees, nodes), -1)
        value, depth = np.zeros((trees, nodes)), np.zeros((trees, nodes))
        for tree in range(trees):
            drawn = rng.choice(len(rows), size, chance is not None, chance) if size else []
            parts = {0: rows[drawn]} if size else {}
            for node in range(nodes):
                own = parts.pop(node, None)
                if own is None:
                    continue
                level = int(math.log2(node + 1))
                varied = np.flatnonzero(own.max(axis=0) > own.min(axis=0)) if len(own) > 1 else []
                if level == levels or not len(varied):
                    depth[tree, node] = level + cls.usual_depth(len(own))
                    continue
                f = rng.choice(varied)
                cut = rng.uniform(own[:, f].min(), own[:, f].max())
                feature[tree, node], value[tree, node] = f, cut
                left = own[:, f] < cut
                parts[2 * node + 1], parts[2 * node + 2] = own[left], own[~left]
        return cls(feature, value, depth, cls.usual_depth(size))

    @staticmethod
    def usual_depth(n: int) -> float:
        """Mean depth of an unsuccessful search in a random tree of ``n`` values."""
        if n < 2:
            return 0.0
        return 2 * (math.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the higher, the sooner a row is alone."""
        if not len(rows) or not self.usual:
            return np.zeros(len(rows))
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, value, depth in zip(self.feature, self.value, self.depth, strict=True):
            node = np.zeros(len(rows), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = rows[every, np.maximum(f, 0)] >= value[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += depth[node]
        return 2.0 ** (-total / len(self.depth) / self.usual)


def fit(sample: np.ndarray, weights: np.ndarray | None = None) -> dict[str, Forest]:
    """A forest for each group on its columns of ``sample``, whose columns are ``FEATURES``."""
    return {group: Forest.fit(sample[:, columns(group)], weights) for group in GROUPS}


def drawn(stats: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of features, in order, and how many rows of ``stats`` each stands for.

    Rows that make up more than one in ``rows`` of all are in it, which are fewer than ``rows``;
    of the others about ``rows`` are drawn by a hash of the features alone. So neither ids
    nor repeated rows nor partitions change the sample."""
    distinct = materialise(stats.groupBy("features").count())
    n, total = distinct.agg(F.count(F.lit(1)), F.sum("count")).first()
    step = max(1, n // rows)
    frequent = F.col("count") * rows > (total or 0)
    chosen = F.pmod(F.xxhash64("features"), F.lit(step)) == 0
    weight = F.when(frequent, F.col("count")).otherwise(F.col("count") * step)
    found = distinct.where(frequent | chosen).select("features", weight.alias("weight")).collect()
    found = sorted((tuple(r["features"]), r["weight"]) for r in found)
    sample = np.array([f for f, _ in found], float).reshape(len(found), len(FEATURES))
    return sample, np.array([w for _, w in found], float)


def columns(group: str) -> list[int]:
    return [FEATURES.index(name) for name in GROUPS[group]]


def scored(stats: DataFrame, forests: dict[str, Forest]) -> DataFrame:
    """``stats`` with a score for each group in place of the features."""
    kept = stats.drop("features").columns

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = np.array(frame["features"].tolist(), float).reshape(len(frame), len(FEATURES))
            found = {group: forest.score(rows[:, columns(group)]) for group, forest in forests.items()}
            yield frame[kept].assign(**found)

    types = [f"{c} {stats.schema[c].dataType.simpleString()}" for c in kept]
    return stats.mapInPandas(add, ", ".join([*types, *[f"`{group}` double" for group in forests]]))


def calibrate(
    scores: DataFrame, labels: DataFrame, most: float = MOST_GOOD_REJECTED
) -> dict[str, float]:
    """For each group the least score at which at most ``most`` of the labelled good documents
    are rejected. All labelled rows count; histograms of them reach the driver."""
    known = label_table(labels).select(F.col("doc_id").alias("of"), "quality")
    bins = F.explode(
        F.array(
            *[
                F.struct(F.lit(group).alias("group"), F.floor(F.col(group) * _BINS).alias("bin"))
                for group in GROUPS
            ]
        )
    ).alias("at")
    counts = (
        scores.where(F.col("n_words") >= FEWEST_WORDS)
        .join(known, F.col("doc_id") == F.col("of"))
        .select("quality", bins)
        .groupBy("at.group", "at.bin", "quality")
        .count()
        .toPandas()
    )
    found = {}
    for group in GROUPS:
        own = counts[counts["group"] == group].sort_values("bin", ascending=False)
        good, bad = own[own["quality"] == 1], own[own["quality"] == 0]
        if good.empty or bad.empty:
            found[group] = DEFAULT_THRESHOLD
            continue
        allowed = most * good["count"].sum()
        over = good[good["count"].cumsum() > allowed]["bin"]
        least = int(over.iloc[0]) + 1
        share = bad[bad["bin"] >= least]["count"].sum() / bad["count"].sum()
        found[group] = least / _BINS if share >= LEAST_GAIN * most else math.inf
    return found


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, ``BASE``, a score for each group, base_failed, kept for each row of ``docs``
    (doc_id, text).

    Null texts count as empty: no words, so base_failed. Repeated doc_ids are judged row by
    row; a null doc_id has no label. Without labels of both kinds all thresholds are
    ``DEFAULT_THRESHOLD``. An empty table gives no rows. Other columns are not read.
    """
    stats = materialise(statistics(docs))
    scores = materialise(scored(stats, fit(*drawn(stats, SAMPLE))))
    odd = F.lit(False)
    for group, least in calibrate(scores, labels).items():
        odd = odd | (F.col(group) >= F.lit(least))
    failed = (F.col("n_words") < FEWEST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED
    )
    return scores.withColumn("base_failed", failed).withColumn("kept", ~failed & ~odd)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", *BASE, "base_failed", "kept", *GROUPS)
