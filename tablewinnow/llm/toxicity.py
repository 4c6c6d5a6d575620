"""Toxicity: cumulative-link ordinal regression on the words and word stems of a text.

Grades 0 to 3 are ordered. One weight per term gives a text its score, and thresholds
shared by all texts cut the score into grades: P(grade <= k) = sigmoid(threshold_k - score).
The output is the expected grade.

Labels say whether a document is toxic, not how much. Grades to learn from are made of
them: clean documents have grade 0, toxic ones 1 to 3 by tertiles of the share of their terms
that mark toxic documents. Terms are chosen by a chi-square test on the training rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewinnow.llm.common import label_table, materialise, measured, read

GRADES = 4
TRAINING_ROWS = 20_000  # labelled documents learned from, about; at most twice as many
VOCABULARY = 4096
LEAST_CHI = 20.0
STEM = 5
MARKING_ODDS = 3.0  # toxic to clean, as a logarithm
RIDGE = 1.0  # over the number of rows
STEPS = 500

_WORD = re.compile(r"[^\W\d_]+")


def terms_of(text: str | None) -> list[str]:
    """The words of a text, and the stems of long ones: toxic words have endings, too."""
    words = _WORD.findall(text.lower()) if text else []
    return words + [w[:STEM] + "~" for w in words if len(w) > STEM]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    weights: dict[str, float]
    thresholds: np.ndarray  # ascending, one less than there are grades
    toxic_from: float = 0.5  # of P(grade >= 1)

    @classmethod
    def fit(cls, vocabulary: list[str], held: list[np.ndarray], grades: np.ndarray) -> Ordinal:
        """``held``: for each text the indexes of its words in ``vocabulary``."""
        present = np.unique(grades)
        if len(present) < 2:
            # Nothing to tell apart: every text gets the one grade there is, or zero.
            only = present[0] if len(present) else 0
            return cls({}, np.where(np.arange(GRADES - 1) < only, -40.0, 40.0))
        rows = np.repeat(np.arange(len(held)), [len(h) for h in held])
        cols = np.concatenate(held).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
        n, k = len(held), GRADES - 1
        shares = np.array([(grades <= i).mean() for i in range(k)]).clip(0.5 / n, 1 - 0.5 / n)
        start = np.log(shares / (1 - shares))
        # Thresholds are a first one and logarithms of the gaps between them.
        value = np.concatenate(
            [np.zeros(len(vocabulary)), start[:1], np.log(np.maximum(np.diff(start), 1e-2))]
        )
        mean, square = np.zeros_like(value), np.zeros_like(value)
        v = len(vocabulary)
        every = np.arange(n)
        for step in range(1, STEPS + 1):
            gaps = np.exp(value[v + 1 :])
            cuts = value[v] + np.concatenate([[0.0], np.cumsum(gaps)])
            score = np.bincount(rows, value[cols], n)
            # P(grade <= i) with i from -1 to k, and its slope.
            upto = sigmoid(cuts[None, :] - score[:, None])
            upto = np.column_stack([np.zeros(n), upto, np.ones(n)])
            slope = upto * (1 - upto)
            chance = np.maximum(upto[every, grades + 1] - upto[every, grades], 1e-12)
            high, low = slope[every, grades + 1] / chance, slope[every, grades] / chance
            of_score = (high - low) / n
            of_cuts = np.array(
                [low[grades == i + 1].sum() - high[grades == i].sum() for i in range(k)]
            ) / n
            later = np.cumsum(of_cuts[::-1])[::-1]
            gradient = np.concatenate(
                [
                    np.bincount(cols, of_score[rows], v) + RIDGE / n * value[:v],
                    later[:1],
                    later[1:] * gaps,
                ]
            )
            mean = 0.9 * mean + 0.1 * gradient
            square = 0.99 * square + 0.01 * gradient**2
            value = value - 0.1 * (mean / (1 - 0.9**step)) / (
                np.sqrt(square / (1 - 0.99**step)) + 1e-9
            )
        cuts = value[v] + np.concatenate([[0.0], np.cumsum(np.exp(value[v + 1 :]))])
        chance = 1 - sigmoid(cuts[0] - np.bincount(rows, value[cols], n))
        weights = dict(zip(vocabulary, value[:v].tolist(), strict=True))
        return cls(weights, cuts, cls._best_cut(chance, grades > 0))

    @staticmethod
    def _best_cut(chance: np.ndarray, toxic: np.ndarray) -> float:
        """Midway, in logits, between the neighbouring chances whose cut has the highest F1."""
        order = np.argsort(-chance, kind="stable")
        ranked, hits = chance[order], np.cumsum(toxic[order])
        f1 = 2 * hits / (np.arange(1, len(chance) + 1) + toxic.sum())
        f1[:-1][ranked[:-1] == ranked[1:]] = 0
        best = int(f1.argmax())
        after = ranked[best + 1] if best + 1 < len(ranked) else 0.0
        low, high = np.clip([after, ranked[best]], 1e-9, 1 - 1e-9)
        return float(sigmoid((np.log(low / (1 - low)) + np.log(high / (1 - high))) / 2))

    def above(self, texts: list[str | None]) -> np.ndarray:
        """P(grade >= k) for k from 1, one row per text."""
        known = self.weights
        score = [sum(known[w] for w in known.keys() & set(terms_of(t))) for t in texts]
        return 1 - sigmoid(self.thresholds[None, :] - np.array(score, float)[:, None])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Ordinal:
    """Learn from about ``rows`` labelled documents, taken by a hash of their id. Word counts
    are summed in Spark; the chosen words, and which of them a training document has, reach
    the driver."""
    known = materialise(label_table(labels).where(F.col("toxic").isNotNull()))
    step = max(1, known.count() // rows)
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
    drawn = materialise(drawn.select(F.col("doc_id").alias("of"), "toxic"))
    sample = docs.select("doc_id", "text").join(measured(drawn, 32), F.col("doc_id") == F.col("of"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms_of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("toxic").cast(pa.int32()),
                    pa.array(found, pa.list_(pa.string())),
                ],
                ["doc_id", "toxic", "words"],
            )

    taken = materialise(
        sample.select("doc_id", "toxic", "text").mapInArrow(
            take, "doc_id long, toxic int, words array<string>"
        )
    )
    toxic, total = taken.agg(F.sum("toxic"), F.count("*")).first()
    if not toxic or toxic == total:
        return Ordinal.fit([], [np.zeros(0, int)] * 1, np.array([1 if toxic else 0]))
    # Two-by-two tables of word and label.
    a, n1, n = F.col("a").cast("double"), float(toxic), float(total)
    held = F.col("held").cast("double")
    cross = a * (n - n1) - (held - a) * n1
    chi = n * cross * cross / (n1 * (n - n1) * held * F.greatest(n - held, F.lit(0.5)))
    odds = F.log((a + 0.5) / (n1 - a + 0.5)) - F.log(
        (held - a + 0.5) / (n - n1 - held + a + 0.5)
    )
    chosen = (
        taken.select("toxic", F.explode(F.array_distinct("words")).alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("a"), F.count("*").alias("held"))
        .select("word", chi.alias("chi"), odds.alias("odds"))
        .where(F.col("chi") >= LEAST_CHI)
        .orderBy(F.desc("chi"), "word")
        .limit(VOCABULARY)
        .toPandas()
    )
    vocabulary = sorted(chosen["word"])
    marking = set(chosen["word"][chosen["odds"] >= MARKING_ODDS])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {word: i for i, word in enumerate(vocabulary)}
        for batch in batches:
            texts = batch.column("words").to_pylist()
            held = [sorted(place[w] for w in place.keys() & set(t)) for t in texts]
            share = [sum(w in marking for w in t) / max(1, len(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("toxic"),
                    pa.array(held, pa.list_(pa.int32())),
                    pa.array(share, pa.float64()),
                ],
                ["doc_id", "toxic", "held", "share"],
            )

    found = taken.mapInArrow(index, "doc_id long, toxic int, held array<int>, share double")
    found = found.toPandas().sort_values("doc_id", kind="stable")
    is_toxic, share = found["toxic"].to_numpy() > 0, found["share"].to_numpy(float)
    cuts = np.quantile(share[is_toxic], [1 / 3, 2 / 3])
    grades = np.where(is_toxic, 1 + np.searchsorted(cuts, share), 0)
    return Ordinal.fit(vocabulary, [np.array(h, int) for h in found["held"]], grades)


def grade(docs: DataFrame, model: Ordinal) -> DataFrame:
    """doc_id, severity (expected grade, 0 to 3), grade (the nearest), toxic for each row of
    ``docs`` (doc_id, text).

    Null, empty and wordless texts have score 0, the grade of a text without any telling
    word. Without labels of both kinds all texts get the one grade there is, or 0. Repeated
    and null doc_ids are graded row by row. An empty table gives no rows. Other columns are
    not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            above = shared.value.above(batch.column("text").to_pylist())
            severity = above.sum(axis=1).round(6)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(severity, pa.float64()),
                    pa.array(np.rint(severity).astype(np.int32), pa.int32()),
                    pa.array(above[:, 0] >= shared.value.toxic_from, pa.bool_()),
                ],
                ["doc_id", "severity", "grade", "toxic"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(score, "doc_id long, severity double, grade int, toxic boolean")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return grade(docs, fit(docs, read(spark, sf_dir, "labels")))
