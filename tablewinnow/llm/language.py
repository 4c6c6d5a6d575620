"""Language identification with a string kernel.

A text is the set of its character n-grams of one to three letters, case folded, anything
but letters counting as a blank. Two texts' kernel is the number of n-grams both have over
the geometric mean of their own numbers (a blended spectrum of presences). N-grams are told
apart by a hash to ``CELLS`` cells.

The kernel is approximated from landmark texts (Nyström), and one ridge regression per
language learns +1 or -1 in that feature space. As the kernel is a product of presence
vectors, landmarks and regression fold into one matrix of cells by languages, so that a
batch of texts is scored by one matrix product.

The outputs for a text sum to two less the number of languages, whatever the text, so its best
score is never below one by that number. What score a text of a learned language reaches
is measured (``least_scores``), by language and by how many n-grams the text has.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewinnow.llm.common import read

CELLS = 1 << 15
ORDERS = 3
LANDMARKS = 384
PER_LANGUAGE = 600  # training texts of each language, at most about twice as many
MOST_TEXTS = 6000
RIDGE = 1e-3
FOLDS = 3
HELD_OUT = 1
UNDETERMINED = "und"
# Least scores are measured for texts of so many n-grams or more.
SIZES = (0, 30, 100, 300)
LOST = 0.005  # share of the texts of a learned language that a least score may turn away
FOREIGN = 0.99  # share of the texts of other languages that it should turn away
# Fewer texts of a language and size are judged by those of all languages: the least score is
# the one that twice as many texts as may be lost do not reach, so that it holds for new texts.
FEWEST_TEXTS = int(2 / LOST)
FEWEST_FOREIGN = 40
ABOVE = 0.01  # what any text has to score above the least that is possible
MOST_FITS = 8
_ROWS = 64  # scored by one product
_CHUNK = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def presence(text: str | None) -> np.ndarray | None:
    """The cells of the text's n-grams; None for a text that is null or has no letter.
    Long texts are read in chunks that overlap, so n-grams across a cut are counted."""
    if not text:
        return None
    found = np.zeros(CELLS, bool)
    seen = False
    for at in range(0, len(text), _CHUNK):
        part = text[max(0, at - ORDERS + 1) : at + _CHUNK].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[codes]
        seen = seen or bool(letter.any())
        codes = np.where(letter, codes, np.uint32(32)).astype(np.uint64)
        gram = codes
        for order in range(1, ORDERS + 1):
            if order > 1:
                gram = (gram[:-1] << np.uint64(21)) | codes[order - 1 :]
            found[(gram * _MIX + np.uint64(order)) >> np.uint64(64 - 15)] = True
    return found if seen else None


@dataclass
class Languages:
    names: list[str]
    weights: np.ndarray  # cells by languages, float32
    bias: np.ndarray | float = 0.0
    least: np.ndarray | None = None  # least scores, sizes by languages

    @classmethod
    def fit(cls, cells: np.ndarray, names: np.ndarray, landmarks: int = LANDMARKS) -> Languages:
        """``cells``: bits of the presences, packed, one row per text."""
        known = sorted(set(names.tolist()))
        if not known:
            return cls([], np.zeros((CELLS, 0), np.float32))
        rng = np.random.default_rng(7)
        chosen = np.sort(rng.permutation(len(cells))[:landmarks])

        def unit(rows: np.ndarray) -> np.ndarray:
            dense = np.unpackbits(rows, axis=1).astype(np.float32)
            return dense / np.sqrt(np.maximum(dense.sum(axis=1, keepdims=True), 1))

        marks = unit(cells[chosen])
        inner = (marks @ marks.T).astype(np.float64)
        values, vectors = np.linalg.eigh(inner)
        use = values > 1e-6 * values[-1]
        root = vectors[:, use] / np.sqrt(values[use])
        kernel = np.concatenate(
            [unit(cells[at : at + 256]) @ marks.T for at in range(0, len(cells), 256)]
        )
        features = np.column_stack([kernel.astype(np.float64) @ root, np.ones(len(cells))])
        wanted = np.where(names[:, None] == np.array(known)[None, :], 1.0, -1.0)
        # Each language counts alike, however many texts it has.
        share = np.array([1 / (names == n).mean() for n in names])
        gram = features.T @ (features * share[:, None]) / len(names)
        ridge = RIDGE * np.eye(len(gram))
        ridge[-1, -1] = 1e-9
        solved = np.linalg.solve(gram + ridge, features.T @ (wanted * share[:, None]) / len(names))
        folded = marks.T @ (root @ solved[:-1]).astype(np.float32)
        return cls(known, folded.astype(np.float32), solved[-1].astype(np.float32))

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The best language of each text and how far towards +1 it is, from 0 to 1."""
        names, scores = [], []
        for at in range(0, len(texts), _ROWS):
            found = [presence(t) for t in texts[at : at + _ROWS]]
            usable = [i for i, f in enumerate(found) if f is not None and self.names]
            rows = [UNDETERMINED] * len(found)
            values = [0.0] * len(found)
            if usable:
                best, value, _ = self.best(np.array([found[i] for i in usable], np.float32))
                for i, b, v in zip(usable, best.tolist(), value.tolist(), strict=True):
                    rows[i], values[i] = self.names[b], round(v, 6)
            names += rows
            scores += values
        return names, scores

    def best(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row of presences the number of the best language, its score and the
        number of n-grams."""
        sizes = batch.sum(axis=1, keepdims=True)
        result = batch @ self.weights / np.sqrt(sizes) + self.bias
        return result.argmax(axis=1), np.clip((result.max(axis=1) + 1) / 2, 0, 1), sizes[:, 0]

    def known(self, texts: list[str | None]) -> list[bool]:
        """Whether each text scores as texts of its best language do."""
        kept = []
        for at in range(0, len(texts), _ROWS):
            found = [presence(t) for t in texts[at : at + _ROWS]]
            usable = [i for i, f in enumerate(found) if f is not None and self.names]
            rows = [False] * len(found)
            if usable:
                best, value, sizes = self.best(np.array([found[i] for i in usable], np.float32))
                enough = value >= self.least[size_class(sizes), best]
                for i, e in zip(usable, enough.tolist(), strict=True):
                    rows[i] = e
            kept += rows
        return kept


def size_class(sizes: np.ndarray) -> np.ndarray:
    return np.searchsorted(SIZES, sizes, side="right") - 1


def least_scores(cells: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Sizes by languages: the score below which a text is taken to be in no learned language.

    Texts are scored by a model of the other half of the texts, foreign ones by a model
    without their language. The least score turns away ``FOREIGN`` of the foreign texts of a
    size, but no more than half of ``LOST`` of the texts that a language and size is found for,
    rightly or not: all of them are in a learned language. Where fewer than ``FEWEST_TEXTS`` are
    known, only what scores no more than any text does goes. Of a single language every text
    scores 1, so nothing is turned away."""
    known = sorted(set(names.tolist()))
    if len(known) < 2:
        return np.zeros((len(SIZES), len(known)))

    def scored(learn: np.ndarray, test: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        model = Languages.fit(cells[learn], names[learn])
        parts = [(np.zeros(0, int), np.zeros(0), np.zeros(0))]
        tested = np.flatnonzero(test) if model.names else []
        for at in range(0, len(tested), 256):
            rows = np.unpackbits(cells[tested[at : at + 256]], axis=1).astype(np.float32)
            parts.append(model.best(rows))
        best, value, sizes = (np.concatenate(p) for p in zip(*parts, strict=True))
        right = np.array(model.names, object)[best] if len(best) else best
        return right, value, size_class(sizes)

    even = np.arange(len(names)) % 2 == 0
    right: dict[tuple[int, str], list[float]] = {}
    for half in (even, ~even):
        for name, value, size in zip(*scored(~half, half), strict=True):
            right.setdefault((size, name), []).append(value)
    foreign: dict[int, list[float]] = {}
    groups = min(len(known), MOST_FITS)
    if len(known) > 2:  # a model of one language has nothing to tell
        number = np.array([known.index(n) for n in names]) % groups
        for group in range(groups):
            _, value, size = scored(number != group, number == group)
            for v, s in zip(value.tolist(), size.tolist(), strict=True):
                foreign.setdefault(s, []).append(v)
    least = np.full((len(SIZES), len(known)), 1 / len(known) + ABOVE)
    for size in range(len(SIZES)):
        others = foreign.get(size, [])
        enough = np.quantile(others, FOREIGN) if len(others) >= FEWEST_FOREIGN else 1.0
        every = [v for n in known for v in right.get((size, n), [])]
        for i, name in enumerate(known):
            own = right.get((size, name), [])
            own = own if len(own) >= FEWEST_TEXTS else every
            if len(own) >= FEWEST_TEXTS:
                least[size, i] = max(least[size, i], min(rare(own), enough))
    return least


def rare(values: list[float]) -> float:
    """A value that a new one falls below with a chance of about ``LOST`` / 2: the j-th
    smallest of n has a chance of j / (n + 1)."""
    j = max(1, int(LOST / 2 * (len(values) + 1)))
    return sorted(values)[j - 1]


def held_out(doc_id: Column) -> Column:
    """Whether CRC-32 of the id's text leaves 1 by 3; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, most: int = MOST_TEXTS) -> Languages:
    """Learn from texts with a language that are not held out."""
    return Languages.fit(*training(docs, per_language, most))


def fit_to_keep(docs: DataFrame, per_language: int = PER_LANGUAGE, most: int = MOST_TEXTS) -> Languages:
    """The same, with the least scores that ``keep_known`` needs."""
    cells, names = training(docs, per_language, most)
    model = Languages.fit(cells, names)
    model.least = least_scores(cells, names)
    return model


def training(docs: DataFrame, per_language: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Presences and languages of texts that are not held out: about ``per_language`` of
    each language by a hash of the id, and no more than ``most`` in all. Only their presence
    bits, ``CELLS / 8`` bytes a text, reach the driver."""
    learnable = docs.select("doc_id", "lang", "text").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    counts = learnable.groupBy("lang").count()
    n = counts.count()
    each = max(1, min(per_language, most // max(1, n)))
    steps = F.broadcast(
        counts.orderBy(F.desc("count"), "lang")
        .limit(most)
        .select(
            F.col("lang").alias("of"),
            F.greatest(F.lit(1), F.floor(F.col("count") / each)).cast("long").alias("step"),
        )
    )
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.col("step"))
    sample = learnable.join(steps, F.col("lang") == F.col("of")).where(draw == 0)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, found = batch.column("lang").to_pylist(), []
            for text in batch.column("text").to_pylist():
                cells = presence(text)
                found.append(None if cells is None else np.packbits(cells).tobytes())
            kept = [i for i, f in enumerate(found) if f is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[i] for i in kept], pa.string()),
                    pa.array([found[i] for i in kept], pa.binary()),
                ],
                ["lang", "cells"],
            )

    rows = sample.select("lang", "text").mapInArrow(bits, "lang string, cells binary")
    # Copies count once, so no group of them makes the sample larger.
    rows = rows.distinct().toPandas().sort_values(["lang", "cells"])
    cells = np.frombuffer(b"".join(rows["cells"]), np.uint8).reshape(len(rows), CELLS // 8)
    return cells, rows["lang"].to_numpy(object)


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row of ``docs`` (doc_id, text).

    Texts that are null or have no letter, and all texts of a model that has learned no
    language, are ``und`` with score 0. A null doc_id is held out. Equal texts get equal
    results. An empty table gives no rows. Other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        "text",
    )
    return rows.mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double"
    )


def keep_known(docs: DataFrame, model: Languages) -> DataFrame:
    """The rows of ``docs`` in a language that ``model``, of ``fit_to_keep``, has learned."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = shared.value.known(batch.column("text").to_pylist())
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(sift, docs.schema)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
