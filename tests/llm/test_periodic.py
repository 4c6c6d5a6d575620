"""Runs against a brute-force version that walks along every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tablewinnow.llm import periodic


def brute(words):
    """(start, length, period) of all runs: per period the stretches in which words a period
    apart agree; a stretch belongs to its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q) and j > i:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def odd_words(rng, n):
    kinds = rng.choice([1, 2, 2, 3, 6, 40])
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 4:
            a = rng.randrange(n)
            q = rng.randint(1, max(1, (n - a) // 2))
            for i in range(a + q, min(n, a + q * rng.randint(2, 6))):
                words[i] = words[i - q]
    return words


@pytest.mark.parametrize("section", [periodic.SECTION, 64, 16])
def test_runs_of_random_words(monkeypatch, section):
    """Short sections, so that runs are cut into fragments and stitched."""
    monkeypatch.setattr(periodic.sections, "__defaults__", (section,))
    rng = random.Random(section)
    for _ in range(600):
        words = odd_words(rng, rng.randint(0, 150))
        assert periodic.runs_of(np.array(words, np.int32)) == brute(words)


def test_sections_cover_all_words_and_overlap():
    for n in (0, 1, 5, 100, 1000, 4321):
        for octave in range((n // 2).bit_length()):
            own = sorted((s, e) for f, last, s, e in periodic.sections(n, 32) if f <= octave <= last)
            assert own[0][0] == 0 and max(e for _, e in own) == n
            for (_, end), (start, _) in zip(own, own[1:]):
                assert end == n or end - start >= 2 * (2 << octave)


def described(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    written = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id,
        len(runs),
        *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4),
        hashlib.sha256(written.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


COLUMNS = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def check(spark, rows, section=periodic.SECTION):
    extra = [(*r, "x", "x", "x") for r in rows]
    schema = "doc_id long, text string, words string, row string, start string"
    docs = spark.createDataFrame(extra, schema).repartition(3)
    found = [tuple(r[c] for c in COLUMNS) for r in periodic.find_runs(docs, section).collect()]
    assert sorted(found, key=repr) == sorted((described(*r) for r in rows), key=repr)


@pytest.mark.parametrize("section", [periodic.SECTION, 32])
def test_documents(spark, section):
    rng = random.Random(3)
    rows = [(i, " ".join(map(str, odd_words(rng, rng.randint(0, 300))))) for i in range(300)]
    check(spark, rows, section)


def test_odd_rows(spark):
    again = "to be or not to be that is the question whether " * 3
    check(
        spark,
        [
            (None, again),
            (None, None),
            (1, again),
            (1, again),
            (1, None),
            (2, ""),
            (3, " \t\r\n\x0b\x0c "),
            (4, "a b   a b " * 9),
            (5, "one " * 5000),
            *((i, "we hold these truths to be self evident that all men " * 2) for i in range(20, 60)),
        ],
    )
    assert periodic.find_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.where("length(text) < 6000").collect()]
    assert len(rows) > 100
    check(spark, rows, 256)
