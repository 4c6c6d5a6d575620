"""Mixing where ids are null or repeated: targets are met, and SQL takes as much."""

import random
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest

from tablewinnow.llm import mixing


def words(draw, n):
    return " ".join(draw.choice("abcdefgh") for _ in range(n))


def tables():
    draw = random.Random(4)
    distinct = [(None if i % 3 == 0 else i, words(draw, 10) + f" x{i}", "s") for i in range(3000)]
    distinct += [(i, words(draw, 10), "t") for i in range(2000)]
    equal = [(1, "ten words " * 5, "s")] * 1000 + [(i, words(draw, 10), "t") for i in range(2000)]
    one = [(None, "same text here", None)] * 500 + [(None, "same text here", "a")] * 40
    mixed = [
        (draw.choice([None, 1, 2, 3]), draw.choice([None, "", "a b c", "a b c d e f"]), draw.choice("ab"))
        for _ in range(900)
    ]
    return {"null ids": distinct, "equal rows": equal, "one text": one, "few of each": mixed}


@pytest.mark.parametrize("name", tables())
def test_null_and_repeated_ids(spark, name):
    rows = tables()[name]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    found = mixing.mix(docs).collect()
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in found:
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
        assert r.taken <= 3 * r["size"]
    for source, words_taken in taken.items():
        assert abs(words_taken - target[source]) <= largest[source]
    key = ["doc_id", "size", "source_size", "target", "taken", "copies"]
    outcome = Counter(tuple(r[c] for c in key) for r in found)
    again = mixing.mix(docs.repartition(2)).collect()
    assert Counter(tuple(r[c] for c in key) for r in again) == outcome

    connection = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    connection.register("documents", frame)
    by_sql = connection.execute(f"SELECT {', '.join(key)} FROM ({mixing.ORACLE})").fetchall()
    assert Counter(by_sql) == outcome

    repeats = Counter(tuple(r) for r in mixing.repeated(docs).collect())
    copies = Counter()
    for r in found:
        copies[r.doc_id, r.source, r["size"]] += r.copies
    sizes = Counter()
    for (doc_id, text, source), n in repeats.items():
        sizes[doc_id, source, len((text or "").split())] += n
    assert sizes == +copies
