"""Alignment against a brute-force version: every pair of tokens compared."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from tablewinnow.llm import alignment

FILES = alignment.vocabularies()
TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "The quick brown fox jumps over the lazy dog.",
    "naïve façade — “quoted” text, 12345 67.89 and\ttabs\r\n\n  lines  ",
    "日本語のテキスト and emoji 🙂👍🏽 mixed",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "a ▁ b",
    "x",
    " ",
    "    leading and trailing    ",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "\x00\x01 control \x7f\x80",
    "é" * 50,
    "",
    None,
    "word " * 3000,
]


def brute(texts):
    """What the contract says, from the libraries' own ids and by comparing all tokens."""
    known = alignment.tokenizers(FILES)
    docs, linked = [], []
    for text in texts:
        a = b = []
        if text:
            a = known._exact.encode(" " + text, add_special_tokens=False).ids
            b = known._pieces.encode(text)
            own = b" " + text.encode()
            spelt = b"".join(known.a_bytes[i] for i in a) == own
            if not spelt or b"".join(known.b_bytes[i] for i in b) != own:
                a = b = []
        spans = []
        for ids, table in ((a, known.a_bytes), (b, known.b_bytes)):
            at, own_spans = 0, []
            for i in ids:
                own_spans.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(own_spans)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        for cut in cuts:
            inside = [[i for s, e, i in own if start <= s and e <= cut] for own in spans]
            groups.append("|".join(",".join(map(str, ids)) for ids in inside))
            start = cut
        links, b_from = [], 0
        for s, e, i in spans[0]:
            while b_from < len(spans[1]) and spans[1][b_from][1] <= s:
                b_from += 1
            for t, f, j in spans[1][b_from:]:
                if t >= e:
                    break
                links.append((i, j))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        docs.append((len(a), len(b), len(groups), len(links), digest))
        linked.append(links)
    counts = Counter(p for links in linked for p in set(links))
    highest = defaultdict(int)
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    return [
        (*doc[:4], sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links), doc[4])
        for doc, links in zip(docs, linked)
    ]


COLUMNS = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def check(spark, texts, **options):
    rows = [(i, t, "x", "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, codes string, part string")
    found = alignment.align_documents(docs.repartition(3), FILES, **options).collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found}
    assert len(found) == len(texts)
    assert got == dict(enumerate(brute(texts)))


@pytest.mark.parametrize("frequent", [1 << 20, 20, 0])
def test_against_brute_force(spark, frequent):
    """All pairs broadcast, some, none."""
    check(spark, TEXTS, frequent=frequent)


def test_random_texts(spark):
    rng = random.Random(7)
    parts = ["the", "Straße", " ", "\n", "Überraschung", "ing", "0", "42", "…", "🙂", "don't", "'s", "ﬁ"]
    check(spark, ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(200)], frequent=50)


def test_given_documents_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 500)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in docs.select("text").limit(60).collect()]
    known = alignment.tokenizers(FILES)
    whole = alignment.align(list(known.both([t or "" for t in texts])), known)
    expected = brute(texts)
    assert [*zip(whole.n_a, whole.n_b, whole.n_groups, whole.n_links, whole.digests)] == [
        (*e[:4], e[6]) for e in expected
    ]
    check(spark, texts)


def test_null_and_repeated_ids_and_no_rows(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)], schema)
    found = alignment.align_documents(docs, FILES).collect()
    assert sorted((str(r.doc_id), r.n_links, r.count_sum) for r in found) == [
        ("1", 2, 6), ("1", 2, 6), ("2", 0, 0), ("None", 2, 6),
    ]
    assert alignment.align_documents(spark.createDataFrame([], schema), FILES).collect() == []
