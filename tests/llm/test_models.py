"""Models against plain versions of what they solve: kernels, ridge regression, likelihoods."""

import math
import random

import numpy as np
import pytest

from tablewinnow.llm import language, toxicity

SOUNDS = {"xa": "aeiou bcd", "yb": "äöü stz ei", "zc": "ñáé rrl que"}


def corpus(seed, n):
    draw = random.Random(seed)
    names = [draw.choice(list(SOUNDS)) for _ in range(n)]
    return names, [
        " ".join("".join(draw.choice(SOUNDS[name]) for _ in range(draw.randrange(2, 9))) for _ in range(draw.randrange(3, 30)))
        for name in names
    ]


def grams(text):
    """Runs of one to three characters, letters folded to lower case, all else a blank."""
    plain = "".join(c if c.isalpha() else " " for c in text.lower())
    return {(n, plain[i : i + n]) for n in (1, 2, 3) for i in range(len(plain) - n + 1)}


def cell(order, gram):
    code = 0
    for c in gram:
        code = (code << 21) | ord(c)
    return ((code * 0x9E3779B97F4A7C15 + order) % 2**64) >> 49


@pytest.mark.parametrize("text", ["Ein Satz, und 2 mehr!", "a", "ÀÉ ñ\n\tß", "日本 語 x", "aaaa" * 50, " .x. "])
def test_presence_is_that_of_all_grams(text, monkeypatch):
    expected = {cell(*g) for g in grams(text)}
    for chunk in (1 << 20, 3, 5):
        monkeypatch.setattr(language, "_CHUNK", chunk)
        assert set(np.flatnonzero(language.presence(text)).tolist()) == expected


def test_scores_are_those_of_kernel_ridge_regression():
    """With a landmark per text the approximation is exact: solve the same with the kernel itself."""
    names, texts = corpus(1, 90)
    _, asked = corpus(2, 40)
    cells = np.array([np.packbits(language.presence(t)) for t in texts])
    model = language.Languages.fit(cells, np.array(names, object), landmarks=len(texts))

    def sets(many):
        return [{cell(*g) for g in grams(t)} for t in many]

    def kernel(some, others):
        return np.array([[len(a & b) / math.sqrt(len(a) * len(b)) for b in others] for a in some])

    own = sets(texts)
    k, n, known = kernel(own, own), len(texts), sorted(set(names))
    wanted = np.array([[1.0 if name == other else -1.0 for other in known] for name in names])
    share = np.sqrt([n / names.count(name) / n for name in names])
    values, vectors = np.linalg.eigh(k)
    root = vectors * np.sqrt(np.maximum(values, 0)) @ vectors.T
    # Weighted squares, plus the ridge on the function's norm and hardly any on the intercept.
    left = np.vstack([
        np.column_stack([share[:, None] * k, share]),
        np.column_stack([math.sqrt(language.RIDGE) * root, np.zeros(n)]),
        np.append(np.zeros(n), math.sqrt(1e-9)),
    ])
    right = np.vstack([share[:, None] * wanted, np.zeros((n + 1, len(known)))])
    solved = np.linalg.lstsq(left, right, rcond=None)[0]
    outputs = kernel(sets(asked), own) @ solved[:-1] + solved[-1]
    found, scores = model.score(asked)
    assert found == [known[i] for i in outputs.argmax(axis=1)]
    assert np.allclose(scores, np.clip((outputs.max(axis=1) + 1) / 2, 0, 1), atol=2e-3)


def test_held_out_languages(spark):
    """At least 97 % of the documents that were not learned from."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    judged = language.identify(docs, language.fit(docs)).where("held_out").drop("held_out")
    both = judged.join(docs.select("doc_id", "lang"), "doc_id").where("lang IS NOT NULL")
    right, n = both.selectExpr("count_if(lang = lang_pred)", "count(*)").first()
    assert n > 3000 and right > 0.97 * n


def loss(weights, cuts, held, grades):
    """Mean negative log-likelihood with the ridge, one text after the other."""
    total = 0.0
    for own, grade in zip(held, grades):
        score = sum(weights[i] for i in own)
        upto = [0.0, *(1 / (1 + math.exp(-(c - score))) for c in cuts), 1.0]
        total -= math.log(upto[grade + 1] - upto[grade])
    return (total + toxicity.RIDGE / 2 * sum(w * w for w in weights)) / len(held)


def test_the_fit_is_a_minimum_of_the_likelihood():
    draw = np.random.default_rng(3)
    held, grades = [], []
    for _ in range(150):
        own = np.flatnonzero(draw.random(6) < 0.4)
        score = own.sum() / 2 + draw.normal(0, 1.5)
        held.append(own)
        grades.append(int(np.searchsorted([1.0, 3.0, 5.0], score)))
    words = list("abcdef")
    model = toxicity.Ordinal.fit(words, held, np.array(grades))
    weights, cuts = [model.weights[w] for w in words], model.thresholds.tolist()
    assert cuts == sorted(cuts)
    at = [*weights, *cuts]

    def value(point):
        return loss(point[:6], point[6:], held, grades)

    for i in range(len(at)):
        step = [0.0] * len(at)
        step[i] = 1e-4
        up, down = ([a + sign * s for a, s in zip(at, step)] for sign in (1, -1))
        assert abs(value(up) - value(down)) / 2e-4 < 5e-3
    for _ in range(50):
        other = [a + d for a, d in zip(at, draw.normal(0, 0.2, len(at)))]
        if sorted(other[6:]) == other[6:]:
            assert value(other) > value(at)


def test_chances_of_grades():
    model = toxicity.Ordinal({"bad": 1.5, "awful": 2.0}, np.array([0.5, 1.5, 2.5]))
    for text, score in (("Bad day", 1.5), ("awful, awful and bad", 3.5), ("", 0.0), (None, 0.0)):
        expected = [1 - 1 / (1 + math.exp(-(c - score))) for c in (0.5, 1.5, 2.5)]
        assert np.allclose(model.above([text])[0], expected)
