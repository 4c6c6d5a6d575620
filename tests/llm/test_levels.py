"""Trees below trees: large leaves are divided level by level, with the same links."""

import random

import numpy as np
import pytest

from tablewinnow.llm import near_dedup


def clusters(draw, n, spread):
    points = set()
    while len(points) < n:
        center = draw.getrandbits(64)
        for _ in range(draw.randrange(1, 6)):
            point = center
            for _ in range(draw.randrange(spread)):
                point ^= 1 << draw.randrange(64)
            points.add(point)
    return sorted(points)


def brute(points, radius):
    """The least member of the component of each point."""
    array = np.array(points, np.uint64)
    least = np.arange(len(array))
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= radius
    while True:
        lower = np.array([least[row].min() for row in near])
        if (lower == least).all():
            return {int(p): int(array[i]) for p, i in zip(points, least, strict=True)}
        least = lower


@pytest.mark.parametrize("tight", [False, True])
def test_levels_equal_brute_force(spark, monkeypatch, tight):
    """The first tree has few leaves; in the tight case a leaf cannot be divided."""
    draw = random.Random(6)
    points = clusters(draw, 3000, 4)
    if tight:
        base = draw.getrandbits(64)
        points = sorted({*points, *(base ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i))})
    levels = []
    split = near_dedup._split_large

    def counted(*args):
        found = split(*args)
        levels.append(found is not None)
        return found

    monkeypatch.setattr(near_dedup, "_split_large", counted)
    monkeypatch.setattr(near_dedup, "TREE_SAMPLE", 64)
    monkeypatch.setattr(near_dedup, "LEAF_SAMPLE", 16)
    monkeypatch.setattr(near_dedup, "LEAF_TREE_SAMPLE", 60)
    monkeypatch.setattr(near_dedup, "LEAF_MOST", 40)
    frame = spark.createDataFrame(
        [(i, near_dedup._signed(p)) for i, p in enumerate(points)], "doc_id long, fingerprint long"
    )
    rows = near_dedup.labels(frame, 2).collect()
    found = {r.fingerprint: r.component_id for r in rows}
    assert len(rows) == len(points)
    numbered = {p: i for i, p in enumerate(points)}
    expected = brute(points, 2)
    assert found == {near_dedup._signed(p): numbered[expected[p]] for p in points}
    assert sum(levels) >= 3
    if not tight:
        assert not levels[-1]
