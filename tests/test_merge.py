import random

import pytest
from conftest import rows

from tablewinnow.operators.merge import merge_all, merge_metadata, merge_summary

SCHEMA = "id long, name string, size int"


def test_merge(join_path, spark):
    target = spark.createDataFrame(
        [(1, "a", 1), (2, "b", 2), (None, "n", 0)], SCHEMA
    )
    source = spark.createDataFrame(
        [(2, None, 5), (3, "c", None), (None, "x", 9), (3, "c", None), (2, None, 5)], SCHEMA
    )
    assert rows(merge_metadata(target, source)) == [
        (1, "a", 1), (2, "b", 5), (3, "c", None), (None, "n", 0),
    ]
    assert rows(merge_summary(target, source)) == [(5, 1, 1, 0, 3)]


def test_repeats_do_not_depend_on_partitioning(spark):
    target = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    source = spark.createDataFrame([(1, f"n{i}", i) for i in range(9)], SCHEMA)
    merged = {tuple(rows(merge_metadata(target, source.repartition(n)))) for n in (1, 3, 7)}
    assert merged == {((1, "n8", 8),)}


def test_columns_and_types_of_the_target_are_kept(spark):
    target = spark.createDataFrame([("a", 1, "z"), ("b", 2, None)], "id string, n int, own string")
    source = spark.createDataFrame(
        [("a", 7, True), ("c", 8, False)], "id string, n long, new boolean"
    )
    merged = merge_metadata(target, source)
    assert merged.dtypes == target.dtypes
    assert rows(merged) == [("a", 7, "z"), ("b", 2, None), ("c", 8, None)]


def test_empty_sides(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    assert rows(merge_metadata(nothing, some)) == rows(merge_metadata(some, nothing)) == rows(some)
    assert rows(merge_summary(nothing, some)) == [(1, 1, 0, 0, 0)]
    assert rows(merge_summary(some, nothing)) == [(0, 0, 0, 0, 0)]


def test_map_and_variant_columns(spark):
    target = spark.sql("SELECT 1 AS id, map('a', 1) AS m, parse_json('[1]') AS v")
    source = spark.sql(
        "SELECT * FROM VALUES (1, map('b', 2), parse_json('[2]')), "
        "(1, map('a', 9), parse_json('[3]')), (2, null, null) AS s(id, m, v)"
    )
    merged = merge_metadata(target, source).selectExpr("id", "to_json(m)", "to_json(v)")
    assert rows(merged) == [(1, '{"b":2}', "[2]"), (2, None, None)]


def in_turn(target, sources):
    counts = []
    for source in sources:
        counts.append(merge_summary(target, source).first().asDict())
        target = merge_metadata(target, source)
    return target, counts


@pytest.mark.parametrize("seed", range(3))
def test_all_files_at_once_equal_files_in_turn(join_path, spark, seed):
    """Null and repeated keys, attributes that some file lacks, other types, an empty file."""
    draw = random.Random(seed)

    def some(n, *kinds):
        return [
            tuple(draw.choice([None, draw.randrange(9)]) if k == "n" else draw.choice([None, "a", "b", "c"])
                  for k in kinds)
            for _ in range(n)
        ]

    target = spark.createDataFrame([(i, "t", i) for i in range(4)] + [(None, "n", 0)], SCHEMA)
    sources = [
        spark.createDataFrame(some(12, "n", "s", "n"), SCHEMA),
        spark.createDataFrame(some(12, "n", "n"), "size int, id int"),
        spark.createDataFrame([], SCHEMA),
        spark.createDataFrame(some(12, "n", "s"), "id string, other string"),
        spark.createDataFrame(some(12, "n", "s", "n"), SCHEMA),
    ]
    merged, counts = merge_all(target, sources)
    expected, expected_counts = in_turn(target, sources)
    assert rows(merged) == rows(expected) and merged.dtypes == target.dtypes
    assert counts == expected_counts


def test_map_columns_from_several_files(spark):
    target = spark.sql("SELECT 1 AS id, map('a', 1) AS m")
    sources = [spark.sql(f"SELECT * FROM VALUES ({n}, map('b', {n})) AS s(id, m)") for n in (1, 2, 1)]
    merged, counts = merge_all(target, sources)
    assert rows(merged.selectExpr("id", "to_json(m)")) == [(1, '{"b":1}'), (2, '{"b":2}')]
    assert [c["updated"] for c in counts] == [1, 0, 1]


def test_the_target_is_read_twice_for_any_number_of_files(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        reads.add(1)
        yield from batches

    target = spark.range(50).coalesce(1).selectExpr("id", "'old' AS name").mapInArrow(counted, "id long, name string")
    for n in (1, 3, 9):
        before = reads.value
        sources = [spark.createDataFrame([(i, f"v{i}"), (100, "new")], "id long, name string") for i in range(n)]
        merged, counts = merge_all(target, sources)
        merged.write.format("noop").mode("overwrite").save()
        assert reads.value - before == 2
        assert [c["created"] for c in counts] == [1] + [0] * (n - 1)
