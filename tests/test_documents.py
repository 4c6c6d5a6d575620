"""Large documents: cut anywhere, they give the tables that a single task reads."""

import json
import random

import pytest
from conftest import rows

from tablewinnow.sources.directory import read_metadata
from tablewinnow.sources.documents import MalformedDocument

ODD = ['plain', '"', "\\", '\\"', "{", "}", "[", "]", '{"id":1}', ",", "é🙂", "\n", "\t\\\\", "null", "x" * 300, ""]


def document(seed, n=60):
    draw = random.Random(seed)

    def thing(i):
        one = {"id": f"i{i}", draw.choice(["name", "na\"me", "[k]"]): draw.choice(ODD)}
        if draw.random() < 0.4:
            one["nested"] = {"list": [{"id": draw.choice(ODD)}, {"id": "z"}], "text": draw.choice(ODD)}
        if draw.random() < 0.3:
            one["size"] = draw.choice([1, 2.5, None, True])
        return one

    return {
        "system": {"version": "2", "lists": [{"id": "no"}], "deep": {"users": [{"id": "no"}]}},
        "users": [thing(i) for i in range(n)],
        "date": '2024 "users": [{"id":"no"}]',
        "names": ["a", "b", '{"id":"no"}'],
        "mixed": [{"id": "a"}, 5],
        "nested": [[{"id": "no"}]],
        "empty": [],
        'data"Sets': [thing(i) for i in range(n // 2)],
        "one": [{"id": "only"}],
        "count": 7,
    }


def same(found, expected):
    assert set(found) == set(expected)
    for name, table in expected.items():
        assert found[name].dtypes == table.dtypes
        assert rows(found[name]) == rows(table)


@pytest.mark.parametrize("layout", [None, 2, "\t"])
@pytest.mark.parametrize("size", [97, 1000])
def test_cut_documents_equal_whole_ones(spark, tmp_path, layout, size):
    path = str(tmp_path / "d.json")
    with open(path, "w") as file:
        json.dump(document(size, 40), file, indent=layout, ensure_ascii=size == 97)
    whole = read_metadata(spark, path)
    assert set(whole) == {"users", 'data"Sets', "one"}
    same(read_metadata(spark, path, whole_bytes=10, range_bytes=size), whole)


def test_runs_of_backslashes_across_ranges(spark, tmp_path):
    path = tmp_path / "d.json"
    users = [{"id": "\\" * n + '"' * (n % 3), "t": "}" * n} for n in range(60)]
    path.write_text(json.dumps({"users": users}))
    for size in (1, 2, 3, 16):
        if size > 3 or path.write_text(json.dumps({"users": users[:8]})):
            found = read_metadata(spark, str(path), whole_bytes=1, range_bytes=size)
            whole = read_metadata(spark, str(path))
            same(found, whole)
        path.write_text(json.dumps({"users": users}))


@pytest.mark.parametrize(
    "text", ['{"users":[{"id":"a"}', '{"users":[{"id":"a}]}', '{"users":[{"id":"a"}]}}', '{"a":[{"id":1}]} ]']
)
def test_malformed_documents_are_errors(spark, tmp_path, text):
    path = tmp_path / "d.json"
    path.write_text(text)
    with pytest.raises(MalformedDocument):
        read_metadata(spark, str(path), whole_bytes=1, range_bytes=5)


def test_other_values_are_read_whole(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text('\n [{"users":[{"id":"a"}]},{"users":[{"id":"b"}]}]')
    found = read_metadata(spark, str(path), whole_bytes=1, range_bytes=5)
    assert rows(found["users"]) == [("a",), ("b",)]


def test_a_large_document_is_read_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "d.json")
    one = json.dumps({"id": "I", "name": 'a "quoted" {name]', "text": "y" * 900})
    with open(path, "w") as file:
        file.write('{"users":[')
        file.write(",\n".join(one.replace("I", str(i), 1) for i in range(200_000)))
        file.write('],"groups":[{"id":"g"}]}')
    tables = read_metadata(spark, path)
    users = tables["users"]
    assert users.rdd.getNumPartitions() > 1
    total = users.selectExpr("count(*)", "sum(cast(id AS long))", "count(distinct name)").first()
    assert tuple(total) == (200_000, sum(range(200_000)), 1)
    assert rows(tables["groups"]) == [("g",)]
