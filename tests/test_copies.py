"""Copies that are proven complete, and replacements that go on where they stopped."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablewinnow.operators.digest import Digest, Observed, digest
from tablewinnow.sources import tableset
from tablewinnow.sources.tableset import (
    Database,
    Folder,
    Frames,
    IncompleteCopy,
    Jdbc,
    check_copy,
    clone_tables,
    write_tables,
)


@pytest.fixture(scope="module")
def table(spark):
    content = [(i, None if i % 3 else f"v{i}", i / 7, [i], {"k": i}) for i in range(50)] + [(1, None, None, None, None)] * 3
    return spark.createDataFrame(content, "id long, v string, d double, a array<int>, m map<string,int>")


def test_digests_do_not_depend_on_order(table):
    assert digest(table) == digest(table.repartition(7)) == digest(table.orderBy(F.desc("id")))
    assert digest(table).row_count == 53 and digest(table.limit(0)) == Digest(0, 0, 0)


def test_digests_tell_every_change(spark, table):
    others = [
        table.filter("id != 7"),
        table.union(table.filter("id = 7")),
        table.filter("id != 7").union(table.filter("id = 8")),
        table.withColumn("v", F.when(F.col("id") == 3, "x").otherwise(F.col("v"))),
        table.withColumn("d", F.when(F.col("id") != 3, F.col("d"))),
        table.withColumn("m", F.when(F.col("id") != 3, F.col("m"))),
        table.withColumn("a", F.when(F.col("id") == 3, F.array(F.lit(4))).otherwise(F.col("a"))),
        # As many rows, and the same values, in other columns.
        table.select(F.col("id"), "v", F.col("d"), "a", "m").withColumn("id", F.when(F.col("id") != 5, F.col("id"))),
    ]
    found = [digest(table), *map(digest, others)]
    assert len(set(found)) == len(found)
    swapped = spark.createDataFrame([(None, "a"), ("b", None)], "x string, y string")
    other = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    assert digest(swapped) != digest(other)


def test_digests_are_taken_while_writing(table, tmp_path):
    observed = Observed(table)
    observed.frame.write.parquet(str(tmp_path / "t"))
    assert observed.digest == digest(table)


def test_changed_and_doubled_rows_are_refused(spark, table):
    for copy in (table.union(table.limit(1)), table.filter("id != 7"), table.withColumn("id", F.col("id") + 1)):
        with pytest.raises(IncompleteCopy, match="things"):
            check_copy("things", table, copy, digest(table))
    check_copy("things", table, table.repartition(3), digest(table))
    # What was counted while writing may be too much; the source decides.
    check_copy("things", table, table, digest(table.union(table)))


def test_verified_folders(spark, table, tmp_path):
    folder = write_tables({"t": table, "e": table.limit(0)}, str(tmp_path / "f"), verify=True)
    assert Folder(spark, folder).read("t").count() == 53


class Lossy(Database):
    """Writes a row too few of one table."""

    def write(self, name, df, staged=False):
        super().write(name, df.limit(2) if name == "b" else df, staged)


@pytest.fixture
def target(spark):
    spark.sql("DROP DATABASE IF EXISTS copies CASCADE")
    spark.sql("CREATE DATABASE copies")
    yield Database(spark, "copies")
    spark.sql("DROP DATABASE IF EXISTS copies CASCADE")


def test_nothing_is_replaced_by_an_incomplete_copy(spark, target):
    target.write("old", spark.range(4))
    source = Frames({"a": spark.range(3), "b": spark.range(3)})
    with pytest.raises(IncompleteCopy, match="b"):
        clone_tables(source, Lossy(spark, "copies"), replace=True, verify=True)
    assert rows(target.read("old")) == rows(spark.range(4))
    assert clone_tables(source, target, replace=True, verify=True) == ["a", "b"]
    assert target.names() == ["a", "b"]


class Stopped(RuntimeError):
    pass


@pytest.mark.parametrize("after", range(8))
def test_a_replacement_goes_on_where_it_stopped(spark, target, monkeypatch, after):
    """It stops before or after each of its six steps; the next call ends in the same tables."""
    for name in ("a", "old", "older"):
        target.write(name, spark.range(9))
    spark.sql("CREATE VIEW copies.report AS SELECT * FROM copies.old")
    source = Frames({"a": spark.range(3), "b": spark.range(5)})
    taken, take = [0], Database._take

    def stopping(self, action, name):
        if taken[0] == after // 1 and after < 6:
            raise Stopped
        taken[0] += 1
        take(self, action, name)
        if after >= 6 and taken[0] == after - 5:
            raise Stopped

    monkeypatch.setattr(Database, "_take", stopping)
    with pytest.raises(Stopped):
        clone_tables(source, target, replace=True)
    monkeypatch.setattr(Database, "_take", take)
    assert not any(n.startswith(tableset.JOURNAL) for n in target.names())
    if after % 2:
        assert target.recover() and not target.recover()
    else:
        # A copy of something else first completes the one before.
        clone_tables(Frames({}), target)
    assert sorted(target.names()) == ["a", "b"] and target.views() == []
    assert target.read("a").count() == 3 and target.read("b").count() == 5
    assert not [t for t in spark.catalog.listTables("copies") if t.name.startswith("_tw_")]


def test_a_replacement_that_stopped_before_its_journal_changes_nothing(spark, target, monkeypatch):
    target.write("old", spark.range(4))
    monkeypatch.setattr(Database, "replace_by_staged", lambda *_: (_ for _ in ()).throw(Stopped()))
    with pytest.raises(Stopped):
        clone_tables(Frames({"a": spark.range(3)}), target, replace=True)
    monkeypatch.undo()
    assert not target.recover() and target.read("old").count() == 4
    clone_tables(Frames({"a": spark.range(3)}), target, replace=True)
    assert target.names() == ["a"]


def test_jdbc_tables_without_partitioning_are_refused(spark):
    with pytest.raises(ValueError, match="partitioning"):
        Jdbc(spark, "jdbc:none").read("large")
