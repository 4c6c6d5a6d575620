import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from tablewinnow.operators.empty import clear_dependents, empty_tables
from tablewinnow.operators.matching import drop_matching
from tablewinnow.sources.tableset import (
    Database,
    Folder,
    Frames,
    clone_tables,
    derived_view_names,
    drop_derived_views,
    select_tables,
    selected_names,
    snapshot_tables,
    write_tables,
)


def test_selected_names():
    names = [
        "datavalue", "analytics_2024", "AggregatedDataValue", "completeness_a", "sys.job",
        "public.users", "public.analytics", "SYS.x", "myanalytics", "other.analytics_x",
    ]
    kept = [
        "datavalue", "AggregatedDataValue", "public.users", "SYS.x", "myanalytics",
        "other.analytics_x",
    ]
    assert selected_names(names) == kept
    assert selected_names(names, exclude=(), exclude_schemas=()) == names
    assert list(select_tables(dict.fromkeys(names))) == kept


@pytest.fixture
def databases(spark):
    names = ("clone_source", "clone_target")
    for name in names:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        spark.sql(f"CREATE DATABASE {name}")
    yield tuple(Database(spark, name) for name in names)
    for name in names:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_clone_replaces_all_but_protected_tables(spark, databases):
    source, target = databases
    for name in ("datavalue", "analytics_x", "organisationunit", "spatial_ref_sys"):
        source.write(name, spark.range(3).withColumnRenamed("id", name[:4]))
    target.write("datavalue", spark.range(9))
    target.write("stale", spark.range(1))
    target.write("spatial_ref_sys", spark.range(5))
    spark.sql("CREATE VIEW clone_target.report AS SELECT * FROM clone_target.stale")
    spark.range(1).createOrReplaceTempView("a_temporary_view")

    copied = clone_tables(source, target, replace=True)
    assert sorted(copied) == ["datavalue", "organisationunit"]
    assert sorted(target.names()) == ["datavalue", "organisationunit", "spatial_ref_sys"]
    assert target.views() == []
    assert rows(target.read("datavalue")) == rows(source.read("datavalue"))
    assert target.read("spatial_ref_sys").count() == 5


def test_a_source_that_reads_the_target_is_copied_before_anything_goes(spark, databases):
    _, target = databases
    target.write("old", spark.range(4))
    source = Frames({"new": target.read("old").filter("id > 1")})
    assert clone_tables(source, target, replace=True) == ["new"]
    assert target.names() == ["new"] and target.read("new").count() == 2


def test_a_failed_copy_leaves_the_target_as_it_was(spark, databases):
    _, target = databases
    target.write("old", spark.range(4))
    broken = spark.range(3).selectExpr("assert_true(id < 0) AS a")
    source = Frames({"fine": spark.range(2), "broken": broken})
    with pytest.raises(Exception, match="is not true"):
        clone_tables(source, target, replace=True)
    assert "old" in target.names() and target.read("old").count() == 4
    assert clone_tables(Frames({"fine": spark.range(2)}), target, replace=True) == ["fine"]
    assert target.names() == ["fine"]


def test_a_database_is_not_cloned_onto_itself(spark, databases):
    _, target = databases
    target.write("old", spark.range(4))
    with pytest.raises(ValueError, match="same database"):
        clone_tables(target, target, replace=True)


def test_a_snapshot_holds_what_is_replaced(spark, databases, tmp_path):
    _, target = databases
    target.write("old", spark.range(4))
    clone_tables(Frames({"new": spark.range(1)}), target, replace=True, snapshot=str(tmp_path))
    (folder,) = tmp_path.iterdir()
    assert Folder(spark, str(folder)).read("old").count() == 4
    assert target.names() == ["new"]


def test_clone_does_not_overwrite_by_itself(spark, databases):
    source, target = databases
    source.write("a", spark.range(3))
    target.write("a", spark.range(9))
    with pytest.raises(AnalysisException):
        clone_tables(source, target)
    assert target.read("a").count() == 9


def test_clone_from_frames(spark, databases):
    _, target = databases
    assert clone_tables(Frames({"t": spark.range(4), "sys.x": spark.range(1)}), target) == ["t"]
    assert target.read("t").count() == 4


def test_a_bucketed_table_is_not_shuffled_for_a_large_key_set(spark, databases):
    target = Database(spark, "clone_target", buckets={"comments": ("event", 4)})
    target.write("comments", spark.range(40).selectExpr("id % 20 AS event", "id AS comment"))
    comments = target.read("comments")
    spark.conf.set("spark.tablewinnow.broadcastBytes", "0")
    try:
        left = drop_matching(comments, spark.range(5).withColumnRenamed("id", "event"), "event")
        plan = left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.tablewinnow.broadcastBytes")
    # The one exchange by key is that of the key set; the table is read by bucket.
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    table_side = plan.split("SortMergeJoin")[1].split("FileScan")[0]
    assert "Exchange" not in table_side
    assert left.count() == 30


def test_write_and_read_back(spark, tmp_path):
    tables = {"a": spark.range(3), "b": spark.range(0)}
    folder = write_tables(tables, str(tmp_path / "out"))
    stored = Folder(spark, folder)
    assert stored.names() == ["a", "b"]
    assert rows(stored.read("a")) == [(0,), (1,), (2,)]
    assert stored.read("b").dtypes == tables["b"].dtypes
    with pytest.raises(AnalysisException):
        write_tables(tables, folder)


@pytest.mark.parametrize("format", ["parquet", "orc", "json"])
def test_formats(spark, tmp_path, format):
    folder = write_tables({"a": spark.range(3)}, str(tmp_path / "out"), format)
    assert rows(Folder(spark, folder, format).read("a")) == [(0,), (1,), (2,)]


def test_a_table_can_be_written_from_a_plan_that_reads_the_old_one(spark, tmp_path):
    first = write_tables({"a": spark.range(10)}, str(tmp_path / "one"))
    pruned = {"a": Folder(spark, first).read("a").filter("id > 6")}
    second = write_tables(pruned, str(tmp_path / "two"))
    assert Folder(spark, first).read("a").count() == 10
    assert Folder(spark, second).read("a").count() == 3


def test_snapshot_keeps_derived_tables(spark, tmp_path):
    tables = {"analytics_1": spark.range(2), "sys.x": spark.range(1), "t": spark.range(1)}
    folder = snapshot_tables(tables, str(tmp_path), "TRAINING", "2024-03-05_0709")
    assert folder.endswith("/TRAINING_2024-03-05_0709")
    assert Folder(spark, folder).names() == ["analytics_1", "t"]


def test_emptying_keeps_schema_and_other_tables(spark):
    tables = {name: spark.range(3) for name in ("datavalue", "datavalueaudit", "dataset")}
    emptied = empty_tables(tables)
    assert {n: df.count() for n, df in emptied.items()} == {
        "datavalue": 0, "datavalueaudit": 0, "dataset": 3,
    }
    assert emptied["datavalue"].dtypes == tables["datavalue"].dtypes
    cleared = clear_dependents(tables)
    assert cleared["datavalue"].count() == 3 and cleared["datavalueaudit"].count() == 0


def test_drop_derived_views(spark, databases):
    _, target = databases
    target.write("t", spark.range(1))
    for view in ("_view_my_report_x", "_view_a_query", "other"):
        spark.sql(f"CREATE VIEW clone_target.{view} AS SELECT * FROM clone_target.t")
    sqlview = spark.createDataFrame(
        [("My Report - X", "VIEW"), ("A query", "QUERY"), ("Never made", "VIEW"), (None, "VIEW")],
        "name string, type string",
    )
    assert rows(derived_view_names(sqlview)) == [
        ("_view_my_report_x",), ("_view_never_made",), (None,),
    ]
    assert drop_derived_views(target, sqlview) == ["_view_my_report_x"]
    assert sorted(target.views()) == ["_view_a_query", "other"]
