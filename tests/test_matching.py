import pytest
from conftest import rows

from tablewinnow.operators.matching import (
    KeySet,
    attach,
    drop_matching,
    flag_matching,
    keep_matching,
)
from tablewinnow.settings import (
    broadcast_up_to,
    concurrently,
    ensure_checkpoint_dir,
    materialise,
)


@pytest.fixture(scope="module")
def fact(spark):
    # A third of the rows share one key and are copies of each other; another
    # key is frequent, some are null.
    content = [(1, "same")] * 40 + [(2, f"v{i}") for i in range(20)]
    content += [(None, "null")] * 20 + [(i, "rare") for i in range(3, 43)]
    return spark.createDataFrame(content, "k long, v string").repartition(5)


@pytest.fixture(scope="module")
def keys(spark):
    return spark.createDataFrame([(1,), (5,), (5,), (99,), (None,)], "k long")


def plain(fact):
    return [tuple(r) for r in fact.collect()]


def test_keep_and_drop_split_the_rows(join_path, fact, keys):
    kept, dropped = keep_matching(fact, keys, "k"), drop_matching(fact, keys, "k")
    wanted = [r for r in plain(fact) if r[0] in (1, 5)]
    assert rows(kept) == sorted(wanted, key=repr)
    assert rows(dropped) == sorted([r for r in plain(fact) if r[0] not in (1, 5)], key=repr)
    assert kept.columns == dropped.columns == fact.columns


def test_attach_does_not_repeat_rows(join_path, spark, fact):
    marks = KeySet(spark.createDataFrame([(1, 10), (3, 30), (77, 70)], "k long, m int"))
    marked = attach(fact, marks, "k")
    value = {1: 10, 3: 30}
    assert rows(marked) == sorted([(*r, value.get(r[0])) for r in plain(fact)], key=repr)


def test_flag(join_path, fact, keys):
    flagged = flag_matching(fact, keys, "k", "hit")
    assert rows(flagged) == sorted([(*r, r[0] in (1, 5)) for r in plain(fact)], key=repr)


def test_two_column_keys(join_path, spark, fact):
    pairs = spark.createDataFrame([(1, "same"), (2, "v3"), (2, None)], "k long, v string")
    left = rows(drop_matching(fact, pairs, ["k", "v"]))
    assert left == sorted(
        [r for r in plain(fact) if r not in ((1, "same"), (2, "v3"))], key=repr
    )


def test_empty_keys(join_path, spark, fact):
    nothing = spark.createDataFrame([], "k long")
    assert rows(keep_matching(fact, nothing, "k")) == []
    assert rows(drop_matching(fact, nothing, "k")) == rows(fact)


def test_size_is_measured_over_all_column_kinds(spark):
    schema = "i int, s string, a array<int>, m map<string,int>"
    small = spark.createDataFrame([(1, "abc", [1], {"a": 1})] * 3, schema)
    large = spark.createDataFrame([(1, "x" * 500, [1], {"a": 1})] * 3, schema)
    assert 0 < KeySet(small).size < KeySet(large).size
    assert KeySet(small.limit(0)).empty


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_small_key_set_is_broadcast_and_nothing_is_shuffled(fact, keys, tmp_path, spark):
    fact.write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    plan = plan_of(drop_matching(stored, keys, "k"))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


@pytest.fixture
def nothing_small(spark):
    spark.conf.set("spark.tablewinnow.broadcastBytes", "0")
    yield
    spark.conf.unset("spark.tablewinnow.broadcastBytes")


def test_a_large_key_set_is_shuffled_once(fact, keys, nothing_small, tmp_path, spark):
    fact.write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    left = drop_matching(drop_matching(stored, keys, "k"), keys, "k")
    plan = plan_of(left)
    assert plan.count("FileScan") == 1 and plan.count("SortMergeJoin") == 2
    assert "LeftAnti" in plan and "Broadcast" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_the_checkpoint_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert named in ensure_checkpoint_dir(spark)
    kept = materialise(spark.range(5))
    assert rows(kept) == [(0,), (1,), (2,), (3,), (4,)]


def test_jobs_side_by_side_return_in_order(spark):
    jobs = [lambda n=n: spark.range(n).count() for n in (3, 1, 2)]
    assert concurrently(*jobs) == [3, 1, 2]
    with pytest.raises(ZeroDivisionError):
        concurrently(lambda: 1, lambda: 1 // 0)


IDS = [0, 1, 2, 63, 64, 32767, 32768, 32769, 65536, -1, -2, -32768, -32769, 2**40, -(2**40), None]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["long", "int"])
def test_bitmaps_hold_every_id(spark, kind):
    """Zero, both ends of words and buckets, negative ids, far ones, null, repeated rows."""
    ids = [i for i in IDS if i is None or kind == "long" or abs(i) < 2**31]
    fact = spark.createDataFrame([(i, n) for n, i in enumerate(ids * 2)], f"k {kind}, v int")
    for chosen in (ids[::2], ids[1::2], ids[:3], ids[-3:], [None]):
        keys = KeySet(spark.createDataFrame([(i,) for i in chosen] * 20_000, f"k {kind}"))
        with broadcast_up_to(keys.size - 1):
            assert not keys.small and keys.bitmap is not None
            inside = {i for i in chosen if i is not None}
            kept, dropped = keep_matching(fact, keys, "k"), drop_matching(fact, keys, "k")
            flagged = flag_matching(fact, keys, "k", "hit")
            for df in (kept, dropped, flagged):
                assert "SortMergeJoin" not in plan_of(df) and "BroadcastHashJoin" in plan_of(df)
        assert rows(kept) == rows(fact.filter(fact.k.isin(inside)))
        assert kept.columns == dropped.columns == fact.columns
        assert sorted(kept.union(dropped).collect(), key=repr) == sorted(fact.collect(), key=repr)
        assert {(r.k, r.hit) for r in flagged.collect()} == {(i, i in inside) for i in ids}


def test_a_million_dense_ids_need_no_shuffle_of_the_fact(spark):
    """Rows of the ids take 48 MB, their bits 130 kB; the limit is 1 MB."""
    fact = spark.range(0, 3_000_000).selectExpr("id % 1500000 AS k", "id AS v")
    keys = KeySet(spark.range(0, 2_000_000, 2).toDF("k"))
    with broadcast_up_to(1 << 20):
        assert not keys.small and keys.bitmap.size < 1 << 18
        kept = keep_matching(fact, keys, "k")
        assert "Exchange hashpartitioning" not in plan_of(kept)
    total = kept.selectExpr("count(*)", "sum(v)", "max(k % 2)").first()
    assert tuple(total) == (1_500_000, sum(range(0, 3_000_000, 2)), 0)


def test_sparse_ids_stay_rows(spark):
    """A bucket for each id would be larger than the ids themselves."""
    keys = KeySet(spark.range(2000).selectExpr("id * 1000003 AS k"))
    fact = spark.range(4000).selectExpr("id * 1000003 AS k")
    with broadcast_up_to(50_000):
        assert not keys.small and keys.bitmap is None
        dropped = drop_matching(fact, keys, "k")
        assert "SortMergeJoin" in plan_of(dropped)
    assert dropped.count() == 2000


def test_other_keys_have_no_bitmap(spark):
    names = KeySet(spark.range(3000).selectExpr("CAST(id AS STRING) AS k"))
    pairs = KeySet(spark.range(3000).selectExpr("id AS k", "id AS l"))
    with broadcast_up_to(10_000):
        assert names.bitmap is None and pairs.bitmap is None


def test_renamed_ids_keep_their_bits(spark):
    keys = KeySet(spark.range(5000).toDF("k")).renamed("k", "other")
    fact = spark.range(10_000).toDF("other")
    with broadcast_up_to(50_000):
        kept = keep_matching(fact, keys, "other")
        assert "SortMergeJoin" not in plan_of(kept)
    assert kept.count() == 5000
