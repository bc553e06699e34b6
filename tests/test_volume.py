"""What steps over large tables may move: each row once, and only as wide as needed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from lakestrata import session
from lakestrata.operators import bucketed, duplicates, upsert
from lakestrata.operators.lookups import reconcile
from lakestrata.profiling import key_search
from lakestrata.session import materialize
from lakestrata.testbed import standins


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """Three orders, one of an unknown customer, with lines that are delivered once or three times."""
    path, day = str(tmp_path_factory.mktemp("sources")), dt.datetime(1997, 5, 1)
    tables = {
        "orders": ([(1, 7, day), (2, 7, day), (3, 9, day)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "customer": ([(7, 4)], "c_custkey long, c_nationkey int"),
        "supplier": ([(5, 2)], "s_suppkey long, s_nationkey int"),
        "lineitem": ([(1, 5, 1, 3.0, 400.0, 0.0, 0.0, "A", "F", day), (1, 5, 2, 3.0, 400.0, 0.0, 0.0, "N", "O", day), (2, 6, 1, 3.0, 400.0, 0.0, 0.0, "A", "F", day),
                      (3, 5, 1, 3.0, 400.0, 0.0, 0.0, "N", "O", day), (None, 5, 1, 3.0, 400.0, 0.0, 0.0, "N", "O", day)],
                     "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                     "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")}
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def test_trips_are_not_dealt_out_again_after_their_join(spark, sources):
    landed = standins.BUILDERS["landed_trips"](spark, sources)
    text = plan(landed)
    assert "RoundRobin" not in text and "SortMergeJoin [l_orderkey" in text
    assert text.count("Exchange hashpartitioning(l_") == 1 and "Exchange hashpartitioning(l_orderkey" in text  # the lines travel to their orders only
    assert rows(landed.select("VendorID", "PULocationID", "DOLocationID", "delivery")) == [(1, 2, 4, 0), (1, 2, 4, 1), (1, 2, 4, 1), (2, 2, 4, 0)]


@pytest.fixture
def own_conf(spark):
    """The settings that depend on a source's size, put back after the test."""
    before = {key: spark.conf.get(key, None) for key in (session.INITIAL, session.SPLIT)}
    for key in before:
        spark.conf.unset(key)
    yield spark.conf
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_shuffles_start_from_parts_that_follow_the_size_of_the_source(spark, sources, own_conf, monkeypatch):
    standins.load(spark, sources, "lineitem")
    assert own_conf.get(session.INITIAL, None) is None and own_conf.get(session.SPLIT) == "32m"  # a small table leaves the session's number
    monkeypatch.setattr(session, "SOURCE_SHARE", 10)
    own_conf.set(session.SPLIT, "5m")
    counted = standins.load(spark, sources, "lineitem").groupBy("l_orderkey").count()
    wanted = int(own_conf.get(session.INITIAL))
    assert wanted > 100 and f", {wanted})" in plan(counted) and own_conf.get(session.SPLIT) == "5m"
    monkeypatch.setattr(session, "SOURCE_SHARE", 1000)
    standins.load(spark, sources, "orders")
    assert int(own_conf.get(session.INITIAL)) == wanted


def test_files_of_a_layer_hold_a_bounded_number_of_rows(spark, sources, monkeypatch):
    monkeypatch.setattr(standins, "FILE_ROWS", 1)
    monkeypatch.setattr(standins, "_written", {})
    landed = standins.table(spark, sources, "landed_trips")
    assert landed.count() == len(landed.inputFiles()) == 4


def test_a_large_table_gets_more_buckets_than_asked_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 10)
    path, target = str(tmp_path / "t"), spark.range(95).withColumn("v", F.lit("old"))
    assert rows(bucketed.write_bucketed(target, path, ["id"], 4)) == rows(target)
    assert bucketed.bucketing_of(spark.read.parquet(path)).buckets == 10
    merged = bucketed.upsert_bucketed(spark, path, spark.range(90, 99).withColumn("v", F.lit("new")), ["id"])
    assert rows(merged) == sorted([(i, "new" if i >= 90 else "old") for i in range(99)], key=repr)


@pytest.mark.parametrize("null_safe", [True, False])
def test_a_load_as_large_as_the_table_travels_once(spark, monkeypatch, null_safe):
    old = materialize(spark.createDataFrame([(9, 1, "a", 1), (None, 2, None, 1), (4, None, "c", 1), (5, 3, "d", 1), (6, 3, "d", 2)], "k long, a int, b string, v int"))
    load = materialize(spark.createDataFrame([(1, "a", 7), (2, None, 7), (None, "c", 7), (3, "d", 7), (3, "e", 7), (None, "z", 7)], "a int, b string, v int"))
    small, large = (upsert.upsert_keyed(old, load, ["a", "b"], "k", ["b", "a", "v"], bulk=b, null_safe=null_safe, check_source=False) for b in (False, True))
    assert rows(large) == rows(small) and large.columns == small.columns and plan(large).count("Join") < plan(small).count("Join")


def test_reconciled_keys_travel_once(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (5,)], "id long")
    right = spark.createDataFrame([(2,), (3,), (3,), (None,), (5,)], "id long")
    found = reconcile(left, right, "id")
    assert "Join" not in plan(found) and plan(found).count("Exchange") == 1
    assert rows(found) == [(1, "left"), (3, "right")] == rows(reconcile(left, right.select(F.col("id").cast("int")), "id"))


def test_a_set_with_many_repeats_is_not_counted_whole(spark, monkeypatch):
    ask, asked = key_search._repeated, []
    monkeypatch.setattr(key_search, "_repeated", lambda df, key: asked.append(df.count()) or ask(df, key))
    df = materialize(spark.range(3000).select("id", (F.col("id") % 1000).alias("a"), F.lit(None).cast("int").alias("b")))
    assert key_search._agreeing(df, ["a", "b"], df.columns) == {"a", "b"} and 0 < asked[0] < 300 and len(asked) == 1
    assert key_search._agreeing(df, ["id", "a"], df.columns) is None and asked[2] == 3000
    one = df.unionByName(df.filter("id = 17"))
    assert key_search._agreeing(one, ["id", "b"], one.columns) == {"id", "a", "b"}


def test_where_many_hashes_repeat_equal_rows_are_combined_before_they_travel(spark, monkeypatch):
    df = materialize(spark.createDataFrame([(1, None), (1, None), (1, "x"), (2, "y"), (2, "y"), (2, "y"), (3, None)], "a int, b string"))
    few = [tuple(r) for r in duplicates.exact_duplicate_summary(df).collect()]
    monkeypatch.setattr(duplicates, "FEW", 0)
    many = duplicates.exact_duplicate_summary(df)
    text = plan(many)
    assert "Join" not in text and text.rindex("partial_count") > text.index("Exchange hashpartitioning(a")
    assert [tuple(r) for r in many.collect()] == few == [(7, 4, 3, 5)]


def test_where_many_hashes_repeat_only_their_rows_travel(spark, monkeypatch):
    df = materialize(spark.range(3000).select(F.when(F.col("id") < 2900, F.col("id")).otherwise(F.col("id") % 7).alias("a"), F.lit(None).cast("string").alias("b")))
    count, travelled = duplicates.key_counts, []
    monkeypatch.setattr(duplicates, "key_counts", lambda rows, keys: travelled.append(rows.count()) or count(rows, keys))
    want = [tuple(r) for r in duplicates.exact_duplicate_summary(df).collect()]
    monkeypatch.setattr(duplicates, "FEW", 0)
    for bits in (28, 16, 3):
        monkeypatch.setattr(duplicates, "BITMAP_BITS", bits)
        assert [tuple(r) for r in duplicates.exact_duplicate_summary(df).collect()] == want == [(3000, 2900, 100, 107)]
    assert travelled[:2] == [107, 107] and 107 <= travelled[2] < 300
