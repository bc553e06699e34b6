import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakestrata.operators.dedupe import keep_one
from lakestrata.operators.duplicates import duplicate_summary, exact_duplicate_summary
from lakestrata.operators.keys import assign_missing_keys, number_rows
from lakestrata.operators.lookups import lookup, orphan_counts, reconcile, within_bounds
from lakestrata.operators.ranking import listed_order, sample_flag, share_of_total, top_k
from lakestrata.operators.upsert import DuplicateSourceKeys, merge_into, upsert, upsert_keyed, upsert_partitions
from lakestrata.operators.writes import (ensure_namespaces, ensure_path, overwrite_path, overwrite_table, replace_path)
from lakestrata.session import new_path


def make(spark, data, schema):
    return spark.createDataFrame(data, schema)


# dedupe

def test_latest_row_wins_and_ties_are_settled_by_the_other_columns(spark):
    df = make(spark, [(1, 5, "b"), (1, 5, "a"), (1, 4, "z"), (None, 1, "x"), (None, 2, "y")], "k int, t int, v string")
    assert rows(keep_one(df, ["k"], ["t"])) == sorted([(1, 5, "a"), (None, 2, "y")], key=repr)


def test_null_order_value_loses(spark):
    df = make(spark, [(1, None, "late"), (1, 1, "known")], "k int, t int, v string")
    assert rows(keep_one(df, ["k"], ["t"])) == [(1, 1, "known")]


def test_key_only_table(spark):
    assert rows(keep_one(make(spark, [(1,), (1,), (2,)], "k int"), ["k"])) == [(1,), (2,)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = keep_one(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_exchange


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3) | st.none(), st.integers(0, 3), st.integers(0, 2)), min_size=1))
def test_dedupe_yields_each_key_once(spark, data):
    got = rows(keep_one(make(spark, data, "k int, t int, v int"), ["k"], ["t"]))
    assert sorted({r[0] for r in data}, key=repr) == sorted((r[0] for r in got), key=repr)
    for k, t, v in got:
        assert (t, -v) == max((x[1], -x[2]) for x in data if x[0] == k)


# upsert

TARGET = [(1, "a", 10), (2, "b", 20), (None, "n", 30)]
SOURCE = [(2, "B"), (3, "C"), (None, "N")]


def tables(spark):
    return make(spark, TARGET, "id int, v string, key int"), make(spark, SOURCE, "id int, v string")


@pytest.mark.parametrize("bulk", [False, True])
def test_null_safe_upsert(spark, bulk):
    assert rows(upsert(*tables(spark), ["id"], bulk=bulk)) == sorted(
        [(1, "a", 10), (2, "B", 20), (None, "N", 30), (3, "C", None)], key=repr)


@pytest.mark.parametrize("bulk", [False, True])
def test_plain_equality_never_matches_null(spark, bulk):
    assert rows(upsert(*tables(spark), ["id"], null_safe=False, bulk=bulk)) == sorted(
        [(1, "a", 10), (2, "B", 20), (None, "n", 30), (None, "N", None), (3, "C", None)], key=repr)


@pytest.mark.parametrize("bulk", [False, True])
def test_delete_unmatched(spark, bulk):
    assert rows(upsert(*tables(spark), ["id"], delete_unmatched=True, bulk=bulk)) == sorted(
        [(2, "B", 20), (None, "N", 30), (3, "C", None)], key=repr)
    assert rows(upsert(*tables(spark), ["id"], null_safe=False, delete_unmatched=True, bulk=bulk)) == sorted(
        [(2, "B", 20), (None, "N", None), (3, "C", None)], key=repr)


@pytest.mark.parametrize("bulk", [False, True])
def test_update_list_leaves_other_columns_alone(spark, bulk):
    target = make(spark, [(1, "a", "x")], "id int, v string, w string")
    source = make(spark, [(1, "A", "X"), (2, "B", "Y")], "id int, v string, w string")
    assert rows(upsert(target, source, ["id"], update=["v"], bulk=bulk)) == [(1, "A", "x"), (2, "B", "Y")]


def test_update_to_null_is_an_update(spark):
    target, source = make(spark, [(1, "a")], "id int, v string"), make(spark, [(1, None)], "id int, v string")
    assert rows(upsert(target, source, ["id"])) == [(1, None)]


def test_repeated_source_keys_are_rejected(spark):
    target = make(spark, [(1, "a")], "id int, v string")
    with pytest.raises(DuplicateSourceKeys):
        upsert(target, make(spark, [(1, "b"), (1, "c")], "id int, v string"), ["id"])
    with pytest.raises(DuplicateSourceKeys):
        upsert(target, make(spark, [(None, "b"), (None, "c")], "id int, v string"), ["id"])


def test_unknown_source_column_is_rejected(spark):
    with pytest.raises(ValueError):
        upsert(make(spark, [(1,)], "id int"), make(spark, [(1, 2)], "id int, extra int"), ["id"])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 6) | st.none(), st.integers(0, 9), max_size=6),
       st.dictionaries(st.integers(0, 6) | st.none(), st.integers(0, 9), max_size=6))
def test_upsert_equals_dict_update_and_is_idempotent(spark, old, new):
    target = make(spark, list(old.items()), "k int, v int")
    source = make(spark, list(new.items()), "k int, v int")
    once = upsert(target, source, ["k"])
    want = sorted((old | new).items(), key=repr)
    assert rows(once) == want
    assert rows(upsert(once, source, ["k"])) == want
    assert rows(upsert(target, source, ["k"], bulk=True)) == want


def test_small_source_leaves_the_target_unshuffled(spark):
    path = new_path(spark, "target")
    spark.range(100000).select("id", (F.col("id") * 2).alias("v")).write.parquet(path)
    source = spark.range(5).select("id", F.lit(0).cast("long").alias("v"))
    merged = upsert(spark.read.parquet(path), source, ["id"], check_source=False)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_upsert_rewrites_only_touched_partitions(spark):
    path = new_path(spark, "months")
    schema = "id int, month string, v string"
    overwrite_path(make(spark, [(1, "2026-03", "a"), (2, "2026-04", "b")], schema), path, "month")
    import os
    before = sorted(os.listdir(f"{path}/month=2026-03"))
    table = upsert_partitions(spark, path, make(spark, [(2, "2026-04", "B"), (3, "2026-05", "c")], schema),
                              ["id", "month"], "month")
    assert rows(table) == [(1, "2026-03", "a"), (2, "2026-04", "B"), (3, "2026-05", "c")]
    assert sorted(os.listdir(f"{path}/month=2026-03")) == before


def test_upsert_partitions_numbers_inserts_after_the_largest_key_of_the_whole_table(spark):
    path = new_path(spark, "months")
    schema = "id int, month string, v string"
    overwrite_path(make(spark, [(7, 1, "a", "2026-03"), (3, 2, "b", "2026-04")], "k bigint, id int, v string, month string"),
                   path, "month")
    table = upsert_partitions(spark, path, make(spark, [(2, "2026-04", "B"), (4, "2026-04", "d"), (3, "2026-04", "c")], schema),
                              ["id"], "month", key="k", order_by=["id"])
    assert rows(table.select("k", "id", "v")) == [(3, 2, "B"), (7, 1, "a"), (8, 3, "c"), (9, 4, "d")]


def test_rows_without_a_partition_value_survive_a_load(spark):
    path = new_path(spark, "months")
    schema = "id int, month string, v string"
    overwrite_path(make(spark, [(1, None, "a"), (2, None, "b"), (3, "2026-04", "c")], schema), path, "month")
    table = upsert_partitions(spark, path, make(spark, [(2, None, "B"), (4, None, "d")], schema), ["id", "month"], "month")
    assert rows(table) == sorted([(1, None, "a"), (2, None, "B"), (3, "2026-04", "c"), (4, None, "d")], key=repr)
    assert upsert_partitions(spark, path, make(spark, [], schema), ["id", "month"], "month").count() == 4


def test_merge_statement_is_refused_by_a_plain_parquet_table(spark):
    overwrite_table(make(spark, [(1, "a")], "id int, v string"), "plain_target")
    with pytest.raises(Exception, match="(?i)merge"):
        merge_into(make(spark, [(1, "b")], "id int, v string"), "plain_target", ["id"])


# surrogate keys

def test_numbers_follow_the_order_without_gaps(spark):
    df = spark.range(10000).select((F.lit(9999) - F.col("id")).alias("n"))
    numbered = number_rows(df.repartition(16), "key", ["n"])
    assert numbered.filter(F.col("key") != F.col("n") + 1).count() == 0
    assert numbered.count() == 10000


def test_known_rows_keep_their_keys(spark):
    df = make(spark, [(5, "a"), (None, "c"), (None, "b")], "key bigint, name string")
    assert rows(assign_missing_keys(df, "key", ["name"])) == [(5, "a"), (6, "b"), (7, "c")]


def test_first_keys_start_at_one(spark):
    df = make(spark, [(None, "b"), (None, "a")], "key bigint, name string")
    assert rows(assign_missing_keys(df, "key", ["name"])) == [(1, "a"), (2, "b")]


def test_keyed_upsert(spark):
    target = make(spark, [(4, 1, "a"), (9, 2, "b")], "key bigint, id int, v string")
    source = make(spark, [(2, "B"), (0, "new"), (3, "new")], "id int, v string")
    assert set(rows(upsert_keyed(target, source, ["id"], "key", ["id"]))) == {
        (4, 1, "a"), (9, 2, "B"), (10, 0, "new"), (11, 3, "new")}


# lookups

def test_lookup_inner_optional_and_roles(spark):
    fact = make(spark, [(1, 2), (3, None)], "a int, b int")
    dim = make(spark, [(1, "one"), (2, "two")], "id int, name string")
    both = lookup(lookup(fact, dim, "a", "id", {"name": "a_name"}), dim, "b", "id", {"name": "b_name"})
    assert rows(both) == [(1, 2, "one", "two")]
    assert rows(lookup(fact, dim, "b", "id", {"name": "n"}, optional=True)) == [(1, 2, "two"), (3, None, None)]


def test_orphans_ignore_null_and_count_rows(spark):
    fact = make(spark, [(1, 9), (7, None), (7, 2), (None, 2)], "a int, b bigint")
    dim = make(spark, [(1,), (2,)], "id int")
    got = rows(orphan_counts(fact, {"a": (dim, "id"), "b": (dim, "id")}))
    assert got == [("a", 4, 2), ("b", 4, 1)]
    assert rows(orphan_counts(fact.limit(0), {"a": (dim, "id")})) == [("a", 0, 0)]


def test_reconcile(spark):
    left, right = make(spark, [(1,), (1,), (2,), (None,)], "id int"), make(spark, [(2,), (3,)], "id int")
    assert rows(reconcile(left, right, "id")) == [(1, "left"), (3, "right")]


def test_bounds_are_inclusive(spark):
    bounds = make(spark, [(2, 4)], "lo int, hi int")
    assert rows(within_bounds(make(spark, [(i,) for i in range(6)], "v int"), "v", bounds, "lo", "hi")) == [(2,), (3,), (4,)]


# duplicates and ranking

def test_scalar_and_struct_duplicates_differ_on_null(spark):
    df = make(spark, [(None,), (None,), (1,), (1,), (2,)], "k int")
    assert rows(duplicate_summary(df, ["k"], skip_null=True)) == [(5, 2, 3, 2)]
    assert rows(duplicate_summary(df, ["k"])) == [(5, 3, 2, 4)]
    assert rows(duplicate_summary(df.limit(0), ["k"])) == [(0, 0, 0, 0)]


def test_exact_duplicates(spark):
    df = make(spark, [(1, None), (1, None), (1, "a"), (2, "b"), (2, "b"), (2, "b")], "k int, v string")
    assert rows(exact_duplicate_summary(df)) == [(6, 3, 3, 5)]
    assert rows(exact_duplicate_summary(df.limit(0))) == [(0, 0, 0, 0)]


def test_top_and_bottom_break_ties_by_id(spark):
    df = make(spark, [(3, 5), (1, 5), (2, 9), (4, 1)], "id int, n int")
    assert [r.id for r in top_k(df, "n", 2, ["id"]).collect()] == [2, 1]
    assert [r.id for r in top_k(df, "n", 3, ["id"], largest=False).collect()] == [4, 1, 3]


def test_share_flag_and_listed_order(spark):
    df = make(spark, [("a", 199), ("b", 200), ("c", 1)], "g string, n bigint")
    got = share_of_total(df, "n").select("g", "pct_of_total", sample_flag(F.col("n")),
                                         listed_order(F.col("g"), ["b", "a"]))
    assert rows(got) == [("a", 49.75, "LOW SAMPLE - interpret with caution", 1), ("b", 50.0, "OK", 0),
                         ("c", 0.25, "LOW SAMPLE - interpret with caution", None)]


# writes

def test_declared_table_is_created_once_and_checked(spark):
    path = new_path(spark, "declared")
    schema = make(spark, [], "id int, v string").schema
    assert ensure_path(spark, path, schema).count() == 0
    overwrite_path(make(spark, [(1, "a")], "id int, v string"), path)
    assert rows(ensure_path(spark, path, schema)) == [(1, "a")]
    with pytest.raises(ValueError):
        ensure_path(spark, path, make(spark, [], "id string, v string").schema)


def test_overwrite_may_change_the_schema_and_replace_may_read_the_table(spark):
    path = new_path(spark, "changing")
    overwrite_path(make(spark, [(1,)], "id int"), path)
    replace_path(spark.read.parquet(path).withColumn("v", F.lit("x")), path)
    assert rows(spark.read.parquet(path)) == [(1, "x")]


def test_namespaces_and_catalog_tables(spark):
    names = ensure_namespaces(spark, "t_")
    assert ensure_namespaces(spark, "t_") == names == ["t_bronze", "t_silver", "t_gold", "t_quality"]
    overwrite_table(make(spark, [(1,)], "id int"), "t_gold.numbers")
    overwrite_table(make(spark, [(2, "x")], "id int, v string"), "t_gold.numbers")
    assert rows(spark.table("t_gold.numbers")) == [(2, "x")]
