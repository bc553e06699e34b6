"""Minimal keys, gaps without generated ids, mergeable distinct counts, schema history."""

import datetime as dt
import random
from itertools import combinations

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakestrata.profiling import key_search
from lakestrata.profiling.gaps import gap_intervals, missing_hours
from lakestrata.profiling.key_search import minimal_keys
from lakestrata.profiling.sketches import distinct_estimates, distinct_sketches, error_bound, store_sketches
from lakestrata.sources.discovery import landed_files
from lakestrata.sources.schemas import file_schemas, schema_history


def brute_keys(data, names):
    unique = [set(c) for k in range(1, len(names) + 1) for c in combinations(range(len(names)), k)
              if len({tuple(r[i] for i in c) for r in data}) == len(data)]
    least = [u for u in unique if not any(v < u for v in unique)]
    return sorted((",".join(names[i] for i in sorted(u)), len(u)) for u in least)


@pytest.mark.parametrize("seed", range(3))
def test_minimal_keys_equal_brute_force_over_all_subsets(spark, seed):
    rnd = random.Random(seed)
    names = list("abcdef")
    data = list({tuple(rnd.choice([None, *range(2 + j + seed)]) for j in range(6)) for _ in range(60)})
    df = spark.createDataFrame(data, ", ".join(f"{n} int" for n in names))
    assert sorted(map(tuple, minimal_keys(df).collect())) == brute_keys(data, names)


def test_known_facts_decide_most_sets(spark):
    data = [(i, i % 2, i % 3, i // 2 % 2, 7, i // 6) for i in range(24)] + [(24, 0, 0, 0, 7, 0)]
    df = spark.createDataFrame(data, "id int, a int, b int, c int, k int, d int")
    looks = []
    assert key_search.search(df, df.columns, None, looks) == [("id",)]
    assert all("id" not in key and "k" not in key for key in looks)  # a unique column and a constant are never combined with others
    twice = df.unionByName(df)
    assert key_search.search(twice.drop("id").unionByName(twice.drop("id")), ["a", "b", "c", "k", "d"]) == []


def test_keys_of_empty_and_one_row_tables(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(minimal_keys(df)) == [("", 0)] == rows(minimal_keys(df.limit(0)))
    assert rows(minimal_keys(spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "a int, b int"), max_width=1)) == []


def test_gaps_equal_a_plain_search(spark):
    rnd = random.Random(5)
    ids = [rnd.randrange(-50, 400) for _ in range(150)] + [None, 100, 100]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(6)
    missing = sorted(set(range(1, 301)) - set(ids))
    want, at = [], 0
    while at < len(missing):
        end = at
        while end + 1 < len(missing) and missing[end + 1] == missing[end] + 1:
            end += 1
        want.append((missing[at], missing[end], end - at + 1))
        at = end + 1
    assert rows(gap_intervals(df, "id", 1, 300)) == sorted(want, key=repr)


def test_a_wide_range_makes_no_row_for_every_id(spark):
    df = spark.createDataFrame([(5,), (10**12 - 5,)], "id long")
    assert rows(gap_intervals(df, "id", 1, 10**12)) == sorted([(1, 4, 4), (6, 10**12 - 6, 10**12 - 11), (10**12 - 4, 10**12, 5)], key=repr)
    assert rows(gap_intervals(df.limit(0), "id", 1, 10**12)) == [(1, 10**12, 10**12)]
    assert rows(gap_intervals(df, "id", 5, 5)) == []


def test_missing_hours(spark):
    hours = [dt.datetime(2026, 3, 1, h, 20) for h in (1, 2, 2, 5)] + [dt.datetime(2026, 3, 3), None]
    df = spark.createDataFrame([(h,) for h in hours], "t timestamp_ntz")
    assert rows(missing_hours(df, "t")) == [(dt.datetime(2026, 3, 1, 3), dt.datetime(2026, 3, 1, 4), 2),
                                            (dt.datetime(2026, 3, 1, 6), dt.datetime(2026, 3, 2, 23), 42)]
    assert rows(missing_hours(df.limit(0), "t")) == []


def test_distinct_counts_are_within_their_bound_at_several_sizes(spark):
    for n in (0, 1, 500, 20_000, 300_000):
        df = spark.range(n).select(F.lit("m").alias("m"), (F.col("id") * 7).alias("x"), F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("y"),
                                   F.concat(F.lit("k"), F.col("id") % 300).alias("z"))
        got = {r["column_name"]: (r["row_count"], r["distinct_estimate"]) for r in distinct_estimates(distinct_sketches(df, ["x", "y", "z"], "m")).collect()}
        if not n:
            assert got == {}
            continue
        for name, exact in (("x", n), ("y", (n + 1) // 2), ("z", min(n, 300))):
            assert got[name][0] == n and abs(got[name][1] - exact) <= error_bound() * exact, (n, name, got)


def test_a_month_is_added_and_replaced_without_the_others(spark, tmp_path):
    path = str(tmp_path / "sketches")

    def month(name, low, high):
        return spark.range(low, high).select(F.col("id"), F.lit(name).alias("m"))
    store_sketches(month("01", 0, 1000), path, ["id"], "m")
    first = sorted((tmp_path / "sketches" / "m=01").iterdir())
    store_sketches(month("02", 500, 1500), path, ["id"], "m")
    store_sketches(month("03", 0, 10), path, ["id"], "m")
    store_sketches(month("03", 0, 2000), path, ["id"], "m")
    assert sorted((tmp_path / "sketches" / "m=01").iterdir()) == first
    stored = spark.read.schema("column_name string, row_count long, sketch binary, m string").parquet(path)
    assert rows(distinct_estimates(stored.filter("m < '03'")))[0][:2] == ("id", 2000)
    near = {r["m"]: r["distinct_estimate"] for r in distinct_estimates(stored, ["m"]).collect()}
    assert all(abs(near[m] - n) <= error_bound() * n for m, n in (("01", 1000), ("02", 1000), ("03", 2000)))
    assert abs(distinct_estimates(stored.filter("m < '03'")).first()["distinct_estimate"] - 1500) <= error_bound() * 1500


def test_schema_history_from_footers(spark, tmp_path):
    land = tmp_path / "landing"
    layouts = {"2026-01": "1 AS id, 'x' AS gone, cast(1 as int) AS wide", "2026-02": "1 AS id, 'x' AS gone, cast(1 as int) AS wide, 2.0d AS come",
               "2026-03": "1 AS id, cast(1 as bigint) AS wide, 2.0d AS come, timestamp_ntz'2026-03-01' AS at"}
    for month, columns in layouts.items():
        spark.sql(f"SELECT {columns}").coalesce(1).write.parquet(str(land / month))
    files = landed_files(spark, str(land))
    month = F.element_at(F.split("path", "/"), -2)
    want = sorted([("id", "int", "2026-01", "2026-03", 3, "same"), ("gone", "string", "2026-01", "2026-02", 2, "dropped"),
                   ("wide", "int", "2026-01", "2026-02", 2, "type changed"), ("wide", "bigint", "2026-03", "2026-03", 1, "type changed"),
                   ("come", "double", "2026-02", "2026-03", 2, "added"), ("at", "timestamp_ntz", "2026-03", "2026-03", 1, "added")], key=repr)
    for in_tasks in (True, False):
        schemas = file_schemas(spark, files, in_tasks)
        assert rows(schema_history(schemas.withColumn("month", month))) == want
    assert file_schemas(spark, files.limit(0)).count() == 0
