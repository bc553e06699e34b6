"""Upserts into bucketed tables: same rows as the other forms, and the stored side is never exchanged."""

import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakestrata.operators import bucketed
from lakestrata.operators.bucketed import bucketed_merge, read_bucketed, upsert_bucketed, write_bucketed
from lakestrata.operators.upsert import DuplicateSourceKeys, upsert, upsert_keyed
from lakestrata.operators.writes import overwrite_path

TARGET = [(i if i % 7 else None, f"k{i % 5}" if i % 3 else None, float(i), "old") for i in range(120)]
LOAD = [(i if i % 7 else None, f"k{i % 5}" if i % 3 else None, float(-i), "new") for i in range(60, 180)]
SCHEMA = "a int, b string, v double, w string"


def unique(spark, data):
    """One row per key, NULL being a value."""
    return spark.createDataFrame(sorted({r[:2]: r for r in data}.values(), key=repr), SCHEMA)


def plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("options", [{}, {"update": ["v"]}, {"delete_unmatched": True}])
def test_rows_equal_the_plain_upsert(spark, tmp_path, null_safe, options):
    target, load = unique(spark, TARGET), unique(spark, LOAD)
    path = str(tmp_path / "t")
    write_bucketed(target, path, ["a", "b"], 4, null_safe)
    want = rows(upsert(target, load, ["a", "b"], null_safe=null_safe, **options))
    assert rows(upsert_bucketed(spark, path, load, ["a", "b"], null_safe=null_safe, **options)) == want
    if null_safe and not options:
        assert rows(upsert_bucketed(spark, path, load, ["a", "b"])) == want
        assert rows(read_bucketed(spark, path)) == want


def test_the_stored_side_is_not_exchanged(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bucketed(unique(spark, TARGET), path, ["a", "b"], 4)
    stored, load = bucketed._stored(spark, path), unique(spark, LOAD)
    once = plan(bucketed_merge(stored, load, check_source=False))
    assert once.count("Exchange") == 1 and "Bucketed: true" in once and re.search(r"SortMergeJoin \[key_hash#\d+L\], \[_src_key_hash#\d+L\], FullOuter", once), once
    kept = plan(bucketed._two_halves(stored, load, None, False, False, None, ()))
    # Each half deals out the load; the stored rows are read twice, in buckets both times.
    assert kept.count("Exchange") == kept.count("ExistingRDD") == 2 == kept.count("Bucketed: true"), kept
    for text in (once, kept):
        assert not any("FileScan" in below for below in under(text, "Exchange")), text


def under(text, name):
    """The plan lines below each node with this name."""
    lines = text.splitlines()
    depth = [len(re.match(r"[ :+-]*", line)[0]) for line in lines]
    for at, line in enumerate(lines):
        if re.match(rf"[ :+-]*{name}", line):
            end = next((k for k in range(at + 1, len(lines)) if depth[k] <= depth[at]), len(lines))
            yield from lines[at + 1:end]


def test_files_stay_in_their_buckets_after_many_upserts(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bucketed(unique(spark, TARGET), path, ["a", "b"], 4)
    for _ in range(3):
        upsert_bucketed(spark, path, unique(spark, LOAD), ["a", "b"])
    names = [f.name for f in (tmp_path / "t").glob("part-*.parquet")]
    assert len(names) == len({re.search(r"_(\d{5})\.c000", n)[1] for n in names}) <= 4
    assert bucketed.bucketing_of(spark.read.parquet(path)) == (("a", "b"), 4, True)


def test_known_rows_keep_their_number(spark, tmp_path):
    path = str(tmp_path / "t")
    target = unique(spark, TARGET).withColumn("n", F.row_number().over(bucketed_order())).select("n", "a", "b", "v", "w")
    load = unique(spark, LOAD)
    write_bucketed(target, path, ["a", "b"], 4)
    got = upsert_bucketed(spark, path, load, ["a", "b"], key="n", order_by=["b", "a"])
    want = upsert_keyed(target, load, ["a", "b"], "n", ["b", "a"])
    assert rows(got.select(*want.columns)) == rows(want)
    again = upsert_bucketed(spark, path, load, ["a", "b"], key="n", order_by=["b", "a"])
    assert rows(again.select(*want.columns)) == rows(want)


def bucketed_order():
    from pyspark.sql import Window
    return Window.orderBy("b", "a")


def test_fallback_for_unbucketed_other_keys_and_empty_tables(spark, tmp_path):
    target, load = unique(spark, TARGET), unique(spark, LOAD)
    want = rows(upsert(target, load, ["a", "b"]))
    plain, other, empty = (str(tmp_path / n) for n in ("plain", "other", "empty"))
    overwrite_path(target, plain)
    assert rows(upsert_bucketed(spark, plain, load, ["a", "b"])) == want and bucketed.HASH not in spark.read.parquet(plain).columns
    write_bucketed(target, other, ["a"], 4)
    assert rows(upsert_bucketed(spark, other, load, ["a", "b"])) == want
    assert bucketed.bucketing_of(spark.read.parquet(other)).keys == ("a",)
    assert write_bucketed(target.limit(0), empty, ["a", "b"], 4).count() == 0
    assert rows(upsert_bucketed(spark, empty, load, ["a", "b"])) == rows(load)
    assert "Bucketed: true" in plan(bucketed_merge(bucketed._stored(spark, empty), load, check_source=False))
    assert rows(upsert_bucketed(spark, empty, load.limit(0), ["a", "b"])) == rows(load)


def test_a_wrong_load_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    target, load = unique(spark, TARGET), unique(spark, LOAD)
    write_bucketed(target, path, ["a", "b"], 4)
    with pytest.raises(DuplicateSourceKeys):
        upsert_bucketed(spark, path, load.unionByName(load), ["a", "b"])
    with pytest.raises(ValueError, match="no columns"):
        upsert_bucketed(spark, path, load.withColumn("x", F.lit(1)), ["a", "b"])
    assert rows(read_bucketed(spark, path)) == rows(target)


def test_hash_collisions_do_not_match(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bucketed, "_hashed", lambda df, spec, prefix="": F.lit(7).cast("long"))
    path = str(tmp_path / "t")
    target, load = unique(spark, TARGET), unique(spark, LOAD)
    write_bucketed(target, path, ["a", "b"], 4)
    assert rows(upsert_bucketed(spark, path, load, ["a", "b"])) == rows(upsert(target, load, ["a", "b"]))


def test_a_table_written_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    first = write_bucketed(unique(spark, TARGET), path, ["a", "b"], 4)
    assert rows(write_bucketed(first.filter("v > 10"), path, ["a"], 3)) == [r for r in rows(unique(spark, TARGET)) if r[2] > 10]
