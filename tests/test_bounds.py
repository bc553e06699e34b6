"""Bounds kept beside a partitioned table: right after every kind of write, and no other partition is read."""

import datetime as dt
from pathlib import Path
from urllib.parse import unquote

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakestrata.operators.bounds import bounds_path, largest, partition_bounds, table_ranges
from lakestrata.operators.upsert import upsert_partitions
from lakestrata.operators.writes import append_path, ensure_path, overwrite_partitions

SCHEMA = "id long, at timestamp_ntz, x double, s string, m string"


def month(spark, m, ids, shift=0.0):
    data = [(i, dt.datetime(2026, 1, 1) + dt.timedelta(hours=i), None if i % 3 == 0 else i + shift, f"s{i}", m) for i in ids]
    return spark.createDataFrame(data, SCHEMA)


def plain(spark, path, columns):
    aggregates = [a for c in columns for a in (F.min(c), F.max(c), F.count(c))]
    return sorted(tuple(r) for r in spark.read.parquet(path).groupBy("m").agg(F.count(F.lit(1)), *aggregates).collect())


def kept(spark, path, columns):
    return sorted((unquote(r["folder"]).removeprefix("m="), r["row_count"], *[r[f"{k}_{c}"] for c in columns for k in ("low", "high", "values")])
                  for r in partition_bounds(spark, path, columns).collect())


def spoil(folder: Path):
    """Zeros over all data pages; the footers stay as they are."""
    for file in folder.glob("*.parquet"):
        data = bytearray(file.read_bytes())
        footer = int.from_bytes(data[-8:-4], "little") + 8
        data[4:len(data) - footer] = bytes(len(data) - footer - 4)
        file.write_bytes(bytes(data))
        (folder / f".{file.name}.crc").unlink(missing_ok=True)


def test_bounds_follow_every_write(spark, tmp_path):
    path, columns = str(tmp_path / "t"), ["id", "at", "x", "s"]
    append_path(month(spark, "a", range(10)).unionByName(month(spark, "b b", range(20, 40))), path, "m")
    assert kept(spark, path, columns) == plain(spark, path, columns)
    append_path(month(spark, "b b", range(100, 105)), path, "m")
    assert kept(spark, path, columns) == plain(spark, path, columns)
    overwrite_partitions(month(spark, "a", range(3)).unionByName(month(spark, "c", [7])), path, "m")
    assert kept(spark, path, columns) == plain(spark, path, columns)
    (tmp_path / "t" / "m=c").rename(tmp_path / "elsewhere")
    assert kept(spark, path, columns) == plain(spark, path, columns)
    append_path(spark.createDataFrame([(5, None, None, None, None)], SCHEMA), path, "m")
    assert {r["folder"] for r in partition_bounds(spark, path, columns).collect()} == {"m=a", "m=b%20b", "m=__HIVE_DEFAULT_PARTITION__"}
    assert largest(partition_bounds(spark, path, ["id"]), "id") == 104


def test_only_changed_folders_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    append_path(month(spark, "a", range(100)).unionByName(month(spark, "b", range(200, 300))), path, "m")
    first = kept(spark, path, ["id"])
    spoil(tmp_path / "t" / "m=a")
    with pytest.raises(Exception):
        spark.read.parquet(path).agg(F.max("id")).collect()
    append_path(month(spark, "b", [999]), path, "m")
    assert kept(spark, path, ["id"]) == [first[0], ("b", 101, 200, 999, 101)]


def test_a_load_reads_no_other_partition_for_its_first_number(spark, tmp_path):
    path = str(tmp_path / "t")
    ensure_path(spark, path, month(spark, "a", []).schema, "m")
    load = month(spark, "a", range(50)).drop("id")
    upsert_partitions(spark, path, load, ["s", "m"], "m", key="id", order_by=["s"])
    spoil(tmp_path / "t" / "m=a")
    upsert_partitions(spark, path, month(spark, "b", range(50, 60)).drop("id"), ["s", "m"], "m", key="id", order_by=["s"])
    assert rows(spark.read.parquet(path).filter("m = 'b'").select("id")) == [(i,) for i in range(51, 61)]
    again = upsert_partitions(spark, path, month(spark, "b", range(55, 65)).drop("id"), ["s", "m"], "m", key="id", order_by=["s"])
    assert rows(again.filter("m = 'b'").select("id", "s")) == [(51 + i, f"s{50 + i}") for i in range(15)]


def test_another_column_another_type_and_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    append_path(month(spark, "a", range(4)), path, "m")
    assert kept(spark, path, ["id"]) == [("a", 4, 0, 3, 4)]
    assert kept(spark, path, ["x"]) == [("a", 4, 1.0, 2.0, 2)]
    both = partition_bounds(spark, path, ["id"])
    assert {"low_x", "low_id"} <= set(both.columns)
    assert rows(table_ranges(both, ["id", "x"])) == [("id", 4, 4, "0", "3"), ("x", 4, 2, "1.0", "2.0")]
    empty = str(tmp_path / "empty")
    ensure_path(spark, empty, month(spark, "a", []).schema, "m")
    schema = month(spark, "a", []).schema
    assert largest(partition_bounds(spark, empty, ["id"], schema), "id") is None
    assert rows(table_ranges(partition_bounds(spark, empty, ["id"], schema), ["id"])) == [("id", 0, 0, None, None)]
    assert Path(bounds_path(empty)).exists()
