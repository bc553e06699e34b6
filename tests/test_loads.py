"""Loads lose nothing: stored columns, malformed input, header order, old partitions, time zones, calendar keys."""

import datetime as dt
import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakestrata.functions import time as clock
from lakestrata.functions.numeric import percentage, settled_round
from lakestrata.operators.duplicates import exact_duplicate_summary
from lakestrata.operators.lookups import orphan_counts
from lakestrata.operators.upsert import upsert_partitions
from lakestrata.operators.writes import ensure_path, overwrite_path
from lakestrata.plans.bronze import ingest_typed_records
from lakestrata.plans.gold import build_calendar, refresh_calendar
from lakestrata.quality.rules import RuleSet
from lakestrata.session import materialize, scratch
from lakestrata.sources.files import read_array_documents, read_csv, read_records, read_records_apart


def test_a_load_without_a_stored_column_keeps_it(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_path(spark.createDataFrame([(1, "a", 5.0, "m1"), (2, "b", 6.0, "m1"), (3, "c", 7.0, "m2")], "id int, v string, fee double, m string"), path, "m")
    batch = spark.createDataFrame([(2, "B", "m1"), (4, "d", "m1"), (5, "e", "m3")], "id int, v string, m string")
    ensure_path(spark, path, batch.schema, "m")
    got = upsert_partitions(spark, path, batch, ["id", "m"], "m")
    want = [(1, "a", "m1", 5.0), (2, "B", "m1", 6.0), (3, "c", "m2", 7.0), (4, "d", "m1", None), (5, "e", "m3", None)]
    assert rows(got.select("id", "v", "m", "fee")) == want
    wider = spark.createDataFrame([(3, "C", "new", "m2")], "id int, v string, extra string, m string")
    got = upsert_partitions(spark, path, wider, ["id", "m"], "m").select("id", "v", "fee", "extra")
    assert rows(got)[2] == (3, "C", 7.0, "new") and rows(got)[0] == (1, "a", 5.0, None)


def test_malformed_json_is_an_error_or_kept_apart(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/a.json").write_text('{"h": {"t": ["1", "2"], "x": [1, 2]}}\n{"h": {"t": ["3"], "x": [3\n')
    with pytest.raises(Exception, match="MALFORMED"):
        read_array_documents(spark, str(tmp_path / "docs"), "h", {"t": "string", "x": "bigint"}).collect()
    lines = ['{"t": 1, "x": 2.5}', '{"t": 2, "x": "n/a"}', '{"t": 3, "x"', '{"t": 4}']
    (tmp_path / "records").mkdir()
    (tmp_path / "records/a.json").write_text("\n".join(lines))
    with pytest.raises(Exception, match="MALFORMED"):
        read_records(spark, str(tmp_path / "records"), "t long, x double").collect()
    good, bad = read_records_apart(spark, str(tmp_path / "records"), "t long, x double")
    assert rows(good) == [(1, 2.5), (4, None)] and rows(bad) == [(lines[1],), (lines[2],)]


def test_records_without_key_are_not_inserted_again(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"t": 1, "x": 2}\n{"x": 3}\n')
    merged = None
    for _ in range(3):
        merged = materialize(ingest_typed_records(spark, str(tmp_path), merged, "t long, x long", "t", "api", dt.datetime(2026, 1, 1)))
    assert rows(merged.select("t", "x")) == [(1, 2), (None, 3)]


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "z.csv").write_text("Borough,LocationID,Zone\nQueens,7,Astoria\n")
    assert rows(read_csv(spark, str(tmp_path), "LocationID int, Borough string")) == [(7, "Queens")]
    with pytest.raises(ValueError, match="service_zone"):
        read_csv(spark, str(tmp_path), "LocationID int, service_zone string")


def test_replacing_removes_old_partitions_in_dynamic_mode(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_path(spark.createDataFrame([(1, "03")], "id int, m string"), path, "m")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        overwrite_path(spark.createDataFrame([(2, "04")], "id int, m string"), path, "m")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r["id"] for r in spark.read.parquet(path).collect()] == [2]


def test_orphans_are_compared_in_a_common_type(spark):
    dim = spark.range(1, 6).withColumnRenamed("id", "k")
    fact = spark.range(1, 7).select(F.col("id").cast("int").alias("i"), F.col("id").cast("double").alias("d"), F.col("id").cast("decimal(12,2)").alias("c"),
                                    F.when(F.col("id") < 4, F.col("id")).alias("n"))
    got = orphan_counts(fact, {c: (dim, "k") for c in "idcn"})
    assert rows(got) == [("c", 6, 1), ("d", 6, 1), ("i", 6, 1), ("n", 6, 0)]
    assert rows(orphan_counts(fact.limit(0), {"i": (dim, "k")})) == [("i", 0, 0)]


def test_an_hour_keeps_its_key_when_the_calendar_grows_to_the_left(spark):
    end = dt.datetime(2026, 3, 31, 23)
    short, long = (build_calendar(spark, dt.datetime(2026, m, 1), end, at=dt.datetime(2026, 6, 1)) for m in (3, 2))
    grown = materialize(refresh_calendar(materialize(short), long))
    keys = dict(grown.select("full_datetime", "datetime_key").collect())
    assert all(keys[t] == k for t, k in short.select("full_datetime", "datetime_key").collect())
    assert grown.count() == long.count() and grown.where("datetime_key = 0").count() == 1


ZONE_SCRIPT = """
import datetime as dt, json, sys
from lakestrata.session import session
spark = session("zone", "local[2]", spark__sql__shuffle__partitions="2", spark__checkpoint__dir=sys.argv[1])
spark.conf.set("spark.sql.session.timeZone", "America/New_York")
from pyspark.sql import functions as F
from lakestrata.functions import time as clock
from lakestrata.functions.numeric import percentage, settled_round
from lakestrata.operators.duplicates import exact_duplicate_summary
from lakestrata.operators.lookups import within_bounds
from lakestrata.sources.generated import hour_grid
grid = hour_grid(spark, dt.datetime(2026, 3, 7), dt.datetime(2026, 3, 9, 23), "t")
bounds = grid.agg(F.min("t").alias("a"), F.max("t").alias("b"))
night = spark.sql("select timestamp_ntz'2026-03-08 01:50:00' a, timestamp_ntz'2026-03-08 03:10:00' b, timestamp_ntz'2026-03-08 02:30:00' c")
row = night.select(clock.minutes_between(F.col("a"), F.col("b")), clock.hour_of(F.col("c")).cast("string")).first()
print("GOT", json.dumps([within_bounds(grid, "t", bounds, "a", "b").count(), row[0], row[1]]))
"""


def test_results_do_not_depend_on_the_time_zone(tmp_path):
    script = tmp_path / "zone.py"
    script.write_text(ZONE_SCRIPT)
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, str(script), str(tmp_path / "work")], capture_output=True, text=True, timeout=300,
                          env={**os.environ, "TZ": "America/New_York", "PYTHONPATH": root})
    assert json.loads(done.stdout.split("GOT")[-1]) == [72, 80.0, "2026-03-08 02:00:00"], done.stderr[-2000:]


def test_hour_of_equals_truncation_in_utc(spark):
    df = spark.sql("select timestamp_ntz'2026-03-08 02:59:59.5' t, timestamp'2026-01-01 00:00:00' u")
    assert df.select(clock.hour_of(F.col("t")).cast("string"), clock.hour_of(F.col("u")).cast("string")).first()[:] == ("2026-03-08 02:00:00", "2026-01-01 00:00:00")


def test_a_replacement_that_is_cut_off_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_path(spark.range(5), path)
    cut_off = spark.range(100).repartition(4).withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("cut off")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="cut off"):
        overwrite_path(cut_off, path)
    assert spark.read.parquet(path).count() == 5
    overwrite_path(spark.read.parquet(path).filter("id > 2"), path)  # from itself
    assert rows(spark.read.parquet(path)) == [(3,), (4,)]


def test_intermediate_tables_go_when_the_result_is_stored(spark, tmp_path):
    with scratch(spark):
        kept = materialize(spark.range(3), "part")
        folder = kept.inputFiles()[0]
        overwrite_path(kept, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    assert not Path(folder.removeprefix("file://")).exists()


def test_values_are_rounded_once(spark):
    got = spark.sql("select 1.0049999996D a, 1.005D b, 2.345D c").select(*[settled_round(F.col(c), 2) for c in "abc"]).first()
    assert tuple(got) == (1.0, 1.01, 2.35)
    share = spark.sql("select 10049999996 part, 1000000000000 whole").select(percentage(F.col("part"), F.col("whole")).alias("p"))
    rules = RuleSet(warn_up_to={"X": 1.0})
    assert share.select(rules.status(F.lit("n"), F.lit("X"), F.lit("X"), F.lit(1), F.col("p"))).first()[0] == "WARN"


def test_whole_row_duplicates_of_an_empty_table(spark):
    assert tuple(exact_duplicate_summary(materialize(spark.range(0))).first()) == (0, 0, 0, 0)
