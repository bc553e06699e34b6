import datetime as dt
import json
from types import SimpleNamespace

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakestrata.functions import time as clock
from lakestrata.functions.codes import WEATHER_CODES, describe
from lakestrata.functions.numeric import mean_ratio, percentage, ratio, settled_round
from lakestrata.functions.text import is_blank, piped_key, title_trim, trimmed_or
from lakestrata.operators.lineage import rename_lineage, stamp, stamp_source
from lakestrata.session import new_path, work_dir
from lakestrata.sources.discovery import (landed_files, landed_months, missing_partitions, month_in, month_window,
                                          next_partition, previous_month)
from lakestrata.sources.files import read_array_documents, read_csv, read_parquet, read_table
from lakestrata.sources.generated import hour_grid, literal_row


def test_csv_keeps_the_text_na(spark, tmp_path):
    (tmp_path / "z.csv").write_text('"LocationID","Borough"\n264,"Unknown"\n265,"N/A"\n')
    assert rows(read_csv(spark, str(tmp_path))) == [(264, "Unknown"), (265, "N/A")]
    assert rows(read_csv(spark, str(tmp_path), "LocationID string, Borough string"))[1] == ("265", "N/A")


def test_array_documents_one_row_per_position(spark, tmp_path):
    doc = {"latitude": 1, "hourly": {"time": ["2026-03-01T00:00", "2026-03-01T01:00"], "t": [1.5, None], "code": [3, 71]}}
    (tmp_path / "w.json").write_text(json.dumps(doc, indent=1))
    df = read_array_documents(spark, str(tmp_path), "hourly", {"time": "string", "t": "double", "code": "bigint"}, True)
    assert rows(df) == [("2026-03-01T00:00", 1.5, 3), ("2026-03-01T01:00", None, 71)]


def test_file_lineage(spark):
    path = new_path(spark, "files")
    spark.range(3).write.parquet(path)
    df = read_parquet(spark, path, file_column="name", path_column="path")
    assert df.filter(F.col("name").endswith(".parquet") & F.col("path").contains(F.col("name"))).count() == 3
    assert read_table(spark, path).count() == 3


def test_next_month_from_landed_names(spark, tmp_path):
    assert rows(next_partition(spark.createDataFrame([], "month string"), "2026-03")) == [("2026-03",)]
    for name in ("trips_2025-11.parquet", "trips_2025-12.parquet", "notes.txt"):
        (tmp_path / name).write_bytes(b"x")
    months = landed_months(landed_files(spark, str(tmp_path)))
    assert rows(months) == [("2025-11",), ("2025-12",)]
    assert rows(next_partition(months, "2026-03")) == [("2026-01",)]


def test_missing_partitions_unless_forced(spark):
    wanted = spark.createDataFrame([("2026-03",), ("2026-04",), ("2026-04",)], "month string")
    loaded = spark.createDataFrame([("2026-03",)], "month string")
    assert rows(missing_partitions(wanted, loaded)) == [("2026-04",)]
    assert rows(missing_partitions(wanted, loaded, force=True)) == [("2026-03",), ("2026-04",)]


def test_month_window(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 15),), (dt.date(2024, 3, 31),)], "d date")
    first, last = month_window(previous_month(F.col("d")))
    assert rows(df.select("d", first, last)) == [
        (dt.date(2024, 3, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
        (dt.date(2026, 1, 15), dt.date(2025, 12, 1), dt.date(2025, 12, 31))]


def test_month_in_name_is_null_when_absent(spark):
    df = spark.createDataFrame([("trips_2026-05.parquet",), ("latest.parquet",), (None,)], "f string")
    assert [r[0] for r in df.select(month_in(F.col("f"))).collect()] == ["2026-05", None, None]


def test_hour_grid_does_not_depend_on_daylight_saving(spark):
    grid = hour_grid(spark, dt.datetime(2026, 3, 1), dt.datetime(2026, 5, 31, 23), position="key")
    assert grid.count() == 2208 and grid.select("full_datetime").distinct().count() == 2208
    assert grid.agg(F.max("key"), F.max("full_datetime")).first() == (2208, dt.datetime(2026, 5, 31, 23))


def test_literal_row(spark):
    assert rows(literal_row(spark, a=F.lit(0), b=F.lit("Unknown"))) == [(0, "Unknown")]


def test_day_parts_and_flags_at_their_limits(spark):
    df = spark.createDataFrame([(h,) for h in (4, 5, 11, 12, 16, 17, 21, 22)], "h int")
    assert [r[0] for r in df.select(clock.day_part(F.col("h"))).collect()] == [
        "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night"]
    days = spark.createDataFrame([(1, 8), (6, 8), (6, 10), (7, 16), (2, 19), (2, 20)], "d int, h int")
    got = days.select(clock.is_weekend(F.col("d")), clock.is_rush_hour(F.col("d"), F.col("h"))).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (False, False), (True, False), (False, True),
                                       (False, False)]


def test_minutes_months_and_seasons(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 1, 1, 0, 0), dt.datetime(2026, 3, 1, 1, 10, 20))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = df.select(clock.minutes_between(F.col("a"), F.col("b")), clock.month_of(F.col("a")),
                    clock.hour_of(F.col("b")), clock.season(F.month("a")), clock.season(F.lit(0))).first()
    assert tuple(got) == (10.33, "2026-03", dt.datetime(2026, 3, 1, 1), "Spring", "Unknown")


def test_codes(spark):
    df = spark.createDataFrame([(0,), (99,), (100,), (None,)], "c bigint")
    assert [r[0] for r in df.select(describe(F.col("c"), WEATHER_CODES)).collect()] == [
        "Clear sky", "Thunderstorm with heavy hail", "Unknown", "Unknown"]
    assert len(WEATHER_CODES) == 28


def test_text_helpers(spark):
    df = spark.createDataFrame([("  staten ISLAND ", None), ("EWR", " ")], "a string, b string")
    got = df.select(title_trim(F.col("a")), trimmed_or(F.col("b"), "Unknown"), is_blank(F.col("b")),
                    piped_key(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [("Staten Island", "Unknown", True, "  staten ISLAND |"), ("Ewr", "", True, "EWR| ")]


def test_rounding_and_ratios(spark):
    df = spark.createDataFrame([(1.005, 2.0), (1.00499999999, 0.0), (-1.005, None)], "x double, y double")
    got = df.select(settled_round(F.col("x"), 2), ratio(F.col("x"), F.col("y")).isNull(),
                    percentage(F.lit(1), F.col("y"))).collect()
    assert [tuple(r) for r in got] == [(1.01, False, 50.0), (1.01, True, None), (-1.01, True, None)]
    assert df.select(mean_ratio(F.col("x"), F.col("y"))).first()[0] == 0.5


def test_lineage_columns(spark):
    at = dt.datetime(2026, 6, 1, 12, 30)
    df = spark.createDataFrame([(dt.datetime(2026, 3, 9),)], "t timestamp_ntz").withColumn("file_name", F.lit("f"))
    df = rename_lineage(stamp(stamp_source(df, "t"), "bronze", at), "bronze")
    row = df.first()
    assert (row.bronze_source_file, row.bronze_source_month) == ("f", "2026-03")
    assert (row.bronze_ingestion_timestamp, row.bronze_ingestion_date) == (at, at.date())
    assert stamp(df, "silver").first().silver_ingestion_timestamp is not None


def test_work_folder_comes_from_the_session(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_only_a_local_session_gets_a_folder_of_its_own():
    def fake(master):
        context = SimpleNamespace(master=master, applicationId="app-1")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)

    assert work_dir(fake("local[2]")) == work_dir(fake("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(fake("spark://host:7077"))
