"""What the plans must look like: pushed filters, pruned columns, no needless shuffles, no cross joins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.duplicates import duplicate_summary, exact_duplicate_summary
from lakestrata.operators.lookups import lookup, orphan_counts, within_bounds
from lakestrata.operators.writes import overwrite_path
from lakestrata.plans import analytics
from lakestrata.plans.presets import TRIP_RULES, TRIP_SOURCE_SCHEMA
from lakestrata.plans.silver import clean_events
from lakestrata.quality.checks import Rows, measure
from lakestrata.session import materialize, new_path
from lakestrata.sources.generated import hour_grid

FACT = ("trip_key bigint, pickup_datetime_key bigint, pickup_location_key bigint, weather_key bigint, PULocationID int, "
        "DOLocationID int, lpep_pickup_datetime timestamp_ntz, trip_distance double, trip_duration_minutes double, "
        "fare_amount double, tip_amount double, total_amount double, passenger_count bigint, other string")
CALENDAR = "datetime_key bigint, full_datetime timestamp_ntz, day_name string, hour int, day_of_week int"
WEATHER = ("weather_key bigint, weather_datetime timestamp_ntz, weather_condition string, temperature_2m double, "
           "precipitation double, snowfall double, wind_speed_10m double")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def gold(spark):
    return {n: materialize(spark.createDataFrame([], s)) for n, s in
            {"fact": FACT, "calendar": CALENDAR, "weather": WEATHER}.items()}


def test_cleaning_prunes_partitions_and_pushes_filters(spark):
    path = new_path(spark, "bronze")
    schema = TRIP_SOURCE_SCHEMA + ", source_file string, source_month string, bronze_ingestion_timestamp timestamp, " \
                                  "bronze_ingestion_date date"
    row = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                  for f in spark.createDataFrame([], schema).schema.fields])
    overwrite_path(row.withColumn("source_month", F.lit("2026-03")), path, "source_month")
    text = plan(clean_events(spark.read.parquet(path), TRIP_RULES, dt.date(2026, 6, 1)))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "source_month" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "2026-03" in scan and "PushedFilters: []" not in scan
    assert text.rindex("WindowGroupLimit") < text.rindex("Filter (") < text.index("FileScan")


def test_demand_reads_two_columns_of_the_fact(gold):
    text = plan(analytics.demand_by_time(gold["fact"], gold["calendar"]))
    assert "ReadSchema: struct<trip_key:bigint,pickup_datetime_key:bigint>" in text


def test_reports_have_no_cross_join(gold):
    for report in (analytics.trips_per_weather_hour, analytics.behaviour_by_condition, analytics.monthly_conditions):
        text = plan(report(gold["fact"], gold["weather"]))
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_bounds_reach_the_scan(spark):
    hours = materialize(hour_grid(spark, dt.datetime(2026, 3, 1), dt.datetime(2026, 3, 9), "t"))
    bounds = hours.filter("hour(t) = 5").agg(F.min("t").alias("low"), F.max("t").alias("high"))
    kept = within_bounds(hours, "t", bounds, "low", "high")
    assert "GreaterThanOrEqual(t,2026-03-01T05:00)" in plan(kept) and kept.count() == 7 * 24 + 1
    assert within_bounds(hours, "t", bounds.filter("low is null"), "low", "high").count() == 0


def test_row_checks_share_one_scan(gold):
    checks = [Rows(f"c{i}", failing=F.col(c).isNull()) for i, c in enumerate(gold["fact"].columns)]
    assert plan(measure(gold["fact"], checks)).count("FileScan") == 1


def test_foreign_keys_share_one_scan_and_are_counted_in_their_own_type_before_the_shuffle(gold):
    text = plan(orphan_counts(gold["fact"], {"pickup_datetime_key": (gold["calendar"], "datetime_key"),
                                             "weather_key": (gold["weather"], "weather_key")}))
    assert text.count("ReadSchema: struct<pickup_datetime_key:bigint,weather_key:bigint>") == 1
    assert text.count("FileScan") == 3 and "as string" not in text and "Expand" not in text
    assert text.index("partial_count") > text.index("Exchange hashpartitioning(_fk")  # counted below the exchange


def test_whole_rows_travel_only_where_their_hash_repeats(spark):
    rows = materialize(spark.range(1000).select("id", F.concat(F.lit("row "), F.col("id")).alias("v")))
    text = plan(exact_duplicate_summary(rows.unionByName(rows.filter("id < 10"))))
    assert "BroadcastHashJoin [_h" in text and "Exchange hashpartitioning(_h" not in text


def test_key_duplicates_are_combined_before_the_shuffle_without_expand(gold):
    text = plan(duplicate_summary(gold["fact"].select("trip_key"), ["trip_key"]))
    assert "partial_count" in text and "Expand" not in text


def test_large_dimension_is_shuffled_not_broadcast(spark):
    fact = spark.range(10).withColumnRenamed("id", "k")
    huge = spark.range(10_000_000_000).select("id", F.col("id").alias("v"))
    text = plan(lookup(fact.join(huge, fact.k == huge.id), huge, "k", "id", {"v": "w"}))
    assert "SortMergeJoin" in text
