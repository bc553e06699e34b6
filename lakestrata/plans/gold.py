"""Gold: calendar, reference and coded dimensions, and the trip fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.functions import time as clock
from lakestrata.functions.codes import describe
from lakestrata.operators.dedupe import keep_one
from lakestrata.operators.keys import number_rows
from lakestrata.operators.lineage import stamp
from lakestrata.operators.lookups import lookup
from lakestrata.operators.upsert import upsert, upsert_keyed
from lakestrata.plans.presets import DROPOFF, PICKUP, TRIP_KEY_ORDER, TRIP_MONEY, WEATHER_MEASURES
from lakestrata.session import materialize
from lakestrata.sources.generated import hour_grid, literal_row

UNKNOWN = "Unknown"
UNKNOWN_DAY = dt.datetime(1900, 1, 1)


def build_calendar(spark: SparkSession, start: dt.datetime, end: dt.datetime, *, with_season: bool = False,
                   at: dt.datetime | None = None) -> DataFrame:
    """One row per hour from start to end plus the unknown member with key 0.

    The key counts hours from the unknown member's day, so an hour has the same key in every calendar,
    and no window over all rows is needed to number them.
    """
    t = F.col("full_datetime")
    epoch = F.lit(UNKNOWN_DAY.isoformat(sep=" ")).cast("timestamp_ntz")
    key = ((clock.wall_seconds(t) - clock.wall_seconds(epoch)) / 3600).cast("long")
    hours = hour_grid(spark, start, end, "full_datetime").select(key.alias("datetime_key"), t)
    parts = hours.withColumns({
        "date": t.cast("date"),
        "day": F.dayofmonth(t),
        "day_name": F.date_format(t, "EEEE"),
        "hour": F.hour(t),
        "hour_label": F.date_format(t, "hh a"),
        "time_period": clock.day_part(F.hour(t)),
        "week_of_year": F.weekofyear(t),
        "month": F.month(t),
        "month_name": F.date_format(t, "MMMM"),
        "quarter": F.quarter(t),
        "year": F.year(t),
        "is_weekend": clock.is_weekend(F.dayofweek(t)),
        "is_rush_hour": clock.is_rush_hour(F.dayofweek(t), F.hour(t)),
        "day_of_week": F.dayofweek(t),
    })
    texts = {"day_name", "hour_label", "time_period", "month_name"}
    flags = {"is_weekend", "is_rush_hour"}
    values = {"datetime_key": F.lit(0).cast("long"),
              "full_datetime": F.lit(UNKNOWN_DAY.isoformat(sep=" ")).cast("timestamp_ntz"),
              "date": F.lit(UNKNOWN_DAY.date()), "year": F.lit(UNKNOWN_DAY.year)}
    member = literal_row(spark, **{
        c: values[c] if c in values else F.lit(UNKNOWN) if c in texts else F.lit(False) if c in flags else F.lit(0)
        for c in parts.columns})
    calendar = member.unionByName(parts)
    if with_season:
        calendar = calendar.withColumn("season", clock.season(F.col("month")))
    return stamp(calendar, "gold", at)


def refresh_calendar(target: DataFrame, calendar: DataFrame, delete_unmatched: bool = False) -> DataFrame:
    """Upsert on the hour; every other column, the key included, is refreshed."""
    return upsert(target, calendar, ["full_datetime"], null_safe=False, delete_unmatched=delete_unmatched,
                  check_source=False)


def build_reference_dim(silver: DataFrame, business_key: str, key: str, attributes: list[str],
                        existing: DataFrame | None = None, at: dt.datetime | None = None) -> DataFrame:
    """Reference dimension with a surrogate key per business key; known members keep theirs."""
    rows = silver.select(business_key, *attributes, "silver_ingestion_timestamp", "silver_ingestion_date")
    rows = stamp(rows, "gold", at)
    if existing is None:
        return number_rows(rows, key, [business_key])
    return upsert_keyed(existing, rows, [business_key], key, [business_key], null_safe=False, check_source=False)


def build_coded_dim(silver: DataFrame, time_column: str, code_column: str, names: dict[int, str], *,
                    member_time: str = "weather_datetime", key: str = "weather_key",
                    label: str = "weather_condition", measures: list[str] = WEATHER_MEASURES,
                    latest_by: str = "silver_ingestion_timestamp", existing: DataFrame | None = None,
                    at: dt.datetime | None = None) -> DataFrame:
    """Time-series dimension: latest reading per time, code described in words, surrogate key."""
    rows = keep_one(silver.filter(F.col(time_column).isNotNull()), [time_column], [latest_by])
    rows = rows.select(
        F.col(time_column).alias(member_time), *measures, F.col(code_column).cast("int").alias(code_column),
        describe(F.col(code_column), names).alias(label), "silver_ingestion_timestamp", "silver_ingestion_date")
    rows = stamp(rows, "gold", at)
    if existing is None:
        return number_rows(rows, key, [member_time])
    return upsert_keyed(existing, rows, [member_time], key, [member_time], null_safe=False, check_source=False)


def join_trip_dimensions(silver: DataFrame, calendar: DataFrame, location: DataFrame) -> DataFrame:
    """Silver trips with the surrogate keys of both calendar roles and both location roles.

    Trips without a calendar or location member are dropped.
    """
    trips = lookup(silver, calendar, clock.hour_of(F.col(PICKUP)), "full_datetime",
                   {"datetime_key": "pickup_datetime_key"})
    trips = lookup(trips, calendar, clock.hour_of(F.col(DROPOFF)), "full_datetime",
                   {"datetime_key": "dropoff_datetime_key"})
    trips = lookup(trips, location, "PULocationID", "location_id", {"location_key": "pickup_location_key"})
    return lookup(trips, location, "DOLocationID", "location_id", {"location_key": "dropoff_location_key"})


SMALL_LOAD = 10  # a load of less than a tenth of the fact is looked up in it, a larger one joined with it
FACT_ORDER = ["vendor_id" if c == "VendorID" else c for c in TRIP_KEY_ORDER]


def trip_fact_rows(silver: DataFrame, calendar: DataFrame, location: DataFrame, weather: DataFrame,
                   at: dt.datetime | None = None) -> DataFrame:
    """Fact rows without their surrogate key."""
    trips = lookup(join_trip_dimensions(silver, calendar, location), weather, clock.hour_of(F.col(PICKUP)),
                   "weather_datetime", {"weather_key": "weather_key"}, optional=True)
    rows = trips.select(
        F.col("VendorID").alias("vendor_id"), F.col("RatecodeID").alias("ratecode_id"), "store_and_fwd_flag",
        "trip_type", "pickup_datetime_key", "dropoff_datetime_key", "pickup_location_key",
        "dropoff_location_key", "weather_key", PICKUP, DROPOFF, "PULocationID", "DOLocationID",
        "payment_type", "passenger_count", "trip_distance",
        clock.minutes_between(F.col(PICKUP), F.col(DROPOFF)).alias("trip_duration_minutes"), *TRIP_MONEY)
    return stamp(rows, "gold", at, names=("gold_processed_timestamp", "gold_processed_date"))


def build_trip_fact(silver: DataFrame, calendar: DataFrame, location: DataFrame, weather: DataFrame,
                    existing: DataFrame | None = None, at: dt.datetime | None = None) -> DataFrame:
    """The trip fact. Matching against ``existing`` uses the trip's own values, not surrogate keys.

    ``existing`` is counted and, beside a small load, passed through; for a large fact ``Warehouse.refresh_fact`` touches only the months
    of the load.
    """
    rows = trip_fact_rows(silver, calendar, location, weather, at)
    if existing is None:
        return number_rows(rows, "trip_key", FACT_ORDER)
    batch = materialize(rows, "fact-batch")
    return upsert_keyed(existing, batch, FACT_ORDER, "trip_key", FACT_ORDER, bulk=SMALL_LOAD * batch.count() >= existing.count(),
                        check_source=False)
