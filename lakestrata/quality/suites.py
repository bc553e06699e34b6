"""The ten suites. Each function lists the checks of one table; defaults are the warehouse's own.

``run`` takes the checks over a table that is there (``run_suite``) or while the rows are written (``observed.writing``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.functions.text import folded, is_blank, is_untrimmed, piped_key
from lakestrata.functions.time import RUSH_HOURS, WEEKEND_DAYS, month_of
from lakestrata.operators.duplicates import duplicate_summary
from lakestrata.plans.gold import join_trip_dimensions
from lakestrata.plans.presets import (DROPOFF, GOLD_BOROUGHS, PAYMENT_TYPES, PICKUP, RATECODES, SERVICE_ZONES,
                                      SILVER_BOROUGHS, STORE_FLAGS, TIME_PERIODS, TRIP_KEY, TRIP_TYPES,
                                      WEATHER_MEASURES, WEATHER_NON_NEGATIVE, WINDOW_FIRST_HOUR, WINDOW_HOURS,
                                      WINDOW_LAST_HOUR)
from lakestrata.quality.checks import (Check, Other, Reference, Rows, Run, Total, Unique, UniqueRows, Volumes, run_suite,
                                       simple_report, source_report, table_report)
from lakestrata.quality.rules import FACT_RULES, LOCATION_RULES, SILVER_ZONE_RULES, SOURCE_RULES, STRICT
from lakestrata.sources.discovery import month_in

def _count() -> Column:
    return F.count(F.lit(1))


def any_null(*columns: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def any_negative(*columns: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns])


def not_in(column: Column, accepted: list) -> Column:
    """Outside the accepted values; NULL is neither in nor out and is not counted."""
    return ~column.isin(accepted)


def listing(values: list) -> str:
    return ", ".join(str(v) for v in values)


def _volume(name: str, wanted: Column, check_type: str = "", **shown) -> Total:
    return Total(name, check_type, F.abs(_count() - wanted), **shown)


def _scalar_count(df: DataFrame) -> Column:
    return df.agg(_count().alias("n")).scalar()


# Source and Bronze ----------------------------------------------------------------------------------------

def _source_common(total_name: str, keys: list[str], min_rows: int) -> tuple[list[Check], Check]:
    short = F.greatest(F.lit(min_rows) - _count(), F.lit(0))
    first = [Total(total_name, "VOLUME", short, severity="CRITICAL", base=F.greatest(_count(), F.lit(1))),
             Unique("Duplicate composite key check (7-columns)", "UNIQUE", keys, severity="COMPOSITE_KEY"),
             UniqueRows("Exact duplicate rows", "UNIQUE", severity="COMPOSITE_KEY")]
    nulls = Rows("Null count for mandatory key fields (7-columns)", "NULL", any_null(*keys), severity="OTHER_DQ")
    return first, nulls


def download_suite(raw: DataFrame, file_column: str = "file_name", event_time: str = PICKUP,
                   keys: list[str] = TRIP_KEY, min_rows: int = 0, run: Run = run_suite) -> DataFrame:
    """Raw files before loading. ``file_column`` holds the file name of each row.

    A file name without a month counts under UNKNOWN. The row count only informs, also for an empty
    source, unless ``min_rows`` asks for more.
    """
    rows = raw.withColumns({"source_month": F.coalesce(month_in(F.col(file_column)), F.lit("UNKNOWN")),
                            "pickup_month": F.coalesce(month_of(F.col(event_time)), F.lit("UNKNOWN"))})
    first, nulls = _source_common("Total Downloaded Row Count", keys, min_rows)
    checks = [*first, nulls,
              Volumes("Monthly Row Count by Source Month", "VOLUME", F.col("source_month"), 10),
              Volumes("Monthly Row Count by Pickup Date", "VOLUME", F.col("pickup_month"), 100)]
    return source_report(run(rows.drop(file_column), checks, SOURCE_RULES, ""))


def bronze_trip_suite(bronze: DataFrame, event_time: str = PICKUP, keys: list[str] = TRIP_KEY,
                      lineage: tuple[str, ...] = ("source_file", "source_month", "bronze_ingestion_timestamp",
                                                  "bronze_ingestion_date"), min_rows: int = 0, run: Run = run_suite) -> DataFrame:
    """Bronze trips after loading; the file month falls back to the source month, then to UNKNOWN."""
    file_month = F.coalesce(month_in(F.col(lineage[0])), F.col(lineage[1]), F.lit("UNKNOWN"))
    first, nulls = _source_common("Total Loaded Row Count", keys, min_rows)
    checks = [*first,
              Rows("Audit lineage population", "LINEAGE", any_null(*lineage), severity="OTHER_DQ"),
              nulls,
              Rows("Non-positive trip distance", "RANGE", F.col("trip_distance") <= 0,
                   severity="OTHER_DQ"),
              Rows("Negative total amount", "RANGE", F.col("total_amount") < 0, severity="OTHER_DQ"),
              Volumes("Monthly Row Count by Source File Month", "VOLUME", file_month, 10),
              Volumes("Monthly Row Count by Pickup Date Month", "VOLUME",
                      F.coalesce(month_of(F.col(event_time)), F.lit("UNKNOWN")), 100)]
    return source_report(run(bronze, checks, SOURCE_RULES, ""))


def _series_checks(time: str, lineage: list[str]) -> list[Check]:
    return [Rows("Completeness", failing=any_null(time, *WEATHER_MEASURES, "weather_code")),
            Unique("Uniqueness", keys=[time], skip_null=True),
            Rows("Lineage", failing=any_null(*lineage)),
            Rows("Validity", failing=any_negative(*WEATHER_NON_NEGATIVE))]


def _range_check(name: str, time: str, first: str, last: str) -> Total:
    def at(text: str) -> Column:
        return F.lit(text).cast("timestamp_ntz")
    matches = (F.min(time) == at(first)) & (F.max(time) == at(last))
    return Total(name, failures=F.when(matches, 0).otherwise(1))


def bronze_weather_suite(bronze: DataFrame, hours: int = WINDOW_HOURS, first: str = WINDOW_FIRST_HOUR,
                         last: str = WINDOW_LAST_HOUR, time: str = "timestamp",
                         lineage: tuple[str, ...] = ("source_file", "bronze_ingestion_timestamp",
                                                     "bronze_ingestion_date"), run: Run = run_suite) -> DataFrame:
    checks = [*_series_checks(time, list(lineage)), _volume("Volume", F.lit(hours)),
              _range_check("Timestamp Range", time, first, last)]
    return simple_report(run(bronze, checks, STRICT, ""))


# Silver ---------------------------------------------------------------------------------------------------

def silver_trip_suite(silver: DataFrame, bronze: DataFrame, valid: Column, keys: list[str] = TRIP_KEY,
                      flags: list[str] = STORE_FLAGS, run: Run = run_suite) -> DataFrame:
    """``valid`` is the row filter the cleaner used: the expected volume is the distinct keys it lets through."""
    flag = F.col("store_and_fwd_flag")
    expected = duplicate_summary(bronze.filter(valid).select(*keys), keys).select("unique_keys").scalar()
    checks = [
        Rows("Completeness", failing=any_null(PICKUP, DROPOFF, "PULocationID", "DOLocationID")),
        Unique("Uniqueness", keys=keys),
        Rows("Lineage", failing=any_null("bronze_source_file", "bronze_source_month", "bronze_ingestion_timestamp",
                                         "bronze_ingestion_date", "silver_ingestion_timestamp",
                                         "silver_ingestion_date")),
        Rows("Standardization", failing=flag.isNull() | is_untrimmed(flag) | not_in(flag, flags)),
        Rows("Cleaned Fields", failing=any_null("RatecodeID", "passenger_count", "payment_type", "trip_type",
                                                "congestion_surcharge")),
        _volume("Volume", expected)]
    return simple_report(run(silver, checks, STRICT, ""))


def silver_zone_suite(silver: DataFrame, bronze: DataFrame, boroughs: list[str] = SILVER_BOROUGHS,
                      service_zones: list[str] = SERVICE_ZONES, case_insensitive: bool = False,
                      table: str = "taxi_zones_silver", run: Run = run_suite) -> DataFrame:
    """Accepted values are compared as written unless ``case_insensitive``."""
    def outside(column: str, accepted: list[str]) -> Column:
        if case_insensitive:
            return not_in(folded(F.col(column)), [v.upper() for v in accepted])
        return not_in(F.col(column), accepted)

    texts = ["borough", "zone", "service_zone"]
    expected = _scalar_count(bronze)
    checks = [
        _volume("Bronze-to-Silver row count match", expected, "VOLUME", expected=expected.cast("string")),
        Rows("Missing location_id", "NULL", any_null("location_id")),
        *[Rows(f"Missing {c}", "NULL", any_null(c)) for c in texts],
        Unique("Duplicate location_id primary key", "UNIQUE", ["location_id"], skip_null=True),
        Rows("Unstandardized text values", "STANDARDIZATION",
             reduce(lambda a, b: a | b, [is_untrimmed(F.col(c)) for c in texts])),
        Rows("Invalid borough value", "VALIDITY", outside("borough", boroughs), listing(boroughs)),
        Rows("Invalid service_zone value", "VALIDITY", outside("service_zone", service_zones),
             listing(service_zones)),
        *[Rows(f"Missing {c}", "LINEAGE", any_null(c)) for c in ("silver_ingestion_timestamp",
                                                                 "silver_ingestion_date")]]
    return table_report(run(silver, checks, SILVER_ZONE_RULES, table))


def silver_weather_suite(silver: DataFrame, hours: int = WINDOW_HOURS, time: str = "timestamp", run: Run = run_suite) -> DataFrame:
    lineage = ["bronze_source_file", "bronze_ingestion_timestamp", "bronze_ingestion_date",
               "silver_ingestion_timestamp", "silver_ingestion_date"]
    checks = [*_series_checks(time, lineage), _volume("Volume", F.lit(hours))]
    return simple_report(run(silver, checks, STRICT, ""))


# Gold -----------------------------------------------------------------------------------------------------

def calendar_suite(calendar: DataFrame, hours: int = WINDOW_HOURS, first_day: str = "2026-03-01",
                   last_day: str = "2026-05-31", period: str = "March-May 2026",
                   table: str = "dim_datetime", run: Run = run_suite) -> DataFrame:
    """Hour table including the unknown member (key 0), which the flag and range checks leave out."""
    known = F.col("datetime_key") > 0
    weekend_day = F.col("day_of_week").isin(WEEKEND_DAYS)
    workday = F.col("day_of_week").between(2, 6)
    rush = F.col("hour").isin(RUSH_HOURS)
    wrong_weekend = known & ((weekend_day & ~F.col("is_weekend")) | (workday & F.col("is_weekend")))
    wrong_rush = known & ((workday & rush & ~F.col("is_rush_hour")) | ((weekend_day | ~rush) & F.col("is_rush_hour")))
    outside = known & ((F.col("date") < F.lit(first_day).cast("date")) | (F.col("date") > F.lit(last_day).cast("date")))

    def rows(name: str, check_type: str, failing: Column) -> Rows:
        return Rows(name, check_type, failing, null_if_empty=True)

    expected = hours + 1
    checks = [
        rows("Missing gold_ingestion_date", "LINEAGE", any_null("gold_ingestion_date")),
        rows("Missing gold_ingestion_timestamp", "LINEAGE", any_null("gold_ingestion_timestamp")),
        *[rows(f"Missing {c}", "NULL", any_null(c))
          for c in ("datetime_key", "full_datetime", "date", "day_name", "month_name")],
        rows("Unstandardized text values", "STANDARDIZATION", not_in(F.col("time_period"), TIME_PERIODS)),
        rows("Invalid weekend flag logic", "STANDARDIZATION", wrong_weekend),
        rows("Invalid rush hour flag logic", "STANDARDIZATION", wrong_rush),
        Unique("Duplicate datetime_key primary key", "UNIQUE", ["datetime_key"], skip_null=True),
        _volume(f"Expected hourly row count match ({period})", F.lit(expected), "VOLUME", expected=str(expected),
                base=F.max(F.lit(expected))),
        rows(f"Records outside {period} date range", "DATE_RANGE", outside)]
    report = table_report(run(calendar, checks, STRICT, table))
    return report.withColumn("expected_value", F.col("expected_value").cast("int"))


def location_suite(location: DataFrame, silver: DataFrame, boroughs: list[str] = GOLD_BOROUGHS,
                   table: str = "dim_location", run: Run = run_suite) -> DataFrame:
    """``Location has conflicting attributes`` reports the offending ids as both checked and failed."""
    texts = ["borough", "zone", "service_zone"]
    ids = silver.select("location_id").dropna().distinct()
    expected = _scalar_count(ids)
    tuples = location.groupBy("location_id").agg(
        F.count_distinct(piped_key(*[folded(F.col(c)) for c in texts])).alias("n"))
    conflicts = tuples.filter("n > 1").agg(_count().alias("records"), _count().alias("failures"))
    members = location.select("location_id", F.lit(True).alias("in_gold"))
    missing = ids.join(members, "location_id", "left").agg(
        _count().alias("records"), F.count_if(F.col("in_gold").isNull()).alias("failures"))
    strangers = location.join(ids.withColumn("known", F.lit(True)), "location_id", "left").agg(
        _count().alias("records"), F.count_if(F.col("known").isNull()).alias("failures"))
    accepted = F.col("borough").isNotNull() & not_in(folded(F.col("borough")), boroughs)
    checks = [
        _volume("Row count vs unique Silver locations", expected, "VOLUME", expected=expected.cast("string"),
                actual=_count()),
        Rows("Missing location_key", "NULL", any_null("location_key")),
        Unique("Duplicate location_key", "UNIQUE", ["location_key"], skip_null=True),
        Rows("Missing location_id", "NULL", any_null("location_id")),
        Unique("Duplicate location business key", "UNIQUE", ["location_id"], skip_null=True),
        *[Rows(f"Missing {c}", "NULL", is_blank(F.col(c))) for c in texts],
        Rows("Invalid location_id", "RANGE", F.col("location_id").isNull() | (F.col("location_id") <= 0), "> 0"),
        Rows("Invalid borough value", "ACCEPTED_VALUE", accepted, listing(boroughs)),
        Other("Location has conflicting attributes", "BUSINESS_RULE", conflicts),
        Other("Silver locations missing from Gold", "REFERENTIAL_INTEGRITY", missing),
        Other("Gold locations missing from Silver", "REFERENTIAL_INTEGRITY", strangers)]
    return table_report(run(location, checks, LOCATION_RULES, table), with_actual=True)


def weather_suite(weather: DataFrame, hours: int = WINDOW_HOURS, first: str = WINDOW_FIRST_HOUR,
                  last: str = WINDOW_LAST_HOUR, run: Run = run_suite) -> DataFrame:
    label = F.col("weather_condition")
    checks = [
        Rows("Completeness", failing=any_null("weather_datetime", *WEATHER_MEASURES, "weather_code",
                                              "weather_condition")),
        Unique("Uniqueness", keys=["weather_datetime"], skip_null=True),
        Rows("Measurement Validity", failing=any_negative(*WEATHER_NON_NEGATIVE)),
        Rows("Weather Code Mapping", failing=(label == "Unknown") | label.isNull()),
        Rows("Weather Key Completeness", failing=any_null("weather_key")),
        Unique("Weather Key Uniqueness", keys=["weather_key"], skip_null=True),
        _volume("Volume", F.lit(hours)),
        _range_check("Timestamp Range", "weather_datetime", first, last)]
    return simple_report(run(weather, checks, STRICT, ""))


def fact_suite(fact: DataFrame, silver: DataFrame, calendar: DataFrame, location: DataFrame, weather: DataFrame,
               payment_types: list[int] = PAYMENT_TYPES, trip_types: list[int] = TRIP_TYPES,
               ratecodes: list[int] = RATECODES, table: str = "fact_taxi_trip", run: Run = run_suite) -> DataFrame:
    """Fact checks; the weather reference is informational because the weather is optional.

    The natural key is compared as a tuple, in which NULL and empty text are different values.
    """
    expected = _scalar_count(join_trip_dimensions(silver, calendar, location))
    natural = ["vendor_id" if c == "VendorID" else c for c in TRIP_KEY]
    checks = [
        _volume("Row count vs expected join result", expected, "VOLUME", expected=expected.cast("string"),
                actual=_count()),
        Rows("Missing trip_key", "NULL", any_null("trip_key")),
        Rows("Missing surrogate FK columns", "NULL",
             any_null("pickup_datetime_key", "dropoff_datetime_key", "pickup_location_key", "dropoff_location_key")),
        Unique("Duplicate trip_key", "UNIQUE", ["trip_key"], skip_null=True),
        Unique("Duplicate natural key", "UNIQUE", natural),
        Rows("Missing natural FK columns", "NULL", any_null(PICKUP, DROPOFF, "PULocationID", "DOLocationID")),
        *[Reference(f"{c} not in dim_location", "REFERENTIAL_INTEGRITY", c, location, "location_key")
          for c in ("pickup_location_key", "dropoff_location_key")],
        *[Reference(f"{c} not in dim_datetime", "REFERENTIAL_INTEGRITY", c, calendar, "datetime_key")
          for c in ("pickup_datetime_key", "dropoff_datetime_key")],
        Reference("weather_key not in dim_weather (informational, LEFT JOIN is expected)", "REFERENTIAL_INTEGRITY",
                  "weather_key", weather, "weather_key"),
        Rows("Invalid trip_distance", "RANGE", F.col("trip_distance") <= 0, "> 0"),
        Rows("Negative trip_duration_minutes", "RANGE", F.col("trip_duration_minutes") < 0, ">= 0"),
        Rows("Negative fare_amount", "RANGE", F.col("fare_amount") < 0, ">= 0"),
        Rows("Negative total_amount", "RANGE", F.col("total_amount") < 0, ">= 0"),
        Rows("Invalid passenger_count", "RANGE", F.col("passenger_count") <= 0, "> 0"),
        Rows("Invalid payment_type", "ACCEPTED_VALUE", not_in(F.col("payment_type"), payment_types),
             listing(payment_types)),
        Rows("Invalid trip_type", "ACCEPTED_VALUE", not_in(F.col("trip_type"), trip_types), listing(trip_types)),
        Rows("Invalid ratecode_id", "ACCEPTED_VALUE", not_in(F.col("ratecode_id"), ratecodes), listing(ratecodes)),
        Rows("Missing gold_processed_timestamp/date", "LINEAGE",
             any_null("gold_processed_timestamp", "gold_processed_date"))]
    return table_report(run(fact, checks, FACT_RULES, table), with_actual=True)
