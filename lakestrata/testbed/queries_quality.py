"""The quality suites over the stand-in warehouse, with seeded defects so that every status occurs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.quality import rules
from lakestrata.quality.observed import writing, writing_partitions
from lakestrata.quality.store import QualityGateFailed, append_report, gate, stored_reports, summarise
from lakestrata.quality.suites import (bronze_trip_suite, bronze_weather_suite, calendar_suite, download_suite,
                                       fact_suite, location_suite, silver_trip_suite, silver_weather_suite,
                                       silver_zone_suite, weather_suite)
from lakestrata.functions.numeric import percentage
from lakestrata.plans.presets import WEATHER_MEASURES, WEATHER_NON_NEGATIVE
from lakestrata.plans.silver import is_valid_event
from lakestrata.session import materialize, new_path
from lakestrata.testbed.registry import query
from lakestrata.testbed.sql import (CALENDAR, FACT, KEY, SILVER, SIMPLE, SOURCE, SOURCE_STATUS, TABLE, TABLE_ACTUAL,
                                    TRIPS, VALID, WEATHER, ZONES, check, pct, rows, suite, warn)
from lakestrata.testbed.standins import BOROUGHS, RULES, UNTIL, bronze_zones, load, table

NULL_KEY = " OR ".join(f"{c.strip()} IS NULL" for c in KEY.split(","))
FIRST, LAST = "1995-01-01 00:00:00", "2001-08-01 00:00:00"


def _distinct(table_name: str, columns: str) -> str:
    return f"(SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {table_name}))"


def _duplicates(table_name: str, name: str, kind: str, columns: str, severity: str = "") -> str:
    return check(name, kind, "count(*)", f"count(*) - {_distinct(table_name, columns)}", severity=severity) \
        + f" FROM {table_name}"


def _keys(table_name: str, name: str, kind: str, column: str) -> str:
    """Uniqueness of one column, in which NULL is no value."""
    return check(name, kind, "count(*)", f"count(*) - count(DISTINCT {column})") + f" FROM {table_name}"


def _nulls(*columns: str) -> str:
    return " OR ".join(f'"{c}" IS NULL' for c in columns)


Defects = list[tuple[str, str, str]]  # column, rows that are spoilt, what they get; texts valid in both dialects


def _cases(defects: Defects) -> dict[str, str]:
    columns = dict.fromkeys(c for c, _, _ in defects)
    return {c: "CASE " + " ".join(f"WHEN {where} THEN {value}" for d, where, value in defects if d == c) + f" ELSE `{c}` END"
            for c in columns}


def spoilt(df: DataFrame, defects: Defects, doubled: str) -> DataFrame:
    """The table with some rows twice and some values spoilt, so that every check sees failing rows."""
    grown = df.unionByName(df.filter(doubled))
    return grown.withColumns({c: F.expr(case) for c, case in _cases(defects).items()})


def spoilt_sql(source: str, name: str, defects: Defects, doubled: str, stamps: str = "") -> str:
    """The same for the SQL check; ``stamps`` are the audit columns that the SQL tables go without."""
    replaced = ", ".join(f"{case} AS `{c}`" for c, case in _cases(defects).items())
    return f""", {name} AS (
  WITH stamped AS (SELECT *{", " if stamps else ""}{stamps} FROM {source}),
  grown AS (SELECT * FROM stamped UNION ALL SELECT * FROM stamped WHERE {doubled})
  SELECT * REPLACE ({replaced}) FROM grown)""".replace("`", '"')


def _stamps(*layers: str) -> str:
    return ", ".join(f"TIMESTAMP '2026-06-01' AS {n}_timestamp, DATE '2026-06-01' AS {n}_date" for n in layers)


def _volumes(table_name: str, name: str, label: str) -> str:
    return (check("x", "VOLUME", "count(*)", "0", severity="MONTHLY_COUNT")
            .replace("'x'", f"'{name} (' || {label} || ')'") + f" FROM {table_name} GROUP BY {label}")


# Sources and Bronze ---------------------------------------------------------------------------------------

_MONTH = "coalesce(nullif(regexp_extract(source_file, '(\\d{4}-\\d{2})', 1), ''), 'UNKNOWN')"
_RAW = """, raw AS (SELECT * EXCLUDE (delivery, source_month, VendorID), nullif(VendorID, 2) AS VendorID,
  {month} AS file_month FROM trips)""".format(month=_MONTH)


@query("dq_raw", TRIPS + _RAW + suite([
    check("Total Downloaded Row Count", "VOLUME", "count(*)", "0", severity="CRITICAL") + " FROM raw",
    _duplicates("raw", "Duplicate composite key check (7-columns)", "UNIQUE", KEY, "COMPOSITE_KEY"),
    _duplicates("raw", "Exact duplicate rows", "UNIQUE", "* EXCLUDE (source_file)", "COMPOSITE_KEY"),
    rows("raw", "Null count for mandatory key fields (7-columns)", "NULL", NULL_KEY, severity="OTHER_DQ"),
    _volumes("raw", "Monthly Row Count by Source Month", "file_month"),
    _volumes("raw", "Monthly Row Count by Pickup Date", "strftime(lpep_pickup_datetime, '%Y-%m')"),
], SOURCE_STATUS, SOURCE))
def dq_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with a NULL vendor here and there."""
    raw = table(spark, sf_dir, "landed_trips").drop("delivery").withColumn("VendorID", F.nullif("VendorID", F.lit(2)))
    return download_suite(raw)


_BRONZE_DEFECTS: Defects = [
    ("source_file", "VendorID = 7", "NULL"), ("PULocationID", "VendorID = 5 AND trip_distance = 3", "NULL"),
    ("bronze_ingestion_date", "VendorID = 6 AND trip_distance = 30", "NULL")]
_BRONZE_TWICE = "VendorID = 4 AND trip_distance = 8"
_BRONZE = spoilt_sql("trips", "bronze", _BRONZE_DEFECTS, _BRONZE_TWICE, _stamps("bronze_ingestion"))
_FILE_MONTH = "coalesce(nullif(regexp_extract(source_file, '(\\d{4}-\\d{2})', 1), ''), source_month, 'UNKNOWN')"


@query("dq_bronze_fact", TRIPS + _BRONZE + suite([
    check("Total Loaded Row Count", "VOLUME", "count(*)", "0", severity="CRITICAL") + " FROM bronze",
    _duplicates("bronze", "Duplicate composite key check (7-columns)", "UNIQUE", KEY, "COMPOSITE_KEY"),
    _duplicates("bronze", "Exact duplicate rows", "UNIQUE", "*", "COMPOSITE_KEY"),
    rows("bronze", "Audit lineage population", "LINEAGE", _nulls("source_file", "source_month", "bronze_ingestion_timestamp",
                                                                 "bronze_ingestion_date"), severity="OTHER_DQ"),
    rows("bronze", "Null count for mandatory key fields (7-columns)", "NULL", NULL_KEY, severity="OTHER_DQ"),
    rows("bronze", "Non-positive trip distance", "RANGE", "trip_distance <= 0", severity="OTHER_DQ"),
    rows("bronze", "Negative total amount", "RANGE", "total_amount < 0", severity="OTHER_DQ"),
    _volumes("bronze", "Monthly Row Count by Source File Month", _FILE_MONTH),
    _volumes("bronze", "Monthly Row Count by Pickup Date Month", "strftime(lpep_pickup_datetime, '%Y-%m')"),
], SOURCE_STATUS, SOURCE))
def dq_bronze_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze trips with missing file names, keys and dates, and rows loaded twice."""
    return bronze_trip_suite(spoilt(table(spark, sf_dir, "bronze_trips"), _BRONZE_DEFECTS, _BRONZE_TWICE))


_NON_NEGATIVE = " OR ".join(f"{c} < 0" for c in WEATHER_NON_NEGATIVE)
_BRONZE_SERIES_DEFECTS: Defects = [
    ("rain", "weather_code = 61 AND temperature_2m = 3", "-0.5"), ("temperature_2m", "weather_code = 3 AND wind_speed_10m = 4", "NULL"),
    ("source_file", "weather_code = 0 AND wind_speed_10m = 7", "NULL"),
    ("bronze_ingestion_date", "weather_code = 71 AND temperature_2m = 0", "NULL")]
_BRONZE_SERIES_TWICE = "weather_code = 100 AND wind_speed_10m = 1"
_BRONZE_SERIES = spoilt_sql("readings", "b", _BRONZE_SERIES_DEFECTS, _BRONZE_SERIES_TWICE,
                            "ts AS \"timestamp\", precipitation AS rain, 'readings.json' AS source_file, " + _stamps("bronze_ingestion"))
_RANGE = f"CASE WHEN min({{0}}) = TIMESTAMP '{FIRST}' AND max({{0}}) = TIMESTAMP '{LAST}' THEN 0 ELSE 1 END"


_BRONZE_SERIES_CHECKS = [
    rows("b", "Completeness", "", _nulls("timestamp", *WEATHER_MEASURES, "weather_code")),
    _keys("b", "Uniqueness", "", "\"timestamp\""),
    rows("b", "Lineage", "", _nulls("source_file", "bronze_ingestion_timestamp", "bronze_ingestion_date")),
    rows("b", "Validity", "", _NON_NEGATIVE),
    check("Volume", "", "count(*)", "abs(count(*) - 57697)") + " FROM b",
    check("Timestamp Range", "", "count(*)", _RANGE.format("ts")) + " FROM b"]


def _spoilt_bronze_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoilt(table(spark, sf_dir, "bronze_weather"), _BRONZE_SERIES_DEFECTS, _BRONZE_SERIES_TWICE)


@query("dq_bronze_series", WEATHER + _BRONZE_SERIES + suite(_BRONZE_SERIES_CHECKS, "", SIMPLE))
def dq_bronze_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze weather with missing and negative measures, missing lineage and doubled readings."""
    return bronze_weather_suite(_spoilt_bronze_series(spark, sf_dir), 57697, FIRST, LAST)


# Silver ---------------------------------------------------------------------------------------------------

_SILVER_DEFECTS: Defects = [
    ("store_and_fwd_flag", "VendorID = 4", "'y '"), ("trip_type", "trip_type = 2", "NULL"),
    ("DOLocationID", "VendorID = 1 AND trip_distance = 5", "NULL"), ("silver_ingestion_date", "VendorID = 2 AND trip_distance = 9", "NULL"),
    ("bronze_source_file", "VendorID = 3 AND trip_distance = 6", "NULL")]
_SILVER_TWICE = "VendorID = 3 AND trip_distance = 11"
_SPOILT_SILVER = spoilt_sql("silver", "checked", _SILVER_DEFECTS, _SILVER_TWICE, "source_file AS bronze_source_file, "
                            "source_month AS bronze_source_month, " + _stamps("bronze_ingestion", "silver_ingestion"))
_SILVER_CHECKS = [
    rows("checked", "Completeness", "", _nulls("lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID")),
    _duplicates("checked", "Uniqueness", "", KEY),
    rows("checked", "Lineage", "", _nulls("bronze_source_file", "bronze_source_month", "bronze_ingestion_timestamp",
                                          "bronze_ingestion_date", "silver_ingestion_timestamp", "silver_ingestion_date")),
    rows("checked", "Standardization", "", "store_and_fwd_flag IS NULL OR store_and_fwd_flag <> trim(store_and_fwd_flag) "
         "OR store_and_fwd_flag NOT IN ('Y', 'N', 'Unknown')"),
    rows("checked", "Cleaned Fields", "", "RatecodeID IS NULL OR passenger_count IS NULL OR payment_type IS NULL "
         "OR trip_type IS NULL OR congestion_surcharge IS NULL"),
    check("Volume", "", "count(*)", f"abs(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {KEY} FROM trips "
          f"WHERE {VALID})))") + " FROM checked"]


def _spoilt_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoilt(table(spark, sf_dir, "silver_trips"), _SILVER_DEFECTS, _SILVER_TWICE)


@query("dq_silver_fact", SILVER + _SPOILT_SILVER + suite(_SILVER_CHECKS, "", SIMPLE))
def dq_silver_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver trips with an untrimmed flag for one vendor, unfilled values, missing lineage and doubled rows."""
    return silver_trip_suite(_spoilt_silver(spark, sf_dir), table(spark, sf_dir, "bronze_trips"), is_valid_event(RULES, UNTIL))


_SILVER_ZONE_STATUS = ("WHEN check_name = 'Missing location_id' THEN 'FAIL' "
                       + warn("'UNIQUE', 'NULL', 'STANDARDIZATION', 'LINEAGE', 'VALIDITY'", 1) + " " + warn("'VOLUME'", 2))
_BOROUGH_TEXT = ", ".join(BOROUGHS)
_BOROUGH_SQL = ", ".join(f"'{b}'" for b in BOROUGHS)


_ZONE_DEFECTS: Defects = [
    ("service_zone", "location_id = 3", "'EWR '"), ("service_zone", "location_id = 5", "NULL"), ("location_id", "location_id = 6", "NULL"),
    ("borough", "location_id = 8", "NULL"), ("borough", "location_id = 2", "'Atlantis'"), ("zone", "location_id = 9", "NULL"),
    ("silver_ingestion_timestamp", "location_id = 10", "NULL"), ("silver_ingestion_date", "location_id = 11", "NULL")]
_ZONE_TWICE = "location_id IN (12, 13)"


@query("dq_silver_ref", ZONES + spoilt_sql("silver_zones", "z", _ZONE_DEFECTS, _ZONE_TWICE, _stamps("silver_ingestion")) + suite([
    check("Bronze-to-Silver row count match", "VOLUME", "count(*)", "abs(count(*) - (SELECT count(*) FROM zones))",
          "(SELECT count(*) FROM zones)") + " FROM z",
    rows("z", "Missing location_id", "NULL", "location_id IS NULL"),
    rows("z", "Missing borough", "NULL", "borough IS NULL"),
    rows("z", "Missing zone", "NULL", "zone IS NULL"),
    rows("z", "Missing service_zone", "NULL", "service_zone IS NULL"),
    _keys("z", "Duplicate location_id primary key", "UNIQUE", "location_id"),
    rows("z", "Unstandardized text values", "STANDARDIZATION",
         "borough <> trim(borough) OR zone <> trim(zone) OR service_zone <> trim(service_zone)"),
    rows("z", "Invalid borough value", "VALIDITY", f"borough NOT IN ({_BOROUGH_SQL})", f"'{_BOROUGH_TEXT}'"),
    rows("z", "Invalid service_zone value", "VALIDITY",
         "service_zone NOT IN ('EWR', 'Boro Zone', 'Yellow Zone', 'Airports')",
         "'EWR, Boro Zone, Yellow Zone, Airports'"),
    *[rows("z", f"Missing {c}", "LINEAGE", _nulls(c)) for c in ("silver_ingestion_timestamp", "silver_ingestion_date")],
], _SILVER_ZONE_STATUS, TABLE, "taxi_zones_silver"))
def dq_silver_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver zones with missing, untrimmed and unlisted values and one zone twice."""
    silver = spoilt(table(spark, sf_dir, "silver_zones"), _ZONE_DEFECTS, _ZONE_TWICE)
    return silver_zone_suite(silver, bronze_zones(spark, sf_dir), BOROUGHS)


_SERIES_DEFECTS: Defects = [
    ("wind_speed_10m", "weather_code = 3", "wind_speed_10m - 5"), ("temperature_2m", "weather_code = 0 AND wind_speed_10m = 6", "NULL"),
    ("bronze_source_file", "weather_code = 61 AND wind_speed_10m = 2", "NULL"),
    ("silver_ingestion_timestamp", "weather_code = 71 AND wind_speed_10m = 3", "NULL")]
_SERIES_TWICE = "weather_code = 100 AND wind_speed_10m = 1"


@query("dq_silver_series", WEATHER + spoilt_sql("silver_weather", "s", _SERIES_DEFECTS, _SERIES_TWICE, "'readings.json' AS "
       "bronze_source_file, " + _stamps("bronze_ingestion", "silver_ingestion")) + suite([
    rows("s", "Completeness", "", _nulls("timestamp", *WEATHER_MEASURES, "weather_code")),
    _keys("s", "Uniqueness", "", "\"timestamp\""),
    rows("s", "Lineage", "", _nulls("bronze_source_file", "bronze_ingestion_timestamp", "bronze_ingestion_date",
                                    "silver_ingestion_timestamp", "silver_ingestion_date")),
    rows("s", "Validity", "", _NON_NEGATIVE),
    check("Volume", "", "count(*)", "abs(count(*) - 57697)") + " FROM s",
], "", SIMPLE))
def dq_silver_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver weather with some wind below zero, missing values and lineage, and doubled readings."""
    return silver_weather_suite(spoilt(table(spark, sf_dir, "silver_weather"), _SERIES_DEFECTS, _SERIES_TWICE), 57697)


# Gold -----------------------------------------------------------------------------------------------------

_CALENDAR_DEFECTS: Defects = [
    ("is_weekend", "`day` = 13", "NOT is_weekend"), ("is_rush_hour", "`hour` = 8 AND `month` = 2", "false"),
    ("time_period", "`hour` = 23 AND `day` = 31", "'Late'"), ("gold_ingestion_date", "`day` = 3 AND `hour` = 4", "NULL"),
    ("gold_ingestion_timestamp", "`day` = 5 AND `hour` = 6", "NULL"), ("datetime_key", "`day` = 7 AND `hour` = 8 AND `month` = 9", "NULL"),
    ("full_datetime", "`day` = 9 AND `hour` = 10 AND `month` = 3", "NULL"), ("date", "`day` = 11 AND `hour` = 12 AND `month` = 4", "NULL"),
    ("day_name", "`day` = 12 AND `hour` = 1", "NULL"), ("month_name", "`day` = 14 AND `hour` = 2", "NULL")]
_CALENDAR_TWICE = "`day` = 15 AND `hour` = 3 AND `month` = 5"


@query("dq_calendar", CALENDAR + spoilt_sql("calendar", "c", _CALENDAR_DEFECTS, _CALENDAR_TWICE, _stamps("gold_ingestion")) + suite([
    *[rows("c", f"Missing {n}", "LINEAGE", _nulls(n)) for n in ("gold_ingestion_date", "gold_ingestion_timestamp")],
    *[rows("c", f"Missing {n}", "NULL", f'"{n}" IS NULL')
      for n in ("datetime_key", "full_datetime", "date", "day_name", "month_name")],
    rows("c", "Unstandardized text values", "STANDARDIZATION",
         "time_period NOT IN ('Morning', 'Afternoon', 'Evening', 'Night', 'Unknown')"),
    rows("c", "Invalid weekend flag logic", "STANDARDIZATION",
         "datetime_key > 0 AND (day_of_week IN (1, 7)) <> is_weekend"),
    rows("c", "Invalid rush hour flag logic", "STANDARDIZATION", "datetime_key > 0 AND "
         "(day_of_week BETWEEN 2 AND 6 AND \"hour\" IN (7, 8, 9, 16, 17, 18, 19)) <> is_rush_hour"),
    _keys("c", "Duplicate datetime_key primary key", "UNIQUE", "datetime_key"),
    check("Expected hourly row count match (1995-2001)", "VOLUME", "count(*)", "abs(count(*) - 57700)", "'57700'",
          base="57700") + " FROM c",
    rows("c", "Records outside 1995-2001 date range", "DATE_RANGE",
         "datetime_key > 0 AND (\"date\" < DATE '1995-01-01' OR \"date\" > DATE '2001-07-31')"),
], "", TABLE.replace("expected_value", "expected_value::INTEGER AS expected_value"), "dim_datetime"))
def dq_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar with wrong flags and labels, missing values, doubled hours and an hour outside the range."""
    calendar = spoilt(table(spark, sf_dir, "calendar"), _CALENDAR_DEFECTS, _CALENDAR_TWICE)
    return calendar_suite(calendar, 57699, "1995-01-01", "2001-07-31", "1995-2001")


_LOCATION_DEFECTS: Defects = [
    ("borough", "location_id = 5", "' '"), ("location_key", "location_id = 2", "NULL"), ("location_id", "location_id = 4", "NULL"),
    ("zone", "location_id = 6", "' '"), ("service_zone", "location_id = 8", "NULL")]
_LOCATION_TWICE = "location_id = 11"
_DEFECT_LOCATION = spoilt_sql("location", "spoilt", _LOCATION_DEFECTS, _LOCATION_TWICE) + """, l AS (
  SELECT location_key, location_id, borough, zone, service_zone FROM spoilt WHERE location_id IS DISTINCT FROM 7
  UNION ALL SELECT location_key, location_id, borough, 'other name', service_zone FROM location WHERE location_id = 9
  UNION ALL SELECT 900, 900, 'Africa', 'nowhere', 'EWR')"""
_LOCATION_STATUS = ("WHEN check_name IN ('Missing location_key', 'Missing location_id', 'Missing borough', "
                    "'Missing zone', 'Missing service_zone') THEN 'FAIL' "
                    + warn("'UNIQUE', 'RANGE', 'ACCEPTED_VALUE', 'BUSINESS_RULE', 'REFERENTIAL_INTEGRITY', 'NULL'", 1)
                    + " " + warn("'VOLUME'", 2))
_UPPER = ", ".join(f"'{b.upper()}'" for b in BOROUGHS)
_CONFLICTS = ("(SELECT count(*) FROM (SELECT location_id FROM l GROUP BY location_id HAVING count(DISTINCT "
              "upper(trim(borough)) || '|' || upper(trim(zone)) || '|' || upper(trim(service_zone))) > 1))")


@query("dq_location", ZONES + _DEFECT_LOCATION + suite([
    check("Row count vs unique Silver locations", "VOLUME", "count(*)",
          "abs(count(*) - (SELECT count(DISTINCT location_id) FROM silver_zones))",
          "(SELECT count(DISTINCT location_id) FROM silver_zones)", "count(*)") + " FROM l",
    rows("l", "Missing location_key", "NULL", "location_key IS NULL"),
    _keys("l", "Duplicate location_key", "UNIQUE", "location_key"),
    rows("l", "Missing location_id", "NULL", "location_id IS NULL"),
    _keys("l", "Duplicate location business key", "UNIQUE", "location_id"),
    *[rows("l", f"Missing {c}", "NULL", f"{c} IS NULL OR trim({c}) = ''") for c in ("borough", "zone", "service_zone")],
    rows("l", "Invalid location_id", "RANGE", "location_id IS NULL OR location_id <= 0", "'> 0'"),
    rows("l", "Invalid borough value", "ACCEPTED_VALUE", f"upper(trim(borough)) NOT IN ({_UPPER})",
         "'" + ", ".join(b.upper() for b in BOROUGHS) + "'"),
    check("Location has conflicting attributes", "BUSINESS_RULE", _CONFLICTS, _CONFLICTS),
    check("Silver locations missing from Gold", "REFERENTIAL_INTEGRITY", "count(*)",
          "count(*) FILTER (WHERE l.location_id IS NULL)")
    + " FROM silver_zones s LEFT JOIN l ON s.location_id = l.location_id",
    check("Gold locations missing from Silver", "REFERENTIAL_INTEGRITY", "count(*)", "count(*) FILTER (WHERE location_id IS NULL "
          "OR location_id NOT IN (SELECT location_id FROM silver_zones))") + " FROM l",
], _LOCATION_STATUS, TABLE_ACTUAL, "dim_location"))
def dq_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A location dimension with blank and missing values, a missing, doubled and unknown locations."""
    good = table(spark, sf_dir, "location")
    doubled = good.filter("location_id = 9").withColumn("zone", F.lit("other name"))
    stranger = doubled.withColumns({"location_key": F.lit(900).cast("long"), "location_id": F.lit(900),
                                    "borough": F.lit("Africa"), "zone": F.lit("nowhere"), "service_zone": F.lit("EWR")})
    location = (spoilt(good, _LOCATION_DEFECTS, _LOCATION_TWICE).filter(~F.col("location_id").eqNullSafe(7))
                .unionByName(doubled).unionByName(stranger))
    return location_suite(location, table(spark, sf_dir, "silver_zones"), [b.upper() for b in BOROUGHS])


_CONDITION_DEFECTS: Defects = [
    ("temperature_2m", "weather_code = 3 AND wind_speed_10m = 4", "NULL"), ("rain", "weather_code = 61 AND wind_speed_10m = 5", "-1"),
    ("weather_key", "weather_code = 71 AND wind_speed_10m = 6", "NULL")]
_CONDITION_TWICE = "weather_code = 0 AND wind_speed_10m = 7"


@query("dq_condition", WEATHER + spoilt_sql("weather", "w", _CONDITION_DEFECTS, _CONDITION_TWICE) + suite([
    rows("w", "Completeness", "", _nulls("weather_datetime", *WEATHER_MEASURES, "weather_code", "weather_condition")),
    _keys("w", "Uniqueness", "", "weather_datetime"),
    rows("w", "Measurement Validity", "", _NON_NEGATIVE),
    rows("w", "Weather Code Mapping", "", "weather_condition = 'Unknown' OR weather_condition IS NULL"),
    rows("w", "Weather Key Completeness", "", "weather_key IS NULL"),
    _keys("w", "Weather Key Uniqueness", "", "weather_key"),
    check("Volume", "", "count(*)", "abs(count(*) - (SELECT count(DISTINCT ts) FROM readings))") + " FROM w",
    check("Timestamp Range", "", "count(*)", _RANGE.format("weather_datetime")) + " FROM w",
], "", SIMPLE))
def dq_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather dimension with unlisted codes, missing and negative values and doubled hours."""
    hours = table(spark, sf_dir, "bronze_weather").select("timestamp").distinct().count()
    return weather_suite(spoilt(table(spark, sf_dir, "weather"), _CONDITION_DEFECTS, _CONDITION_TWICE), hours, FIRST, LAST)


_FACT_DEFECTS: Defects = [
    ("pickup_location_key", "vendor_id = 6 AND trip_distance = 20", "pickup_location_key + 1000"),
    ("dropoff_location_key", "vendor_id = 2 AND trip_distance = 7", "NULL"),
    ("dropoff_location_key", "vendor_id = 7 AND trip_distance = 17", "dropoff_location_key + 1000"),
    ("pickup_datetime_key", "vendor_id = 2 AND trip_distance = 15", "pickup_datetime_key + 10000000"),
    ("dropoff_datetime_key", "vendor_id = 1 AND trip_distance = 16", "dropoff_datetime_key + 10000000"),
    ("weather_key", "vendor_id = 1", "weather_key + 1000000"), ("trip_distance", "passenger_count = 1 AND trip_distance = 49", "0"),
    ("fare_amount", "trip_distance = 10", "-1"), ("payment_type", "vendor_id = 3", "9"),
    ("trip_key", "vendor_id = 4 AND trip_distance = 13", "NULL"), ("PULocationID", "vendor_id = 3 AND trip_distance = 14", "NULL"),
    ("trip_duration_minutes", "vendor_id = 1 AND trip_distance = 18", "-1"), ("total_amount", "vendor_id = 2 AND trip_distance = 19", "-2"),
    ("passenger_count", "vendor_id = 3 AND trip_distance = 21", "0"), ("trip_type", "vendor_id = 4 AND trip_distance = 22", "9"),
    ("ratecode_id", "vendor_id = 5 AND trip_distance = 23", "77"), ("gold_processed_date", "vendor_id = 6 AND trip_distance = 24", "NULL"),
    ("gold_processed_timestamp", "vendor_id = 1 AND trip_distance = 25", "NULL")]
_FACT_TWICE = "vendor_id = 5 AND trip_distance = 12"
_FACT_STATUS = ("WHEN check_name IN ('Missing trip_key', 'Missing surrogate FK columns') THEN 'FAIL' "
                "WHEN check_type = 'REFERENTIAL_INTEGRITY' AND check_name LIKE '%weather%' THEN 'PASS' "
                + warn("'UNIQUE', 'RANGE', 'ACCEPTED_VALUE', 'REFERENTIAL_INTEGRITY', 'NULL'", 1) + " "
                + warn("'VOLUME'", 2))


def _orphans(column: str, dim: str, key: str, name: str) -> str:
    return rows("f", name, "REFERENTIAL_INTEGRITY",
                f"{column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {dim})")


@query("dq_fact", FACT + spoilt_sql("fact", "f", _FACT_DEFECTS, _FACT_TWICE, _stamps("gold_processed")) + suite([
    check("Row count vs expected join result", "VOLUME", "count(*)", "abs(count(*) - (SELECT count(*) FROM joined))",
          "(SELECT count(*) FROM joined)", "count(*)") + " FROM f",
    rows("f", "Missing trip_key", "NULL", "trip_key IS NULL"),
    rows("f", "Missing surrogate FK columns", "NULL", "pickup_datetime_key IS NULL OR dropoff_datetime_key IS NULL "
         "OR pickup_location_key IS NULL OR dropoff_location_key IS NULL"),
    _keys("f", "Duplicate trip_key", "UNIQUE", "trip_key"),
    _duplicates("f", "Duplicate natural key", "UNIQUE", KEY.replace("VendorID", "vendor_id")),
    rows("f", "Missing natural FK columns", "NULL", _nulls("lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID")),
    _orphans("pickup_location_key", "location", "location_key", "pickup_location_key not in dim_location"),
    _orphans("dropoff_location_key", "location", "location_key", "dropoff_location_key not in dim_location"),
    _orphans("pickup_datetime_key", "calendar", "datetime_key", "pickup_datetime_key not in dim_datetime"),
    _orphans("dropoff_datetime_key", "calendar", "datetime_key", "dropoff_datetime_key not in dim_datetime"),
    _orphans("weather_key", "weather", "weather_key",
             "weather_key not in dim_weather (informational, LEFT JOIN is expected)"),
    rows("f", "Invalid trip_distance", "RANGE", "trip_distance <= 0", "'> 0'"),
    rows("f", "Negative trip_duration_minutes", "RANGE", "trip_duration_minutes < 0", "'>= 0'"),
    rows("f", "Negative fare_amount", "RANGE", "fare_amount < 0", "'>= 0'"),
    rows("f", "Negative total_amount", "RANGE", "total_amount < 0", "'>= 0'"),
    rows("f", "Invalid passenger_count", "RANGE", "passenger_count <= 0", "'> 0'"),
    rows("f", "Invalid payment_type", "ACCEPTED_VALUE", "payment_type NOT IN (1, 2, 3, 4, 5, 6, -1)",
         "'1, 2, 3, 4, 5, 6, -1'"),
    rows("f", "Invalid trip_type", "ACCEPTED_VALUE", "trip_type NOT IN (1, 2, -1)", "'1, 2, -1'"),
    rows("f", "Invalid ratecode_id", "ACCEPTED_VALUE", "ratecode_id NOT IN (1, 2, 3, 4, 5, 6, 99, -1)",
         "'1, 2, 3, 4, 5, 6, 99, -1'"),
    rows("f", "Missing gold_processed_timestamp/date", "LINEAGE", _nulls("gold_processed_timestamp", "gold_processed_date")),
], _FACT_STATUS, TABLE_ACTUAL, "fact_taxi_trip"))
def dq_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact with lost references, missing, negative and unlisted values and doubled rows."""
    fact = spoilt(table(spark, sf_dir, "fact"), _FACT_DEFECTS, _FACT_TWICE)
    return fact_suite(fact, *[table(spark, sf_dir, n) for n in ("silver_trips", "calendar", "location", "weather")])


# Status rules, gate ---------------------------------------------------------------------------------------

_TYPES = ["COMPOSITE_KEY", "OTHER_DQ", "MONTHLY_COUNT", "UNIQUE", "NULL", "RANGE", "ACCEPTED_VALUE", "BUSINESS_RULE",
          "REFERENTIAL_INTEGRITY", "VOLUME", "STANDARDIZATION", "LINEAGE", "VALIDITY"]
_NAMES = ["Missing location_id", "Missing trip_key", "weather reference", "other"]


@query("dq_status_rules", f"""
WITH s AS (SELECT l_suppkey, count(*) AS records, count(*) FILTER (WHERE l_quantity = 1) AS failures
           FROM lineitem GROUP BY l_suppkey),
p AS (SELECT *, {pct('failures', 'records')} AS failure_pct FROM s),
g AS (SELECT p.*, t.check_type, n.check_name FROM p, (SELECT unnest({_TYPES}) AS check_type) t,
             (SELECT unnest({_NAMES}) AS check_name) n)
SELECT l_suppkey, check_type, check_name, failures, failure_pct,
  CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS strict,
  CASE WHEN failures = 0 OR check_type = 'MONTHLY_COUNT' THEN 'PASS'
       WHEN check_type = 'COMPOSITE_KEY' AND failure_pct <= 1 THEN 'WARN'
       WHEN check_type = 'OTHER_DQ' AND failure_pct <= 2 THEN 'WARN' ELSE 'FAIL' END AS source,
  CASE WHEN failures = 0 THEN 'PASS' WHEN check_name = 'Missing location_id' THEN 'FAIL'
       WHEN check_type IN ('UNIQUE', 'NULL', 'STANDARDIZATION', 'LINEAGE', 'VALIDITY') AND failure_pct <= 1 THEN 'WARN'
       WHEN check_type = 'VOLUME' AND failure_pct <= 2 THEN 'WARN' ELSE 'FAIL' END AS silver_zone,
  CASE WHEN failures = 0 THEN 'PASS' WHEN check_name = 'Missing location_id' THEN 'FAIL'
       WHEN check_type IN ('UNIQUE', 'RANGE', 'ACCEPTED_VALUE', 'BUSINESS_RULE', 'REFERENTIAL_INTEGRITY', 'NULL')
            AND failure_pct <= 1 THEN 'WARN'
       WHEN check_type = 'VOLUME' AND failure_pct <= 2 THEN 'WARN' ELSE 'FAIL' END AS location,
  CASE WHEN failures = 0 THEN 'PASS' WHEN check_name = 'Missing trip_key' THEN 'FAIL'
       WHEN check_type = 'REFERENTIAL_INTEGRITY' AND check_name LIKE '%weather%' THEN 'PASS'
       WHEN check_type IN ('UNIQUE', 'RANGE', 'ACCEPTED_VALUE', 'REFERENTIAL_INTEGRITY', 'NULL')
            AND failure_pct <= 1 THEN 'WARN'
       WHEN check_type = 'VOLUME' AND failure_pct <= 2 THEN 'WARN' ELSE 'FAIL' END AS fact
FROM g
""")
def dq_status_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule set on the failure rate of each supplier's lines, for every check type."""
    measured = load(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("l_quantity") == 1).alias("failures"))
    grid = (measured.withColumn("failure_pct", percentage(F.col("failures"), F.col("records")))
            .withColumn("check_type", F.explode(F.array(*[F.lit(t) for t in _TYPES])))
            .withColumn("check_name", F.explode(F.array(*[F.lit(n) for n in _NAMES]))))
    sets = {"strict": rules.STRICT, "source": rules.SOURCE_RULES, "silver_zone": rules.SILVER_ZONE_RULES,
            "location": rules.LOCATION_RULES, "fact": rules.FACT_RULES}
    kind = F.col("check_type")
    return grid.select(
        "l_suppkey", "check_type", "check_name", "failures", "failure_pct",
        *[r.status(F.col("check_name"), kind, kind, F.col("failures"), F.col("failure_pct")).alias(n)
          for n, r in sets.items()])


_SUITES = {"bronze_weather": _BRONZE_SERIES_CHECKS, "silver_trips": _SILVER_CHECKS}


@query("dq_gate_summary", SILVER + "," + WEATHER.removeprefix("WITH") + _SPOILT_SILVER + _BRONZE_SERIES + ", r AS (" + "\nUNION ALL ".join(
    f"SELECT '{name}' AS suite, failures FROM ({c})" for name, checks in _SUITES.items() for c in checks) + """)
SELECT suite, count(*) FILTER (WHERE failures = 0) AS pass_checks, 0::BIGINT AS warn_checks,
       count(*) FILTER (WHERE failures > 0) AS fail_checks, count(*) AS checks
FROM r GROUP BY suite
""")
def dq_gate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports stored in the quality table, read back and counted per suite and status."""
    reports = {
        "bronze_weather": bronze_weather_suite(_spoilt_bronze_series(spark, sf_dir), 57697, FIRST, LAST),
        "silver_trips": silver_trip_suite(_spoilt_silver(spark, sf_dir), table(spark, sf_dir, "bronze_trips"),
                                          is_valid_event(RULES, UNTIL))}
    path = new_path(spark, "quality")
    for suite_name, report in reports.items():
        append_report(report, path, suite_name, "run-1")
    stored = stored_reports(spark, path)
    return summarise({name: stored.filter(F.col("suite") == name) for name in reports})


@query("gate_stops", SILVER + _SPOILT_SILVER + ", r AS (" + "\nUNION ALL ".join(_SILVER_CHECKS) + """)
SELECT 'spoilt' AS load, count(*) FILTER (WHERE failures > 0) > 0 AS stopped, count(*) FILTER (WHERE failures > 0) AS failed_checks FROM r
UNION ALL SELECT 'passing', false, 0 FROM r WHERE check_name = 'Completeness'
""")
def gate_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate before a load with failed checks, and before one whose checks all pass."""
    report = silver_trip_suite(_spoilt_silver(spark, sf_dir), table(spark, sf_dir, "bronze_trips"), is_valid_event(RULES, UNTIL))
    report = materialize(report, "report")
    rows = []
    for load_name, checks in (("spoilt", report), ("passing", report.filter("status = 'PASS'"))):
        try:
            gate(checks)
            rows.append((load_name, False, 0))
        except QualityGateFailed as error:
            rows.append((load_name, True, int(str(error).split()[0])))
    return spark.createDataFrame(rows, "load string, stopped boolean, failed_checks long")


@query("dq_silver_observed", SILVER + _SPOILT_SILVER + suite(_SILVER_CHECKS, "", SIMPLE))
def dq_silver_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the Silver trips, its row checks taken while the table is written."""
    run = writing(new_path(spark, "silver-trips"), "bronze_source_month", stop=False)
    return silver_trip_suite(_spoilt_silver(spark, sf_dir), table(spark, sf_dir, "bronze_trips"), is_valid_event(RULES, UNTIL), run=run)


@query("gate_keeps_table", SILVER + """
SELECT bronze_source_month, count(*) AS trips, count(*) FILTER (WHERE VendorID = 1) AS vendor_1, count(trip_type) AS typed
FROM (SELECT *, source_month AS bronze_source_month FROM silver) GROUP BY bronze_source_month
""")
def gate_keeps_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver trips written by month through the gate, twice: rows that pass take their months' place, spoilt ones leave the table as it was."""
    good, bronze = table(spark, sf_dir, "silver_trips"), table(spark, sf_dir, "bronze_trips")
    path, valid = new_path(spark, "silver-trips"), is_valid_event(RULES, UNTIL)
    silver_trip_suite(good, bronze, valid, run=writing_partitions(path, "bronze_source_month"))
    try:
        silver_trip_suite(_spoilt_silver(spark, sf_dir), bronze, valid, run=writing_partitions(path, "bronze_source_month"))
        raise RuntimeError("the gate let spoilt rows pass")
    except QualityGateFailed:
        stored = spark.read.schema(good.schema).parquet(path)
    return stored.groupBy("bronze_source_month").agg(F.count(F.lit(1)).alias("trips"), F.count_if(F.col("VendorID") == 1).alias("vendor_1"),
                                                     F.count("trip_type").alias("typed"))
