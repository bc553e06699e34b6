"""Test tables in the shape of the warehouse sources, and the warehouse built from them.

trips    one per line item (re-delivered items come three times): pickup = order date plus minutes,
         zones = nations of supplier and customer
zones    nations with their region, ids as text, one of them no number
weather  one reading per order, several per hour

The layers are written once per Spark application and test folder, as in a real warehouse; the
queries then read tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakestrata.functions.codes import WEATHER_CODES
from lakestrata.functions.time import month_of
from lakestrata.operators.keys import number_rows
from lakestrata.operators.lineage import stamp, stamp_source
from lakestrata.plans.gold import build_calendar, build_coded_dim, build_reference_dim, build_trip_fact
from lakestrata.plans.presets import DROPOFF, PICKUP, TRIP_KEY_ORDER, TRIP_RULES
from lakestrata.plans.silver import clean_events, clean_reference, clean_series
from lakestrata.session import configure, fit_to, new_path

AT = dt.datetime(2026, 6, 1)
RULES = replace(TRIP_RULES, first_day="1996-01-01")
UNTIL = dt.date(2000, 12, 31)
FILE_ROWS = 1_000_000  # a file has one row group, which no scan splits
BOROUGHS = ["Africa", "America", "Asia", "Europe"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    rows = configure(spark).read.parquet(path)
    fit_to(spark, path)
    return rows


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as delivered, with the name of the file each came in and the number of the delivery.

    Orders get their customer while they are narrow. The lines travel once, to their orders, before deliveries repeat and columns are made: the
    merge join deals them out at any size, so trips land as many files, in parts that AQE sizes by their bytes.
    """
    lines = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("DOLocationID"))
    suppliers = load(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("PULocationID"))
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey).drop("o_custkey", "c_custkey")
    joined = (lines.join(placed.hint("merge"), lines.l_orderkey == placed.o_orderkey)
              .join(suppliers, lines.l_suppkey == suppliers.s_suppkey))
    again = F.when(F.col("l_returnflag") == "A", F.array(F.lit(0), F.lit(1), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = joined.withColumn("delivery", F.explode(again))
    number = F.col("l_linenumber")
    fare = F.col("l_extendedprice") / 400 * F.when(F.col("l_discount") > 0.095, -1).otherwise(1)
    seats = F.when(F.col("l_returnflag") == "N", number - 1).otherwise(number) + F.col("delivery")
    pickup = F.expr("o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int), 0)")
    rows = rows.withColumn(PICKUP, pickup)
    rows = rows.withColumn(DROPOFF, F.expr(
        f"{PICKUP} + make_dt_interval(0, 0, 0, 10 * datediff(l_shipdate, o_orderdate))"))
    file_name = F.when(number == 7, "trips_latest.parquet").otherwise(
        F.concat(F.lit("trips_"), month_of(F.col(DROPOFF)), F.lit(".parquet")))
    return rows.select(
        number.alias("VendorID"), PICKUP, DROPOFF,
        F.when(F.col("l_linestatus") == "F", " Y").alias("store_and_fwd_flag"),
        F.when(number < 7, number).cast("long").alias("RatecodeID"), "PULocationID", "DOLocationID",
        F.when(F.col("l_tax") < 0.075, seats).cast("long").alias("passenger_count"),
        (F.col("l_quantity") - 1).alias("trip_distance"), fare.alias("fare_amount"), F.col("l_tax").alias("extra"),
        F.lit(0.5).alias("mta_tax"), (F.col("l_discount") * 10).alias("tip_amount"), F.lit(0.0).alias("tolls_amount"),
        F.lit(None).cast("double").alias("ehail_fee"), F.lit(0.3).alias("improvement_surcharge"),
        (fare * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("total_amount"),
        F.when(number != 5, number).cast("long").alias("payment_type"),
        F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2).cast("long").alias("trip_type"),
        F.when(F.col("l_linestatus") == "F", 2.75).alias("congestion_surcharge"),
        F.lit(0.75).alias("cbd_congestion_fee"), file_name.alias("file_name"), "delivery")


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze trips as the overwrite load leaves them: re-deliveries included, loaded a day later each."""
    rows = stamp_source(table(spark, sf_dir, "landed_trips"), PICKUP)
    loaded = F.lit(AT.isoformat(sep=" ")).cast("timestamp") + F.make_dt_interval(days=F.col("delivery"))
    return stamp(rows, "bronze", loaded).drop("delivery")


def bronze_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations, regions = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    key = F.col("n_regionkey")
    service = (F.when(key == 0, "Boro Zone").when(key == 1, " Yellow Zone").when(key == 2, "Airports")
               .when(key == 3, "EWR").otherwise("N/A"))
    rows = nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.when(F.col("n_nationkey") == 24, "n/a").otherwise(F.col("n_nationkey").cast("string")).alias("LocationID"),
        F.concat(F.lit("  "), "r_name", F.lit(" ")).alias("Borough"), F.col("n_name").alias("Zone"),
        service.alias("service_zone"))
    return stamp(rows, "bronze", AT)


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    moment = F.expr("o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int), 0)")
    urgency = F.col("o_orderpriority")
    code = (F.when(urgency == "1-URGENT", 0).when(urgency == "2-HIGH", 71).when(urgency == "3-MEDIUM", 3)
            .when(urgency == "4-NOT SPECIFIED", 61).otherwise(100))
    wet = F.when(urgency == "1-URGENT", F.lit(0.0)).otherwise((F.col("o_orderkey") % 11).cast("double"))
    loaded = F.lit(AT.isoformat(sep=" ")).cast("timestamp") + F.make_dt_interval(
        days=(F.col("o_orderkey") % 100000).cast("int"), mins=F.floor(F.col("o_orderkey") / 100000).cast("int"))
    rows = orders.select(
        F.date_trunc("hour", moment).cast("timestamp_ntz").alias("timestamp"),
        (F.col("o_custkey") % 40 - 5).cast("double").alias("temperature_2m"), wet.alias("precipitation"),
        wet.alias("rain"), F.when(urgency == "2-HIGH", 0.7).otherwise(0.0).alias("snowfall"),
        (F.col("o_custkey") % 30).cast("double").alias("wind_speed_10m"), code.cast("long").alias("weather_code"),
        F.lit("readings.json").alias("source_file"), loaded.alias("loaded"))
    return stamp(rows, "bronze", F.col("loaded")).drop("loaded")


def calendar(spark: SparkSession, sf_dir: str, with_season: bool = False) -> DataFrame:
    first, last = load(spark, sf_dir, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    return build_calendar(spark, first, last, with_season=with_season, at=AT)


def _silver_trips(spark, sf_dir):
    return number_rows(clean_events(table(spark, sf_dir, "bronze_trips"), RULES, UNTIL, AT), "trip_key", TRIP_KEY_ORDER)


def _silver_zones(spark, sf_dir):
    return clean_reference(bronze_zones(spark, sf_dir), "LocationID", {"Borough": "borough", "Zone": "zone"},
                           {"service_zone": "service_zone"}, "location_id", AT)


def _silver_weather(spark, sf_dir):
    return clean_series(table(spark, sf_dir, "bronze_weather"), "timestamp", at=AT)


def _location(spark, sf_dir):
    return build_reference_dim(table(spark, sf_dir, "silver_zones"), "location_id", "location_key",
                               ["borough", "zone", "service_zone"], at=AT)


def _weather(spark, sf_dir):
    return build_coded_dim(table(spark, sf_dir, "silver_weather"), "timestamp", "weather_code", WEATHER_CODES, at=AT)


def _fact(spark, sf_dir):
    return build_trip_fact(*[table(spark, sf_dir, n) for n in ("silver_trips", "calendar", "location", "weather")],
                           at=AT)


BUILDERS = {"landed_trips": trips, "bronze_trips": bronze_trips, "bronze_zones": bronze_zones, "bronze_weather": bronze_weather,
            "silver_trips": _silver_trips, "silver_zones": _silver_zones, "silver_weather": _silver_weather,
            "calendar": calendar, "location": _location, "weather": _weather, "fact": _fact}


class Written(NamedTuple):
    path: str
    schema: T.StructType


_written: dict[tuple[str, str, str], Written] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A warehouse table, built and written at its first use in this Spark application.

    It is built again if the work folder was cleared in the meantime.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key in _written:
        known = _written[key]
        try:
            return spark.read.schema(known.schema).parquet(known.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    configure(spark)
    built = BUILDERS[name](spark, sf_dir)
    path = new_path(spark, name)
    built.write.option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    _written[key] = Written(path, built.schema)
    return spark.read.schema(built.schema).parquet(path)
