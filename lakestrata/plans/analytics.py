"""Reports over the star schema.

Demand reports count the fact per key first and join the (small) counts to the dimension, so hot
keys are combined before the shuffle and the fact itself is never shuffled. Behaviour reports group
by a dimension label; there the dimension is looked up and the fact is combined per label in each task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.functions.numeric import mean, mean_ratio, ratio, settled_round
from lakestrata.functions.time import hour_of, month_of
from lakestrata.operators.lookups import lookup, within_bounds
from lakestrata.operators.ranking import listed_order, sample_flag, share_of_total, top_k
from lakestrata.plans.presets import (INTENSITY_LABELS, INTENSITY_LIMITS, NO_SNOW, NO_WEATHER, OUTLIER_LIMITS, PICKUP,
                                      SNOW)

ZONE = ["location_id", "borough", "zone"]


def demand_by_time(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Trips per weekday and hour of pickup."""
    per_hour = fact.groupBy("pickup_datetime_key").agg(F.count("trip_key").alias("n"))
    named = lookup(per_hour, calendar, "pickup_datetime_key", "datetime_key",
                   {c: c for c in ("day_name", "hour", "day_of_week")})
    return (named.groupBy("day_name", "hour", "day_of_week").agg(F.sum("n").alias("trip_count"))
            .orderBy("day_of_week", "hour").drop("day_of_week"))


def demand_by_zone(fact: DataFrame, location: DataFrame) -> DataFrame:
    """Trips per pickup zone name and borough; zones that share both names count as one."""
    per_key = fact.groupBy("pickup_location_key").agg(F.count(F.lit(1)).alias("n"))
    named = lookup(per_key, location, "pickup_location_key", "location_key", {"zone": "zone", "borough": "borough"})
    return named.groupBy("zone", "borough").agg(F.sum("n").alias("trip_count")).orderBy(F.desc("trip_count"))


def top_zones(fact: DataFrame, location: DataFrame, k: int = 5) -> DataFrame:
    """The zones with most pickups: trips, mean distance and duration, revenue."""
    per_zone = fact.groupBy("PULocationID").agg(
        F.count("trip_key").alias("pickup_trips"),
        mean(F.col("trip_distance")).alias("avg_trip_distance"),
        mean(F.col("trip_duration_minutes")).alias("avg_trip_duration_minutes"),
        settled_round(F.sum("total_amount"), 2).alias("total_revenue"))
    named = lookup(per_zone, location, "PULocationID", "location_id", {c: c for c in ZONE})
    named = named.select(*ZONE, "pickup_trips", "avg_trip_distance", "avg_trip_duration_minutes", "total_revenue")
    return top_k(named, "pickup_trips", k, ["location_id"])


def opportunity_zones(fact: DataFrame, location: DataFrame, k: int = 5) -> DataFrame:
    """The zones with least activity (pickups + dropoffs), zones without any included."""
    ends = fact.select(F.inline(F.array(
        F.struct(F.col("PULocationID").alias("id"), F.lit(1).alias("is_pickup")),
        F.struct(F.col("DOLocationID").alias("id"), F.lit(0).alias("is_pickup")))))
    per_zone = ends.groupBy("id").agg(F.sum("is_pickup").alias("p"), F.sum(1 - F.col("is_pickup")).alias("d"))
    zones = lookup(location.select(*ZONE), per_zone, "location_id", "id", {"p": "p", "d": "d"}, optional=True)
    pickups, dropoffs = F.coalesce("p", F.lit(0)), F.coalesce("d", F.lit(0))
    activity = zones.select(*ZONE, pickups.alias("pickup_trips"), dropoffs.alias("dropoff_trips"),
                            (pickups + dropoffs).alias("total_mobility_activity"),
                            (pickups - dropoffs).alias("mobility_imbalance"))
    return top_k(activity, "total_mobility_activity", k, ["location_id"], largest=False)


def without_outliers(fact: DataFrame, limits: dict[str, tuple[float, float]] = OUTLIER_LIMITS) -> DataFrame:
    return fact.filter(reduce(lambda a, b: a & b, [F.col(c).between(*lim) for c, lim in limits.items()]))


def _with_weather(fact: DataFrame, weather: DataFrame, *columns: str) -> DataFrame:
    take = {c: c for c in columns} | {"weather_key": "member_key"}
    return lookup(without_outliers(fact), weather, "weather_key", "weather_key", take, optional=True)


def _condition() -> Column:
    return F.coalesce("weather_condition", F.lit(NO_WEATHER))


def _behaviour(*names: str) -> list[Column]:
    measures = {
        "avg_trip_duration_min": mean(F.col("trip_duration_minutes")),
        "avg_trip_distance_mi": mean(F.col("trip_distance")),
        "avg_fare_amount": mean(F.col("fare_amount")),
        "avg_total_amount": mean(F.col("total_amount")),
        "avg_tip_amount": mean(F.col("tip_amount")),
        "avg_passenger_count": mean(F.col("passenger_count")),
        "avg_fare_per_mile": mean_ratio(F.col("fare_amount"), F.col("trip_distance")),
        "avg_temperature_c": mean(F.col("temperature_2m"), 1),
        "avg_wind_speed": mean(F.col("wind_speed_10m"), 1),
    }
    return [measures[n].alias(n) for n in names]


BASIC = ["avg_trip_duration_min", "avg_trip_distance_mi", "avg_fare_amount", "avg_total_amount", "avg_fare_per_mile"]
FULL = ["avg_trip_duration_min", "avg_trip_distance_mi", "avg_fare_amount", "avg_total_amount", "avg_tip_amount",
        "avg_passenger_count", "avg_fare_per_mile", "avg_temperature_c", "avg_wind_speed"]


def _grouped(rows: DataFrame, groups: list[Column], measures: list[str], share: bool = True) -> DataFrame:
    counted = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("trip_count"), *_behaviour(*measures))
    labels = [c for c in counted.columns if c not in measures]
    if share:
        counted = share_of_total(counted, "trip_count", "pct_of_total_trips")
        labels.append("pct_of_total_trips")
    return counted.select(*labels, sample_flag(F.col("trip_count")).alias("sample_size_flag"), *measures)


def behaviour_by_condition(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """Demand and trip behaviour per weather condition."""
    rows = _with_weather(fact, weather, "weather_condition", "temperature_2m", "wind_speed_10m")
    return _grouped(rows, [_condition().alias("weather_condition")], FULL).orderBy(F.desc("trip_count"))


def intensity_bucket(member: Column, precipitation: Column) -> Column:
    none, dry, light, moderate, heavy = INTENSITY_LABELS
    light_max, moderate_max = INTENSITY_LIMITS
    return (F.when(member.isNull(), none).when(F.coalesce(precipitation, F.lit(0.0)) == 0, dry)
            .when(precipitation <= light_max, light).when(precipitation <= moderate_max, moderate).otherwise(heavy))


def behaviour_by_intensity(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """Demand and trip behaviour per precipitation intensity, from none to heavy."""
    rows = _with_weather(fact, weather, "precipitation")
    bucket = intensity_bucket(F.col("member_key"), F.col("precipitation"))
    return (_grouped(rows, [bucket.alias("precipitation_bucket")], BASIC)
            .orderBy(listed_order(F.col("precipitation_bucket"), INTENSITY_LABELS)))


def snow_comparison(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips in snow against trips without, shares among trips whose weather is known."""
    flag = (F.when(F.col("member_key").isNull(), NO_WEATHER)
            .when(F.coalesce("snowfall", F.lit(0.0)) > 0, SNOW).otherwise(NO_SNOW))
    rows = _with_weather(fact, weather, "snowfall").withColumn("snow_flag", flag)
    return _grouped(rows.filter(F.col("snow_flag") != NO_WEATHER), [F.col("snow_flag")], BASIC).orderBy("snow_flag")


def trips_per_weather_hour(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips per condition divided by the hours of that condition within the time the trips span."""
    trips = (_with_weather(fact, weather, "weather_condition").groupBy(_condition().alias("weather_condition"))
             .agg(F.count(F.lit(1)).alias("trip_count")))
    span = fact.agg(hour_of(F.min(PICKUP)).alias("first"), hour_of(F.max(PICKUP)).alias("last"))
    hours = (within_bounds(weather, "weather_datetime", span, "first", "last")
             .groupBy(_condition().alias("condition"))
             .agg(F.count_distinct("weather_datetime").alias("hours")))
    joined = lookup(trips, hours, "weather_condition", "condition", {"hours": "weather_hours"}, optional=True)
    rate = settled_round(ratio(F.col("trip_count"), F.col("weather_hours")), 2)
    return joined.withColumn("trips_per_weather_hour", rate).orderBy(F.desc("trips_per_weather_hour"))


def monthly_conditions(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """Trip behaviour per month and weather condition."""
    rows = _with_weather(fact, weather, "weather_condition")
    groups = [month_of(F.col(PICKUP)).alias("trip_month"), _condition().alias("weather_condition")]
    measures = ["avg_trip_duration_min", "avg_trip_distance_mi", "avg_fare_amount", "avg_fare_per_mile"]
    return _grouped(rows, groups, measures, share=False).orderBy("trip_month", F.desc("trip_count"))
