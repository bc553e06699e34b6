"""Schemas, keys and rules of the mobility warehouse: trips, zones, hourly weather."""

from __future__ import annotations

from dataclasses import dataclass, field

# Source schema of the trip files.
TRIP_SOURCE_SCHEMA = """
VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz,
store_and_fwd_flag string, RatecodeID bigint, PULocationID int, DOLocationID int,
passenger_count bigint, trip_distance double, fare_amount double, extra double, mta_tax double,
tip_amount double, tolls_amount double, ehail_fee double, improvement_surcharge double,
total_amount double, payment_type bigint, trip_type bigint, congestion_surcharge double,
cbd_congestion_fee double
"""

# Trips carry no id; these seven columns together identify one.
TRIP_KEY = ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID",
            "DOLocationID", "trip_distance", "total_amount"]
PICKUP = "lpep_pickup_datetime"
DROPOFF = "lpep_dropoff_datetime"
# Surrogate keys are numbered in this order, which also clusters the table by time.
TRIP_KEY_ORDER = [PICKUP, DROPOFF, "VendorID", "PULocationID", "DOLocationID", "trip_distance", "total_amount"]

# Source schemas of the zone list and of the hourly weather.
ZONE_SOURCE_SCHEMA = "LocationID string, Borough string, Zone string, service_zone string"
WEATHER_MEASURES = ["temperature_2m", "precipitation", "rain", "snowfall", "wind_speed_10m"]
WEATHER_NON_NEGATIVE = ["precipitation", "rain", "snowfall", "wind_speed_10m"]
WEATHER_SOURCE_SCHEMA = """
timestamp timestamp_ntz, temperature_2m double, precipitation double, rain double, snowfall double,
wind_speed_10m double, weather_code bigint
"""
WEATHER_ARRAYS = {"time": "string", "temperature_2m": "double", "precipitation": "double", "rain": "double",
                  "snowfall": "double", "wind_speed_10m": "double", "weather_code": "bigint"}


@dataclass(frozen=True)
class EventRules:
    """What a valid event row is and how its gaps are filled."""

    key: list[str]
    required: list[str]
    start: str
    end: str
    non_negative: list[str]
    positive: list[str]
    first_day: str
    month_column: str
    latest_by: list[str]
    trimmed_defaults: dict[str, str] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)


# The cleaning rules of trips.
TRIP_RULES = EventRules(
    key=TRIP_KEY,
    required=[PICKUP, DROPOFF, "PULocationID", "DOLocationID"],
    start=PICKUP,
    end=DROPOFF,
    non_negative=["fare_amount", "total_amount"],
    positive=["trip_distance", "passenger_count"],
    first_day="2026-03-01",
    month_column="source_month",
    latest_by=["bronze_ingestion_timestamp"],
    trimmed_defaults={"store_and_fwd_flag": "Unknown"},
    defaults={"RatecodeID": -1, "payment_type": -1, "trip_type": -1, "congestion_surcharge": 0.0},
)

# Columns refreshed when a Silver trip is loaded again; key and surrogate key stay.
TRIP_UPDATE = [
    "store_and_fwd_flag", "RatecodeID", "passenger_count", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "ehail_fee", "improvement_surcharge", "payment_type", "trip_type", "congestion_surcharge",
    "cbd_congestion_fee", "bronze_source_file", "bronze_source_month", "bronze_ingestion_timestamp",
    "bronze_ingestion_date", "silver_ingestion_timestamp", "silver_ingestion_date",
]

# Money columns of the trip fact.
TRIP_MONEY = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
              "improvement_surcharge", "congestion_surcharge", "cbd_congestion_fee", "total_amount"]

# Accepted values of the zone list and of the trip codes.
SILVER_BOROUGHS = ["EWR", "Queens", "Bronx", "Manhattan", "Staten Island", "Brooklyn", "Unknown"]
SERVICE_ZONES = ["EWR", "Boro Zone", "Yellow Zone", "Airports"]
GOLD_BOROUGHS = ["BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND", "EWR"]
STORE_FLAGS = ["Y", "N", "Unknown"]
TIME_PERIODS = ["Morning", "Afternoon", "Evening", "Night", "Unknown"]
PAYMENT_TYPES = [1, 2, 3, 4, 5, 6, -1]
TRIP_TYPES = [1, 2, -1]
RATECODES = [1, 2, 3, 4, 5, 6, 99, -1]

# The project window and its hourly volume.
WINDOW_FIRST_HOUR = "2026-03-01 00:00:00"
WINDOW_LAST_HOUR = "2026-05-31 23:00:00"
WINDOW_HOURS = 2208

# Inclusive limits outside which a trip is left out of the behaviour reports.
OUTLIER_LIMITS = {"trip_distance": (0, 100), "trip_duration_minutes": (0, 180),
                  "fare_amount": (0, 250), "passenger_count": (1, 8)}

# Report labels.
NO_WEATHER = "No Weather Data"
INTENSITY_LABELS = ["No Weather Data", "No Precipitation", "Light (0-2.5mm)", "Moderate (2.5-7.5mm)",
                    "Heavy (7.5mm+)"]
INTENSITY_LIMITS = (2.5, 7.5)
SNOW, NO_SNOW = "Snow", "No Snow"
