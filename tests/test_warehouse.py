"""The whole warehouse from files to reports, twice, and the streaming load."""

import datetime as dt
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakestrata.plans import analytics
from lakestrata.plans.presets import PICKUP, TRIP_KEY, TRIP_RULES, TRIP_SOURCE_SCHEMA
from lakestrata.plans.silver import clean_events, clean_reference, clean_series
from lakestrata.plans.warehouse import Warehouse
from lakestrata.quality.store import QualityGateFailed
from lakestrata.session import new_path
from lakestrata.streaming.incremental import load_new_files

AT = dt.datetime(2026, 6, 1)
SCHEMA = TRIP_SOURCE_SCHEMA
NAMES = [column.split()[0] for column in SCHEMA.split(",")]


def trip(pickup, minutes=10, pu=1, do=2, distance=2.0, fare=10.0, total=12.0, passengers=1, vendor=1, **other):
    start = dt.datetime.fromisoformat(pickup)
    values = {"VendorID": vendor, "lpep_pickup_datetime": start, "passenger_count": passengers,
              "lpep_dropoff_datetime": start + dt.timedelta(minutes=minutes), "PULocationID": pu, "DOLocationID": do,
              "trip_distance": distance, "fare_amount": fare, "total_amount": total, "tip_amount": 1.0, **other}
    return tuple(values.get(n) for n in NAMES)


MARCH = [
    trip("2026-03-02 08:15:00", store_and_fwd_flag=" N ", RatecodeID=1, payment_type=1, trip_type=1),
    trip("2026-03-02 08:15:00", store_and_fwd_flag=" N ", RatecodeID=1, payment_type=1, trip_type=1),  # delivered twice
    trip("2026-03-02 09:00:00", pu=2, do=1, distance=5.0, fare=20.0, total=25.0),
    trip("2026-03-07 17:30:00", pu=2, do=2, minutes=30, distance=4.0, fare=16.0, total=20.0),
    trip("2026-03-03 10:00:00", minutes=-5),          # ends before it starts
    trip("2026-03-03 11:00:00", distance=0.0),        # no distance
    trip("2026-03-03 12:00:00", passengers=0),        # no passengers
    trip("2026-03-03 13:00:00", passengers=None),     # passengers missing
    trip("2026-03-03 14:00:00", fare=-3.0),           # negative fare
    trip("2026-03-03 15:00:00", pu=None),             # zone missing
    trip("2009-01-01 00:00:00"),                      # clock drift
    trip("2026-03-03 16:00:00", pu=99),               # zone unknown to the dimension
]
APRIL = [trip("2026-04-01 23:50:00", minutes=20, pu=1, do=3, distance=1.0, fare=8.0, total=9.0)]


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    spark.createDataFrame(MARCH, SCHEMA).coalesce(1).write.parquet(str(root / "march"))
    spark.createDataFrame(APRIL, SCHEMA).coalesce(1).write.parquet(str(root / "april"))
    (root / "zones.csv").write_text(
        '"LocationID","Borough","Zone","service_zone"\n1," queens ","jfk airport","Airports"\n'
        '2,"Manhattan","Alphabet City","Yellow Zone"\n3,"Bronx","Allerton","Boro Zone"\nx,"Nowhere","None","N/A"\n')
    hours = [dt.datetime(2026, 3, 1) + dt.timedelta(hours=i) for i in range(24 * 40)]
    doc = {"hourly": {
        "time": [h.strftime("%Y-%m-%dT%H:%M") for h in hours], "temperature_2m": [float(h.hour) for h in hours],
        "precipitation": [3.0 if h.hour == 9 else 0.0 for h in hours], "rain": [0.0] * len(hours),
        "snowfall": [0.5 if h.hour == 17 else 0.0 for h in hours], "wind_speed_10m": [1.0] * len(hours),
        "weather_code": [63 if h.hour == 9 else 73 if h.hour == 17 else 0 for h in hours]}}
    (root / "weather.json").write_text(json.dumps(doc))
    return root


@pytest.fixture(scope="module")
def warehouse(spark, sources, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")), "2026-03-01 00:00:00", "2026-04-30 23:00:00", AT)
    w.load_trips(str(sources / "march"))
    w.load_zones(str(sources / "zones.csv"))
    w.load_weather_documents(str(sources / "weather.json"))
    w.refresh()
    return w


def fact_rows(w):
    return rows(w.table("gold", "fact_taxi_trip").select("trip_key", F.col(PICKUP).cast("string"), "trip_distance"))


def test_layers_hold_what_the_rules_let_through(warehouse):
    bronze, silver = warehouse.table("bronze", "trips"), warehouse.table("silver", "trips")
    assert bronze.count() == len(MARCH) - 1 and bronze.filter("source_month = '2009-01'").count() == 1
    assert silver.count() == 4  # the unknown zone is dropped by the fact only
    flags = rows(silver.select("store_and_fwd_flag", "RatecodeID", "payment_type", "congestion_surcharge"))
    assert flags[0] == ("N", 1, 1, 0.0) and flags[1] == ("Unknown", -1, -1, 0.0)
    assert rows(warehouse.table("gold", "dim_location").select("location_key", "location_id", "borough", "zone"))[0] == (
        1, 1, "Queens", "Jfk Airport")
    assert warehouse.table("gold", "dim_datetime").count() == 61 * 24 + 1
    assert fact_rows(warehouse) == [(1, "2026-03-02 08:15:00", 2.0), (2, "2026-03-02 09:00:00", 5.0),
                                    (3, "2026-03-07 17:30:00", 4.0)]


def test_reports(warehouse):
    assert rows(warehouse.report("demand_by_time")) == sorted(
        [("Monday", 8, 1), ("Monday", 9, 1), ("Saturday", 17, 1)], key=repr)
    assert [tuple(r) for r in warehouse.report("demand_by_zone").collect()] == [
        ("Alphabet City", "Manhattan", 2), ("Jfk Airport", "Queens", 1)]
    assert [tuple(r) for r in warehouse.report("top_zones").collect()] == [
        (2, "Manhattan", "Alphabet City", 2, 4.5, 20.0, 45.0), (1, "Queens", "Jfk Airport", 1, 2.0, 10.0, 12.0)]
    assert [tuple(r) for r in warehouse.report("opportunity_zones").collect()] == [
        (3, "Bronx", "Allerton", 0, 0, 0, 0), (1, "Queens", "Jfk Airport", 1, 1, 2, 0),
        (2, "Manhattan", "Alphabet City", 2, 2, 4, 0)]
    low = "LOW SAMPLE - interpret with caution"
    got = {r.weather_condition: r for r in warehouse.report("behaviour_by_condition").collect()}
    assert (got["Moderate rain"].trip_count, got["Moderate rain"].pct_of_total_trips, got["Moderate rain"].sample_size_flag,
            got["Moderate rain"].avg_fare_per_mile, got["Moderate rain"].avg_temperature_c) == (1, 33.33, low, 4.0, 9.0)
    assert [r.precipitation_bucket for r in warehouse.report("behaviour_by_intensity").collect()] == [
        "No Precipitation", "Moderate (2.5-7.5mm)"]
    assert [(r.snow_flag, r.trip_count) for r in warehouse.report("snow_comparison").collect()] == [("No Snow", 2), ("Snow", 1)]
    rates = {r.weather_condition: tuple(r)[1:] for r in warehouse.report("trips_per_weather_hour").collect()}
    assert rates["Moderate rain"] == (1, 6, 0.17) and rates["Moderate snowfall"] == (1, 6, 0.17)
    assert {(r.trip_month, r.weather_condition, r.trip_count) for r in warehouse.report("monthly_conditions").collect()} == {
        ("2026-03", "Clear sky", 1), ("2026-03", "Moderate rain", 1), ("2026-03", "Moderate snowfall", 1)}


def test_landed_files_are_checked_and_the_next_month_is_known(warehouse, sources, tmp_path):
    for name, month in (("march", "2026-03"), ("april", "2026-04")):
        part = next((sources / name).glob("*.parquet"))
        (tmp_path / f"trips_{month}.parquet").write_bytes(part.read_bytes())
    report = {r.check_name: (r.records_checked, r.affected_rows, r.status)
              for r in warehouse.file_report(str(tmp_path)).collect()}
    assert report["Total Downloaded Row Count"] == (13, 0, "PASS")
    assert report["Exact duplicate rows"] == (13, 1, "FAIL")
    assert report["Null count for mandatory key fields (7-columns)"] == (13, 1, "FAIL")
    assert report["Monthly Row Count by Source Month (2026-04)"] == (1, 0, "PASS")
    assert report["Monthly Row Count by Pickup Date (2009-01)"] == (1, 0, "PASS")
    assert warehouse.next_month(str(tmp_path), "2026-03") == "2026-05"


def test_suites_over_stored_tables(warehouse):
    stored = warehouse.check("run-1")
    status = {(r.suite, r.check_name): r.status for r in stored.collect()}
    failed = {k for k, s in status.items() if s != "PASS" and k[0] in ("fact_taxi_trip", "silver_trips", "dim_datetime")}
    assert failed == set()
    assert status[("dim_location", "Invalid borough value")] == "PASS"
    assert status[("silver_zones", "Bronze-to-Silver row count match")] == "FAIL"
    assert len({suite for suite, _ in status}) == 9


def test_loading_again_changes_nothing_and_a_new_month_is_added(spark, warehouse, sources):
    before, bronze = fact_rows(warehouse), warehouse.table("bronze", "trips").count()
    warehouse.load_trips(str(sources / "march"))
    warehouse.refresh()
    assert fact_rows(warehouse) == before and warehouse.table("bronze", "trips").count() == bronze
    warehouse.at = AT + dt.timedelta(days=1)
    warehouse.load_trips(str(sources / "april"))
    assert warehouse.changed_months(warehouse.at) == ["2026-04"]
    warehouse.refresh(months=["2026-04"], gate_silver=True)
    after = fact_rows(warehouse)
    assert set(before) < set(after) and len(after) == len(before) + 1
    new = (set(after) - set(before)).pop()
    assert new == (max(k for k, _, _ in before) + 1, "2026-04-01 23:50:00", 1.0)


def test_weather_records_merge_by_time(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), at=AT)
    first, second = new_path(spark, "r"), new_path(spark, "r")
    line = {"temperature_2m": 1.0, "precipitation": 0.0, "rain": 0.0, "snowfall": 0.0, "wind_speed_10m": 1.0, "weather_code": 3}
    for path, hours, temperature in ((first, range(0, 4), 1.0), (second, range(2, 6), 2.0)):
        (spark.createDataFrame([json.dumps({**line, "timestamp": f"2026-03-01T0{h}:00:00", "temperature_2m": temperature})
                                for h in hours], "string").write.text(path))
    assert w.load_weather_records(first).count() == 4
    assert w.load_weather_records(first).count() == 4
    merged = w.load_weather_records(second)
    assert [r[0] for r in merged.orderBy("timestamp").select("temperature_2m").collect()] == [1.0, 1.0, 2.0, 2.0, 2.0, 2.0]


def test_stream_loads_only_new_files(spark, sources, tmp_path):
    landing, table = tmp_path / "in", new_path(spark, "bronze")
    landing.mkdir()
    args = (spark, str(landing), table, str(tmp_path / "checkpoint"), SCHEMA, PICKUP, TRIP_KEY, AT)

    def land(name):
        for f in (sources / name).glob("*.parquet"):
            (landing / f"{name}.parquet").write_bytes(f.read_bytes())

    land("march")
    assert load_new_files(*args).count() == len(MARCH) - 1
    assert load_new_files(*args).count() == len(MARCH) - 1
    land("april")
    assert load_new_files(*args).count() == len(MARCH)


def test_month_mismatch_and_late_delivery(spark):
    bronze = spark.createDataFrame(MARCH[:1] * 2 + APRIL, SCHEMA).withColumns({
        "source_file": F.lit("f"), "source_month": F.lit("2026-03"), "bronze_ingestion_date": F.lit(AT.date())})
    bronze = bronze.withColumn("bronze_ingestion_timestamp", F.lit(AT)).withColumn("tip_amount", F.lit(1.0))
    late = bronze.withColumns({"bronze_ingestion_timestamp": F.lit(AT + dt.timedelta(days=1)), "tip_amount": F.lit(9.0)})
    cleaned = clean_events(bronze.unionByName(late), TRIP_RULES, dt.date(2026, 12, 31), AT)
    assert rows(cleaned.select(F.col(PICKUP).cast("string"), "tip_amount")) == [("2026-03-02 08:15:00", 9.0)]


def test_reference_and_series_cleaning(spark):
    audit = {"bronze_ingestion_timestamp": F.lit(AT), "bronze_ingestion_date": F.lit(AT.date())}
    zones = spark.createDataFrame([("1", " a ", "b"), ("1", " A ", "c"), ("x", "q", "r"), (None, "s", "t")],
                                  "id string, borough string, zone string").withColumns(audit)
    got = clean_reference(zones, "id", {"borough": "borough"}, {"zone": "zone"}, "location_id", AT)
    assert rows(got.select("location_id", "borough", "zone")) == [(1, "A", "b")]
    series = spark.createDataFrame([(1, 5), (1, 6), (None, 7)], "t int, v int").withColumns(audit).withColumns({
        "source_file": F.lit("f"), "bronze_ingestion_timestamp": F.expr(f"timestamp'2026-06-01' + make_dt_interval(v)")})
    assert rows(clean_series(series, "t", at=AT).select("t", "v")) == [(1, 6)]


@pytest.mark.parametrize("member,rain,label", [
    (None, None, "No Weather Data"), (1, None, "No Precipitation"), (1, 0.0, "No Precipitation"),
    (1, 0.01, "Light (0-2.5mm)"), (1, 2.5, "Light (0-2.5mm)"), (1, 2.51, "Moderate (2.5-7.5mm)"),
    (1, 7.5, "Moderate (2.5-7.5mm)"), (1, 7.51, "Heavy (7.5mm+)")])
def test_intensity_limits(spark, member, rain, label):
    df = spark.createDataFrame([(member, rain)], "m int, p double")
    assert df.select(analytics.intensity_bucket(F.col("m"), F.col("p"))).first()[0] == label


def test_a_gated_refresh_stops_before_the_table_that_fails(spark, sources, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), "2026-03-01 00:00:00", "2026-04-09 23:00:00", AT)
    w.load_trips(str(sources / "march"))
    (tmp_path / "zones.csv").write_text('"LocationID","Borough","Zone","service_zone"\n1,"Queens","Jfk Airport","Airports"\n'
                                        '2,"Manhattan","Alphabet City","Yellow Zone"\n')
    w.load_zones(str(tmp_path / "zones.csv"))
    w.load_weather_documents(str(sources / "weather.json"))
    w.refresh(gated=True)
    before = fact_rows(w)
    assert len(before) == 3 and w.table("silver", "zones").count() == 2

    (tmp_path / "zones.csv").write_text('"LocationID","Borough","Zone","service_zone"\n1,"Queens","Jfk Airport","Airports"\n'
                                        '2,"Atlantis","Alphabet City","Yellow Zone"\n')
    w.load_zones(str(tmp_path / "zones.csv"))
    w.load_trips(str(sources / "april"))
    with pytest.raises(QualityGateFailed, match="Invalid borough value"):
        w.refresh(gated=True)
    assert rows(w.table("silver", "zones").select("borough")) == [("Manhattan",), ("Queens",)]
    assert fact_rows(w) == before  # Silver trips took the new month; nothing behind the failed table was touched
    assert w.table("silver", "trips").filter("bronze_source_month = '2026-04'").count() == 1
    assert not list((tmp_path / "w").glob("*/*__new-*"))


def test_a_gated_load_leaves_the_months_of_the_fact(spark, warehouse):
    months = rows(warehouse.table("gold", "fact_taxi_trip").select("pickup_month").distinct())
    before = fact_rows(warehouse)
    spoilt = warehouse.table("silver", "trips").withColumn("payment_type", F.lit(77).cast("long"))
    kept = Warehouse.table

    def table(self, layer, name):
        return spoilt if (layer, name) == ("silver", "trips") else kept(self, layer, name)
    Warehouse.table = table
    try:
        with pytest.raises(QualityGateFailed, match="Invalid payment_type"):
            warehouse.refresh_fact(gated=True)
    finally:
        Warehouse.table = kept
    assert fact_rows(warehouse) == before
    assert rows(warehouse.table("gold", "fact_taxi_trip").select("pickup_month").distinct()) == months
