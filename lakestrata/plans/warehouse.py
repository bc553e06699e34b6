"""The mobility warehouse in a folder: load sources, refresh the layers, run the suites.

Trip tables are partitioned by month and a load rewrites only the months it touches. Zones, weather
and the dimensions are small next to the trips and are replaced as a whole.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakestrata.functions.codes import WEATHER_CODES
from lakestrata.functions.time import month_of
from lakestrata.operators.journal import Journal
from lakestrata.operators.upsert import upsert, upsert_partitions
from lakestrata.operators.writes import ensure_path, overwrite_partitions, replace_path
from lakestrata.plans import analytics
from lakestrata.plans.bronze import (MONTH, ingest_array_documents, ingest_partitioned_files, ingest_reference_csv,
                                     ingest_typed_records, stage_files)
from lakestrata.plans.gold import (FACT_ORDER, build_calendar, build_coded_dim, build_reference_dim, refresh_calendar,
                                   trip_fact_rows)
from lakestrata.plans.presets import (PICKUP, TRIP_KEY, TRIP_KEY_ORDER, TRIP_RULES, TRIP_SOURCE_SCHEMA, TRIP_UPDATE,
                                      WEATHER_ARRAYS, WEATHER_SOURCE_SCHEMA, WINDOW_FIRST_HOUR, WINDOW_LAST_HOUR,
                                      ZONE_SOURCE_SCHEMA)
from lakestrata.plans.silver import clean_events, clean_reference, clean_series, is_valid_event
from lakestrata.quality import suites
from lakestrata.quality.observed import writing, writing_partitions
from lakestrata.quality.store import append_report, gate, stored_reports
from lakestrata.session import configure, scratch
from lakestrata.sources.discovery import landed_files, landed_months, next_partition
from lakestrata.sources.files import read_parquet

FACT_MONTH = "pickup_month"


def _schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


@dataclass
class Warehouse:
    """All tables live under ``root``; ``first_hour``/``last_hour`` bound the calendar."""

    spark: SparkSession
    root: str
    first_hour: str = WINDOW_FIRST_HOUR
    last_hour: str = WINDOW_LAST_HOUR
    at: dt.datetime | None = None

    def __post_init__(self):
        configure(self.spark)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    @property
    def rules(self):
        return replace(TRIP_RULES, first_day=self.first_hour[:10])

    @property
    def until(self) -> dt.date:
        return dt.date.fromisoformat(self.last_hour[:10]) + dt.timedelta(days=1)

    def _existing(self, layer: str, name: str) -> DataFrame | None:
        try:
            return self.table(layer, name)
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
                return None
            raise

    # Landed files

    def next_month(self, landing: str, default: str) -> str:
        """The month after the latest landed one, or the default for an empty folder."""
        return next_partition(landed_months(landed_files(self.spark, landing)), default).first()[0]

    def file_report(self, files: str) -> DataFrame:
        """The suite over landed trip files, before they are loaded."""
        return suites.download_suite(read_parquet(self.spark, files, _schema(TRIP_SOURCE_SCHEMA), "file_name"))

    # Bronze

    @property
    def journal(self) -> Journal:
        return Journal(self.spark, self.path("quality", "loads"))

    def load_trips(self, files: str, batch: str | None = None) -> DataFrame:
        """Upsert trip files. A named batch that the journal has is not written again; one that was cut off is."""
        def load(touched):
            with scratch(self.spark):
                ingest_partitioned_files(self.spark, files, self.path("bronze", "trips"), PICKUP, TRIP_KEY, _schema(TRIP_SOURCE_SCHEMA), self.at, touched)
        self.journal.once(batch or f"load-{uuid.uuid4().hex}", "bronze/trips", load, self.at)
        return ensure_path(self.spark, self.path("bronze", "trips"), stage_files(self.spark, files, PICKUP, _schema(TRIP_SOURCE_SCHEMA), self.at).schema,
                           partition_by=MONTH)

    def changed_months(self, since: dt.datetime) -> list[str]:
        """Months with Bronze rows loaded at or after a moment: what to refresh after a load.

        From the journal; from the load times of the rows only for a table that was loaded without one.
        """
        if not self.journal.entries().filter(F.col("table_name") == "bronze/trips").isEmpty():
            return self.journal.changed("bronze/trips", since)
        loaded = F.col("bronze_ingestion_timestamp") >= F.lit(since.isoformat(sep=" ")).cast("timestamp")
        months = self.table("bronze", "trips").filter(loaded).select(MONTH).dropna().distinct()
        return sorted(row[0] for row in months.collect())  # one per table partition

    def load_zones(self, csv: str) -> DataFrame:
        return ingest_reference_csv(self.spark, csv, self.path("bronze", "zones"), _schema(ZONE_SOURCE_SCHEMA), self.at)

    def load_weather_documents(self, path: str, multi_line: bool = True) -> DataFrame:
        return ingest_array_documents(self.spark, path, self.path("bronze", "weather"), "hourly", WEATHER_ARRAYS,
                                      "time", "timestamp", "weather.json", multi_line, self.at)

    def load_weather_records(self, path: str) -> DataFrame:
        with scratch(self.spark):
            merged = ingest_typed_records(self.spark, path, self._existing("bronze", "weather"),
                                          _schema(WEATHER_SOURCE_SCHEMA), "timestamp", "weather_api", self.at)
            replace_path(merged, self.path("bronze", "weather"))
        return self.table("bronze", "weather")

    # Silver

    def _put(self, rows: DataFrame, layer: str, name: str, suite: Callable[..., DataFrame] | None) -> DataFrame:
        """Replace a table; with a suite only if its checks, taken while the rows are written, allow it."""
        path = self.path(layer, name)
        if suite is None:
            replace_path(rows, path)
        else:
            suite(rows, run=writing(path))
        return self.table(layer, name)

    def refresh_silver_trips(self, months: list[str] | None = None, gated: bool = False) -> DataFrame:
        """Clean the given months of Bronze (all of them by default) and upsert them.

        ``gated``, here and below, takes the table's suite over the new rows while they are written; a failed check stops the load and leaves the table.
        """
        bronze = self.table("bronze", "trips")
        if months is not None:
            bronze = bronze.filter(F.col(MONTH).isin(months))
        cleaned = clean_events(bronze, self.rules, self.until, self.at)
        path, month = self.path("silver", "trips"), f"bronze_{MONTH}"
        keyed = T.StructType([T.StructField("trip_key", T.LongType()), *cleaned.schema.fields])
        ensure_path(self.spark, path, keyed, partition_by=month)
        def checked(rows: DataFrame, path: str, part: str) -> None:
            suites.silver_trip_suite(rows, bronze, is_valid_event(self.rules, self.until), run=writing_partitions(path, part))

        with scratch(self.spark):
            return upsert_partitions(self.spark, path, cleaned, TRIP_KEY, month, key="trip_key", order_by=TRIP_KEY_ORDER,
                                     store=checked if gated else overwrite_partitions, update=TRIP_UPDATE, check_source=False)

    def _merge(self, layer: str, name: str, rows: DataFrame, key: str, suite: Callable[..., DataFrame] | None) -> DataFrame:
        target = self._existing(layer, name)
        merged = rows if target is None else upsert(target, rows, [key], null_safe=False, check_source=False)
        return self._put(merged, layer, name, suite)

    def refresh_silver_zones(self, gated: bool = False) -> DataFrame:
        rows = clean_reference(self.table("bronze", "zones"), "LocationID", {"Borough": "borough", "Zone": "zone"},
                               {"service_zone": "service_zone"}, "location_id", self.at)
        suite = partial(suites.silver_zone_suite, bronze=self.table("bronze", "zones"))
        return self._merge("silver", "zones", rows, "location_id", suite if gated else None)

    def refresh_silver_weather(self, gated: bool = False) -> DataFrame:
        return self._merge("silver", "weather", clean_series(self.table("bronze", "weather"), "timestamp", at=self.at),
                           "timestamp", partial(suites.silver_weather_suite, hours=self.hours()) if gated else None)

    # Gold

    def refresh_calendar(self, delete_unmatched: bool = False, gated: bool = False) -> DataFrame:
        fresh = build_calendar(self.spark, dt.datetime.fromisoformat(self.first_hour),
                               dt.datetime.fromisoformat(self.last_hour), at=self.at)
        target = self._existing("gold", "dim_datetime")
        merged = fresh if target is None else refresh_calendar(target, fresh, delete_unmatched)
        suite = partial(suites.calendar_suite, hours=self.hours(), first_day=self.first_hour[:10], last_day=self.last_hour[:10])
        return self._put(merged, "gold", "dim_datetime", suite if gated else None)

    def refresh_location(self, gated: bool = False) -> DataFrame:
        with scratch(self.spark):
            dim = build_reference_dim(self.table("silver", "zones"), "location_id", "location_key",
                                      ["borough", "zone", "service_zone"], self._existing("gold", "dim_location"), self.at)
            return self._put(dim, "gold", "dim_location", partial(suites.location_suite, silver=self.table("silver", "zones")) if gated else None)

    def refresh_weather(self, gated: bool = False) -> DataFrame:
        with scratch(self.spark):
            dim = build_coded_dim(self.table("silver", "weather"), "timestamp", "weather_code", WEATHER_CODES,
                                  existing=self._existing("gold", "dim_weather"), at=self.at)
            suite = partial(suites.weather_suite, hours=self.hours(), first=self.first_hour, last=self.last_hour)
            return self._put(dim, "gold", "dim_weather", suite if gated else None)

    def refresh_fact(self, months: list[str] | None = None, gated: bool = False) -> DataFrame:
        """Upsert the Silver trips of the given months (all by default); only those months are rewritten."""
        silver = self.table("silver", "trips")
        if months is not None:
            silver = silver.filter(F.col(f"bronze_{MONTH}").isin(months))
        dims = [self.table("gold", n) for n in ("dim_datetime", "dim_location", "dim_weather")]
        rows = trip_fact_rows(silver, *dims, at=self.at).withColumn(FACT_MONTH, month_of(F.col(PICKUP)))
        path = self.path("gold", "fact_taxi_trip")
        ensure_path(self.spark, path, T.StructType([T.StructField("trip_key", T.LongType()), *rows.schema.fields]),
                    partition_by=FACT_MONTH)
        def checked(rows: DataFrame, path: str, part: str) -> None:
            suites.fact_suite(rows, silver, *dims, run=writing_partitions(path, part))

        with scratch(self.spark):
            return upsert_partitions(self.spark, path, rows, FACT_ORDER, FACT_MONTH, key="trip_key", order_by=FACT_ORDER,
                                     store=checked if gated else overwrite_partitions, check_source=False)

    def refresh(self, months: list[str] | None = None, gate_silver: bool = False, gated: bool = False) -> None:
        """Silver, dimensions and fact in their order of dependence.

        With ``gate_silver`` a failed check of the Silver trips stops the load before Gold is touched. With ``gated`` every table's suite is taken
        while its new rows are written, and a failed check stops the load with that table, and all after it, as they were.
        """
        self.refresh_silver_trips(months, gated)
        self.refresh_silver_zones(gated)
        self.refresh_silver_weather(gated)
        if gate_silver:
            gate(self.silver_trip_report())
        self.refresh_calendar(gated=gated)
        self.refresh_location(gated)
        self.refresh_weather(gated)
        self.refresh_fact(months, gated)

    # Quality and reports

    def hours(self) -> int:
        span = dt.datetime.fromisoformat(self.last_hour) - dt.datetime.fromisoformat(self.first_hour)
        return int(span.total_seconds() // 3600) + 1

    def silver_trip_report(self) -> DataFrame:
        return suites.silver_trip_suite(self.table("silver", "trips"), self.table("bronze", "trips"),
                                        is_valid_event(self.rules, self.until))

    def reports(self) -> dict[str, DataFrame]:
        """The report of every suite over stored tables."""
        t, hours = self.table, self.hours()
        first, last = self.first_hour, self.last_hour
        return {
            "bronze_trips": suites.bronze_trip_suite(t("bronze", "trips")),
            "bronze_weather": suites.bronze_weather_suite(t("bronze", "weather"), hours, first, last),
            "silver_trips": self.silver_trip_report(),
            "silver_zones": suites.silver_zone_suite(t("silver", "zones"), t("bronze", "zones")),
            "silver_weather": suites.silver_weather_suite(t("silver", "weather"), hours),
            "dim_datetime": suites.calendar_suite(t("gold", "dim_datetime"), hours, first[:10], last[:10]),
            "dim_location": suites.location_suite(t("gold", "dim_location"), t("silver", "zones")),
            "dim_weather": suites.weather_suite(t("gold", "dim_weather"), hours, first, last),
            "fact_taxi_trip": suites.fact_suite(t("gold", "fact_taxi_trip"), t("silver", "trips"),
                                                t("gold", "dim_datetime"), t("gold", "dim_location"),
                                                t("gold", "dim_weather"))}

    def check(self, run_id: str) -> DataFrame:
        """Run all suites, keep their reports in the quality layer, and return what is stored."""
        path = self.path("quality", "reports")
        for suite, report in self.reports().items():
            append_report(report, path, suite, run_id)
        return stored_reports(self.spark, path)

    def report(self, name: str) -> DataFrame:
        """One of the analytics reports by the name of its function in ``plans.analytics``."""
        dims = {"demand_by_time": "dim_datetime", "demand_by_zone": "dim_location", "top_zones": "dim_location",
                "opportunity_zones": "dim_location"}
        return getattr(analytics, name)(self.table("gold", "fact_taxi_trip"),
                                        self.table("gold", dims.get(name, "dim_weather")))
