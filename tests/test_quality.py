import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakestrata.plans.gold import build_calendar
from lakestrata.quality import rules, suites
from lakestrata.quality.checks import Other, Reference, Rows, Total, Unique, Volumes, measure, run_suite
from lakestrata.quality.store import QualityGateFailed, append_report, gate, stored_reports, summarise
from lakestrata.session import new_path


@pytest.mark.parametrize("rule,kind,name,pct,status", [
    (rules.STRICT, "", "x", 0.01, "FAIL"),
    (rules.SOURCE_RULES, "COMPOSITE_KEY", "x", 1.0, "WARN"),
    (rules.SOURCE_RULES, "COMPOSITE_KEY", "x", 1.01, "FAIL"),
    (rules.SOURCE_RULES, "OTHER_DQ", "x", 2.0, "WARN"),
    (rules.SOURCE_RULES, "OTHER_DQ", "x", 2.01, "FAIL"),
    (rules.SOURCE_RULES, "MONTHLY_COUNT", "x", 100.0, "PASS"),
    (rules.SOURCE_RULES, "CRITICAL", "x", 0.5, "FAIL"),
    (rules.SILVER_ZONE_RULES, "VOLUME", "x", 2.0, "WARN"),
    (rules.SILVER_ZONE_RULES, "VALIDITY", "x", 1.01, "FAIL"),
    (rules.SILVER_ZONE_RULES, "NULL", "Missing location_id", 0.1, "FAIL"),
    (rules.SILVER_ZONE_RULES, "NULL", "Missing zone", 0.1, "WARN"),
    (rules.LOCATION_RULES, "NULL", "Missing zone", 0.1, "FAIL"),
    (rules.LOCATION_RULES, "BUSINESS_RULE", "x", 100.0, "FAIL"),
    (rules.FACT_RULES, "REFERENTIAL_INTEGRITY", "weather_key not in dim_weather", 50.0, "PASS"),
    (rules.FACT_RULES, "REFERENTIAL_INTEGRITY", "other", 1.0, "WARN"),
    (rules.FACT_RULES, "LINEAGE", "x", 0.1, "FAIL"),
])
def test_status(spark, rule, kind, name, pct, status):
    got = spark.range(1).select(rule.status(F.lit(name), F.lit(kind), F.lit(kind), F.lit(1), F.lit(pct)),
                                rule.status(F.lit(name), F.lit(kind), F.lit(kind), F.lit(0), F.lit(None)))
    assert tuple(got.first()) == (status, "PASS")


def test_all_kinds_of_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (9, "a")], "id int, v string")
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    other = spark.createDataFrame([(7, 3)], "records int, failures int")
    result = run_suite(df, [
        Rows("nulls", "NULL", F.col("v").isNull()),
        Total("volume", "VOLUME", F.abs(F.count("*") - 5), expected="5", actual=F.count("*"), base=F.max(F.lit(5))),
        Unique("unique", "UNIQUE", ["id"]),
        Reference("ri", "RI", "id", dim, "id"),
        Other("other", "X", other),
        Volumes("Rows", "VOLUME", F.coalesce("v", F.lit("none")), 10)], rules.STRICT, "t")
    got = {r.check_name: (r.check_order, r.records_checked, r.failures, r.expected_value, r.actual_value, r.failure_pct,
                          r.status) for r in result.collect()}
    assert got == {
        "nulls": (1, 4, 1, "0", "1", 25.0, "FAIL"), "volume": (2, 4, 1, "5", "4", 20.0, "FAIL"),
        "unique": (3, 4, 1, "0", "1", 25.0, "FAIL"), "ri": (4, 4, 1, "0", "1", 25.0, "FAIL"),
        "other": (5, 7, 3, "0", "3", 42.86, "FAIL"), "Rows (a)": (11, 2, 0, "0", "0", 0.0, "PASS"),
        "Rows (b)": (12, 1, 0, "0", "0", 0.0, "PASS"), "Rows (none)": (13, 1, 0, "0", "0", 0.0, "PASS")}


def test_empty_table_has_no_division_error(spark):
    df = spark.createDataFrame([], "id int, v string")
    got = measure(df, [Rows("nulls", failing=F.col("v").isNull()), Rows("sum", failing=F.col("v").isNull(), null_if_empty=True),
                       Unique("unique", keys=["id"], skip_null=True)])
    assert [(r.check_name, r.failures, r.failure_pct) for r in got.orderBy("check_order").collect()] == [
        ("nulls", 0, None), ("sum", None, None), ("unique", 0, None)]


def test_calendar_suite_passes_on_a_calendar_and_fails_when_empty(spark):
    calendar = build_calendar(spark, dt.datetime(2026, 3, 1), dt.datetime(2026, 5, 31, 23))
    report = suites.calendar_suite(calendar)
    assert report.count() == 13 and report.filter("status <> 'PASS'").count() == 0
    empty = suites.calendar_suite(calendar.limit(0))
    assert {r.status for r in empty.collect() if r.check_name != "Duplicate datetime_key primary key"} == {"FAIL"}


ZONES = [(i, b, f"Zone {i}", s) for i, (b, s) in enumerate(
    [("Queens", "Boro Zone")] * 69 + [("Manhattan", "Yellow Zone")] * 69 + [("Brooklyn", "Boro Zone")] * 61
    + [("Bronx", "Boro Zone")] * 43 + [("Staten Island", "Boro Zone")] * 20 + [("Ewr", "EWR")] + [("Unknown", "N/A")]
    + [("N/a", "N/A")], 1)]


def test_zone_suites_give_the_recorded_warnings(spark):
    """265 zones as published: a few boroughs and service zones outside the lists, the rest passes."""
    at = dt.datetime(2026, 6, 1)
    silver = spark.createDataFrame(ZONES, "location_id int, borough string, zone string, service_zone string").withColumns(
        {"silver_ingestion_timestamp": F.lit(at), "silver_ingestion_date": F.lit(at.date())})
    got = {r.check_name: (r.failures, r.failure_pct, r.status) for r in suites.silver_zone_suite(silver, silver).collect()}
    assert got.pop("Invalid borough value") == (2, 0.75, "WARN")
    assert got.pop("Invalid service_zone value") == (2, 0.75, "WARN")
    assert len(got) == 9 and {s for _, _, s in got.values()} == {"PASS"}
    folded = suites.silver_zone_suite(silver, silver, case_insensitive=True).filter("check_name = 'Invalid borough value'")
    assert folded.first().failures == 1

    location = silver.withColumn("location_key", F.col("location_id").cast("long"))
    got = {r.check_name: (r.failures, r.failure_pct, r.status) for r in suites.location_suite(location, silver).collect()}
    assert got.pop("Invalid borough value") == (2, 0.75, "WARN")
    assert len(got) == 12 and {s for _, _, s in got.values()} == {"PASS"}


def test_total_row_count_passes_on_an_empty_source(spark):
    raw = spark.createDataFrame([], "VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
                                    "PULocationID int, DOLocationID int, trip_distance double, total_amount double, "
                                    "file_name string")
    report = suites.download_suite(raw)
    assert [(r.check_name, r.records_checked, r.affected_percentage, r.status) for r in report.collect()][0] == (
        "Total Downloaded Row Count", 0, "0.00%", "PASS")
    assert {r.status for r in report.collect()} == {"PASS"}


def test_reports_are_stored_summarised_and_gate_the_load(spark):
    good = spark.createDataFrame([("a", 0, "PASS"), ("b", 1, "WARN")], "check_name string, failed_rows long, status string")
    bad = spark.createDataFrame([("t", "c", "FAIL")], "table_name string, check_name string, status string")
    path = new_path(spark, "reports")
    append_report(good, path, "good", "r1")
    append_report(bad, path, "bad", "r1")
    append_report(good, path, "good", "r2")
    stored = stored_reports(spark, path)
    assert stored.filter("run_id = 'r1'").count() == 3 and stored.count() == 5
    assert rows(summarise({"good": good, "bad": bad})) == [("bad", 0, 0, 1, 1), ("good", 1, 1, 0, 2)]
    assert gate(good) is good
    with pytest.raises(QualityGateFailed, match="c"):
        gate(bad)
