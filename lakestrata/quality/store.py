"""Keep reports, summarise them, and stop a load that failed its checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.operators.writes import append_path
from lakestrata.quality.rules import FAIL, PASS, WARN


class QualityGateFailed(RuntimeError):
    pass


def append_report(report: DataFrame, path: str, suite: str, run_id: str) -> None:
    """Add a report to the quality table, one partition per run. Values are kept as text."""
    columns = [F.col(c).cast("string").alias(c) for c in report.columns]
    append_path(report.select(*columns, F.lit(suite).alias("suite"), F.lit(run_id).alias("run_id")), path, "run_id")


def stored_reports(spark: SparkSession, path: str) -> DataFrame:
    """All stored reports; layouts that lack a column show NULL there."""
    return spark.read.option("mergeSchema", True).parquet(path)


def gate(report: DataFrame) -> DataFrame:
    """The report itself, or an error naming the failed checks (a report has one row per check)."""
    failed = [row[0] for row in report.filter(F.col("status") == FAIL).select("check_name").collect()]
    if failed:
        raise QualityGateFailed(f"{len(failed)} failed checks: {', '.join(sorted(failed))}")
    return report


def summarise(reports: dict[str, DataFrame]) -> DataFrame:
    """Checks per status for each suite."""
    merged = None
    for suite, report in reports.items():
        part = report.select(F.lit(suite).alias("suite"), "status")
        merged = part if merged is None else merged.unionByName(part)
    return merged.groupBy("suite").agg(
        *[F.count_if(F.col("status") == s).alias(f"{s.lower()}_checks") for s in (PASS, WARN, FAIL)],
        F.count(F.lit(1)).alias("checks"))
