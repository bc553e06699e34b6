"""Checks taken while a table is written, and a gate before it takes the place of the old one.

Row checks and totals are aggregates of the rows that the write passes through (``DataFrame.observe``), so they cost no second scan. The new rows are
complete beside the old ones when their checks are known: if one fails, the new rows are removed and the table stays as it was. Checks that need rows
of one key together (uniqueness, references, volumes by label) read their columns from the new rows, still before the swap.

The functions give a way to run a suite: ``location_suite(rows, silver, run=writing(path))`` writes the rows as the table and returns the report.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, types as T

from lakestrata.operators.writes import balanced, replace_partitions
from lakestrata.quality.checks import Check, Rows, Run, Total, measure_numbered, scan_aggregates, scan_rows, with_status
from lakestrata.quality.rules import RuleSet
from lakestrata.quality.store import gate
from lakestrata.session import delete_path, new_beside, swap_path


def writing(path: str, partition_by: str | None = None, stop: bool = True) -> Run:
    """Replaces the table at ``path`` by the rows.

    With ``stop`` a failed check raises ``QualityGateFailed`` and the old table stays; without, the table is replaced and the report says so. An
    error while writing leaves the old table too. The rows may come from the table itself.
    """
    return _run(path, partition_by, stop, lambda spark, fresh: swap_path(spark, fresh, path))


def writing_partitions(path: str, partition_by: str, stop: bool = True) -> Run:
    """Replaces only the partitions that the rows belong to; the checks see these rows."""
    return _run(path, partition_by, stop, lambda spark, fresh: replace_partitions(spark, fresh, path))


def _run(path: str, partition_by: str | None, stop: bool, put: Callable[[SparkSession, str], None]) -> Run:
    def run(df: DataFrame, checks: Sequence[Check], rules: RuleSet, table: str = "") -> DataFrame:
        spark, fresh = df.sparkSession, new_beside(path)
        try:
            measured = _write(df, fresh, partition_by, checks)
            report = with_status(measured, rules, table)
            report = spark.createDataFrame(report.collect(), report.schema)  # a row per check: kept, as what it was taken from may go
            if stop:
                gate(report)
        except BaseException:
            delete_path(spark, fresh)
            raise
        put(spark, fresh)
        return report
    return run


def _write(df: DataFrame, fresh: str, partition_by: str | None, checks: Sequence[Check]) -> DataFrame:
    """Write the rows and measure the checks. The aggregates are observed behind the last exchange, in the tasks that write: Spark counts a task once."""
    spark, numbered = df.sparkSession, list(enumerate(checks, 1))
    passing = [(i, c) for i, c in numbered if isinstance(c, Rows | Total)]
    aggregates, seen = scan_aggregates(passing), Observation()
    dealt = balanced(df, partition_by)
    writer = (dealt.observe(seen, *aggregates) if passing else dealt).write
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(fresh)
    first = []
    if passing:
        names = df.limit(0).agg(*aggregates).schema  # types of the metrics, which come as plain values
        shape = T.StructType([T.StructField(f.name, f.dataType) for f in names.fields])
        first = [scan_rows(spark.createDataFrame([tuple(seen.get[f.name] for f in shape.fields)], shape), passing)]
    rest = [(i, c) for i, c in numbered if not isinstance(c, Rows | Total)]
    return measure_numbered(spark.read.schema(df.schema).parquet(fresh), rest, first)
