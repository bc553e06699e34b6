"""Row sources that need no input files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def hour_grid(spark: SparkSession, start: dt.datetime, end: dt.datetime, column: str = "full_datetime",
              step_hours: int = 1, position: str | None = None) -> DataFrame:
    """Every ``step_hours`` from start to end (both included), split over tasks by ``spark.range``."""
    if end < start:
        raise ValueError("end lies before start")
    steps = int((end - start).total_seconds() // (3600 * step_hours)) + 1
    first = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    grid = spark.range(steps)
    moment = first + F.make_dt_interval(hours=(F.col("id") * step_hours).cast("int"))
    cols = [moment.alias(column)]
    if position:
        cols.insert(0, (F.col("id") + 1).alias(position))
    return grid.select(*cols)


def hour_sequence(bounds: DataFrame, start: str, end: str, column: str = "full_datetime",
                  keep: Sequence[str] = ()) -> DataFrame:
    """One row per hour between the two timestamp columns of each row of ``bounds``."""
    hours = F.sequence(F.col(start), F.col(end), F.expr("interval 1 hour"))
    return bounds.select(*keep, F.explode(hours).alias(column))


def literal_row(spark: SparkSession, **values: Column) -> DataFrame:
    """A single row of literal values."""
    return spark.range(1).select(*[v.alias(n) for n, v in values.items()])
