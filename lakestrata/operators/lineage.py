"""Audit and lineage columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def stamp(df: DataFrame, layer: str, at: dt.datetime | Column | None = None,
          names: tuple[str, str] | None = None) -> DataFrame:
    """Add ``<layer>_ingestion_timestamp`` and ``<layer>_ingestion_date`` (or the given names).

    One moment per query: the current one, or ``at`` for a repeatable load.
    """
    if at is None:
        moment = F.current_timestamp()
    else:
        moment = at if isinstance(at, Column) else F.lit(at.isoformat(sep=" ")).cast("timestamp")
    ts, date = names or (f"{layer}_ingestion_timestamp", f"{layer}_ingestion_date")
    return df.withColumns({ts: moment, date: moment.cast("date")})


def stamp_source(df: DataFrame, event_time: str, file_column: str = "file_name") -> DataFrame:
    """Add ``source_file`` and ``source_month`` (the month of the event time)."""
    return (df.withColumnRenamed(file_column, "source_file")
            .withColumn("source_month", F.date_format(event_time, "yyyy-MM")))


def rename_lineage(df: DataFrame, layer: str, columns: tuple[str, ...] = ("source_file", "source_month")) -> DataFrame:
    """Prefix lineage columns with the layer they come from."""
    return df.withColumnsRenamed({c: f"{layer}_{c}" for c in columns})
