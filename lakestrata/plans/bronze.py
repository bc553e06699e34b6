"""Bronze: land source files with lineage columns, by overwrite or by idempotent upsert."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakestrata.operators.dedupe import keep_one
from lakestrata.operators.lineage import stamp, stamp_source
from lakestrata.operators.upsert import upsert, upsert_partitions
from lakestrata.operators.writes import ensure_path, overwrite_path
from lakestrata.session import materialize
from lakestrata.sources.files import read_array_documents, read_csv, read_parquet, read_records

MONTH = "source_month"


def stage_files(spark: SparkSession, path: str, event_time: str, schema: T.StructType | None = None,
                at: dt.datetime | None = None) -> DataFrame:
    """Rows of all Parquet files under a path with source file, source month and audit columns."""
    rows = read_parquet(spark, path, schema, file_column="file_name")
    return stamp(stamp_source(rows, event_time), "bronze", at)


def ingest_partitioned_files(spark: SparkSession, path: str, table: str, event_time: str, keys: Sequence[str],
                             schema: T.StructType | None = None, at: dt.datetime | None = None,
                             touched: Callable[[list], object] | None = None) -> DataFrame:
    """Upsert the files under ``path`` into the Bronze table, one row per key, partitioned by source month.

    Loading the same files again changes nothing but the audit columns; a new month adds its partition. ``touched`` is told the months.
    """
    batch = keep_one(stage_files(spark, path, event_time, schema, at), keys)
    ensure_path(spark, table, batch.schema, partition_by=MONTH)
    return upsert_partitions(spark, table, batch, [*keys, MONTH], MONTH, touched=touched, check_source=False)


def ingest_overwrite(spark: SparkSession, path: str, table: str, event_time: str,
                     schema: T.StructType | None = None, at: dt.datetime | None = None) -> DataFrame:
    """Replace the Bronze table by the files under ``path``, rows as they are."""
    rows = stage_files(spark, path, event_time, schema, at)
    overwrite_path(rows, table, partition_by=MONTH)
    return read_parquet(spark, table, rows.schema)


def ingest_reference_csv(spark: SparkSession, path: str, table: str, schema: T.StructType | str | None = None,
                         at: dt.datetime | None = None) -> DataFrame:
    """Replace a reference table by a CSV list; its columns may have changed."""
    overwrite_path(stamp(read_csv(spark, path, schema), "bronze", at), table)
    return read_parquet(spark, table)


def ingest_array_documents(spark: SparkSession, path: str, table: str, field: str, columns: dict[str, str],
                           time_array: str, time_column: str, source_name: str, multi_line: bool = False,
                           at: dt.datetime | None = None) -> DataFrame:
    """Replace a time-series table by documents of parallel arrays; the time array becomes a timestamp."""
    rows = read_array_documents(spark, path, field, columns, multi_line)
    rows = (rows.withColumn(time_array, F.to_timestamp_ntz(time_array))
            .withColumnRenamed(time_array, time_column).withColumn("source_file", F.lit(source_name)))
    overwrite_path(stamp(rows, "bronze", at), table)
    return read_parquet(spark, table)


def ingest_typed_records(spark: SparkSession, path: str, target: DataFrame | None, schema: T.StructType | str,
                         primary_key: str, source_name: str, at: dt.datetime | None = None) -> DataFrame:
    """Merge typed JSON records into ``target`` by primary key and return the merged rows.

    A NULL key is a key like any other, so that loading the same file again adds nothing.
    """
    rows = read_records(spark, path, schema).withColumn("source_file", F.lit(source_name))
    batch = keep_one(stamp(rows, "bronze", at), [primary_key])
    if target is None:
        return batch
    return upsert(target, materialize(batch, "records"), [primary_key], check_source=False)
