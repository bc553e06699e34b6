"""A journal of loads: which batch changed which partitions of which table.

A batch is one delivery, named by the caller (a file name, a message id). Its entry is written after its last partition, so a batch without an
entry may be half done and is done again, which upserts allow; a batch with one is not written twice. What must be refreshed after a load is read
from the journal, a few rows for each load, instead of from the load times of all rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.operators.writes import append_path

SCHEMA = "batch string, table_name string, part string, done_at timestamp"


class Journal:
    """Entries in a Parquet folder, one row per batch, table and partition. One writer at a time is assumed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def is_done(self, batch: str, table: str) -> bool:
        return not self.entries().filter((F.col("batch") == batch) & (F.col("table_name") == table)).isEmpty()

    def add(self, batch: str, table: str, parts: Sequence[str | None], at: dt.datetime | None = None) -> None:
        """The entry of a finished batch; one without partitions has a row as well."""
        moment = at or dt.datetime.now(dt.timezone.utc)
        rows = [(batch, table, None if p is None else str(p)) for p in parts] or [(batch, table, None)]
        stamp = F.lit(moment.isoformat(sep=" ")).cast("timestamp")
        append_path(self.spark.createDataFrame(rows, "batch string, table_name string, part string").withColumn("done_at", stamp).coalesce(1), self.path)

    def once(self, batch: str, table: str, load: Callable[[Callable[[Sequence], None]], object], at: dt.datetime | None = None) -> bool:
        """Runs ``load(touched)`` unless the batch is done, and enters the partitions that it passes to ``touched``. Whether it ran."""
        if self.is_done(batch, table):
            return False
        parts: list[str | None] = []
        load(lambda more: parts.extend(p for p in more if p not in parts))
        self.add(batch, table, parts, at)
        return True

    def changed(self, table: str, since: dt.datetime | None = None) -> list[str]:
        """Partitions that batches finished at or after a moment have changed, in order."""
        rows = self.entries().filter(F.col("table_name") == table).filter("part IS NOT NULL")
        if since is not None:
            rows = rows.filter(F.col("done_at") >= F.lit(since.isoformat(sep=" ")).cast("timestamp"))
        return sorted(r[0] for r in rows.select("part").distinct().collect())  # at most one per table partition
