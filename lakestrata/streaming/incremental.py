"""Load newly landed files and stop: the batch upsert driven by a file stream.

The checkpoint remembers which files are done, so a rerun reads only new ones; the upsert makes a
batch that is replayed after a failure harmless.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakestrata.operators.dedupe import keep_one
from lakestrata.operators.journal import Journal
from lakestrata.operators.lineage import stamp, stamp_source
from lakestrata.operators.upsert import upsert_partitions
from lakestrata.operators.writes import ensure_path
from lakestrata.plans.bronze import MONTH


def load_new_files(spark: SparkSession, path: str, table: str, checkpoint: str, schema: T.StructType,
                   event_time: str, keys: Sequence[str], at: dt.datetime | None = None,
                   files_per_batch: int | None = None, journal: Journal | None = None) -> DataFrame:
    """Upsert all files that landed under ``path`` since the last call into the Bronze table, and return it with all columns it has stored.

    With a journal each micro-batch is entered as ``<checkpoint>#<number>``, and one that is entered is not written again.
    """
    source = spark.readStream.schema(schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    rows = source.parquet(path).select("*", F.col("_metadata.file_name").alias("file_name"))
    staged = stamp(stamp_source(rows, event_time), "bronze", at)
    ensure_path(spark, table, staged.schema, partition_by=MONTH)

    def load(batch: DataFrame, number: int) -> None:
        def put(touched=None):
            upsert_partitions(spark, table, keep_one(batch, keys), [*keys, MONTH], MONTH, touched=touched, check_source=False)
        if journal is None:
            put()
        else:
            journal.once(f"{checkpoint}#{number}", table, put, at)

    query = (staged.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return ensure_path(spark, table, staged.schema, partition_by=MONTH)
