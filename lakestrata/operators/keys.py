"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestrata.session import materialize

_PART_BITS = 33  # monotonically_increasing_id: partition number above, row position in the lower 33 bits


def number_rows(df: DataFrame, key: str, order_by: Sequence[str], after: Column | None = None) -> DataFrame:
    """Number the rows ``after + 1, after + 2, ...`` in ``order_by`` order, without a single-task window.

    Rows are range-partitioned and sorted, and each remembers its place within its run. The runs are
    written once, so the numbering survives lost executors; the count of each run then gives the
    offset of the next. Only one row per run meets in one task. ``order_by`` should be unique, else
    rows equal in it get their numbers in any order. The key column of ``df``, if any, is replaced.
    """
    columns = [c for c in df.columns if c != key]
    runs = materialize(
        df.select(*columns).repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id()), "numbered")
    runs = runs.withColumn("_run", F.shiftright("_place", _PART_BITS))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (runs.groupBy("_run").agg(F.count(F.lit(1)).alias("_n"))
               .select("_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    start = F.lit(0) if after is None else F.coalesce(after, F.lit(0))
    place = F.col("_place").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    number = (start + F.col("_before") + place + 1).cast("long")
    # At most one offset per sort partition, so the broadcast is bounded by the partition count.
    return runs.join(F.broadcast(offsets), "_run").select(number.alias(key), *columns)


def assign_missing_keys(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Rows with a key keep it; rows without one get the numbers after the largest, in ``order_by`` order."""
    present = df.filter(F.col(key).isNotNull())
    largest = present.agg(F.max(key).alias("k")).scalar()
    fresh = number_rows(df.filter(F.col(key).isNull()), key, order_by, after=largest)
    return present.unionByName(fresh)
