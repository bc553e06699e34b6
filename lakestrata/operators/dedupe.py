"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def total_order(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()) -> list[Column]:
    """Latest first by ``latest_by``; equal rows are settled by every other column, smallest first."""
    order = [F.col(c).desc_nulls_last() for c in latest_by]
    rest = [c for c in df.columns if c not in set(keys) | set(latest_by)]
    return order + [F.col(c).asc_nulls_last() for c in rest]


def keep_one(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()) -> DataFrame:
    """One row per key (NULL keys count as equal), the latest by ``latest_by``.

    ``row_number() = 1`` becomes a group limit that runs before the shuffle as well: each task sends
    at most one row per key, so a key that holds a third of all rows sends one row per task.
    """
    order = total_order(df, keys, latest_by)
    if not order:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
