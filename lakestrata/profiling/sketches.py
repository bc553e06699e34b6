"""Distinct counts of a growing table from small mergeable sketches, one for each month and column.

A month's sketches are made from that month's rows alone and stored; the count over any set of months is that of their union. So a new month is added,
and an old one replaced, without reading the others. A sketch takes at most 2 ** ``LG_K`` bytes and its error does not depend on the number
of rows: counts up to about 2 ** ``LG_K`` / 8 are exact, and above that the standard error of a union is 1.04 / sqrt(2 ** ``LG_K``). The
exact counts (``profile.column_uniqueness``) stay for where they are wanted.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.operators.writes import overwrite_partitions

LG_K = 14


def error_bound(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """The relative error that a count exceeds in fewer than 3 of 1000 cases (three standard errors)."""
    return deviations * 1.04 / sqrt(2 ** lg_k)


def _values(column: str) -> Column:
    """What is counted: a hash of any type, nothing for NULL."""
    return F.when(F.col(column).isNotNull(), F.xxhash64(column))


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: str, lg_k: int = LG_K) -> DataFrame:
    """``column_name, row_count, sketch, <by>``: one row per value of ``by`` and column, all from one scan."""
    aggregates = [F.hll_sketch_agg(_values(c), lg_k).alias(f"s{i}") for i, c in enumerate(columns)]
    one = df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"), *aggregates)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("row_count"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)])
    return one.select(by, F.inline(rows)).select("column_name", "row_count", "sketch", by)


def store_sketches(df: DataFrame, path: str, columns: Sequence[str], by: str, lg_k: int = LG_K) -> None:
    """Add the sketches of the months of ``df``, which must hold these months completely, to the table at ``path``, in place of earlier ones."""
    overwrite_partitions(distinct_sketches(df, columns, by, lg_k), path, by)


def distinct_estimates(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``column_name, row_count, distinct_estimate`` over all given sketches, or for each value of ``by``."""
    united = sketches.groupBy("column_name", *by).agg(F.sum("row_count").alias("row_count"), F.hll_union_agg("sketch").alias("sketch"))
    return united.select("column_name", *by, "row_count", F.hll_sketch_estimate("sketch").alias("distinct_estimate"))
