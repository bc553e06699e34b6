"""Ordered reports: top and bottom k, shares, report positions, custom orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestrata.functions.numeric import settled_round

# Sample size under which a group is flagged, and the two flags.
LOW_SAMPLE_ROWS = 200
LOW_SAMPLE = "LOW SAMPLE - interpret with caution"
ENOUGH = "OK"


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str], largest: bool = True) -> DataFrame:
    """The k rows with the largest (or smallest) value; ties go to the smallest ``tie_break``."""
    first = F.col(by).desc() if largest else F.col(by).asc()
    return df.orderBy(first, *tie_break).limit(k)


def share_of_total(groups: DataFrame, count: str, name: str = "pct_of_total", digits: int = 2) -> DataFrame:
    """Percentage of each row in the sum of ``count``. For aggregated rows: they meet in one task."""
    share = F.lit(100.0) * F.col(count) / F.sum(count).over(Window.partitionBy())
    return groups.withColumn(name, settled_round(share, digits))


def sample_flag(count: Column, at_least: int = LOW_SAMPLE_ROWS) -> Column:
    return F.when(count < at_least, LOW_SAMPLE).otherwise(ENOUGH)


def listed_order(col: Column, values: Sequence[str], first: int = 0) -> Column:
    """Position of a value in a list, for sorting; NULL when not listed."""
    order = F.lit(None).cast("int")
    for i, value in reversed(list(enumerate(values, first))):
        order = F.when(col == value, i).otherwise(order)
    return order


def label_positions(groups: DataFrame, label: str, name: str, start: Column | int,
                    within: Sequence[str] = ()) -> DataFrame:
    """``start`` + dense rank of a label, per value of ``within`` if given.

    For aggregated rows (one per label): those of one ``within`` value meet in one task.
    """
    first = F.lit(start) if isinstance(start, int) else start
    return groups.withColumn(name, first + F.dense_rank().over(Window.partitionBy(*within).orderBy(label)))
