"""Rounding and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SETTLE_DIGITS = 10


def settled_round(col: Column, digits: int) -> Column:
    """Round half up after removing floating-point noise.

    The sum behind a mean depends on the order in which tasks finish, in its last bits only; a value
    on the edge between two roundings would flip from run to run. Dropping what lies beyond ten digits
    makes the result the same on every run, and is far below any difference that could matter to it.
    """
    return F.round(F.round(col.cast("double"), SETTLE_DIGITS), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    return settled_round(ratio(part.cast("double") * 100.0, whole), digits)


def mean(col: Column, digits: int = 2) -> Column:
    return settled_round(F.avg(col), digits)


def mean_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Mean of the per-row ratios over rows with a positive denominator."""
    return mean(F.when(denominator > 0, numerator / denominator), digits)
