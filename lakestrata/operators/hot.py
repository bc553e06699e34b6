"""Lookups where a few values hold much of the rows.

AQE splits a join partition only far above its size threshold. Here the hot values are found first, by a sketch of bounded size, and their rows are dealt
out over several tasks, each of which gets its own copy of the few members they meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MOST = 1000  # values that can be hot: the rows of one are more than the 1000th part of all


def hot_values(df: DataFrame, column: str, share: float) -> dict:
    """Values that more than ``share`` of the rows have (0.001 at least), with an estimate of their rows, from one pass.

    The sketch (``approx_top_k``) is exact up to its size and else never misses a value above its error, which is far below the 1000th part; NULLs are
    no values.
    """
    if not 1 / MOST <= share <= 1:
        raise ValueError(f"share must be {1 / MOST} to 1")
    top = F.expr(f"approx_top_k(`{column}`, {MOST}, {64 * MOST})")
    one = df.filter(F.col(column).isNotNull()).agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {r["item"]: r["count"] for r in one["top"] or [] if r["count"] > share * one["n"]}


def split_lookup(df: DataFrame, dim: DataFrame, column: str, dim_key: str, take: dict[str, str], optional: bool = False, parts: int = 128,
                 hot: dict | None = None) -> DataFrame:
    """``lookup`` of one column, with the rows of hot values dealt out over ``parts`` tasks.

    Hot is, unless given, a value with more than the ``parts``-th part of the rows. Its rows are told apart by a hash of all their columns, which a repeated task
    computes again; the members of hot values, and no others, are copied ``parts`` times, which should be several times the tasks. Rows that are equal in every column stay together.
    """
    hot = hot_values(df, column, max(1 / parts, 1 / MOST)) if hot is None else hot
    value, member = F.col(column), F.col(dim_key)

    def is_hot(key: Column) -> Column:
        return F.coalesce(key.isin(list(hot)), F.lit(False)) if hot else F.lit(False)
    dealt = df.withColumn("_part", F.when(is_hot(value), F.pmod(F.xxhash64(*df.columns), F.lit(parts))).otherwise(F.lit(0).cast("long"))).withColumn("_value", value)
    first, last = F.lit(0).cast("long"), F.lit(parts - 1).cast("long")
    copies = F.when(is_hot(member), F.sequence(first, last)).otherwise(F.array(first))
    side = (dim.select(member.alias("_member"), *[F.col(c).alias(n) for c, n in take.items()], copies.alias("_copies"))
            .withColumn("_of", F.explode("_copies")).drop("_copies"))
    joined = dealt.join(side, (F.col("_value") == F.col("_member")) & (F.col("_part") == F.col("_of")), "left" if optional else "inner")
    return joined.drop("_part", "_value", "_member", "_of")
