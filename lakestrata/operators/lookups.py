"""Dimension lookups and key reconciliation.

No join here carries a broadcast hint. Spark broadcasts a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with AQE splitting hot keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def lookup(df: DataFrame, dim: DataFrame, on: Column | str, dim_key: str, take: dict[str, str],
           optional: bool = False) -> DataFrame:
    """Add columns of a dimension (``take``: dimension column -> new name), matched on one value.

    Inner by default: rows without a member are dropped. ``optional`` keeps them with NULLs. The same
    dimension can be looked up again under other names (role playing).
    """
    value = F.col(on) if isinstance(on, str) else on
    side = dim.select(F.col(dim_key).alias("_member"), *[F.col(c).alias(n) for c, n in take.items()])
    joined = df.withColumn("_value", value).join(side, F.col("_value") == F.col("_member"),
                                                 "left" if optional else "inner")
    return joined.drop("_value", "_member")


def orphan_counts(df: DataFrame, references: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per foreign key (``column -> (dimension, key)``) whose value no dimension row has.

    The foreign keys of one type, in practice all, share one scan: each row gives its values under the number of their key, which are counted before
    anything is shuffled, and the counts, not the rows, are matched. A value is compared in the common type of both keys, as a join would. NULL values
    are not orphans. Columns: fk, records_checked, orphans (one row per foreign key, also for an empty table).
    """
    by_type: dict[str, list[tuple[int, str]]] = {}
    for i, (column, (dim, key)) in enumerate(references.items()):
        by_type.setdefault(_common_type(df, column, dim, key), []).append((i, column))
    parts = []
    for kind, columns in by_type.items():
        each = F.array(*[F.struct(F.lit(i).alias("_fk"), F.col(c).cast(kind).alias("_value")) for i, c in columns])
        values = df.select(F.inline(each)).groupBy("_fk", "_value").agg(F.count(F.lit(1)).alias("_n"))
        members = reduce(DataFrame.unionByName, [references[c][0].select(F.lit(i).alias("_of"), F.col(references[c][1]).cast(kind).alias("_member"))
                                                 .dropna().distinct() for i, c in columns])
        matched = values.join(members, (F.col("_fk") == F.col("_of")) & (F.col("_value") == F.col("_member")), "left")
        lost = F.col("_value").isNotNull() & F.col("_member").isNull()
        sums = [s for i, _ in columns for s in (F.sum(F.when(F.col("_fk") == i, F.col("_n"))).alias(f"n{i}"),
                                                F.sum(F.when((F.col("_fk") == i) & lost, F.col("_n"))).alias(f"o{i}"))]
        rows = [F.struct(F.lit(c).alias("fk"), F.coalesce(f"n{i}", F.lit(0)).alias("records_checked"), F.coalesce(f"o{i}", F.lit(0)).alias("orphans"))
                for i, c in columns]
        parts.append(matched.agg(*sums).select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def _common_type(df: DataFrame, column: str, dim: DataFrame, key: str) -> str:
    """The type in which the planner compares the two keys; only the plan is analysed."""
    own, other = df.schema[column].dataType, dim.schema[key].dataType
    if own == other:
        return own.simpleString()
    one = df.sparkSession.createDataFrame([], T.StructType([T.StructField("a", own), T.StructField("b", other)]))
    return one.select(F.coalesce("a", "b").alias("c")).schema["c"].dataType.simpleString()


def only_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys of ``left`` that ``right`` lacks."""
    return left.select(key).dropna().distinct().join(right.select(key), key, "left_anti")


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys found on one side only, with the side.

    Keys of one type travel once: both sides are marked, combined before the shuffle and counted together. Keys of two types are compared by joins,
    in their common type.
    """
    if left.schema[key].dataType != right.schema[key].dataType:
        return (only_in(left, right, key).withColumn("only_in", F.lit("left"))
                .unionByName(only_in(right, left, key).withColumn("only_in", F.lit("right"))))
    marked = (left.select(F.col(key).alias("_key"), F.lit(1).alias("_side"))
              .unionByName(right.select(F.col(key).alias("_key"), F.lit(2).alias("_side"))))
    sides = marked.dropna(subset=["_key"]).groupBy("_key").agg(F.bit_or("_side").alias("_sides")).filter("_sides < 3")
    return sides.select(F.col("_key").alias(key), F.when(F.col("_sides") == 1, "left").otherwise("right").alias("only_in"))


def within_bounds(df: DataFrame, column: str, bounds: DataFrame, low: str, high: str) -> DataFrame:
    """Rows whose column lies between two columns of the one-row table ``bounds`` (both included).

    The one row is read first and its values go into the filter as literals, which the scan of ``df``
    can use to skip partitions and row groups; a join with the row could not. No row or a NULL bound
    keeps nothing. The values travel as text: a naive time would be taken for the driver's local time.
    Where the table keeps the day of the column (``<column>_day``, see ``writes.with_day``) its days are bounded too.
    """
    kind = df.schema[column].dataType
    one = bounds.select(*[F.col(c).cast(kind).cast("string") for c in (low, high)]).first() or (None, None)
    limits = [F.lit(v).cast(kind) for v in one]
    kept = df.filter(F.col(column).between(*limits))
    day = f"{column}_day"
    return kept.filter(F.col(day).between(*[F.to_date(v) for v in limits])) if day in df.columns else kept
