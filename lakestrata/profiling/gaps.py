"""Missing stretches of a numbered series, without a row for every number that should be there."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lakestrata.session import materialize


def gap_intervals(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """``gap_start, gap_end, missing``: maximal stretches of ``first``..``last`` that no row has, in any order.

    The values are range-partitioned, so each part holds a stretch of its own, and within a part each is compared with the one before. Only the
    smallest and largest value of each part, and the two ends of the range, meet to find the gaps between parts. NULLs and values outside the range do
    not count.
    """
    span = F.col("id").between(first, last)
    ids = df.select(F.col(column).cast("long").alias("id")).filter(span).distinct()
    parts = materialize(ids.repartitionByRange("id").sortWithinPartitions("id").withColumn("part", F.spark_partition_id()), "gap-parts")
    before = F.lag("id").over(Window.partitionBy("part").orderBy("id"))
    inside = parts.select(before.alias("low"), F.col("id").alias("high")).filter("low IS NOT NULL")
    ends = parts.groupBy("part").agg(F.min("id").alias("low"), F.max("id").alias("high")).select("low", "high")
    edge = df.sparkSession.createDataFrame([(first - 1, first - 1), (last + 1, last + 1)], "low long, high long")
    lines = ends.unionByName(edge)  # one row per part
    between = lines.select(F.lag("high").over(Window.orderBy("low")).alias("low"), F.col("low").alias("high"))
    return (inside.unionByName(between).filter("high - low > 1")
            .select((F.col("low") + 1).alias("gap_start"), (F.col("high") - 1).alias("gap_end"), (F.col("high") - F.col("low") - 1).alias("missing")))


def missing_hours(series: DataFrame, time: str) -> DataFrame:
    """``gap_start, gap_end, missing``: stretches of hours without a row, from the first hour of the series to its last."""
    hour = F.unix_micros(F.date_trunc("hour", F.col(time)).cast("timestamp")) / 3_600_000_000
    hours = series.select(F.floor(hour).cast("long").alias("hour")).dropna().distinct()
    low, high = hours.agg(F.min("hour"), F.max("hour")).first()
    if low is None:
        low, high = 0, -1
    gaps = gap_intervals(hours, "hour", low, high)

    def moment(name: str):
        return F.timestamp_seconds(F.col(name) * 3600).cast("timestamp_ntz").alias(name)
    return gaps.select(moment("gap_start"), moment("gap_end"), "missing")
