"""What a source looks like: shape, NULLs, keys, ranges, codes, gaps, drift.

Per-column statistics are one scan and one row of aggregates, turned into one row per column.
Distinct counts read one column each and combine counts before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.functions.numeric import percentage
from lakestrata.functions.time import hour_of, month_of
from lakestrata.operators.duplicates import duplicate_summary
from lakestrata.sources.files import schema_rows


def _per_column(df: DataFrame, columns: Sequence[str], stats: dict[str, Callable[[str], Column]]) -> DataFrame:
    """One row per column; ``stats`` maps the result name to the aggregate of a column."""
    aggregates = [make(c).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, make in stats.items()]
    one_row = df.agg(F.count(F.lit(1)).alias("row_count"), *aggregates)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("row_count"),
                     *[F.col(f"{name}_{i}").alias(name) for name in stats]) for i, c in enumerate(columns)]
    return one_row.select(F.inline(F.array(*rows)))


def table_shape(df: DataFrame) -> DataFrame:
    """Row count and column count next to every column's name and type."""
    counted = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return schema_rows(df).select("position", "column_name", "data_type", counted.alias("row_count"),
                                  F.lit(len(df.columns)).alias("column_count"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    stats = _per_column(df, columns or df.columns, {"null_count": lambda c: F.count_if(F.col(c).isNull())})
    return stats.withColumn("null_pct", percentage(F.col("null_count"), F.col("row_count")))


def null_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per pattern of missing columns: one digit per column, 1 where it is NULL."""
    digits = [F.col(c).isNull().cast("int").cast("string") for c in columns]
    return df.groupBy(F.concat(*digits).alias("pattern")).agg(F.count(F.lit(1)).alias("row_count"))


def column_uniqueness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values per column and their share of the rows."""
    parts = [duplicate_summary(df.select(c), [c], skip_null=True)
             .select(F.lit(c).alias("column_name"), F.col("records").alias("row_count"),
                     F.col("unique_keys").alias("unique_values")) for c in columns]
    stats = reduce(DataFrame.unionByName, parts)
    return stats.withColumn("unique_pct", percentage(F.col("unique_values"), F.col("row_count")))


def key_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidate key: rows, unique combinations, and the rows that share their key with another row."""
    found = duplicate_summary(df.select(*keys), keys)
    return found.select(F.lit(",".join(keys)).alias("candidate_key"), "records", "unique_keys", "rows_in_duplicates")


def event_order(df: DataFrame, start: str, end: str) -> DataFrame:
    """Earliest and latest start and end, and the rows that end before they start."""
    return df.agg(F.min(start).alias("earliest_start"), F.max(start).alias("latest_start"),
                  F.min(end).alias("earliest_end"), F.max(end).alias("latest_end"),
                  F.count_if(F.col(end) < F.col(start)).alias("end_before_start"))


def sign_profile(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    return _per_column(df, measures, {"negative": lambda c: F.count_if(F.col(c) < 0),
                                      "zero": lambda c: F.count_if(F.col(c) == 0)})


def numeric_ranges(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    return _per_column(df, measures, {"min_value": lambda c: F.min(F.col(c).cast("double")),
                                      "max_value": lambda c: F.max(F.col(c).cast("double"))})


def code_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Observed values of code columns, one row per value, with their rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))


def observation_count(series: DataFrame, time: str, measures: Sequence[str]) -> DataFrame:
    """Hourly series: hours expected over its days against the values present, per column."""
    days = F.datediff(F.max(time), F.min(time)) + 1
    stats = _per_column(series, [time, *measures], {"actual": lambda c: F.count(c), "expected": lambda c: days * 24})
    return stats.select("column_name", F.col("expected").cast("long").alias("expected"), "actual",
                        (F.col("actual") == F.col("expected")).alias("complete"))


def id_gaps(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """Ids of first..last that are missing, and ids present outside it, each with its finding."""
    ids = df.select(F.col(column).cast("long").alias("id")).dropna().distinct()
    expected = df.sparkSession.range(first, last + 1)
    missing = expected.join(ids, "id", "left_anti").withColumn("finding", F.lit("missing"))
    unexpected = ids.filter(~F.col("id").between(first, last)).withColumn("finding", F.lit("unexpected"))
    return missing.unionByName(unexpected)


def repeated_names(df: DataFrame, id_column: str, name_column: str) -> DataFrame:
    """Ids whose name is used by more than one id."""
    pairs = df.select(id_column, name_column).distinct()
    shared = pairs.groupBy(name_column).agg(F.count(F.lit(1)).alias("ids_with_name")).filter("ids_with_name > 1")
    return pairs.join(shared, name_column)


def distribution(df: DataFrame, column: str, total_label: str = "Total") -> DataFrame:
    """Rows per value and a total row."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.unionByName(counts.agg(F.lit(total_label).alias("value"), F.sum("row_count").alias("row_count")))


def out_of_month(df: DataFrame, event_time: str, month_column: str) -> DataFrame:
    """Rows whose event month is not their file month, per pair of months."""
    months = df.select(F.col(month_column).alias("file_month"), month_of(F.col(event_time)).alias("event_month"))
    return (months.filter(F.col("file_month") != F.col("event_month")).groupBy("file_month", "event_month")
            .agg(F.count(F.lit(1)).alias("row_count")))


def hours_covered(series: DataFrame, time: str) -> DataFrame:
    """Distinct hours with data against the hours of the span."""
    per_hour = series.groupBy(hour_of(F.col(time)).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    span = (F.unix_timestamp(F.max("h").cast("timestamp")) - F.unix_timestamp(F.min("h").cast("timestamp"))) / 3600 + 1
    return per_hour.agg(span.cast("long").alias("expected_hours"), F.count(F.lit(1)).alias("hours_with_data"),
                        F.sum("n").alias("row_count"))


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns added, removed or of another type between two tables, e.g. two monthly files."""
    a = schema_rows(left).select("column_name", F.col("data_type").alias("left_type"))
    b = schema_rows(right).select("column_name", F.col("data_type").alias("right_type"))
    change = (F.when(F.col("left_type").isNull(), "added").when(F.col("right_type").isNull(), "removed")
              .when(F.col("left_type") != F.col("right_type"), "changed").otherwise("same"))
    return a.join(b, "column_name", "full_outer").withColumn("change", change)
