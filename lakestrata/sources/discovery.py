"""Which monthly partition to load next, which ones are missing, and the load window of a month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: the month part of landed file names.
MONTH_PATTERN = r"(\d{4}-\d{2})"


def month_in(text: Column) -> Column:
    """The yyyy-MM inside a text, or NULL.

    regexp_extract answers '' when nothing matches; that is turned to NULL so defaults can apply.
    """
    return F.nullif(F.regexp_extract(text, MONTH_PATTERN, 1), F.lit(""))


def landed_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Names of the files in a folder: a listing only, no file content is read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", True).load(folder))
    return files.select("path", "length")


def landed_months(files: DataFrame, column: str = "path") -> DataFrame:
    """Distinct months found in file names."""
    return files.select(month_in(F.element_at(F.split(column, "/"), -1)).alias("month")).dropna().distinct()


def next_partition(months: DataFrame, default: str, column: str = "month") -> DataFrame:
    """One row: the month after the latest loaded one, or ``default`` when nothing is loaded."""
    latest = F.to_date(F.concat(F.max(column), F.lit("-01")))
    return months.agg(F.coalesce(F.date_format(F.add_months(latest, 1), "yyyy-MM"), F.lit(default))
                      .alias("next_month"))


def missing_partitions(candidates: DataFrame, loaded: DataFrame, column: str = "month",
                       force: bool = False) -> DataFrame:
    """Candidate months not loaded yet; all of them when forced."""
    wanted = candidates.select(column).distinct()
    return wanted if force else wanted.join(loaded.select(column), column, "left_anti")


def previous_month(as_of: Column) -> Column:
    return F.date_format(F.add_months(as_of, -1), "yyyy-MM")


def month_window(month: Column) -> tuple[Column, Column]:
    """First and last day of a yyyy-MM month."""
    first = F.to_date(F.concat(month, F.lit("-01")))
    return first, F.last_day(first)
