"""Writes: overwrite, schema-checked creation, partition replacement, layer namespaces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakestrata.session import child_folders, delete_path, new_beside, swap_path

# The layers of the warehouse.
LAYERS = ["bronze", "silver", "gold", "quality"]


def overwrite_path(df: DataFrame, path: str, partition_by: str | None = None, cluster_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table folder; the new schema may differ, and ``df`` may read the folder itself.

    With ``cluster_by`` the rows are range-partitioned and sorted by these columns, so that a filter on the first of them skips the files, row groups
    and pages outside its range (for a time, see ``with_day``).

    The new table is complete beside the old one before it takes its place by renaming, so a write that is cut off
    leaves the old table as it was (and a folder ``__new-...``), and no partition of the old table survives. Two
    renames are not one step: a reader between them finds no table. One writer at a time is assumed.
    """
    fresh = new_beside(path)
    writer = (clustered(df, partition_by, cluster_by) if cluster_by else balanced(df, partition_by)).write
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(fresh)
    swap_path(df.sparkSession, fresh, path)


replace_path = overwrite_path  # by rows that may come from the folder itself


def overwrite_table(df: DataFrame, table: str, partition_by: str | None = None) -> None:
    """Replace a catalog table; the new schema may differ."""
    writer = balanced(df, partition_by).write.mode("overwrite").format("parquet")
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(table)


def append_path(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: str, cluster_by: Sequence[str] = ()) -> None:
    """Replace only the partitions that ``df`` holds rows of; ``cluster_by`` as for ``overwrite_path``."""
    ((clustered(df, partition_by, cluster_by) if cluster_by else balanced(df, partition_by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_by).parquet(path))


def replace_partitions(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts the partition folders of the table at ``fresh`` in the place of those at ``path``, one rename each, and removes the rest of ``fresh``.

    Complete for each partition, not across them: a driver that ends in between leaves the folder ``fresh`` with the partitions that were not moved.
    """
    for folder in child_folders(spark, fresh):
        if "=" in folder:
            swap_path(spark, f"{fresh}/{folder}", f"{path.rstrip('/')}/{folder}")
    delete_path(spark, fresh)
    spark.catalog.refreshByPath(path)


def balanced(df: DataFrame, partition_by: str | None) -> DataFrame:
    """Rows grouped by table partition for few output files; AQE splits a partition that is too large."""
    return df.hint("rebalance", partition_by) if partition_by else df


def with_day(df: DataFrame, time: str) -> DataFrame:
    """``df`` with the day of a time in ``<time>_day``, to cluster by: the reader has no bounds of times (without zone they are not pushed to the files, with
    zone they are stored without statistics), but of dates it has. ``within_bounds`` uses the column where a table has it."""
    return df.withColumn(f"{time}_day", F.to_date(time))


def clustered(df: DataFrame, partition_by: str | None, cluster_by: Sequence[str]) -> DataFrame:
    """Rows in ranges of (table partition and) the columns, sorted within each: every file holds one stretch of values. A sample finds the ranges, so
    a hot value only makes its own range larger."""
    order = [*([partition_by] if partition_by else []), *cluster_by]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def ensure_path(spark: SparkSession, path: str, schema: T.StructType, partition_by: str | None = None) -> DataFrame:
    """The Parquet table at ``path``, created empty unless it is there.

    Stored columns beyond ``schema`` are kept; declared columns that the table lacks read as NULL. A
    column of another type is an error.
    """
    stored = stored_schema(spark, path)
    if stored is None:
        writer = spark.createDataFrame([], schema).write.mode("append")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(joint_schema(schema, stored, partition_by, path)).parquet(path)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """All columns that any file of a Parquet table has, or None if there is no table.

    Reads the footers of all files (as a Spark job), because a column can be younger than most of them.
    """
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except Exception as error:  # the reader reports a missing folder or a folder without files this way
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return None


def joint_schema(declared: T.StructType, stored: T.StructType | None, partition_by: str | None, path: str) -> T.StructType:
    """The declared columns and then the other stored ones; types must agree.

    The partition column takes the declared type: files do not hold it, and Spark only guesses it.
    """
    have = {} if stored is None else {f.name: f for f in stored.fields}
    wrong = [f.name for f in declared.fields if f.name != partition_by and f.name in have and have[f.name].dataType != f.dataType]
    if wrong:
        raise ValueError(f"table at {path} differs from the declared schema in {wrong}")
    names = set(declared.fieldNames())
    return T.StructType([*declared.fields, *(f for n, f in have.items() if n not in names)])


def ensure_namespaces(spark: SparkSession, prefix: str = "", layers: list[str] = LAYERS) -> list[str]:
    """One database per layer, created when missing."""
    names = [f"{prefix}{layer}" for layer in layers]
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    return names
