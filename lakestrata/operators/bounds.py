"""Bounds of a partitioned table, kept beside it: what a load or a range check must know of all partitions, without reading them.

One row per partition folder holds its row count and, for some columns, the smallest and largest value and the number of values. The row also
holds a digest of the folder's file names, which are new with every write. So the kept rows are trusted only for folders whose files are the
same, and only the other folders are read. Rows and digests are as many as the table has partitions; listing the files is what reading the table does
first anyway.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakestrata.operators.writes import overwrite_path
from lakestrata.session import materialize


def bounds_path(path: str) -> str:
    return f"{path.rstrip('/')}__bounds"


def _listing(table: DataFrame) -> dict[str, tuple[str, str]]:
    """Per partition folder its place and the digest of its file names."""
    files = defaultdict(list)
    for file in table.inputFiles():
        files[file.rsplit("/", 1)[0]].append(file.rsplit("/", 1)[1])
    found = {place.rsplit("/", 1)[1]: (unquote(place), hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest())
             for place, names in files.items()}
    if len(found) < len(files):
        raise ValueError("bounds are kept for tables with one partition column")
    return found


def _kept(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(bounds_path(path))
    except Exception as error:  # the reader reports a missing folder or a folder without files this way
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return None


def _measured(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The bounds of the folders that the rows come from."""
    aggregates = [a for c in columns for a in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"), F.count(c).alias(f"values_{c}"))]
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return rows.select(folder.alias("folder"), *columns).groupBy("folder").agg(F.count(F.lit(1)).alias("row_count"), *aggregates)


def partition_bounds(spark: SparkSession, path: str, columns: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """One row per partition folder with rows: ``folder, files, row_count`` and ``low_c, high_c, values_c`` of each column.

    Folders are read only if the kept bounds do not have them as they are, or lack a column. What is found is kept for the next call.
    """
    table = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    now, kept = _listing(table), _kept(spark, path)
    wanted = list(dict.fromkeys(columns))
    if kept is not None:
        have = [f.name.removeprefix("low_") for f in kept.schema.fields if f.name.startswith("low_")]
        types = {f.name: f.dataType for f in table.schema.fields}
        usable = all(c in types and kept.schema[f"low_{c}"].dataType == types[c] for c in have)
        kept = kept if usable and set(wanted) <= set(have) else None
        wanted = list(dict.fromkeys([*(c for c in have if c in types), *wanted]))
    same = {}
    if kept is not None:
        same = {r["folder"]: r for r in kept.select("folder", "files").collect() if now.get(r["folder"], ("", ""))[1] == r["files"]}
    stale = sorted(set(now) - set(same))
    if kept is not None and not stale and len(same) == kept.count():
        return kept
    parts = [] if kept is None else [kept.where(F.col("folder").isin(sorted(same)))]
    if stale or not parts:
        parts.insert(0, _read(spark, path, table.schema, {f: now[f] for f in stale}, wanted) if stale else _nothing(spark, table.schema, wanted))
    order = ["folder", "files", "row_count", *(f"{kind}_{c}" for c in wanted for kind in ("low", "high", "values"))]
    merged = parts[0].select(*order)
    for more in parts[1:]:
        merged = merged.unionByName(more.select(*order))
    overwrite_path(materialize(merged, "bounds").coalesce(1), bounds_path(path))
    return spark.read.parquet(bounds_path(path))


def _read(spark: SparkSession, path: str, schema: T.StructType, folders: dict[str, tuple[str, str]], columns: Sequence[str]) -> DataFrame:
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[place for place, _ in folders.values()])
    digests = spark.createDataFrame([(folder, digest) for folder, (_, digest) in folders.items()], "folder string, files string")
    return _measured(rows, columns).join(digests, "folder")


def _nothing(spark: SparkSession, schema: T.StructType, columns: Sequence[str]) -> DataFrame:
    types = {f.name: f.dataType for f in schema.fields}
    fields = [T.StructField("folder", T.StringType()), T.StructField("files", T.StringType()), T.StructField("row_count", T.LongType())]
    for c in columns:
        fields += [T.StructField(f"low_{c}", types[c]), T.StructField(f"high_{c}", types[c]), T.StructField(f"values_{c}", T.LongType())]
    return spark.createDataFrame([], T.StructType(fields))


def table_ranges(bounds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column over all partitions: ``column_name, row_count, value_count, low, high`` (as text, which any type has)."""
    aggregates = [a for i, c in enumerate(columns) for a in (F.coalesce(F.sum(f"values_{c}"), F.lit(0)).alias(f"n{i}"),
                                                             F.min(f"low_{c}").cast("string").alias(f"a{i}"), F.max(f"high_{c}").cast("string").alias(f"b{i}"))]
    one = bounds.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), *aggregates)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("row_count"), F.col(f"n{i}").alias("value_count"), F.col(f"a{i}").alias("low"),
                     F.col(f"b{i}").alias("high")) for i, c in enumerate(columns)]
    return one.select(F.inline(F.array(*rows)))


def largest(bounds: DataFrame, column: str):
    """The largest value of a column, or None: one number from as many rows as the table has partitions."""
    return bounds.agg(F.max(f"high_{column}")).first()[0]
