"""How the layout of files changes over months: the schema in every file's footer, merged into one history."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import from_arrow_type

from lakestrata.sources.files import schema_rows

ROWS = "path string, position int, column_name string, data_type string"


def _type_name(kind: pa.DataType) -> str:
    try:
        return from_arrow_type(kind, prefer_timestamp_ntz=True).simpleString()
    except Exception:  # a type that Spark has no name for is shown by its own
        return str(kind)


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path in batch.column("path").to_pylist():
            files, place = _open(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
            with files.open_input_file(place) as file:
                rows += [(path, i, f.name, _type_name(f.type)) for i, f in enumerate(pq.read_schema(file))]
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        yield pa.record_batch([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()),
                               pa.array(columns[3], pa.string())], names=["path", "position", "column_name", "data_type"])


def file_schemas(spark: SparkSession, files: DataFrame, in_tasks: bool = True) -> DataFrame:
    """``path, position, column_name, data_type`` of every file in ``files`` (column ``path``).

    Footers are read in tasks, a few KB of each file. ``in_tasks=False`` asks Spark's own reader for one file after the other, for stores that only
    Spark can open.
    """
    if in_tasks:
        return files.select("path").mapInArrow(_footers, ROWS)
    rows = []
    for (path,) in files.select("path").collect():
        rows += [(path, r["position"], r["column_name"], r["data_type"]) for r in schema_rows(spark.read.parquet(path)).collect()]
    return spark.createDataFrame(rows, ROWS)


def schema_history(schemas: DataFrame, month: str = "month") -> DataFrame:
    """``column_name, data_type, first_month, last_month, files, finding``: one row per column and type.

    ``schemas`` has the month of each file. A column of several types has 'type changed'; else one that the first or last month lacks 'added' or
    'dropped' (or 'added, dropped'), one that a month between lacks in some file 'missing in between', and 'same' the others.
    """
    span = schemas.agg(F.min(month).alias("low"), F.max(month).alias("high"), F.count_distinct("path").alias("all_files"))
    pairs = schemas.groupBy("column_name", "data_type").agg(F.min(month).alias("first_month"), F.max(month).alias("last_month"),
                                                            F.count_distinct("path").alias("files"))
    types = pairs.groupBy("column_name").agg(F.count(F.lit(1)).alias("types"))
    added, dropped = F.col("first_month") > span.select("low").scalar(), F.col("last_month") < span.select("high").scalar()
    finding = (F.when(F.col("types") > 1, "type changed").when(added & dropped, "added, dropped").when(added, "added").when(dropped, "dropped")
               .when(F.col("files") < span.select("all_files").scalar(), "missing in between").otherwise("same"))
    return pairs.join(types, "column_name").select("column_name", "data_type", "first_month", "last_month", "files", finding.alias("finding"))
