"""File scans. Every reader takes an explicit schema where the format does not carry one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                 file_column: str | None = None, path_column: str | None = None) -> DataFrame:
    """Parquet files of a folder or glob, optionally with the name or path of the file of each row.

    A given schema skips footer inference, which matters when the glob matches very many files.
    """
    paths = [path] if isinstance(path, str) else path
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(*paths)
    extra = []
    if file_column:
        extra.append(F.col("_metadata.file_name").alias(file_column))
    if path_column:
        extra.append(F.col("_metadata.file_path").alias(path_column))
    return df.select("*", *extra) if extra else df


def query_path(spark: SparkSession, path: str, select: str = "*") -> DataFrame:
    """SQL over a Parquet path used as a table."""
    return spark.sql(f"SELECT {select} FROM parquet.`{path}`")


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or the Parquet table in a folder."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. No text stands for NULL, so a literal N/A stays the text N/A.

    A given schema is matched by name, whatever the order of the header; a missing column or a value
    that is not of its type is an error, columns beyond the schema are left out. Without a schema the
    types are inferred, which reads the files one extra time. Malformed lines are an error.
    """
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    texts = reader.csv(path)
    missing = [f.name for f in wanted.fields if f.name not in texts.columns]
    if missing:
        raise ValueError(f"CSV at {path} has no columns {missing}")
    return texts.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted.fields])


def read_array_documents(spark: SparkSession, path: str, field: str, columns: dict[str, str],
                         multi_line: bool = False) -> DataFrame:
    """JSON documents that hold one array per column under ``field``; one row per array position.

    ``columns`` maps array name to element type. Each document is unpacked where it is read. A document
    that cannot be parsed is an error, so none is lost unnoticed.
    """
    arrays = T.StructType([T.StructField(n, T.ArrayType(T.DataType.fromDDL(t)))
                           for n, t in columns.items()])
    schema = T.StructType([T.StructField(field, arrays)])
    docs = spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    zipped = F.arrays_zip(*[F.col(f"{field}.{n}").alias(n) for n in columns])
    return docs.select(F.inline(zipped))


def read_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with declared column types; a line that does not fit is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_records_apart(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """JSON lines as two tables: records that fit the schema, and the text of the lines that do not.

    Both read the files; nothing is dropped: every line is in one of them.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.read.text(path).filter(F.trim("value") != "")
    with_reject = T.StructType([*wanted.fields, T.StructField("_reject", T.StringType())])
    parsed = lines.select(F.from_json("value", with_reject, {"columnNameOfCorruptRecord": "_reject"}).alias("r"))
    return (parsed.filter(F.col("r._reject").isNull()).select("r.*").drop("_reject"),
            parsed.filter(F.col("r._reject").isNotNull()).select(F.col("r._reject").alias("line")))


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    return df.limit(rows)


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema of ``df`` as rows (position, column name, type, nullable)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean")
