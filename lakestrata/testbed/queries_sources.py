"""Scans, writes, ingestion and discovery."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakestrata.operators.bounds import partition_bounds
from lakestrata.operators.journal import Journal
from lakestrata.operators.lookups import within_bounds
from lakestrata.operators.upsert import upsert_partitions
from lakestrata.operators.writes import LAYERS, ensure_namespaces, ensure_path, overwrite_path, overwrite_table, with_day
from lakestrata.plans.bronze import (ingest_array_documents, ingest_overwrite, ingest_partitioned_files,
                                     ingest_reference_csv, ingest_typed_records)
from lakestrata.profiling.profile import schema_diff
from lakestrata.session import materialize, new_path
from lakestrata.sources.discovery import (landed_files, month_in, landed_months, missing_partitions, month_window, next_partition,
                                          previous_month)
from lakestrata.sources.files import (preview, query_path, read_array_documents, read_csv, read_parquet,
                                      read_records, read_records_apart, read_table)
from lakestrata.sources.generated import hour_sequence
from lakestrata.sources.schemas import file_schemas, schema_history
from lakestrata.streaming.incremental import load_new_files
from lakestrata.testbed.registry import query
from lakestrata.testbed.standins import AT, load


@query("scan_lineage", """
SELECT 'orders.parquet' AS source_file, strftime(o_orderdate, '%Y-%m') AS source_month, count(*) AS row_count
FROM orders GROUP BY ALL
""")
def scan_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_parquet(spark, f"{sf_dir}/orders.parquet", file_column="source_file")
    month = F.date_format("o_orderdate", "yyyy-MM").alias("source_month")
    return rows.groupBy("source_file", month).agg(F.count(F.lit(1)).alias("row_count"))


@query("scan_path_sql", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def scan_path_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = query_path(spark, f"{sf_dir}/orders.parquet", "o_orderstatus, o_orderpriority")
    return rows.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("scan_csv_typed", """
SELECT c_custkey, c_name, c_acctbal, c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'N/A' ELSE c_mktsegment END AS segment
FROM customer
""")
def scan_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written CSV read with declared types; the text N/A is not taken for NULL."""
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "N/A").otherwise(F.col("c_mktsegment")).alias("segment")
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey", segment)
    path = new_path(spark, "csv")
    rows.write.option("header", True).csv(path)
    return read_csv(spark, path, rows.schema)


@query("scan_csv_inferred", """
SELECT p_partkey::INTEGER AS p_partkey, p_name, p_size, p_retailprice FROM part
""")
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv")
    load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice").write.option(
        "header", True).csv(path)
    return read_csv(spark, path)


MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_ARRAYS = {"time": "string", "event": "bigint", "reading": "double"}


def _event_documents(spark: SparkSession, sf_dir: str) -> str:
    """Events as documents of parallel arrays, up to 500 events with neighbouring ids in each."""
    events = load(spark, sf_dir, "events")
    entry = F.struct(F.date_format("ts", MICROS).alias("time"),
                     F.col("event_id").alias("event"), F.col("value").alias("reading"))
    docs = events.groupBy(F.floor(F.col("event_id") / 500).alias("doc")).agg(F.collect_list(entry).alias("e"))
    path = new_path(spark, "documents")
    docs.select(F.struct(*[F.col(f"e.{c}").alias(c) for c in _ARRAYS]).alias("hourly")).write.json(path)
    return path


@query("scan_json_arrays", "SELECT event_id AS event, ts, value AS reading FROM events")
def scan_json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of parallel arrays, one row per array position."""
    rows = read_array_documents(spark, _event_documents(spark, sf_dir), "hourly", _ARRAYS)
    return rows.select("event", F.to_timestamp_ntz("time").alias("ts"), "reading")


@query("scan_json_records", """
SELECT event_id, ts, event_type, value, (props->>'k')::BIGINT AS code FROM events
""")
def scan_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with declared types, and a JSON text column opened with a declared type."""
    path = new_path(spark, "records")
    load(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value", "props").write.option(
        "timestampNTZFormat", MICROS).json(path)
    rows = read_records(spark, path, "event_id bigint, ts timestamp_ntz, event_type string, value double, props string")
    return rows.select("event_id", "ts", "event_type", "value",
                       F.from_json("props", T.StructType([T.StructField("k", T.LongType())]))["k"].alias("code"))


@query("scan_rejects", """
SELECT event_id, CASE WHEN event_id % 10 > 1 THEN value END AS value, event_id % 10 <= 1 AS rejected FROM events
""")
def scan_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of which one in ten is cut off and one in ten has text for a number: every line is read or kept apart."""
    line = F.to_json(F.struct("event_id", "value"))
    digit = F.col("event_id") % 10
    spoilt = (F.when(digit == 0, F.expr("substring(line, 1, length(line) - 2)"))
              .when(digit == 1, F.regexp_replace("line", '"value":.*}', '"value":"n/a"}')).otherwise(F.col("line")))
    path = new_path(spark, "records")
    load(spark, sf_dir, "events").select("event_id", line.alias("line")).select(spoilt.alias("value")).write.text(path)
    good, bad = read_records_apart(spark, path, "event_id bigint, value double")
    number = F.regexp_extract("line", '"event_id":([0-9]+)', 1).cast("bigint")
    return (good.withColumn("rejected", F.lit(False))
            .unionByName(bad.select(number.alias("event_id"), F.lit(None).cast("double").alias("value"), F.lit(True).alias("rejected"))))


@query("upsert_missing_column", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, o_orderdate,
       strftime(o_orderdate, '%Y-%m') AS order_month, CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice END AS o_totalprice
FROM orders
""")
def upsert_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load without the price: urgent orders keep the stored one, orders that are new have none."""
    orders = load(spark, sf_dir, "orders").withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))
    path = new_path(spark, "orders")
    stored = orders.filter("o_orderpriority <> '2-HIGH'").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "order_month")
    overwrite_path(stored, path, "order_month")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    batch = (orders.filter("o_orderpriority IN ('1-URGENT', '2-HIGH')").withColumn("o_custkey", urgent)
             .select("o_orderkey", "o_custkey", "o_orderdate", "order_month"))
    ensure_path(spark, path, batch.schema, "order_month")
    return upsert_partitions(spark, path, batch, ["o_orderkey", "order_month"], "order_month")


@query("partition_bounds", """
SELECT strftime(o_orderdate, '%Y-%m') AS order_month, count(*) AS row_count, min(o_orderkey) AS low_key, max(o_orderkey) AS high_key,
       min(o_orderdate) AS low_date, max(o_orderdate) AS high_date, min(price) AS low_price, max(price) AS high_price, count(price) AS prices
FROM (SELECT *, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END END AS price FROM orders)
GROUP BY ALL
""")
def partition_bounds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of each month from what is kept beside the table, after one load of some rows and one that rewrites their months."""
    orders = load(spark, sf_dir, "orders").withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))
    price = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice"))
    path, columns = new_path(spark, "orders"), ["o_orderkey", "o_orderdate", "price"]
    rows = orders.select("o_orderkey", "o_orderdate", price.alias("price"), "order_month")
    overwrite_path(rows.filter("month(o_orderdate) % 2 = 0 OR o_orderkey % 3 <> 0"), path, "order_month")
    partition_bounds(spark, path, columns)
    dearer = rows.filter("o_orderkey % 3 = 0").withColumn("price", F.col("price") + 1)
    upsert_partitions(spark, path, dearer, ["o_orderkey", "order_month"], "order_month")
    bounds = partition_bounds(spark, path, columns)
    return bounds.select(F.substring("folder", -7, 7).alias("order_month"), "row_count", F.col("low_o_orderkey").alias("low_key"),
                         F.col("high_o_orderkey").alias("high_key"), F.col("low_o_orderdate").alias("low_date"),
                         F.col("high_o_orderdate").alias("high_date"), "low_price", "high_price", F.col("values_price").alias("prices"))


@query("partition_keys", """
WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS order_month, year(o_orderdate) AS y FROM orders),
n AS (SELECT *, CASE WHEN y <= 1996 THEN row_number() OVER (PARTITION BY y <= 1996 ORDER BY order_month, o_orderkey)
                     ELSE (SELECT count(*) FROM o WHERE y <= 1996) + row_number() OVER (PARTITION BY y <= 1996 ORDER BY order_month, o_orderkey) END AS n FROM o)
SELECT n AS order_number, o_orderkey, order_month, CASE WHEN y IN (1996, 1997) THEN 'second' WHEN y < 1996 THEN 'first' ELSE 'third' END AS loaded_by FROM n
""")
def partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate keys over loads of months: known rows keep theirs, new ones go on after the largest number kept in the bounds."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("order_month"), F.year("o_orderdate").alias("y"))
    path, keys = new_path(spark, "orders"), ["o_orderkey", "order_month"]
    loads = [("first", "y <= 1996"), ("second", "y = 1996 OR y = 1997"), ("third", "y > 1997")]
    for k, (name, where) in enumerate(loads):
        rows = orders.filter(where).select(*keys, F.lit(name).alias("loaded_by"))
        if not k:
            ensure_path(spark, path, T.StructType([T.StructField("order_number", T.LongType()), *rows.schema.fields]), "order_month")
        order = ["order_month", "o_orderkey"]
        stored = upsert_partitions(spark, path, rows, keys, "order_month", key="order_number", order_by=order)
    return stored.select("order_number", *keys, "loaded_by")


@query("catalog_tables", "\nUNION ALL ".join(
    f"SELECT '{layer}' AS layer, c_custkey, c_name, c_acctbal < 0 AS in_debt FROM customer WHERE c_custkey % 4 = {k}"
    for k, layer in enumerate(LAYERS)))
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One namespace per layer; its table written, replaced with one more column, and read by name."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    prefix = f"t{uuid.uuid4().hex[:10]}_"
    parts = []
    for k, namespace in enumerate(ensure_namespaces(spark, prefix)):
        own, name = customer.filter(F.col("c_custkey") % 4 == k), f"{namespace}.customer"
        overwrite_table(own.drop("c_acctbal"), name)
        overwrite_table(own.withColumn("in_debt", F.col("c_acctbal") < 0), name)
        parts.append(read_table(spark, name).drop("c_acctbal").withColumn("layer", F.lit(namespace.removeprefix(prefix))))
    return reduce(DataFrame.unionByName, parts)


@query("landed_months", """
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS "month",
       (SELECT strftime(max(o_orderdate) + INTERVAL 1 MONTH, '%Y-%m') FROM orders) AS next_month
FROM orders
""")
def landed_months_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of landed files by listing them (here by their folder), and the month to load next."""
    landed = new_path(spark, "landing")
    orders = load(spark, sf_dir, "orders")
    orders.withColumn("landed", F.date_format("o_orderdate", "yyyy-MM")).repartition("landed").write.partitionBy("landed").parquet(landed)
    folders = landed_files(spark, landed).withColumn("path", F.element_at(F.split("path", "/"), -2))
    months = landed_months(folders)
    return months.withColumn("next_month", next_partition(months, "2026-03").select("next_month").scalar())


@query("write_roundtrip", """
SELECT c_custkey, c_name, c_acctbal, c_acctbal < 0 AS in_debt FROM customer
""")
def write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared table, overwrite, overwrite with one more column; all rows read back."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = new_path(spark, "table")
    ensure_path(spark, path, customer.schema)
    overwrite_path(customer, path)
    ensure_path(spark, path, customer.schema)
    overwrite_path(customer.withColumn("in_debt", F.col("c_acctbal") < 0), path)
    return spark.read.parquet(path)


@query("schema_and_preview", """
SELECT p.*, (SELECT count(*) FROM customer) AS all_rows
FROM (SELECT count(*) AS previewed FROM (SELECT * FROM customer LIMIT 20)) p
""")
def schema_and_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    shown = preview(customer, 20).agg(F.count(F.lit(1)).alias("previewed"))
    return shown.select("previewed", customer.agg(F.count(F.lit(1)).alias("n")).scalar().alias("all_rows"))


@query("ingest_files", """
SELECT *, strftime(o_orderdate, '%Y-%m') AS source_month, true AS has_file, true AS has_audit FROM orders
""")
def ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries upserted into Bronze: finished orders without price, then all orders, twice."""
    orders = load(spark, sf_dir, "orders")
    first, second, table = new_path(spark, "landing"), new_path(spark, "landing"), new_path(spark, "bronze")
    (orders.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.lit(0.0))
     .write.parquet(first))
    orders.unionByName(orders).write.parquet(second)
    for landed in (first, second):
        bronze = ingest_partitioned_files(spark, landed, table, "o_orderdate", ["o_orderkey", "o_orderdate"], at=AT)
    audit = ["bronze_ingestion_timestamp", "bronze_ingestion_date"]
    return (bronze.withColumns({"has_file": F.col("source_file").like("%.parquet"),
                                "has_audit": F.col(audit[0]).isNotNull() & F.col(audit[1]).isNotNull()})
            .drop("source_file", *audit))


@query("ingest_overwrite", """
SELECT *, strftime(o_orderdate, '%Y-%m') AS source_month, true AS has_audit FROM orders
UNION ALL SELECT *, strftime(o_orderdate, '%Y-%m'), true FROM orders
""")
def ingest_overwrite_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overwrite load keeps every landed row; loading again replaces, it does not add."""
    orders = load(spark, sf_dir, "orders")
    landed, table = new_path(spark, "landing"), new_path(spark, "bronze")
    orders.unionByName(orders).write.parquet(landed)
    ingest_overwrite(spark, landed, table, "o_orderdate", at=AT)
    bronze = ingest_overwrite(spark, landed, table, "o_orderdate", at=AT)
    audit = ["source_file", "bronze_ingestion_timestamp", "bronze_ingestion_date"]
    stamped = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in audit])
    return bronze.withColumn("has_audit", stamped).drop(*audit)


@query("ingest_reference", """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, true AS has_audit FROM customer
""")
def ingest_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, table = new_path(spark, "csv"), new_path(spark, "bronze")
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    rows.write.option("header", True).csv(path)
    bronze = ingest_reference_csv(spark, path, table, rows.schema, at=AT)
    return bronze.select(*rows.columns, F.col("bronze_ingestion_timestamp").isNotNull().alias("has_audit"))


@query("ingest_series", "SELECT event_id AS event, ts AS moment, value AS reading, 'events.json' AS source_file FROM events")
def ingest_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = ingest_array_documents(spark, _event_documents(spark, sf_dir), new_path(spark, "bronze"), "hourly", _ARRAYS,
                                    "time", "moment", "events.json", at=AT)
    return bronze.select("event", "moment", "reading", "source_file")


@query("ingest_records", "SELECT event_id, ts, value, 'api' AS source_file FROM events")
def ingest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records merged by primary key: a first pull with old values, then the whole series."""
    events = load(spark, sf_dir, "events").select("event_id", "ts", "value")
    old, new = new_path(spark, "records"), new_path(spark, "records")
    events.filter(F.col("value") < 20).withColumn("value", -F.col("value")).write.option(
        "timestampNTZFormat", MICROS).json(old)
    events.write.option("timestampNTZFormat", MICROS).json(new)
    merged = ingest_typed_records(spark, old, None, events.schema, "event_id", "api", AT)
    merged = ingest_typed_records(spark, new, materialize(merged, "target"), events.schema, "event_id", "api", AT)
    return merged.select("event_id", "ts", "value", "source_file")


@query("stream_ingest", """
SELECT *, strftime(o_orderdate, '%Y-%m') AS source_month, true AS has_file FROM orders
""")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files landing in two steps, each loaded by a stream that takes what is new and stops."""
    orders = load(spark, sf_dir, "orders")
    landed, table, checkpoint = (new_path(spark, n) for n in ("landing", "bronze", "checkpoint"))
    args = (spark, landed, table, checkpoint, orders.schema, "o_orderdate", ["o_orderkey", "o_orderdate"], AT)
    orders.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.lit(0.0)).write.parquet(landed)
    load_new_files(*args)
    orders.write.mode("append").parquet(landed)
    bronze = load_new_files(*args)
    return (bronze.withColumn("has_file", F.col("source_file").like("%.parquet"))
            .drop("source_file", "bronze_ingestion_timestamp", "bronze_ingestion_date"))


def _order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))


@query("next_partition", """
SELECT strftime(max(o_orderdate) + INTERVAL 1 MONTH, '%Y-%m') AS next_month, '2026-03' AS next_when_empty FROM orders
""")
def next_partition_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = _order_months(spark, sf_dir)
    empty = next_partition(months.filter(F.col("month").isNull()), "2026-03")
    return next_partition(months, "2026-03").select(
        "next_month", empty.select("next_month").scalar().alias("next_when_empty"))


@query("missing_partitions", """
WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS "month", 'not loaded' AS why FROM orders
           WHERE strftime(o_orderdate, '%Y-%m') NOT IN (SELECT strftime(l_shipdate + INTERVAL 6 MONTH, '%Y-%m') FROM lineitem)),
forced AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS "month", 'forced' AS why FROM orders)
SELECT * FROM m UNION ALL SELECT * FROM forced
""")
def missing_partitions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order months against the months half a year after a shipment (the first months lack); and all of them when forced."""
    wanted = _order_months(spark, sf_dir)
    shipped = F.add_months(F.col("l_shipdate").cast("date"), 6)
    loaded = load(spark, sf_dir, "lineitem").select(F.date_format(shipped, "yyyy-MM").alias("month")).distinct()
    return (missing_partitions(wanted, loaded).withColumn("why", F.lit("not loaded"))
            .unionByName(missing_partitions(wanted, loaded, force=True).withColumn("why", F.lit("forced"))))


@query("prev_month_window", """
WITH d AS (SELECT DISTINCT o_orderdate::DATE AS as_of FROM orders)
SELECT as_of, strftime(as_of - INTERVAL 1 MONTH, '%Y-%m') AS previous_month,
       (date_trunc('month', as_of) - INTERVAL 1 MONTH)::DATE AS first_day,
       (date_trunc('month', as_of) - INTERVAL 1 DAY)::DATE AS last_day
FROM d
""")
def prev_month_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = load(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("as_of")).distinct()
    first, last = month_window(F.col("previous_month"))
    return days.withColumn("previous_month", previous_month(F.col("as_of"))).withColumns(
        {"first_day": first, "last_day": last})


@query("hour_rows", """
WITH b AS (SELECT event_type, date_trunc('hour', min(ts)) AS first, date_trunc('hour', max(ts)) AS last
           FROM events GROUP BY event_type)
SELECT event_type, unnest(generate_series(first, last, INTERVAL 1 HOUR)) AS full_datetime FROM b
""")
def hour_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours between the first and last event of each type, as generated rows."""
    hour = lambda c: F.date_trunc("hour", c).cast("timestamp_ntz")
    bounds = load(spark, sf_dir, "events").groupBy("event_type").agg(
        hour(F.min("ts")).alias("first"), hour(F.max("ts")).alias("last"))
    return hour_sequence(bounds, "first", "last", keep=["event_type"])


@query("schema_diff", """
SELECT * FROM (VALUES ('o_orderkey', 'bigint', 'bigint', 'same'), ('o_custkey', 'bigint', 'string', 'changed'),
  ('o_orderstatus', 'string', NULL, 'removed'), ('o_totalprice', 'double', 'double', 'same'),
  ('o_orderdate', 'timestamp_ntz', 'timestamp_ntz', 'same'), ('o_orderpriority', 'string', 'string', 'same'),
  ('source_month', NULL, 'string', 'added')) v(column_name, left_type, right_type, change)
""")
def schema_diff_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two monthly files of different layout, as landed."""
    orders = load(spark, sf_dir, "orders")
    path = new_path(spark, "landing")
    (orders.drop("o_orderstatus").withColumn("o_custkey", F.col("o_custkey").cast("string"))
     .withColumn("source_month", F.date_format("o_orderdate", "yyyy-MM")).write.parquet(path))
    return schema_diff(orders, read_parquet(spark, path))


@query("schema_history", """
WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS m FROM orders),
f AS (SELECT DISTINCT m FROM o),
c AS (SELECT m, unnest([{'n': 'o_orderkey', 't': 'bigint'},
                        {'n': 'o_custkey', 't': CASE WHEN m < '1997-01' THEN 'int' ELSE 'bigint' END},
                        {'n': CASE WHEN m < '1998-01' THEN 'o_orderstatus' END, 't': 'string'},
                        {'n': CASE WHEN m >= '1996-01' THEN 'o_totalprice' END, 't': 'double'},
                        {'n': 'o_orderdate', 't': 'timestamp_ntz'},
                        {'n': CASE WHEN m >= '1996-01' AND m < '1998-01' THEN 'o_orderpriority' END, 't': 'string'}]) AS s FROM f)
SELECT s.n AS column_name, s.t AS data_type, min(m) AS first_month, max(m) AS last_month, count(*) AS files,
       CASE s.n WHEN 'o_custkey' THEN 'type changed' WHEN 'o_orderstatus' THEN 'dropped' WHEN 'o_totalprice' THEN 'added'
                WHEN 'o_orderpriority' THEN 'added, dropped' ELSE 'same' END AS finding
FROM c WHERE s.n IS NOT NULL GROUP BY s.n, s.t
""")
def schema_history_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed monthly files of four layouts: a column widened, one dropped, one added, one added and dropped; from the footers of all files."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    month, landed = F.date_format("o_orderdate", "yyyy-MM"), new_path(spark, "landing")
    wide, narrow = F.col("o_custkey").cast("bigint"), F.col("o_custkey").cast("int")
    layouts = [("0000", "1996-01", orders.withColumn("o_custkey", narrow).drop("o_totalprice", "o_orderpriority")),
               ("1996-01", "1997-01", orders.withColumn("o_custkey", narrow)), ("1997-01", "1998-01", orders.withColumn("o_custkey", wide)),
               ("1998-01", "9999", orders.withColumn("o_custkey", wide).drop("o_orderstatus", "o_orderpriority"))]
    for first, last, rows in layouts:
        of = rows.withColumn("landed", month).filter((F.col("landed") >= first) & (F.col("landed") < last))
        of.repartition("landed").write.mode("append").partitionBy("landed").parquet(landed)
    schemas = file_schemas(spark, landed_files(spark, landed))
    return schema_history(schemas.withColumn("month", month_in(F.element_at(F.split("path", "/"), -2))))


@query("load_journal", """
SELECT 'orders-' || year(o_orderdate) AS batch, count(DISTINCT strftime(o_orderdate, '%Y-%m')) AS months, min(strftime(o_orderdate, '%Y-%m')) AS first_month,
       max(strftime(o_orderdate, '%Y-%m')) AS last_month, count(*) AS orders_stored, 1::BIGINT AS times_written
FROM orders GROUP BY year(o_orderdate)
""")
def load_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders delivered by year, each delivery twice: the journal has every batch once, with the months it changed, and they hold its orders."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.date_format("o_orderdate", "yyyy-MM").alias("order_month"))
    path, journal, written = new_path(spark, "orders"), Journal(spark, new_path(spark, "journal")), []
    ensure_path(spark, path, orders.schema, "order_month")
    years = [r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect()]
    for year in sorted(years) * 2:
        def put(touched, year=year):
            upsert_partitions(spark, path, orders.filter(F.year("o_orderdate") == year), ["o_orderkey", "order_month"], "order_month", touched=touched)
        if journal.once(f"orders-{year}", "orders", put, AT):
            written.append((f"orders-{year}",))
    times = spark.createDataFrame(written, "batch string").groupBy("batch").agg(F.count(F.lit(1)).alias("times_written"))
    stored = spark.read.schema(orders.schema).parquet(path).groupBy(F.col("order_month").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return (journal.entries().join(stored, "part").groupBy("batch")
            .agg(F.count(F.lit(1)).alias("months"), F.min("part").alias("first_month"), F.max("part").alias("last_month"), F.sum("n").alias("orders_stored"))
            .join(times, "batch"))


@query("clustered_window", """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= (SELECT min(o_orderdate) + INTERVAL 400 DAY FROM orders) AND o_orderdate < (SELECT min(o_orderdate) + INTERVAL 407 DAY FROM orders)
""")
def clustered_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one week, from a table written in order of their dates: its bounds skip all other files and pages."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    path = new_path(spark, "clustered")
    overwrite_path(with_day(orders, "o_orderdate"), path, cluster_by=["o_orderdate_day", "o_orderdate"])
    stored = spark.read.parquet(path)
    first = stored.agg(F.min("o_orderdate").alias("first"))
    week = first.select((F.col("first") + F.expr("INTERVAL 400 DAYS")).alias("low"),
                        (F.col("first") + F.expr("INTERVAL 407 DAYS") - F.expr("INTERVAL 0.000001 SECONDS")).alias("high"))
    return within_bounds(stored, "o_orderdate", week, "low", "high").drop("o_orderdate_day")
