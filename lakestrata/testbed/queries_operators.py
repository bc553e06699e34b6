"""Predicates, functions, aggregates, set operations, sorts, dedupe, upsert, surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakestrata.functions import time as clock
from lakestrata.functions.codes import WEATHER_CODES, describe
from lakestrata.functions.numeric import mean, mean_ratio, percentage, ratio, settled_round
from lakestrata.functions.text import folded, is_blank, is_untrimmed, piped_key, title_trim, trimmed_or
from lakestrata.operators.bucketed import upsert_bucketed, write_bucketed
from lakestrata.operators.dedupe import keep_one
from lakestrata.operators.duplicates import duplicate_summary, exact_duplicate_summary
from lakestrata.operators.hot import split_lookup
from lakestrata.operators.keys import assign_missing_keys, number_rows
from lakestrata.operators.lookups import lookup, orphan_counts, reconcile, within_bounds
from lakestrata.operators.ranking import label_positions, listed_order, share_of_total, top_k
from lakestrata.operators.upsert import upsert
from lakestrata.session import materialize, new_path
from lakestrata.sources.discovery import month_in
from lakestrata.sources.generated import literal_row
from lakestrata.testbed.registry import query
from lakestrata.testbed.sql import TITLE, pct, settled
from lakestrata.testbed.standins import load

N = lambda: F.count(F.lit(1))


@query("predicates_grid", """
WITH c AS (SELECT c_custkey, c_name, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS seg,
                  nullif(c_nationkey, 0) AS nation, nullif(c_nationkey % 5, 0) AS other
           FROM customer)
SELECT c_custkey, seg IN ('MACHINERY', 'FURNITURE') AS is_in, seg NOT IN ('MACHINERY') AS is_not_in,
       c_name LIKE '%7_' AS is_like, nation IS NOT DISTINCT FROM other AS null_safe_equal, nation = other AS plain_equal,
       seg <> 'MACHINERY' AS differs, c_acctbal BETWEEN 0 AND 1000.5 AS in_range,
       (seg IS NULL AND NOT c_acctbal < 0) OR nation > 20 AS combined
FROM c
""")
def predicates_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set membership, patterns, null-safe and plain equality, ranges and their combinations, with NULLs."""
    rows = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"),
        F.nullif("c_nationkey", F.lit(0)).alias("nation"), F.nullif(F.col("c_nationkey") % 5, F.lit(0)).alias("other"))
    seg, nation, other, balance = F.col("seg"), F.col("nation"), F.col("other"), F.col("c_acctbal")
    return rows.select(
        "c_custkey", seg.isin("MACHINERY", "FURNITURE").alias("is_in"), (~seg.isin("MACHINERY")).alias("is_not_in"),
        F.col("c_name").like("%7_").alias("is_like"), nation.eqNullSafe(other).alias("null_safe_equal"),
        (nation == other).alias("plain_equal"), (seg != "MACHINERY").alias("differs"),
        balance.between(0, 1000.5).alias("in_range"),
        ((seg.isNull() & ~(balance < 0)) | (nation > 20)).alias("combined"))


@query("scalar_text", f"""
WITH c AS (SELECT c_custkey, '  ' || c_mktsegment || CASE WHEN c_nationkey = 3 THEN '' ELSE ' x' END AS t,
                  CASE WHEN c_nationkey = 4 THEN ' ' END AS maybe, c_name FROM customer)
SELECT c_custkey, trim(t) AS trimmed, {TITLE.format('t')} AS titled, upper(trim(t)) AS folded,
       t <> trim(t) AS untrimmed, maybe IS NULL OR trim(maybe) = '' AS blank, trim(coalesce(maybe, 'Unknown')) AS filled,
       coalesce(maybe, '') || '|' || c_custkey::VARCHAR AS piped, c_name || '%' AS labelled,
       nullif(regexp_extract(c_name || '_2026-0' || (c_custkey % 9 + 1)::VARCHAR, '(\\d{{4}}-\\d{{2}})', 1), '')
         AS month_found,
       nullif(regexp_extract(c_name, '(\\d{{4}}-\\d{{2}})', 1), '') AS month_missing,
       try_cast(maybe || '7' AS INTEGER) AS cast_number, try_cast(c_name AS INTEGER) AS cast_failed
FROM c
""")
def scalar_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    rows = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_name",
        F.concat(F.lit("  "), "c_mktsegment", F.when(nation == 3, "").otherwise(" x")).alias("t"),
        F.when(nation == 4, " ").alias("maybe"))
    t, maybe, name = F.col("t"), F.col("maybe"), F.col("c_name")
    file_name = F.concat(name, F.lit("_2026-0"), (F.col("c_custkey") % 9 + 1).cast("string"))
    return rows.select(
        "c_custkey", F.trim(t).alias("trimmed"), title_trim(t).alias("titled"), folded(t).alias("folded"),
        is_untrimmed(t).alias("untrimmed"), is_blank(maybe).alias("blank"), trimmed_or(maybe, "Unknown").alias("filled"),
        piped_key(maybe, F.col("c_custkey")).alias("piped"), F.concat(name, F.lit("%")).alias("labelled"),
        month_in(file_name).alias("month_found"), month_in(name).alias("month_missing"),
        F.concat(maybe, F.lit("7")).try_cast("int").alias("cast_number"), name.try_cast("int").alias("cast_failed"))


@query("scalar_time", """
SELECT event_id, date_trunc('hour', ts) AS hour_start, strftime(ts, '%Y-%m') AS month_label,
       strftime(ts, '%A') AS day_name, strftime(ts, '%I %p') AS hour_label, strftime(ts, '%B') AS month_name,
       day(ts)::INTEGER AS "day", hour(ts)::INTEGER AS "hour", month(ts)::INTEGER AS "month",
       quarter(ts)::INTEGER AS "quarter", year(ts)::INTEGER AS "year", week(ts)::INTEGER AS week_of_year,
       dayofweek(ts)::INTEGER + 1 AS day_of_week, ts::DATE AS "date",
       CASE WHEN hour(ts) BETWEEN 5 AND 11 THEN 'Morning' WHEN hour(ts) BETWEEN 12 AND 16 THEN 'Afternoon'
            WHEN hour(ts) BETWEEN 17 AND 21 THEN 'Evening' ELSE 'Night' END AS day_part,
       CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) IN (3, 4, 5) THEN 'Spring'
            WHEN month(ts) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
       ts >= TIMESTAMP '2024-01-15' AND ts::DATE <= DATE '2024-01-20' AS in_window,
       strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed,
       CAST(round(CAST((epoch(date_trunc('second', ts)) - epoch(date_trunc('hour', ts))) / 60 AS DECIMAL(18,8)), 2)
            AS DOUBLE) AS minutes_into_hour
FROM events
""")
def scalar_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events").select("event_id", "ts")
    t = F.col("ts")
    return rows.select(
        "event_id", clock.hour_of(t).alias("hour_start"), clock.month_of(t).alias("month_label"),
        F.date_format(t, "EEEE").alias("day_name"), F.date_format(t, "hh a").alias("hour_label"),
        F.date_format(t, "MMMM").alias("month_name"), F.dayofmonth(t).alias("day"), F.hour(t).alias("hour"),
        F.month(t).alias("month"), F.quarter(t).alias("quarter"), F.year(t).alias("year"),
        F.weekofyear(t).alias("week_of_year"), F.dayofweek(t).alias("day_of_week"), F.to_date(t).alias("date"),
        clock.day_part(F.hour(t)).alias("day_part"), clock.season(F.month(t)).alias("season"),
        ((t >= F.lit("2024-01-15").cast("timestamp_ntz")) & (t.cast("date") <= F.lit("2024-01-20").cast("date")))
        .alias("in_window"),
        F.to_timestamp_ntz(F.date_format(t, "yyyy-MM-dd HH:mm:ss")).alias("parsed"),
        clock.minutes_between(clock.hour_of(t), t).alias("minutes_into_hour"))


_CODE_SQL = " ".join(f"WHEN {c} THEN '{n}'" for c, n in WEATHER_CODES.items())


@query("scalar_misc", f"""
WITH e AS (SELECT event_id, value, (props->>'k')::INTEGER AS k FROM events)
SELECT event_id, k AS code, CASE k {_CODE_SQL} ELSE 'Unknown' END AS code_text, abs(value - 50) AS deviation,
       {settled('value / 3')} AS rounded, value / nullif(k, 0) AS guarded_ratio, {pct('value', 'k')} AS percentage,
       coalesce(nullif(k, 0), -1) AS defaulted
FROM e
""")
def scalar_misc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events").select(
        "event_id", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    k, value = F.col("k"), F.col("value")
    return rows.select(
        "event_id", k.alias("code"), describe(k, WEATHER_CODES).alias("code_text"), F.abs(value - 50).alias("deviation"),
        settled_round(value / 3, 2).alias("rounded"), ratio(value, k).alias("guarded_ratio"),
        percentage(value, k).alias("percentage"), F.coalesce(F.nullif(k, F.lit(0)), F.lit(-1)).alias("defaulted"))


@query("set_ops", """
WITH u AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
           UNION ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
           UNION ALL SELECT -1, 'Unknown')
SELECT 'bag' AS form, o_custkey, count(*) AS n FROM u GROUP BY o_custkey
UNION ALL SELECT 'distinct', o_custkey, count(*) FROM (SELECT DISTINCT * FROM u) GROUP BY o_custkey
""")
def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    columns = ["o_custkey", "o_orderstatus"]
    unknown = literal_row(spark, o_custkey=F.lit(-1).cast("long"), o_orderstatus=F.lit("Unknown"))
    bag = (orders.filter(F.col("o_orderstatus") == "F").select(*columns)
           .unionByName(orders.filter(F.col("o_orderpriority") == "1-URGENT").select(*columns)).unionByName(unknown))

    def per_customer(rows: DataFrame, form: str) -> DataFrame:
        return rows.groupBy("o_custkey").agg(N().alias("n")).withColumn("form", F.lit(form))

    return per_customer(bag, "bag").unionByName(per_customer(bag.distinct(), "distinct"))


@query("agg_basics", f"""
SELECT l_returnflag, l_linestatus, year(l_shipdate)::INTEGER AS ship_year, count(*) AS rows_all,
       count(nullif(l_linenumber, 7)) AS rows_not_null, {settled('avg(l_quantity)')} AS avg_quantity,
       {settled('sum(l_extendedprice)')} AS total_price, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
       count(*) FILTER (WHERE l_discount > 0.05) AS discounted,
       sum(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END)::BIGINT AS untaxed,
       {settled('avg(CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity END)')} AS avg_unit_price
FROM lineitem GROUP BY ALL
""")
def agg_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    return lines.groupBy("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("ship_year")).agg(
        N().alias("rows_all"), F.count(F.nullif("l_linenumber", F.lit(7))).alias("rows_not_null"),
        mean(F.col("l_quantity")).alias("avg_quantity"), settled_round(F.sum("l_extendedprice"), 2).alias("total_price"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        F.sum(F.when(F.col("l_tax") == 0, 1).otherwise(0)).alias("untaxed"),
        mean_ratio(F.col("l_extendedprice"), F.col("l_quantity")).alias("avg_unit_price"))


@query("agg_distinct", """
SELECT 'scalar' AS form, count(*) AS records, count(DISTINCT nullif(l_linenumber, 7)) AS distinct_keys,
       count(*) - count(DISTINCT nullif(l_linenumber, 7)) AS duplicates FROM lineitem
UNION ALL SELECT 'struct', count(*), (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, nullif(l_linenumber, 7) FROM lineitem)),
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, nullif(l_linenumber, 7) FROM lineitem)) FROM lineitem
UNION ALL SELECT 'row', count(*), (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_quantity FROM lineitem)),
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_quantity FROM lineitem)) FROM lineitem
UNION ALL SELECT 'piped', count(*), count(DISTINCT l_orderkey::VARCHAR || '|' || l_linenumber::VARCHAR),
       count(*) - count(DISTINCT l_orderkey::VARCHAR || '|' || l_linenumber::VARCHAR) FROM lineitem
""")
def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts of a column, of a tuple, of whole rows and of a concatenated key."""
    lines = load(spark, sf_dir, "lineitem").withColumn("line", F.nullif("l_linenumber", F.lit(7)))
    piped = lines.select(piped_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("key"))
    forms = {"scalar": duplicate_summary(lines.select("line"), ["line"], skip_null=True),
             "struct": duplicate_summary(lines.select("l_orderkey", "line"), ["l_orderkey", "line"]),
             "row": exact_duplicate_summary(lines.select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity")),
             "piped": duplicate_summary(piped, ["key"])}
    result = None
    for form, summary in forms.items():
        part = summary.select(F.lit(form).alias("form"), "records", F.col("unique_keys").alias("distinct_keys"),
                              "duplicates")
        result = part if result is None else result.unionByName(part)
    return result


@query("agg_having", """
SELECT l_partkey, count(DISTINCT l_returnflag || '|' || l_linestatus) AS kinds, count(*) AS lines,
       (SELECT count(*) FROM part) AS parts
FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_returnflag || '|' || l_linestatus) > 5
""")
def agg_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups kept by their distinct count, next to a single value from another table."""
    parts = load(spark, sf_dir, "part").agg(N().alias("n")).scalar()
    kinds = F.count_distinct(piped_key(F.col("l_returnflag"), F.col("l_linestatus")))
    groups = load(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(kinds.alias("kinds"), N().alias("lines"))
    return groups.filter("kinds > 5").withColumn("parts", parts)


@query("share_of_total", f"""
SELECT p_brand, count(*) AS n, {settled('100.0::DOUBLE * count(*) / sum(count(*)) OVER ()')} AS pct_of_total
FROM part GROUP BY p_brand
""")
def share_of_total_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share_of_total(load(spark, sf_dir, "part").groupBy("p_brand").agg(N().alias("n")), "n")


@query("sort_forms", """
WITH g AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n, min(o_orderdate) AS first_order FROM orders GROUP BY ALL),
r AS (SELECT *, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 WHEN 'F' THEN 2 END AS listed,
             10 + dense_rank() OVER (ORDER BY o_orderpriority) AS check_order FROM g)
SELECT o_orderpriority, o_orderstatus, n, listed, check_order::INTEGER AS check_order,
       row_number() OVER (ORDER BY listed, o_orderpriority DESC)::INTEGER AS place
FROM r
""")
def sort_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed order, mixed directions and label positions; the place in the order is shown as a column."""
    groups = load(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(N().alias("n"))
    ranked = label_positions(groups, "o_orderpriority", "check_order", 10)
    listed = listed_order(F.col("o_orderstatus"), ["P", "O", "F"])
    order = Window.orderBy("listed", F.desc("o_orderpriority"))
    return (ranked.withColumn("listed", listed).withColumn("place", F.row_number().over(order))
            .orderBy("listed", F.desc("o_orderpriority")))


@query("top_and_bottom", """
(SELECT 'top' AS which, c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5)
UNION ALL (SELECT 'bottom', c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 5)
""")
def top_and_bottom(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    top = top_k(customers, "c_acctbal", 5, ["c_custkey"]).withColumn("which", F.lit("top"))
    bottom = top_k(customers, "c_acctbal", 5, ["c_custkey"], largest=False).withColumn("which", F.lit("bottom"))
    return top.unionByName(bottom)


# Joins ----------------------------------------------------------------------------------------------------

@query("lookup_roles", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, c.n_name AS customer_nation, s.n_name AS supplier_nation, p.p_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation c ON c_nationkey = c.n_nationkey
JOIN nation s ON s_nationkey = s.n_nationkey LEFT JOIN (SELECT * FROM part WHERE p_size < 25) p ON l_partkey = p_partkey
""")
def lookup_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation table in two roles, and an optional lookup that leaves NULL."""
    nations = load(spark, sf_dir, "nation")
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    rows = lookup(rows, load(spark, sf_dir, "orders"), "l_orderkey", "o_orderkey", {"o_custkey": "o_custkey"})
    rows = lookup(rows, load(spark, sf_dir, "customer"), "o_custkey", "c_custkey", {"c_nationkey": "c_nationkey"})
    rows = lookup(rows, load(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey", {"s_nationkey": "s_nationkey"})
    rows = lookup(rows, nations, "c_nationkey", "n_nationkey", {"n_name": "customer_nation"})
    rows = lookup(rows, nations, "s_nationkey", "n_nationkey", {"n_name": "supplier_nation"})
    rows = lookup(rows, load(spark, sf_dir, "part").filter("p_size < 25"), "l_partkey", "p_partkey",
                  {"p_name": "p_name"}, optional=True)
    return rows.drop("o_custkey", "c_nationkey", "s_nationkey", "l_suppkey")


@query("lookup_hot", """
SELECT l_orderkey, l_linenumber, k, s_name, s_acctbal
FROM (SELECT *, CASE WHEN l_linenumber <= 4 THEN 1 WHEN l_linenumber = 5 THEN 2 WHEN l_linenumber = 6 THEN NULL ELSE l_suppkey END AS k FROM lineitem)
LEFT JOIN supplier ON k = s_suppkey
""")
def lookup_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of line items of which one has most, found by a sketch and dealt out over many tasks; NULL and unknown keys stay."""
    number = F.col("l_linenumber")
    key = F.when(number <= 4, 1).when(number == 5, 2).when(number == 6, F.lit(None)).otherwise(F.col("l_suppkey")).cast("bigint")
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", key.alias("k"))
    return split_lookup(lines, load(spark, sf_dir, "supplier"), "k", "s_suppkey", {"s_name": "s_name", "s_acctbal": "s_acctbal"}, optional=True)


@query("orphan_counts", """
SELECT 'l_partkey' AS fk, count(*) AS records_checked,
       count(*) FILTER (WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)) AS orphans FROM lineitem
UNION ALL SELECT 'l_suppkey', count(*),
       count(*) FILTER (WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)) FROM lineitem
UNION ALL SELECT 'l_orderkey', count(*),
       count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) FROM lineitem
""")
def orphan_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_counts(load(spark, sf_dir, "lineitem"), {
        "l_partkey": (load(spark, sf_dir, "part").filter("p_size < 25"), "p_partkey"),
        "l_suppkey": (load(spark, sf_dir, "supplier").filter("s_acctbal > 0"), "s_suppkey"),
        "l_orderkey": (load(spark, sf_dir, "orders"), "o_orderkey")})


@query("reconcile_keys", """
WITH l AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'F'),
r AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R')
SELECT k AS order_key, 'left' AS only_in FROM l WHERE k NOT IN (SELECT k FROM r)
UNION ALL SELECT k, 'right' FROM r WHERE k NOT IN (SELECT k FROM l)
""")
def reconcile_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unfinished orders against orders with a returned line, both ways."""
    orders = load(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    returned = load(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    return reconcile(orders.select(F.col("o_orderkey").alias("order_key")),
                     returned.select(F.col("l_orderkey").alias("order_key")), "order_key")


@query("within_bounds", """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate BETWEEN (SELECT min(o_orderdate) + INTERVAL 1 YEAR FROM orders)
                     AND (SELECT max(o_orderdate) - INTERVAL 4 YEAR FROM orders)
""")
def within_bounds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = load(spark, sf_dir, "orders").agg(
        F.expr("min(o_orderdate) + interval 1 year").alias("first"),
        F.expr("max(o_orderdate) - interval 4 year").alias("last"))
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return within_bounds(lines, "l_shipdate", span, "first", "last")


# Dedupe ---------------------------------------------------------------------------------------------------

_TIES = ("l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus")


@query("dedupe_first", f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_TIES}, l_shipdate) = 1
""")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_one(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dedupe_latest", f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {_TIES}) = 1
""")
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_one(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("dedupe_hot_key", """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY CASE WHEN event_type IN ('click', 'view') THEN 'common' ELSE event_type END
                           ORDER BY ts DESC, event_id, user_id, event_type, value, props) = 1
""")
def dedupe_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Very few keys, one of which holds a large part of all events."""
    kind = F.when(F.col("event_type").isin("click", "view"), "common").otherwise(F.col("event_type"))
    return keep_one(load(spark, sf_dir, "events").withColumn("kind", kind), ["kind"], ["ts"]).drop("kind")


# Upsert ---------------------------------------------------------------------------------------------------

_NEW = "c_mktsegment IN ('BUILDING', 'MACHINERY')"


def _target_and_source(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers outside one segment; and all of two segments with other balances and names."""
    customer = load(spark, sf_dir, "customer")
    target = customer.filter("c_mktsegment <> 'BUILDING'").withColumn("loaded_by", F.lit("first"))
    source = customer.filter(_NEW).withColumns({
        "c_acctbal": F.col("c_acctbal") + 1000, "c_name": F.upper("c_name"), "loaded_by": F.lit("second")})
    return target, source


@query("upsert_all", f"""
SELECT c_custkey, CASE WHEN {_NEW} THEN upper(c_name) ELSE c_name END AS c_name, c_nationkey,
       CASE WHEN {_NEW} THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
       CASE WHEN {_NEW} THEN 'second' ELSE 'first' END AS loaded_by
FROM customer
""")
def upsert_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(*_target_and_source(spark, sf_dir), ["c_custkey"])


@query("upsert_bulk", f"""
SELECT c_custkey, CASE WHEN {_NEW} THEN upper(c_name) ELSE c_name END AS c_name, c_nationkey,
       CASE WHEN {_NEW} THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
       CASE WHEN {_NEW} THEN 'second' ELSE 'first' END AS loaded_by
FROM customer
""")
def upsert_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert as one full outer join, for a source as large as the target."""
    return upsert(*_target_and_source(spark, sf_dir), ["c_custkey"], bulk=True)


@query("upsert_bucketed", f"""
SELECT c_custkey, CASE WHEN {_NEW} THEN upper(c_name) ELSE c_name END AS c_name, c_nationkey,
       CASE WHEN {_NEW} THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
       CASE WHEN {_NEW} THEN 'second' ELSE 'first' END AS loaded_by
FROM customer
""")
def upsert_bucketed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert into a table stored in buckets of its key: the load moves, the table does not."""
    target, source = _target_and_source(spark, sf_dir)
    path = new_path(spark, "bucketed")
    write_bucketed(target, path, ["c_custkey"], 8)
    return upsert_bucketed(spark, path, source, ["c_custkey"])


@query("upsert_bucketed_nullable", """
WITH t AS (SELECT nullif(c_nationkey, 0) AS nation, c_custkey, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'),
s AS (SELECT nullif(c_nationkey, 0) AS nation, c_custkey, c_acctbal + 1000 AS c_acctbal FROM customer
      WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
u AS (
SELECT 'null-safe' AS kind, t.nation, t.c_custkey, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal
FROM t LEFT JOIN s ON t.nation IS NOT DISTINCT FROM s.nation AND t.c_custkey = s.c_custkey
UNION ALL SELECT 'null-safe', * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.nation IS NOT DISTINCT FROM s.nation AND t.c_custkey = s.c_custkey)
UNION ALL SELECT 'plain', t.nation, t.c_custkey, coalesce(s.c_acctbal, t.c_acctbal)
FROM t LEFT JOIN s ON t.nation = s.nation AND t.c_custkey = s.c_custkey
UNION ALL SELECT 'plain', * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.nation = s.nation AND t.c_custkey = s.c_custkey))
SELECT kind, nation, c_custkey, c_acctbal FROM u
""")
def upsert_bucketed_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with NULLs in buckets: one value under null-safe equality, matching nothing under plain equality."""
    target, source = _nullable_keys(spark, sf_dir)
    parts = []
    for kind in ("null-safe", "plain"):
        path = new_path(spark, "bucketed")
        write_bucketed(target, path, ["nation", "c_custkey"], 8, null_safe=kind == "null-safe")
        merged = upsert_bucketed(spark, path, source, ["nation", "c_custkey"], null_safe=kind == "null-safe")
        parts.append(merged.select(F.lit(kind).alias("kind"), "nation", "c_custkey", "c_acctbal"))
    return parts[0].unionByName(parts[1])


@query("upsert_columns", """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN upper(c_name) ELSE c_name END AS c_name, c_nationkey,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal,
       c_mktsegment, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey + 500 END AS customer_key
FROM customer
""")
def upsert_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the balance is refreshed on a match; the surrogate key of known rows is kept."""
    target, source = _target_and_source(spark, sf_dir)
    target = target.drop("loaded_by").withColumn("customer_key", F.col("c_custkey") + 500)
    return upsert(target, source.drop("loaded_by"), ["c_custkey"], null_safe=False, update=["c_acctbal"])


_NULLABLE = """
WITH t AS (SELECT nullif(c_nationkey, 0) AS nation, c_custkey, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'),
s AS (SELECT nullif(c_nationkey, 0) AS nation, c_custkey, c_acctbal + 1000 AS c_acctbal FROM customer
      WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
SELECT t.nation, t.c_custkey, CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal
FROM t LEFT JOIN s ON {match}
UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {match})
"""


def _nullable_keys(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return tuple(df.select(F.nullif("c_nationkey", F.lit(0)).alias("nation"), "c_custkey", "c_acctbal")
                 for df in _target_and_source(spark, sf_dir))


@query("upsert_nullsafe", _NULLABLE.format(match="t.nation IS NOT DISTINCT FROM s.nation AND t.c_custkey = s.c_custkey"))
def upsert_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(*_nullable_keys(spark, sf_dir), ["nation", "c_custkey"], null_safe=True)


@query("upsert_plain_equality", _NULLABLE.format(match="t.nation = s.nation AND t.c_custkey = s.c_custkey"))
def upsert_plain_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL keys match nothing: such rows stay in the target and are inserted from the source."""
    return upsert(*_nullable_keys(spark, sf_dir), ["nation", "c_custkey"], null_safe=False)


@query("upsert_plain_equality_bulk", _NULLABLE.format(match="t.nation = s.nation AND t.c_custkey = s.c_custkey"))
def upsert_plain_equality_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(*_nullable_keys(spark, sf_dir), ["nation", "c_custkey"], null_safe=False, bulk=True)


@query("upsert_delete_unmatched", f"""
SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal + 1000 AS c_acctbal, c_mktsegment,
       'second' AS loaded_by
FROM customer WHERE {_NEW}
""")
def upsert_delete_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(*_target_and_source(spark, sf_dir), ["c_custkey"], delete_unmatched=True)


@query("upsert_idempotent", f"""
SELECT run, c_custkey, CASE WHEN {_NEW} THEN upper(c_name) ELSE c_name END AS c_name, c_nationkey,
       CASE WHEN {_NEW} THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
       CASE WHEN {_NEW} THEN 'second' ELSE 'first' END AS loaded_by
FROM customer, (VALUES ('once'), ('twice')) v(run)
""")
def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading the same source again changes nothing."""
    target, source = _target_and_source(spark, sf_dir)
    once = materialize(upsert(target, source, ["c_custkey"]), "once")
    twice = upsert(once, source, ["c_custkey"])
    return once.withColumn("run", F.lit("once")).unionByName(twice.withColumn("run", F.lit("twice")))


# Surrogate keys -------------------------------------------------------------------------------------------

@query("assign_keys", """
WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey + 1 END AS k FROM customer)
SELECT coalesce(k, (SELECT max(k) FROM c) + row_number() OVER (PARTITION BY k IS NULL ORDER BY c_name, c_custkey))
         AS customer_key, c_custkey, c_name
FROM c
""")
def assign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known customers keep their key, the others are numbered after the largest."""
    key = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey") + 1).alias("customer_key")
    rows = load(spark, sf_dir, "customer").select(key, "c_custkey", "c_name")
    return assign_missing_keys(rows, "customer_key", ["c_name", "c_custkey"])


@query("number_rows", """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_number, o_orderkey, o_orderdate FROM orders
""")
def number_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return number_rows(orders, "order_number", ["o_orderdate", "o_orderkey"])
