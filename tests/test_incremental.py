"""Load journal, clustered files, lookups with hot values, streamed loads that keep stored columns."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakestrata.operators.hot import hot_values, split_lookup
from lakestrata.operators.journal import Journal
from lakestrata.operators.lookups import lookup, within_bounds
from lakestrata.operators.upsert import upsert_partitions
from lakestrata.operators.writes import ensure_path, overwrite_partitions, overwrite_path, with_day
from lakestrata.session import materialize
from lakestrata.streaming.incremental import load_new_files

AT = dt.datetime(2026, 6, 1)
SCHEMA = "id long, v string, m string"


def months(spark, *names, v="x"):
    return spark.createDataFrame([(100 * k + i, v, n) for k, n in enumerate(names) for i in range(3)], SCHEMA)


def table(spark, path):
    return rows(spark.read.schema(SCHEMA).parquet(path))


def test_a_batch_delivered_twice_is_written_once(spark, tmp_path):
    path, journal, runs = str(tmp_path / "t"), Journal(spark, str(tmp_path / "j")), []
    ensure_path(spark, path, months(spark).schema, "m")

    def load(touched):
        runs.append(1)
        upsert_partitions(spark, path, months(spark, "01", "02"), ["id", "m"], "m", touched=touched)
    assert journal.once("b1", "t", load, AT) and not journal.once("b1", "t", load, AT) and len(runs) == 1
    assert journal.once("b1", "other", lambda touched: None, AT) and journal.is_done("b1", "other")
    assert journal.changed("t") == ["01", "02"] and journal.changed("other") == []
    assert journal.changed("t", AT) == ["01", "02"] and journal.changed("t", AT + dt.timedelta(seconds=1)) == []


def test_a_batch_cut_off_between_two_partitions_is_done_again(spark, tmp_path):
    path, clean, journal = str(tmp_path / "t"), str(tmp_path / "clean"), Journal(spark, str(tmp_path / "j"))
    for p in (path, clean):
        overwrite_path(months(spark, "01", v="old"), p, "m")

    def cut(df, to, by):
        overwrite_partitions(df.filter("m = '01'"), to, by)  # the first partition is in place, then the driver dies
        raise KeyboardInterrupt
    batch = months(spark, "01", "02", v="new")
    with pytest.raises(KeyboardInterrupt):
        journal.once("b", "t", lambda touched: upsert_partitions(spark, path, batch, ["id", "m"], "m", store=cut, touched=touched), AT)
    assert not journal.is_done("b", "t") and journal.changed("t") == [] and len(table(spark, path)) == 3
    for p in (path, clean):
        Journal(spark, str(tmp_path / f"j{p[-1]}")).once("b", "t", lambda touched, p=p: upsert_partitions(spark, p, batch, ["id", "m"], "m", touched=touched), AT)
    assert table(spark, path) == table(spark, clean) == rows(batch)


def test_a_streamed_batch_is_entered_and_stored_columns_stay(spark, tmp_path):
    land, path, journal = str(tmp_path / "land"), str(tmp_path / "t"), Journal(spark, str(tmp_path / "j"))
    schema = spark.createDataFrame([], "id long, at timestamp_ntz").schema
    rows_in = spark.createDataFrame([(1, dt.datetime(2026, 1, 5)), (2, dt.datetime(2026, 2, 5))], schema)
    rows_in.coalesce(1).write.parquet(land)
    load_new_files(spark, land, path, str(tmp_path / "c"), schema, "at", ["id"], AT, journal=journal)
    assert journal.changed(path) == ["2026-01", "2026-02"]
    stored = spark.read.parquet(path)
    overwrite_path(stored.withColumn("extra", F.col("id") * 10), path, "source_month")
    spark.createDataFrame([(2, dt.datetime(2026, 2, 5)), (3, dt.datetime(2026, 2, 6))], schema).coalesce(1).write.mode("append").parquet(land)
    got = load_new_files(spark, land, path, str(tmp_path / "c"), schema, "at", ["id"], AT, journal=journal)
    assert rows(got.select("id", "extra")) == [(1, 10), (2, 20), (3, None)]
    assert journal.entries().select("batch").distinct().count() == 2


def scanned(df):
    """Rows that the scan hands on."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    plans, found = [node], []
    while plans:
        p = plans.pop()
        if p.nodeName().startswith("Scan parquet"):
            found.append(p.metrics().get("numOutputRows").get().value())
        children = p.children()
        plans += [children.apply(i) for i in range(children.size())]
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            plans.append(p.executedPlan())
    return sum(found)


def test_a_day_of_a_clustered_table_reads_few_rows(spark, tmp_path):
    first = dt.datetime(2026, 1, 1)
    df = (spark.range(400_000).select(F.col("id"), (F.lit(first).cast("timestamp_ntz") + F.make_dt_interval(mins=((F.col("id") * 7919) % 129_600).cast("int"))).alias("at"))
          .withColumn("m", F.date_format("at", "yyyy-MM")))
    bounds = spark.sql("SELECT TIMESTAMP_NTZ'2026-02-10' AS low, TIMESTAMP_NTZ'2026-02-10 23:59:59.999999' AS high")
    for part in (None, "m"):
        mixed, ordered = str(tmp_path / f"mixed{part}"), str(tmp_path / f"ordered{part}")
        overwrite_path(df, mixed, part)
        overwrite_path(with_day(df, "at"), ordered, part, cluster_by=["at_day", "at"])

        def day(path):
            return within_bounds(spark.read.parquet(path), "at", bounds, "low", "high").select("id")
        want = rows(day(mixed))
        assert rows(day(ordered)) == want and len(want) > 3000
        assert scanned(day(ordered)) < 60_000 < 400_000 == scanned(day(mixed))


def skewed(spark):
    return spark.range(60_000).select("id", F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 20 == 1, F.lit(None)).otherwise(F.col("id") % 500).cast("long").alias("zone"))


def test_hot_values_are_found(spark):
    assert set(hot_values(skewed(spark), "zone", 0.1)) == {7}
    assert hot_values(skewed(spark).limit(0), "zone", 0.1) == {} and hot_values(skewed(spark).filter("zone IS NULL"), "zone", 0.1) == {}
    with pytest.raises(ValueError):
        hot_values(skewed(spark), "zone", 0)


@pytest.mark.parametrize("optional", [True, False])
def test_split_lookup_equals_lookup(spark, optional):
    zones = spark.range(0, 400).select(F.col("id").alias("k"), F.concat(F.lit("z"), F.col("id")).alias("name")).unionByName(
        spark.createDataFrame([(None, "none")], "k long, name string"))
    df = skewed(spark).limit(5000)
    want = rows(lookup(df, zones, "zone", "k", {"name": "zone_name"}, optional))
    assert rows(split_lookup(df, zones, "zone", "k", {"name": "zone_name"}, optional, parts=16)) == want
    assert rows(split_lookup(df, zones, "zone", "k", {"name": "zone_name"}, optional, hot={})) == want


def test_no_task_has_three_times_the_median(spark):
    zones = spark.range(0, 500).select(F.col("id").alias("k"), F.col("id").alias("name"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        def per_task(df):
            return sorted(r[0] for r in materialize(df.withColumn("task", F.spark_partition_id())).groupBy("task").count().select("count").collect())
        plain = per_task(lookup(skewed(spark).filter("zone IS NOT NULL"), zones, "zone", "k", {"name": "n"}))
        split = per_task(split_lookup(skewed(spark).filter("zone IS NOT NULL"), zones, "zone", "k", {"name": "n"}))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plain[-1] > 3 * plain[len(plain) // 2] and split[-1] <= 3 * split[len(split) // 2]
