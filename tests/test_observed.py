"""Checks taken while rows are written: same report, one pass, and a failed one leaves the table."""

from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakestrata.operators.writes import overwrite_path
from lakestrata.quality import suites
from lakestrata.quality.checks import Reference, Rows, Total, Unique, UniqueRows, Volumes, run_suite
from lakestrata.quality.observed import writing, writing_partitions
from lakestrata.quality.rules import SOURCE_RULES, STRICT
from lakestrata.quality.store import QualityGateFailed

SCHEMA = "id long, zone long, fare double, m string"
GOOD = [(i, i % 3, float(i), f"2026-0{1 + i % 2}") for i in range(40)]
BAD = [*GOOD, (1, 7, -5.0, "2026-01"), (1, 7, -5.0, "2026-01"), (None, 1, 2.0, None)]


def checks(spark):
    zones = spark.createDataFrame([(0,), (1,), (2,)], "zone_key long")
    return [Total("Volume", "VOLUME", F.abs(F.count(F.lit(1)) - zones.agg(F.count(F.lit(1)) + 37).scalar()), actual=F.count(F.lit(1))),
            Rows("Negative fare", "RANGE", F.col("fare") < 0), Unique("Id", "UNIQUE", ["id"], skip_null=True),
            Reference("Zone", "RI", "zone", zones, "zone_key"), Rows("No month", "NULL", F.col("m").isNull(), null_if_empty=True),
            UniqueRows("Rows", "UNIQUE"), Volumes("Month", "VOLUME", F.col("m"), 10)]


@pytest.mark.parametrize("data", [GOOD, BAD, []])
@pytest.mark.parametrize("partition_by", [None, "m"])
def test_the_report_is_that_of_the_suite(spark, tmp_path, data, partition_by):
    df = spark.createDataFrame(data, SCHEMA)
    got = writing(str(tmp_path / "t"), partition_by, stop=False)(df, checks(spark), SOURCE_RULES, "trips")
    want = run_suite(df, checks(spark), SOURCE_RULES, "trips")
    assert got.schema.names == want.schema.names and rows(got) == rows(want)
    assert rows(spark.read.schema(df.schema).parquet(str(tmp_path / "t"))) == rows(df)


def test_row_checks_take_no_second_pass(spark, tmp_path):
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            passed.add(b.num_rows)
            yield b
    df = spark.createDataFrame(GOOD, SCHEMA).repartition(3).mapInArrow(count, SCHEMA)
    plain = [c for c in checks(spark) if isinstance(c, Rows | Total)]
    report = writing(str(tmp_path / "t"), "m")(df, plain, STRICT, "")
    assert report.count() == 3 and passed.value == len(GOOD)


def test_a_failed_check_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame(GOOD[:5], SCHEMA)
    overwrite_path(old, path)
    with pytest.raises(QualityGateFailed, match="Negative fare"):
        writing(path)(spark.createDataFrame(BAD, SCHEMA), checks(spark), STRICT, "")
    assert rows(spark.read.parquet(path)) == rows(old) and [p.name for p in tmp_path.iterdir()] == ["t"]
    grown = spark.read.parquet(path).unionByName(spark.createDataFrame(GOOD[5:], SCHEMA))  # rows from the table itself
    writing(path)(grown, checks(spark)[:6], STRICT, "")
    assert rows(spark.read.parquet(path)) == rows(spark.createDataFrame(GOOD, SCHEMA))


def test_an_error_while_writing_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame(GOOD[:5], SCHEMA)
    overwrite_path(old, path)
    with pytest.raises(Exception, match="broken row"):
        broken = spark.createDataFrame(GOOD, SCHEMA).withColumn("fare", F.when(F.col("id") == 7, F.raise_error(F.lit("broken row"))).otherwise(F.col("fare")))
        writing(path)(broken, checks(spark), STRICT, "")
    assert rows(spark.read.parquet(path)) == rows(old) and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_only_the_partitions_of_the_rows_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_path(spark.createDataFrame(GOOD, SCHEMA), path, "m")
    february = [r for r in GOOD if r[3] == "2026-02"]
    put = writing_partitions(path, "m")
    put(spark.createDataFrame([(100, 1, 1.0, "2026-01"), (101, 2, 1.0, "2026-03")], SCHEMA), checks(spark)[1:5], STRICT, "")
    stored = spark.read.schema(SCHEMA).parquet(path)
    assert rows(stored) == sorted([*february, (100, 1, 1.0, "2026-01"), (101, 2, 1.0, "2026-03")], key=repr)
    with pytest.raises(QualityGateFailed):
        put(spark.createDataFrame([(200, 1, -1.0, "2026-02")], SCHEMA), checks(spark)[1:2], STRICT, "")
    assert rows(spark.read.schema(SCHEMA).parquet(path)) == rows(stored)
    assert sorted(p.name for p in Path(path).glob("m=*")) == ["m=2026-01", "m=2026-02", "m=2026-03"]


def test_every_suite_takes_the_way_it_is_run():
    import inspect
    named = [f for n, f in vars(suites).items() if n.endswith("_suite") and n != "run_suite"]
    assert len(named) == 10 and all("run" in inspect.signature(f).parameters for f in named)
