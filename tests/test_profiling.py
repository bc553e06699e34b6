import datetime as dt

from helpers import rows

from lakestrata.profiling import profile


def test_shape_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "b")], "id int, v string")
    assert rows(profile.table_shape(df)) == [(0, "id", "int", 4, 2), (1, "v", "string", 4, 2)]
    assert rows(profile.null_profile(df)) == [("id", 4, 0, 0.0), ("v", 4, 2, 50.0)]
    assert rows(profile.null_patterns(df, ["id", "v"])) == [("00", 2), ("01", 2)]


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (None, "c")], "k int, v string")
    assert rows(profile.column_uniqueness(df, ["k", "v"])) == [("k", 4, 1, 25.0), ("v", 4, 3, 75.0)]
    assert rows(profile.key_profile(df, ["k", "v"])) == [("k,v", 4, 3, 2)]


def test_order_signs_ranges_and_codes(spark):
    t = [dt.datetime(2026, 4, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(t[0], t[1], -1.0, 1), (t[2], t[1], 0.0, 1), (t[1], t[1], 5.0, None)],
                               "s timestamp_ntz, e timestamp_ntz, m double, c int")
    assert rows(profile.event_order(df, "s", "e")) == [(t[0], t[2], t[1], t[1], 1)]
    assert rows(profile.sign_profile(df, ["m"])) == [("m", 3, 1, 1)]
    assert rows(profile.numeric_ranges(df, ["m", "c"])) == [("c", 3, 1.0, 1.0), ("m", 3, -1.0, 5.0)]
    assert rows(profile.code_values(df, ["c"])) == sorted([("c", "1", 2), ("c", None, 1)], key=repr)


def test_gaps_names_and_distribution(spark):
    df = spark.createDataFrame([(1, "x", "a"), (2, "x", "a"), (4, "y", "b"), (9, "z", "b")], "id int, n string, b string")
    assert rows(profile.id_gaps(df, "id", 1, 5)) == [(3, "missing"), (5, "missing"), (9, "unexpected")]
    assert rows(profile.repeated_names(df, "id", "n")) == [("x", 1, 2), ("x", 2, 2)]
    assert rows(profile.distribution(df, "b")) == [("Total", 4), ("a", 2), ("b", 2)]


def test_series_and_drift(spark):
    hours = [dt.datetime(2026, 3, 1, h) for h in range(24)]
    df = spark.createDataFrame([(h, 1.0 if h.hour else None) for h in hours], "t timestamp_ntz, v double")
    assert rows(profile.observation_count(df, "t", ["v"])) == [("t", 24, 24, True), ("v", 24, 23, False)]
    assert rows(profile.hours_covered(df.filter("hour(t) <> 5"), "t")) == [(24, 23, 23)]
    drift = spark.createDataFrame([(dt.datetime(2008, 12, 31), "2026-03"), (hours[0], "2026-03")],
                                  "t timestamp_ntz, m string")
    assert rows(profile.out_of_month(drift, "t", "m")) == [("2026-03", "2008-12", 1)]


def test_schema_drift(spark):
    left = spark.createDataFrame([], "a int, b string, c int")
    right = spark.createDataFrame([], "a bigint, c int, d string")
    assert rows(profile.schema_diff(left, right).select("column_name", "change")) == [
        ("a", "changed"), ("b", "removed"), ("c", "same"), ("d", "added")]
