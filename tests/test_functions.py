import datetime as dt

import pytest
from dateutil.relativedelta import relativedelta
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spark_elt import functions as sf


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_format_duration(spark):
    vals = [(0.12,), (5.6,), (70.2,), (4000.0,), (59.96,), (None,), (3600.0,), (0.0,)]
    got = one(spark, sf.format_duration("x"), vals, "x double")
    assert got == ["0.1s", "5.6s", "1:10m", "1:06h", "60.0s", "", "1:00h", "0.0s"]


def test_format_duration_ms(spark):
    vals = [(120,), (5600,), (70000,), (4000000,), (5960,), (999,), (1000,)]
    got = one(spark, sf.format_duration_ms("x"), vals, "x long")
    assert got == ["120ms", "5.6s", "1:10m", "1:06h", "6.0s", "999ms", "1.0s"]


def _py_time_difference(t1, t2):
    d = relativedelta(t2, t1)
    parts = ["years", "months", "days", "hours", "minutes", "seconds"]
    return ", ".join(f"{getattr(d, a)} {a}" for a in parts if getattr(d, a) or a == "seconds")


@settings(max_examples=25, deadline=None)
@given(
    st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 1, 1)),
    st.timedeltas(min_value=dt.timedelta(0), max_value=dt.timedelta(days=2000)),
)
def test_format_time_difference_matches_relativedelta(spark, t1, delta):
    t2 = t1 + delta
    got = one(spark, sf.format_time_difference("a", "b"), [(t1, t2)], "a timestamp_ntz, b timestamp_ntz")[0]
    assert got == _py_time_difference(t1, t2)


def test_month_end_clipping(spark):
    t1, t2 = dt.datetime(2024, 1, 31, 12), dt.datetime(2024, 2, 29, 13)
    got = one(spark, sf.format_time_difference("a", "b"), [(t1, t2)], "a timestamp_ntz, b timestamp_ntz")[0]
    assert got == _py_time_difference(t1, t2)


def test_mask_is_literal_and_ordered(spark):
    got = one(spark, sf.mask_secrets("m", ["a.b", "b*"]), [("xa.b aXb b*",)], "m string")
    assert got == ["x*** aXb ***"]


def test_clean_message(spark):
    got = one(spark, sf.clean_message("m", ["pw"]), [("pw is x \t\n",), ("   ",)], "m string")
    assert got == ["*** is x", ""]


def test_sanitize_id(spark):
    got = one(spark, sf.sanitize_id("m"), [("Foo-Bar baz!",), (12,)], "m string")
    assert got == ["foo_barbaz", "12"]


def test_iso_timestamp(spark):
    rows = [(dt.datetime(2024, 1, 2, 3, 4, 5),), (dt.datetime(2024, 1, 2, 3, 4, 5, 120),)]
    got = one(spark, sf.iso_timestamp("t"), rows, "t timestamp_ntz")
    assert got == [r[0].isoformat() for r in rows]


def test_status_and_labels(spark):
    assert one(spark, sf.status_text("s"), [(None,), (True,), (False,)], "s boolean") == ["unfinished", "succeeded", "failed"]
    df = spark.createDataFrame([({"b": "2", "a": "1"},), (None,)], "m map<string,string>")
    assert [r[0] for r in df.select(sf.format_labels("m")).collect()] == ["a: '1', b: '2'", ""]


def test_usage_ratio_zero_total(spark):
    assert one(spark, sf.usage_ratio("u", "t"), [(1.0, 0.0), (1.0, 4.0)], "u double, t double") == [None, 25.0]


def test_paths(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b"],)], "p array<string>")
    assert [r[0] for r in df.select(sf.last_name("p")).collect()] == ["root", "a", "b"]
    assert [r[0] for r in df.select(sf.path_has_prefix("p", ["a"])).collect()] == [False, True, True]
    assert [r[0] for r in df.select(sf.path_has_prefix("p", ["a"], strict=True)).collect()] == [False, False, True]
    assert [r[0] for r in df.select(sf.path_has_prefix("p", [])).collect()] == [True, True, True]
    assert [r[0] for r in df.select(sf.relative_label("p", 1)).collect()] == ["", "", "b"]


def test_truncate_text(spark):
    got = one(spark, sf.truncate_text("m", 3), [("abcdef",), ("ab",)], "m string")
    assert got == ["abc</pre>", "ab"]


def test_day_id(spark):
    assert one(spark, sf.day_id("d"), [(dt.date(2024, 1, 5),)], "d date") == [20240105]


@pytest.mark.parametrize("v", [None])
def test_format_duration_null(spark, v):
    assert one(spark, sf.format_duration(F.lit(v).cast("double")), [(1,)], "x int") == [""]


def test_durations_ignore_session_time_zone(spark):
    """Wall-clock differences must not depend on the session zone (DST gap)."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = [(dt.datetime(2001, 3, 31, 23, 0), dt.datetime(2001, 4, 1, 2, 30))]
        got = one(spark, sf.epoch_seconds("a", "b"), rows, "a timestamp_ntz, b timestamp_ntz")
        assert got == [3.5 * 3600]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
