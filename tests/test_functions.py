from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from clickweir.functions import payloads, ratios, times
from conftest import rows


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_parse_hour_by_width(spark):
    df = spark.createDataFrame(
        [(14102101,), (2014102101,), (99999999,), (140102,), (14102124,), (None,)], "hour bigint")
    stamp = times.parse_hour(F.col("hour"))
    got = rows(df.select(stamp, stamp.cast("date"), times.hour_of_day(stamp)))
    good = (datetime(2014, 10, 21, 1), date(2014, 10, 21), "01")
    assert got == [good, good, *[(None, None, None)] * 4]


def test_hour_parts(spark):
    df = spark.createDataFrame([(14102103,)], "hour int")
    assert rows(df.select(*times.hour_parts(F.col("hour")))) == [(2014, 10, 21, 3)]


def test_event_hour_timestamp_skips_missing_parts(spark):
    df = spark.createDataFrame([(date(2014, 10, 21), "07"), (None, "07")], "d date, h string")
    got = rows(df.select(times.event_hour_timestamp(F.col("d"), F.col("h"))))
    assert got == [("2014-10-21 07:00:00",), (" 07:00:00",)]


@pytest.mark.parametrize("impressions, clicks, rate", [
    (100, 10, 10.0), (50, 5, 10.0), (0, 0, 0.0), (100, 15, 15.0), (200, 40, 20.0), (100, 99, 99.0),
    (1000, 1, 0.1), (0, 3, 0.0), (6, 4, 4 / 6 * 100), (7, 3, 3 / 7 * 100)])
def test_ctr_stream(spark, impressions, clicks, rate):
    assert value(spark, ratios.ctr_stream(F.lit(clicks), F.lit(impressions))) == pytest.approx(rate)


@pytest.mark.parametrize("clicks, events, rate", [
    (4, 10, "40.00"), (3, 10, "30.00"), (1, 3, "33.33"), (2, 3, "66.67"), (0, 5, "0.00"),
    (1, 800, "0.13"), (82037, 500000, "16.41"), (1, 0, None), (None, 5, None)])
def test_ctr_batch(spark, clicks, events, rate):
    got = value(spark, ratios.ctr_batch(F.lit(clicks).cast("int"), F.lit(events)))
    assert got == (None if rate is None else Decimal(rate))


@pytest.mark.parametrize("now, before, change", [
    (15, 10, "50.00"), (5, 10, "-50.00"), (2, 3, "-33.33"), (10, 0, None), (10, None, None),
    (1, 800, "-99.88")])
def test_pct_change(spark, now, before, change):
    got = value(spark, ratios.pct_change(F.lit(now), F.lit(before).cast("int")))
    assert got == (None if change is None else Decimal(change))


def test_hundredths_are_exact(spark):
    cases = []

    @settings(max_examples=300, deadline=None)
    @given(st.integers(-10**9, 10**9), st.integers(1, 10**9))
    def collect(n, d):
        cases.append((n, d))
    collect()
    df = spark.createDataFrame(cases, "n bigint, d bigint")
    for n, d, got in df.select("n", "d", ratios.hundredths(F.col("n"), F.col("d"))).collect():
        size = (200 * abs(n) + d) // (2 * d)
        assert got == (size if n >= 0 else -size)


@pytest.mark.parametrize("attempt, wait", [(0, 0), (1, 1000), (2, 2000), (3, 4000), (6, 32000), (7, 32000),
                                           (500, 32000)])
def test_backoff(spark, attempt, wait):
    assert value(spark, times.backoff_ms(F.lit(attempt))) == wait


def test_json_keeps_non_ascii_and_nulls(spark):
    df = spark.createDataFrame([(1, "광고", None)], "id int, site string, app string")
    assert rows(df.select(payloads.event_to_json(["id", "site", "app"]))) == \
        [('{"id":1,"site":"광고","app":null}',)]


def test_json_default(spark):
    got = payloads.json_field_default(F.lit('{"a":{"id":7}}'), "$.a.id", "unknown")
    assert value(spark, got) == "7"
    assert value(spark, payloads.json_field_default(F.lit("{}"), "$.a.id", "unknown")) == "unknown"


def test_epoch_ms(spark):
    start, end = (value(spark, times.epoch_ms_to_timestamp(F.lit(ms)))
                  for ms in (1704067200000, 1704067260000))
    assert (end - start).total_seconds() == 60


def test_kpis_without_denominator(spark):
    for f in (ratios.cost_per_click, ratios.cost_per_action, ratios.return_on_ad_spend):
        assert value(spark, f(F.lit(10.0), F.lit(0))) is None
        assert value(spark, f(F.lit(10.0), F.lit(4))) == 2.5


def test_cross_features(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert rows(df.select(payloads.cross_feature("x", "y"))) == [("a|",), ("a|b",)]
    assert all(0 <= r[0] < 10 for r in rows(df.select(payloads.cross_feature_hash("x", "y", buckets=10))))
