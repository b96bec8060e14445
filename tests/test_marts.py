from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from clickweir.operators import joins
from clickweir.plans import exploration, marts, serving
from clickweir.schema import CAMPAIGN_COLUMNS, EVENT_COLUMNS, EVENT_SCHEMA
from conftest import rows

BASE = dict(zip(EVENT_COLUMNS, (1, 0, 14102101, 0, "s", "dom", "cat", "a", "ad", "ac", "d", "ip", "m", 1, 0,
                                1, 2, 3, 4, 5, 6, 7, 8, 9)))


def events(spark, *changes):
    from decimal import Decimal as D
    data = []
    for c in changes:
        row = {**BASE, **c}
        row["id"] = None if row["id"] is None else D(row["id"])
        data.append(tuple(row[k] for k in EVENT_COLUMNS))
    return spark.createDataFrame(data, EVENT_SCHEMA)


def test_staging_filters_and_parses(spark):
    df = events(spark, {}, {"id": 2, "click": 2}, {"id": 3, "hour": None}, {"id": 4, "site_id": None},
                {"id": None}, {"id": 5, "hour": 99999999})
    got = {int(r["id"]): r for r in marts.stage_events(df).collect()}
    assert set(got) == {1, 5}
    assert got[1]["event_timestamp"] == datetime(2014, 10, 21, 1) and got[1]["event_hour"] == "01"
    assert got[5]["event_date"] is None


def test_dedup_keeps_newest_and_is_total(spark):
    copies = [{"hour": 14102101, "click": 1}, {"hour": 14102103, "click": 0, "device_ip": "z"},
              {"hour": 14102103, "click": 0, "device_ip": "y"}, {"hour": 14102102, "click": 1}]
    wide = marts.stage_events(events(spark, *copies)).collect()
    again = marts.stage_events(events(spark, *copies[::-1])).collect()
    assert len(wide) == 1 and wide == again
    assert wide[0]["event_timestamp"] == datetime(2014, 10, 21, 3) and wide[0]["device_ip"] == "z"


def test_narrow_staging_keeps_the_same_copy(spark):
    copies = [{"click": c, "site_id": s, "device_type": d, "device_ip": ip}
              for c in (0, 1) for s in ("a", "b", "c") for d in (1, 2) for ip in ("x", "y")]
    wide = marts.stage_events(events(spark, *copies)).first()
    for columns in (("click",), ("site_id",), ("device_type", "site_id"), CAMPAIGN_COLUMNS):
        narrow = marts.stage_events(events(spark, *copies), columns).first()
        assert all(narrow[c] == wide[c] for c in columns)


def test_hot_id(spark):
    """One id on a third of the rows still leaves one row, chosen before the shuffle."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("decimal(20,0)").alias("id"),
        (F.col("id") % 2).cast("int").alias("click"), F.lit(14102101).alias("hour"), F.lit("s").alias("site_id"))
    out = marts.dedup_latest(df.withColumn("t", marts.parse_hour(F.col("hour"))), "id", "t", ["click"])
    assert out.count() == 20_001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_hourly_flags(spark):
    staged = marts.stage_events(events(spark, {"id": 1, "click": 1}, {"id": 2, "click": 0},
                                       {"id": 3, "click": 1, "site_id": "all"}))
    got = {r["site_id"]: r for r in marts.hourly_agg(staged).collect()}
    assert got["s"]["ctr_percentage"] == Decimal("50.00")
    assert (got["s"]["has_clicks"], got["s"]["no_clicks"]) == (1, 0)
    assert (got["all"]["has_clicks"], got["all"]["no_clicks"]) == (1, 1)
    assert got["s"]["event_hour_timestamp"] == "2014-10-21 01:00:00"


def test_daily_paths_agree(spark, sf):
    from clickweir.catalog import frames
    staged = frames.staged_for_marts(spark, sf)
    hourly = marts.hourly_agg(staged)
    expected = sorted(rows(marts.daily_agg(hourly)), key=str)
    assert sorted(rows(marts.daily_agg(hourly, unique_hours=True)), key=str) == expected
    assert sorted(rows(marts.daily_agg_direct(staged)), key=str) == expected


def daily_frame(spark, entries):
    return spark.createDataFrame(
        [(d, "s", dom, "c", 1, imps, clicks, 3) for d, dom, imps, clicks in entries],
        "event_date date, site_id string, site_domain string, site_category string, device_type int, "
        "daily_total_impressions bigint, daily_total_clicks bigint, hours_with_data bigint"
    ).withColumn("daily_ctr_percentage", marts.ctr_batch(F.col("daily_total_clicks"), F.col("daily_total_impressions")))


def test_rows_not_days_and_zero_division(spark):
    start = date(2024, 1, 1)
    offsets = [0, 1, 2, 4, 5, 6, 8, 9, 10]  # two days missing
    clicks = [10, 0, 5, 5, 5, 5, 5, 5, 40]
    daily = daily_frame(spark, [(start + timedelta(days=o), "d", 100, c) for o, c in zip(offsets, clicks)])
    got = marts.daily_metrics(daily).orderBy("event_date").collect()
    change = [r["clicks_dod_pct_change"] for r in got]
    assert change[:4] == [None, Decimal("-100.00"), None, Decimal("0.00")]
    assert change[8] == Decimal("700.00")
    averages = [r["clicks_7day_moving_avg"] for r in got]
    for i in range(len(clicks)):
        part = clicks[max(0, i - 6): i + 1]
        assert averages[i] == Decimal((200 * sum(part) + len(part)) // (2 * len(part))) / 100
    calendar = marts.daily_metrics(daily, calendar_days=True).orderBy("event_date").collect()
    # six of the seven days up to the last one are there: (5 * 5 + 40) / 6
    assert calendar[8]["clicks_7day_moving_avg"] == Decimal("10.83")


def test_tie_day_is_settled_by_domain(spark):
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    entries = [(d1, "a", 10, 1), (d1, "b", 10, 2), (d2, "a", 10, 4)]
    for order in (entries, entries[::-1]):
        got = marts.with_previous_day(daily_frame(spark, order)).orderBy("event_date", "site_domain").collect()
        assert [r["previous_day_clicks"] for r in got] == [None, 1, 2]


def test_surrogate_key_is_dense_sorted_and_null_last(spark):
    combos = [("s%02d" % (i % 50), None if i % 7 == 0 else "a%d" % (i % 11), i % 8, None if i % 5 == 0 else i % 4)
              for i in range(3000)]
    staged = spark.createDataFrame([(s, "d", "c", a, "ad", "ac", b, t) for s, a, b, t in combos],
                                   "site_id string, site_domain string, site_category string, app_id string, "
                                   "app_domain string, app_category string, banner_pos int, device_type int")
    dim = marts.dim_campaigns(staged)
    got = sorted((r["campaign_id"], r["site_id"], r["app_id"], r["banner_pos"], r["device_type"])
                 for r in dim.collect())
    last = (1, "")
    expected = sorted(set(combos), key=lambda c: (c[0], last if c[1] is None else (0, c[1]), c[2],
                                                  99 if c[3] is None else c[3]))
    assert [g[0] for g in got] == list(range(1, len(expected) + 1))
    assert [g[1:] for g in got] == expected
    joined = joins.fact_to_campaign(staged, dim, CAMPAIGN_COLUMNS)
    assert joined.count() == 3000 and joined.where("campaign_id IS NULL").count() == 0


def test_campaign_join_without_broadcast(spark, sf, monkeypatch):
    from clickweir.catalog import frames
    staged, dim = frames.staged_for_campaigns(spark, sf), frames.campaigns(spark, sf)
    small = sorted(rows(joins.fact_to_campaign(staged, dim, CAMPAIGN_COLUMNS).select("id", "campaign_id")))
    monkeypatch.setattr(joins, "broadcast_if_small", lambda df: df)
    assert sorted(rows(joins.fact_to_campaign(staged, dim, CAMPAIGN_COLUMNS).select("id", "campaign_id"))) == small


def test_broadcast_bound(spark):
    hinted = joins.broadcast_if_small(spark.range(10), 80)._jdf.queryExecution().analyzed().toString()
    plain = joins.broadcast_if_small(spark.range(11), 80)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted and "broadcast" not in plain


def test_orphans_and_reconcile(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "x string")
    parent = spark.createDataFrame([("a",), (None,)], "y string")
    assert rows(joins.relationship_orphans(child, "x", parent, "y")) == [("b", 2)]
    left = spark.createDataFrame([(1, 5, 9), (2, 1, 1)], "h int, clicks bigint, events bigint")
    right = spark.createDataFrame([(1, 5, 9), (3, 2, 2)], "h int, clicks bigint, events bigint")
    got = {r["h"]: r["matched"] for r in joins.batch_vs_stream_reconcile(left, right, "h").collect()}
    assert got == {1: 1, 2: 0, 3: 0}


def test_serving_edges(spark):
    metrics = spark.createDataFrame(
        [(datetime(2024, 12, 16, 14, m), datetime(2024, 12, 16, 14, m + 1), i, c, 0.0)
         for m, i, c in ((30, 834, 166), (31, 920, 150), (32, 1050, 172))],
        "window_start timestamp_ntz, window_end timestamp_ntz, impressions bigint, clicks bigint, ctr double")
    newest = serving.latest_ctr_1min(metrics, "2024-12-16 15:31:00").collect()
    assert [r["clicks"] for r in newest] == [172, 150]
    assert serving.avg_ctr_window(metrics, "2025-01-01 00:00:00").first()["avg_ctr"] is None
    live = serving.current_metrics_union(metrics, metrics, "2024-12-16 14:37:00")
    kinds = [(r["window_type"], r["clicks"]) for r in live.collect()]
    assert sorted(kinds) == [("1min", 172), ("5min", 150), ("5min", 166), ("5min", 172)]
    serving.register_views(metrics, metrics, "2024-12-16 15:00:00")
    assert spark.sql("SELECT count(*) FROM latest_ctr_5min").first()[0] == 3


def test_no_data_alert_on_empty(spark):
    empty = spark.createDataFrame([], "event_time timestamp_ntz")
    assert serving.alert_no_data(empty, "2024-01-01").first()["no_data"] == 1


def test_counts(spark):
    df = events(spark, {"id": 1}, {"id": 2, "click": 1}, {"id": 3, "hour": 14102102})
    assert rows(exploration.count_by_hour(df)) == [(14102101, 2), (14102102, 1)]
    profile = serving.volume_profile(df).first()
    assert (profile["total_records"], profile["unique_hours"], profile["avg_per_hour"]) == (3, 2, Decimal("1.50"))
    assert serving.volume_profile(df, approximate=True).first()["unique_hours"] == 2


def test_retention_cleanup(spark, tmp_path):
    path = str(tmp_path / "events")
    days = [(i, datetime(2024, 1, 1 + i // 2, 23 * (i % 2))) for i in range(10)]
    table = spark.createDataFrame(days + [(99, None)], "id int, created_at timestamp_ntz") \
        .withColumn("event_date", F.to_date("created_at"))
    table.write.partitionBy("event_date").parquet(path)
    # keeps from January 3rd, noon: two whole days go, the third is rewritten
    assert serving.retention_cleanup(spark, path, "2024-01-05 12:00:00", days=2) == 5
    left = spark.read.parquet(path)
    assert sorted(r["id"] for r in left.collect()) == [5, 6, 7, 8, 9, 99]
    assert serving.retention_cleanup(spark, path, "2024-01-05 12:00:00", days=2) == 0
    report = serving.maintenance_report(spark.createDataFrame([(5,)], "deleted_rows bigint"))
    assert rows(report) == [("cleanup_events", "5"), ("status", "Maintenance completed")]
