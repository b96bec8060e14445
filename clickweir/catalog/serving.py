"""Serving, alert and retention queries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from clickweir.catalog import frames
from clickweir.catalog.registry import query
from clickweir.catalog.sql import AS_OF, MIDDAY, ctr, ratio
from clickweir.operators import quality
from clickweir.plans import serving
from clickweir.session import scratch_path
from clickweir.sources.driver_tables import ad_events, ad_events_stream
from clickweir.sources.tables import write_batch
from clickweir.streaming.jobs import StreamRun

_M = "window_start, window_end, impressions, clicks, ctr"
_F = """CAST(event_date AS VARCHAR) AS event_date, site_id, site_domain, site_category,
CAST(device_type AS BIGINT) AS device_type, daily_total_impressions, daily_total_clicks, daily_ctr_percentage,
hours_with_data, clicks_dod_pct_change, clicks_7day_moving_avg, ctr_7day_moving_avg"""


def _before(as_of: str, hours: int) -> str:
    """Scan bound: so many hours, and one hour for windows that began earlier, before a moment."""
    return (datetime.fromisoformat(as_of) - timedelta(hours=hours + 1)).isoformat(sep=" ")


@query("recent_window_filter", f"SELECT {_M} FROM m1 WHERE window_start >= TIMESTAMP '{AS_OF}' - INTERVAL 6 HOUR")
def _(spark, d):
    metrics = frames.metrics_1min(spark, d, since=_before(AS_OF, 6))
    return serving.recent_window_filter(metrics, AS_OF, "6 HOURS")


@query("latest_ctr_1min", f"SELECT {_M} FROM m1 WHERE window_start >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR")
def _(spark, d):
    return serving.latest_ctr_1min(frames.metrics_1min(spark, d, since=_before(AS_OF, 1)), AS_OF)


@query("latest_ctr_5min", f"SELECT {_M} FROM m5 WHERE window_start >= TIMESTAMP '{AS_OF}' - INTERVAL 2 HOUR")
def _(spark, d):
    return serving.latest_ctr_5min(frames.metrics_5min(spark, d, since=_before(AS_OF, 2)), AS_OF)


@query("avg_ctr_window", f"""SELECT round(avg(ctr), 6) AS avg_ctr FROM m1 WHERE window_start >= TIMESTAMP '{AS_OF}' - INTERVAL 12 HOUR""")
def _(spark, d):
    metrics = frames.metrics_1min(spark, d, since=_before(AS_OF, 12))
    return serving.avg_ctr_window(metrics, AS_OF, "12 HOURS").select(F.round("avg_ctr", 6).alias("avg_ctr"))


_LIVE = f"""SELECT '1min' AS window_type, * FROM m1 WHERE window_end > TIMESTAMP '{MIDDAY}' - INTERVAL 5 MINUTE AND window_end <= TIMESTAMP '{MIDDAY}'
UNION ALL SELECT '5min', * FROM m5 WHERE window_end > TIMESTAMP '{MIDDAY}' - INTERVAL 25 MINUTE AND window_end <= TIMESTAMP '{MIDDAY}'"""


def _live(spark, d):
    since = _before(MIDDAY, 1)
    return serving.current_metrics_union(frames.metrics_1min(spark, d, since),
                                         frames.metrics_5min(spark, d, since), MIDDAY)


@query("current_metrics_union", f"SELECT window_type, {_M} FROM ({_LIVE})")
def _(spark, d):
    return _live(spark, d)


@query("metrics_comparison", f"""SELECT window_type, count(*) AS n_windows, round(avg(ctr), 6) AS avg_ctr,
CAST(sum(impressions) AS BIGINT) AS total_impressions, CAST(sum(clicks) AS BIGINT) AS total_clicks FROM ({_LIVE}) GROUP BY 1""")
def _(spark, d):
    return serving.metrics_comparison(_live(spark, d)).withColumn("avg_ctr", F.round("avg_ctr", 6))


@query("metrics_filter", """SELECT CAST(event_date AS VARCHAR) AS event_date, site_id, CAST(device_type AS BIGINT) AS device_type,
daily_ctr_percentage, daily_total_clicks, daily_total_impressions FROM fact
WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND site_id = 'site_3' AND device_type = 1""")
def _(spark, d):
    return serving.metrics_filter(frames.facts(spark, d), "2024-01-05", "2024-01-20", "site_3", 1)


@query("last_30_days", f"SELECT {_F} FROM fact WHERE event_date >= DATE '2024-02-10' - 30")
def _(spark, d):
    return serving.last_30_days(frames.facts(spark, d), "2024-02-10")


@query("overall_ctr", f"""SELECT total, clicks, {ctr('clicks', 'total')} AS ctr FROM (
SELECT count(*) AS total, count(*) FILTER (click = 1) AS clicks FROM ad WHERE click IN (0, 1))""")
def _(spark, d):
    return serving.overall_ctr(frames.ads(spark, d))


@query("overall_ctr_today", f"""SELECT total, clicks, {ctr('clicks', 'total')} AS ctr FROM (
SELECT count(*) AS total, count(*) FILTER (click = 1) AS clicks FROM ad
WHERE click IN (0, 1) AND event_time >= TIMESTAMP '2024-01-30 00:00:00')""")
def _(spark, d):
    """The overall rate since midnight; the scan reads the day's row groups only."""
    return serving.overall_ctr(ad_events(spark, d, since="2024-01-30 00:00:00"))


@query("volume_profile", f"""SELECT total_records, unique_hours, unique_sites,
{ratio('total_records', 'greatest(1, unique_hours)')} AS avg_per_hour FROM (SELECT count(*) AS total_records,
count(DISTINCT hour) AS unique_hours, count(DISTINCT site_id) AS unique_sites FROM ad)""")
def _(spark, d):
    return serving.volume_profile(frames.ads(spark, d))


_HOURLY = """SELECT CAST(hour AS BIGINT) AS hour, count(*) AS impression_count, count(*) FILTER (click = 1) AS click_count
FROM ad WHERE hour IS NOT NULL GROUP BY 1"""


@query("hourly_stats", f"SELECT *, {ctr('click_count', 'impression_count')} AS ctr FROM ({_HOURLY})")
def _(spark, d):
    return serving.hourly_stats(frames.ads(spark, d))


@query("latest_hours_topk", f"SELECT *, {ctr('click_count', 'impression_count')} AS ctr FROM ({_HOURLY}) ORDER BY hour DESC LIMIT 24")
def _(spark, d):
    return serving.latest_hours_topk(serving.hourly_stats(frames.ads(spark, d)))


@query("duplicate_ids_topk", """SELECT CAST(id AS VARCHAR) AS id, cnt FROM (SELECT id, count(*) AS cnt FROM ad
GROUP BY id HAVING count(*) > 1 ORDER BY id LIMIT 10)""")
def _(spark, d):
    return serving.duplicate_ids_topk(frames.ads(spark, d))


@query("regex_numeric_check", """SELECT count(*) AS total, count(*) FILTER (regexp_matches(hour, '^[0-9]+$')) AS valid FROM raw""")
def _(spark, d):
    return serving.regex_numeric_check(frames.raw(spark, d, "hour"), "hour")


@query("like_prefix_filter", """SELECT CAST(id AS VARCHAR) AS id, device_id FROM ad WHERE device_id LIKE 'dev_1%'""")
def _(spark, d):
    return serving.like_prefix_filter(frames.ads(spark, d), "device_id", "dev_1%").select("id", "device_id")


@query("loss_check", """SELECT CAST(100 AS BIGINT) AS expected, count(DISTINCT device_id) AS received,
100 - count(DISTINCT device_id) AS lost FROM ad WHERE device_id LIKE 'dev_1%'""")
def _(spark, d):
    return serving.loss_check(frames.ads(spark, d), "device_id", "dev_1%", 100)


@query("alert_ctr_spike", f"SELECT {_F} FROM fact WHERE abs(clicks_dod_pct_change) > 200")
def _(spark, d):
    """A lower limit than the default, which these counts cannot reach."""
    return serving.alert_ctr_spike(frames.facts(spark, d), limit=200)


@query("alert_no_data", f"""SELECT max(event_time) AS newest_event,
CAST(coalesce(max(event_time) < TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR, true) AS BIGINT) AS no_data FROM ad""")
def _(spark, d):
    return serving.alert_no_data(frames.ads(spark, d), AS_OF)


@query("alert_low_ctr", f"SELECT {_F} FROM fact WHERE daily_ctr_percentage < 15")
def _(spark, d):
    return serving.alert_low_ctr(frames.facts(spark, d))


def stored_events(spark, d) -> str:
    """The raw table as its sink writes it, stamped with the event time so that rows can expire."""
    path = scratch_path(spark, "retention")
    events = ad_events_stream(spark, d)

    def sink(batch, batch_id):
        rows = batch.withColumn("created_at", F.col("event_time")).withColumn("event_date", F.to_date("event_time"))
        write_batch(rows, path, batch_id, ["event_date"])

    StreamRun(events, sink, scratch_path(spark, "progress")).catch_up()
    return path


@query("retention_cleanup", """SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, CAST(id AS VARCHAR) AS id, event_time
FROM ad WHERE event_time >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 15 DAY""")
def _(spark, d):
    """A stored table after its clean-up: whole folders dropped, mixed ones rewritten."""
    path = stored_events(spark, d)
    serving.retention_cleanup(spark, path, "2024-01-30 12:00:00", days=15)
    return spark.read.parquet(path).select("event_date", "id", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


OLD = "event_time < TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 15 DAY"


@query("retention_split", f"""SELECT count(*) FILTER ({OLD}) AS deleted_rows, count(*) FILTER (NOT {OLD}) AS kept_rows FROM ad""")
def _(spark, d):
    return serving.retention_split(frames.ads(spark, d), "2024-01-30 12:00:00", 15, "event_time")


@query("dq_freshness_today", "SELECT count(*) AS rows_today FROM ad WHERE event_time >= TIMESTAMP '2024-01-30 00:00:00'")
def _(spark, d):
    return quality.freshness_today(frames.ads(spark, d), "event_time", "2024-01-30 18:00:00")
