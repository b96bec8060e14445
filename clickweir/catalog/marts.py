"""Mart queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweir.catalog import frames
from clickweir.catalog.registry import query
from clickweir.catalog.sql import ctr
from clickweir.operators import joins
from clickweir.operators.windows import ONE_MINUTE
from clickweir.plans import exploration, marts, serving
from clickweir.schema import CAMPAIGN_COLUMNS, EVENT_COLUMNS, EVENT_TYPES
from clickweir.session import scratch_path, stored
from clickweir.sources import tables
from clickweir.sources.driver_tables import ad_events_stream
from clickweir.streaming import jobs

_DAY = "CAST(event_date AS VARCHAR) AS event_date"
_KEYS = f"{_DAY}, site_id, site_domain, site_category, CAST(device_type AS BIGINT) AS device_type"


def _event_col(c: str) -> str:
    if c == "id":
        return "CAST(id AS VARCHAR) AS id"
    return f"CAST({c} AS BIGINT) AS {c}" if EVENT_TYPES[c] == "int" else c


_STG = ", ".join(_event_col(c) for c in EVENT_COLUMNS if c != "hour")


@query("staging_filter", """SELECT CAST(id AS VARCHAR) AS id, CAST(click AS BIGINT) AS click,
CAST(hour AS BIGINT) AS hour, site_id FROM valid""")
def _(spark, d):
    return marts.staging_filter(frames.ads(spark, d)).select("id", "click", "hour", "site_id")


@query("stg_ad_events", f"SELECT {_STG}, event_timestamp, {_DAY}, event_hour FROM stg")
def _(spark, d):
    """Cleaned, de-duplicated events with all their columns."""
    return frames.staged(spark, d)


@query("dedup_latest", "SELECT CAST(id AS VARCHAR) AS id, CAST(click AS BIGINT) AS click, event_timestamp FROM stg")
def _(spark, d):
    return frames.staged(spark, d, "click").select("id", "click", "event_timestamp")


@query("hourly_filter", "SELECT event_hour, count(*) AS n_rows FROM stg GROUP BY 1")
def _(spark, d):
    return marts.hourly_filter(frames.staged(spark, d, "site_id")).groupBy("event_hour") \
        .agg(F.count("*").alias("n_rows"))


@query("hourly_agg", f"""SELECT {_KEYS}, event_hour_timestamp, total_impressions, total_clicks, ctr_percentage, clicks_count,
impressions_count, has_clicks, no_clicks FROM hourly""")
def _(spark, d):
    return frames.hourly(spark, d)


_DAILY = f"SELECT {_KEYS}, daily_total_impressions, daily_total_clicks, daily_ctr_percentage, hours_with_data FROM daily"


@query("daily_agg", _DAILY)
def _(spark, d):
    """Days rolled up from the hourly aggregate."""
    return marts.daily_agg(frames.hourly(spark, d), unique_hours=True)


@query("daily_agg_direct", _DAILY)
def _(spark, d):
    """The same days straight from events, one shuffle less."""
    return frames.daily(spark, d)


@query("hours_with_data", f"SELECT {_KEYS}, hours_with_data FROM daily")
def _(spark, d):
    return marts.daily_agg(frames.hourly(spark, d)).select(*marts.DAILY_GRAIN, "hours_with_data")


@query("fct_daily_metrics", f"""SELECT {_KEYS}, daily_total_impressions, daily_total_clicks, daily_ctr_percentage,
hours_with_data, clicks_dod_pct_change, clicks_7day_moving_avg, ctr_7day_moving_avg FROM fact""")
def _(spark, d):
    """Flagship: daily facts from raw events."""
    return frames.facts(spark, d)


@query("lag_clicks", f"SELECT {_KEYS}, daily_total_clicks, previous_day_clicks FROM lagged")
def _(spark, d):
    return marts.with_previous_day(frames.daily(spark, d)).select(
        *marts.DAILY_GRAIN, "daily_total_clicks", "previous_day_clicks")


@query("lag_ctr", f"SELECT {_KEYS}, daily_ctr_percentage, previous_day_ctr FROM lagged")
def _(spark, d):
    return marts.with_previous_day(frames.daily(spark, d)).select(
        *marts.DAILY_GRAIN, "daily_ctr_percentage", "previous_day_ctr")


def _fact_column(key: str) -> None:
    column = {"dod_change": "clicks_dod_pct_change", "moving_avg_clicks": "clicks_7day_moving_avg",
              "moving_avg_ctr": "ctr_7day_moving_avg"}[key]

    @query(key, f"SELECT {_KEYS}, {column} FROM fact")
    def _(spark, d):
        return frames.facts(spark, d).select(*marts.DAILY_GRAIN, column)


for _key in ("dod_change", "moving_avg_clicks", "moving_avg_ctr"):
    _fact_column(_key)


@query("moving_avg_calendar", f"""SELECT {_KEYS}, ((200 * c7 + n7) // (2 * n7)) / 100.0::DOUBLE AS clicks_7day_moving_avg
FROM (SELECT *, CAST(sum(daily_total_clicks) OVER w AS BIGINT) AS c7, count(*) OVER w AS n7 FROM daily
  WINDOW w AS (PARTITION BY site_id, device_type ORDER BY event_date
               RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW))""")
def _(spark, d):
    """The averages over calendar days instead of rows."""
    return marts.daily_metrics(frames.daily(spark, d), calendar_days=True).select(
        *marts.DAILY_GRAIN, "clicks_7day_moving_avg")


_COMBO = ", ".join(f"CAST({c} AS BIGINT) AS {c}" if EVENT_TYPES[c] == "int" else c for c in CAMPAIGN_COLUMNS)


@query("campaign_filter", f"SELECT CAST(id AS VARCHAR) AS id, site_id, app_id FROM stg WHERE site_id IS NOT NULL OR app_id IS NOT NULL")
def _(spark, d):
    return marts.campaign_filter(frames.staged(spark, d, "site_id", "app_id")).select("id", "site_id", "app_id")


@query("distinct_campaigns", f"SELECT {_COMBO} FROM combos")
def _(spark, d):
    return marts.distinct_campaigns(frames.staged_for_campaigns(spark, d))


@query("campaign_surrogate_key", f"SELECT campaign_id, {_COMBO} FROM dim")
def _(spark, d):
    combos = marts.distinct_campaigns(frames.staged_for_campaigns(spark, d))
    return marts.campaign_surrogate_key(combos)


@query("dim_campaigns", f"SELECT campaign_id, {_COMBO}, CAST(is_active AS BIGINT) AS is_active FROM dim")
def _(spark, d):
    return frames.campaigns(spark, d)


@query("dim_devices", """SELECT row_number() OVER (ORDER BY device_type NULLS LAST, device_conn_type NULLS LAST,
device_model NULLS LAST) AS device_key, CAST(device_type AS BIGINT) AS device_type,
CAST(device_conn_type AS BIGINT) AS device_conn_type, device_model
FROM (SELECT DISTINCT device_type, device_conn_type, device_model FROM stg)""")
def _(spark, d):
    return marts.dim_devices(frames.staged(spark, d, *marts.DEVICE_COLUMNS))


_RATE = ctr("clicks", "impressions")


@query("mart_hourly_ctr", f"""SELECT event_hour_timestamp, impressions, clicks, {_RATE} AS ctr FROM (
SELECT event_hour_timestamp, CAST(sum(total_impressions) AS BIGINT) AS impressions,
CAST(sum(total_clicks) AS BIGINT) AS clicks FROM hourly GROUP BY 1)""")
def _(spark, d):
    return marts.mart_hourly_ctr(frames.hourly(spark, d))


@query("device_stats", f"""SELECT {_DAY}, device_type, impressions, clicks, {_RATE} AS ctr FROM (
SELECT event_date, CAST(device_type AS BIGINT) AS device_type, count(*) AS impressions,
CAST(sum(click) AS BIGINT) AS clicks FROM stg GROUP BY 1, 2)""")
def _(spark, d):
    return marts.device_stats(frames.staged(spark, d, "click", "device_type"))


@query("daily_device_agg", f"""SELECT {_DAY}, device_type, impressions, clicks, {_RATE} AS ctr FROM (
SELECT event_date, CAST(device_type AS BIGINT) AS device_type, CAST(sum(daily_total_impressions) AS BIGINT) AS impressions,
CAST(sum(daily_total_clicks) AS BIGINT) AS clicks FROM daily GROUP BY 1, 2)""")
def _(spark, d):
    """Days by device, rolled up from the daily aggregate."""
    totals = frames.daily(spark, d).groupBy("event_date", "device_type").agg(
        F.sum("daily_total_impressions").alias("impressions"), F.sum("daily_total_clicks").alias("clicks"))
    return totals.withColumn("ctr", marts.ctr_batch(F.col("clicks"), F.col("impressions")))


_ON = " AND ".join(f"s.{c} IS NOT DISTINCT FROM k.{c}" for c in CAMPAIGN_COLUMNS)


@query("campaign_performance", f"""SELECT campaign_id, impressions, clicks, {_RATE} AS ctr FROM (
SELECT k.campaign_id, count(*) AS impressions, CAST(sum(s.click) AS BIGINT) AS clicks
FROM stg s JOIN dim k ON {_ON} GROUP BY 1)""")
def _(spark, d):
    staged = stored(frames.staged_for_campaigns(spark, d), "staged")
    return marts.campaign_performance(staged, stored(marts.dim_campaigns(staged), "campaigns"))


@query("fact_to_campaign", f"""SELECT CAST(s.id AS VARCHAR) AS id, CAST(s.click AS BIGINT) AS click, k.campaign_id
FROM stg s LEFT JOIN dim k ON {_ON}""")
def _(spark, d):
    events = stored(frames.staged_for_campaigns(spark, d), "staged")
    joined = joins.fact_to_campaign(events, stored(marts.dim_campaigns(events), "campaigns"), CAMPAIGN_COLUMNS)
    return joined.select("id", "click", "campaign_id")


@query("relationship_orphans", """SELECT device_ip AS orphan_value, count(*) AS n_rows FROM ad
WHERE device_ip NOT IN (SELECT device_ip FROM stg WHERE click = 1) GROUP BY 1""")
def _(spark, d):
    """Addresses in the feed that never clicked after cleaning."""
    clicked = frames.staged(spark, d, "click", "device_ip").where("click = 1")
    return joins.relationship_orphans(frames.ads(spark, d), "device_ip", clicked, "device_ip")


@query("events_to_metrics", """SELECT CAST(a.id AS VARCHAR) AS id, a.event_time, m.window_start, m.impressions, m.clicks, m.ctr
FROM ad a JOIN m1 m ON time_bucket(INTERVAL 1 MINUTE, a.event_time) = m.window_start""")
def _(spark, d):
    joined = joins.events_to_metrics(frames.ads(spark, d).select("id", "event_time"),
                                     stored(frames.metrics_1min(spark, d), "metrics"), ONE_MINUTE)
    return joined.select("id", "event_time", "window_start", "impressions", "clicks", "ctr")


def stored_minutes(spark, d, path: str | None = None):
    """The one-minute stream run with its sink, and the table it has written."""
    path = path or scratch_path(spark, "metrics")
    frame = jobs.ctr_metrics_stream(ad_events_stream(spark, d), ONE_MINUTE)
    jobs.StreamRun(frame, jobs.versions_sink(path), scratch_path(spark, "progress"), "update").catch_up()
    return jobs.read_metrics(spark, path, frame.schema)


@query("batch_vs_stream_reconcile", """SELECT hour_start, coalesce(b.clicks, 0) AS batch_clicks, coalesce(s.clicks, 0) AS stream_clicks,
coalesce(b.events, 0) AS batch_events, coalesce(s.events, 0) AS stream_events,
coalesce(b.clicks, 0) - coalesce(s.clicks, 0) AS clicks_diff,
CAST(coalesce(b.clicks, 0) = coalesce(s.clicks, 0) AS BIGINT) AS matched
FROM (SELECT CAST(event_hour_timestamp AS TIMESTAMP) AS hour_start, CAST(sum(total_clicks) AS BIGINT) AS clicks,
      CAST(sum(total_impressions) AS BIGINT) AS events FROM hourly GROUP BY 1) b
FULL JOIN (SELECT date_trunc('hour', window_start) AS hour_start, CAST(sum(clicks) AS BIGINT) AS clicks,
      CAST(sum(clicks + impressions) AS BIGINT) AS events FROM m1 GROUP BY 1) s USING (hour_start)""")
def _(spark, d):
    """Hourly batch totals against the windows that the one-minute stream has stored."""
    batch = frames.hourly(spark, d).groupBy(
        F.col("event_hour_timestamp").cast("timestamp_ntz").alias("hour_start")).agg(
        F.sum("total_clicks").alias("clicks"), F.sum("total_impressions").alias("events"))
    metrics = stored_minutes(spark, d)
    stream = metrics.groupBy(F.window("window_start", "1 hour")["start"].alias("hour_start")).agg(
        F.sum("clicks").alias("clicks"), F.sum(F.col("clicks") + F.col("impressions")).alias("events"))
    return joins.batch_vs_stream_reconcile(batch, stream, "hour_start")


@query("materialize_table", f"""SELECT {_KEYS}, event_hour_timestamp, total_impressions, total_clicks, ctr_percentage, clicks_count,
impressions_count, has_clicks, no_clicks, 1 AS loaded FROM hourly""")
def _(spark, d):
    """Hourly table written by day; one day, which was written wrong, is redone from the staging of that day alone."""
    staging, path = scratch_path(spark, "staging"), scratch_path(spark, "hourly")
    staged = tables.materialize_table(frames.staged_for_marts(spark, d), staging)
    wrong = staged.where("event_date <> DATE '2024-01-10' OR click = 1")
    table = tables.materialize_table(marts.hourly_agg(wrong), path, loaded_at="loaded_at")
    day = marts.hourly_agg(staged.where("event_date = DATE '2024-01-10'"))
    tables.materialize_table(day, path, loaded_at="loaded_at", refresh="partitions")
    return spark.read.schema(table.schema).parquet(path) \
        .withColumn("loaded", F.col("loaded_at").isNotNull().cast("int")).drop("loaded_at")


@query("ctr_bounds", """SELECT count(*) AS n_rows, min(daily_ctr_percentage) AS min_ctr,
max(daily_ctr_percentage) AS max_ctr FROM fact""")
def _(spark, d):
    return serving.ctr_bounds(frames.daily(spark, d))


@query("count_by_hour", "SELECT CAST(hour AS BIGINT) AS hour, count(*) AS n_rows FROM ad WHERE hour IS NOT NULL GROUP BY 1")
def _(spark, d):
    return exploration.count_by_hour(frames.ads(spark, d))


@query("count_by_site", "SELECT site_id, count(*) AS n_rows FROM ad GROUP BY 1")
def _(spark, d):
    return exploration.count_by_site(frames.ads(spark, d))


@query("count_events", "SELECT count(*) AS n_rows FROM ad")
def _(spark, d):
    return frames.ads(spark, d).agg(F.count("*").alias("n_rows"))
