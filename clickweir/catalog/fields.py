"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweir.catalog import frames
from clickweir.catalog.registry import query
from clickweir.catalog.sql import ctr, ratio, stream_ctr
from clickweir.functions import payloads, ratios, times
from clickweir.schema import DAILY_GRAIN
from clickweir.sources.driver_tables import read_driver_table

_TS = """make_timestamp(2000 + hour // 1000000, (hour // 10000) % 100, (hour // 100) % 100, hour % 100, 0, 0)"""


@query("parse_hour", f"""SELECT CAST(id AS VARCHAR) AS id, {_TS} AS event_timestamp,
CAST(CAST({_TS} AS DATE) AS VARCHAR) AS event_date, strftime({_TS}, '%H') AS event_hour FROM ad""")
def _(spark, d):
    stamp = times.parse_hour(F.col("hour"))
    return frames.ads(spark, d).select("id", stamp.alias("event_timestamp"),
                                       stamp.cast("date").alias("event_date"),
                                       times.hour_of_day(stamp).alias("event_hour"))


@query("hour_parts", """SELECT CAST(id AS VARCHAR) AS id, CAST(hour // 1000000 + 2000 AS BIGINT) AS year,
CAST((hour // 10000) % 100 AS BIGINT) AS month, CAST((hour // 100) % 100 AS BIGINT) AS day,
CAST(hour % 100 AS BIGINT) AS hour_of_day FROM ad""")
def _(spark, d):
    return frames.ads(spark, d).select("id", *times.hour_parts(F.col("hour")))


@query("event_hour_timestamp", """SELECT CAST(id AS VARCHAR) AS id,
concat(CAST(event_date AS VARCHAR), ' ', event_hour, ':00:00') AS event_hour_timestamp FROM stg""")
def _(spark, d):
    rows = frames.staged(spark, d, "click")
    return rows.select("id", times.event_hour_timestamp(F.col("event_date"), F.col("event_hour"))
                       .alias("event_hour_timestamp"))


@query("ctr_batch", f"""SELECT site_id, device_type, {ctr('clicks', 'n')} AS ctr FROM (SELECT site_id,
CAST(device_type AS BIGINT) AS device_type, count(*) AS n, count(*) FILTER (click = 1) AS clicks FROM ad GROUP BY 1, 2)""")
def _(spark, d):
    counts = frames.ads(spark, d).groupBy("site_id", "device_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("click") == 1).alias("clicks"))
    return counts.select("site_id", "device_type", ratios.ctr_batch(F.col("clicks"), F.col("n")).alias("ctr"))


@query("ctr_stream", f"""SELECT site_id, device_type, {stream_ctr('clicks', 'imps')} AS ctr FROM (SELECT site_id,
CAST(device_type AS BIGINT) AS device_type, count(*) FILTER (click = 0) AS imps,
count(*) FILTER (click = 1) AS clicks FROM ad GROUP BY 1, 2)""")
def _(spark, d):
    counts = frames.ads(spark, d).groupBy("site_id", "device_type").agg(
        F.count_if(F.col("click") == 0).alias("imps"), F.count_if(F.col("click") == 1).alias("clicks"))
    return counts.select("site_id", "device_type",
                         ratios.ctr_stream(F.col("clicks"), F.col("imps")).alias("ctr"))


@query("pct_change", f"""SELECT CAST(event_date AS VARCHAR) AS event_date, site_id, CAST(device_type AS BIGINT) AS device_type,
{ratio('(100 * (daily_total_impressions - prev))', 'prev')} AS impressions_change
FROM (SELECT *, lag(daily_total_impressions) OVER (PARTITION BY site_id, device_type
  ORDER BY event_date, site_domain, site_category) AS prev FROM daily)""")
def _(spark, d):
    from clickweir.plans.marts import day_windows
    by_day, _ = day_windows()
    n = F.col("daily_total_impressions")
    return frames.daily(spark, d).select("event_date", "site_id", "device_type",
                                         ratios.pct_change(n, F.lag(n).over(by_day)).alias("impressions_change"))


@query("click_flag", """SELECT CAST(click AS BIGINT) AS click, CAST(CASE WHEN click = 1 THEN 1 ELSE 0 END AS BIGINT) AS flag,
count(*) AS n_rows FROM ad GROUP BY 1, 2""")
def _(spark, d):
    return frames.ads(spark, d).groupBy("click", ratios.click_flag(F.col("click")).alias("flag")) \
        .agg(F.count("*").alias("n_rows"))


@query("abs_coalesce", """SELECT CAST(event_date AS VARCHAR) AS event_date, site_id, CAST(device_type AS BIGINT) AS device_type,
abs(coalesce(clicks_dod_pct_change, 0.0::DOUBLE)) AS change_size FROM fact""")
def _(spark, d):
    return frames.facts(spark, d).select("event_date", "site_id", "device_type",
                                         ratios.abs_coalesce(F.col("clicks_dod_pct_change")).alias("change_size"))


@query("backoff_ms", """SELECT attempt, n_rows, CASE WHEN attempt <= 0 THEN 0
ELSE CAST(least(1000 * pow(2, attempt - 1), 32000) AS BIGINT) END AS backoff_ms
FROM (SELECT CAST(c14 % 10 AS BIGINT) AS attempt, count(*) AS n_rows FROM ad GROUP BY 1)""")
def _(spark, d):
    attempts = frames.ads(spark, d).groupBy((F.col("c14") % 10).alias("attempt")).agg(F.count("*").alias("n_rows"))
    return attempts.select("attempt", "n_rows", times.backoff_ms(F.col("attempt")).alias("backoff_ms"))


@query("epoch_ms_to_ts", """SELECT event_id, date_trunc('millisecond', ts) AS at FROM events""")
def _(spark, d):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return read_driver_table(spark, d, "events").select("event_id", times.epoch_ms_to_timestamp(ms).alias("at"))


@query("event_to_json", """SELECT CAST(id AS VARCHAR) AS id, '{"id":' || CAST(id AS VARCHAR) || ',"click":' || click
|| ',"site_id":' || coalesce('"' || site_id || '"', 'null') || ',"app_id":' || coalesce('"' || app_id || '"', 'null')
|| '}' AS body FROM ad""")
def _(spark, d):
    return frames.ads(spark, d).select(
        "id", payloads.event_to_json(["id", "click", "site_id", "app_id"]).alias("body"))


@query("json_field_default", """SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'unknown') AS k,
coalesce(json_extract_string(props, '$.missing.id'), 'unknown') AS missing_id FROM events""")
def _(spark, d):
    rows = read_driver_table(spark, d, "events")
    return rows.select("event_id", payloads.json_field_default(F.col("props"), "$.k", "unknown").alias("k"),
                       payloads.json_field_default(F.col("props"), "$.missing.id", "unknown").alias("missing_id"))


@query("audit_columns", """SELECT CAST(event_date AS VARCHAR) AS event_date, site_id, site_domain, site_category, CAST(device_type AS BIGINT) AS device_type,
daily_total_impressions, daily_total_clicks, 1 AS stamped, 1 AS same_stamp FROM daily""")
def _(spark, d):
    """Every row of a write carries the same creation and update stamp."""
    rows = frames.daily(spark, d).select("*", *payloads.audit_columns())
    recent = F.col("created_at").between(F.current_timestamp() - F.expr("INTERVAL 1 HOUR"), F.current_timestamp())
    return rows.select(*DAILY_GRAIN, "daily_total_impressions", "daily_total_clicks", recent.cast("int").alias("stamped"),
                       (F.col("created_at") == F.col("updated_at")).cast("int").alias("same_stamp"))


@query("cross_features", """SELECT concat_ws('|', coalesce(site_id, ''), site_category) AS site_cross,
concat_ws('|', device_type, device_conn_type) AS device_cross, count(*) AS n_rows FROM ad GROUP BY 1, 2""")
def _(spark, d):
    return frames.ads(spark, d).groupBy(
        payloads.cross_feature("site_id", "site_category").alias("site_cross"),
        payloads.cross_feature("device_type", "device_conn_type").alias("device_cross"),
    ).agg(F.count("*").alias("n_rows"))


@query("kpi_ratios", """SELECT site, CAST(cost AS DOUBLE) / nullif(clicks, 0) AS cpc, CAST(cost AS DOUBLE) / nullif(conversions, 0) AS cpa,
CAST(revenue AS DOUBLE) / nullif(cost, 0) AS roas FROM (SELECT user_id % 7 AS site,
CAST(coalesce(sum(CAST(round(value * 100) AS BIGINT)) FILTER (event_type = 'click'), 0) AS BIGINT) AS cost,
CAST(coalesce(sum(CAST(round(value * 100) AS BIGINT)) FILTER (event_type = 'purchase'), 0) AS BIGINT) AS revenue,
count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'purchase') AS conversions
FROM events GROUP BY 1)""")
def _(spark, d):
    """Cost and revenue in cents: a click's value is its cost, a purchase's its revenue."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    kind, zero = F.col("event_type"), F.lit(0).cast("bigint")
    sums = read_driver_table(spark, d, "events").groupBy((F.col("user_id") % 7).alias("site")).agg(
        F.coalesce(F.sum(F.when(kind == "click", cents)), zero).alias("cost"),
        F.coalesce(F.sum(F.when(kind == "purchase", cents)), zero).alias("revenue"),
        F.count_if(kind == "click").alias("clicks"), F.count_if(kind == "purchase").alias("conversions"))
    cost, revenue = F.col("cost"), F.col("revenue")
    return sums.select("site", ratios.cost_per_click(cost, F.col("clicks")).alias("cpc"),
                       ratios.cost_per_action(cost, F.col("conversions")).alias("cpa"),
                       ratios.return_on_ad_spend(revenue, cost).alias("roas"))
