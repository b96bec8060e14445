"""Batch marts: staging, hourly, daily facts, campaign dimension and their relatives.

Plain functions from frame to frame: composed lazily, Catalyst sees one plan from scan
to mart and prunes columns through all of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from clickweir.functions.ratios import (click_flag, ctr_batch, ctr_batch_hundredths,
                                        from_hundredths, pct_change, ratio_2dp)
from clickweir.functions.times import event_hour_timestamp, hour_of_day, parse_hour
from clickweir.operators.dedup import dedup_latest
from clickweir.operators.global_order import surrogate_key
from clickweir.schema import (CAMPAIGN_COLUMNS, CLICK_VALUES, DAILY_GRAIN, EVENT_COLUMNS,
                              HOURLY_GRAIN)

# Ties among equally new copies of an id are broken by these columns in this order.
# A job that needs fewer columns breaks ties by a prefix of the list and so keeps the
# same copy as a job that needs them all, without reading the rest.
TIE_ORDER = ("click", "site_id", "site_domain", "site_category", "device_type",
             "app_id", "app_domain", "app_category", "banner_pos",
             "device_id", "device_ip", "device_model", "device_conn_type",
             "c1", "c14", "c15", "c16", "c17", "c18", "c19", "c20", "c21")


def staging_filter(events: DataFrame) -> DataFrame:
    return events.where(F.col("click").isin(*CLICK_VALUES) & F.col("id").isNotNull()
                        & F.col("hour").isNotNull() & F.col("site_id").isNotNull())


def stage_events(events: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Valid events, newest copy of each id, with timestamp, date and hour.

    `columns` names the event columns the caller needs; the others are not read.
    """
    wanted = [c for c in EVENT_COLUMNS if columns is None or c in columns or c in ("id", "click")]
    last = max((TIE_ORDER.index(c) for c in wanted if c in TIE_ORDER), default=0)
    ties = TIE_ORDER[: last + 1]
    valid = staging_filter(events).withColumn("event_timestamp", parse_hour(F.col("hour")))
    valid = valid.select(*dict.fromkeys([*wanted, *ties, "event_timestamp"]))
    newest = dedup_latest(valid, "id", "event_timestamp", ties)
    stamp = F.col("event_timestamp")
    order = [c for c in wanted if c != "hour"]
    return newest.select(*order[:2], stamp, stamp.cast("date").alias("event_date"),
                         hour_of_day(stamp).alias("event_hour"), *order[2:])


def hourly_filter(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("event_hour").isNotNull() & F.col("site_id").isNotNull())


def hourly_agg(staged: DataFrame) -> DataFrame:
    """Counts, rate and click flags per hour, site and device.

    `no_clicks` keeps its inherited name and formula: the smallest click flag, so 1
    means that every event of the hour was a click.
    """
    flag = click_flag(F.col("click"))
    grouped = hourly_filter(staged).groupBy(*HOURLY_GRAIN).agg(
        F.count("*").alias("total_impressions"), F.sum("click").alias("total_clicks"),
        F.sum(flag).alias("clicks_count"), F.max(flag).alias("has_clicks"),
        F.min(flag).alias("no_clicks"))
    return grouped.select(
        "event_date",
        event_hour_timestamp(F.col("event_date"), F.col("event_hour")).alias("event_hour_timestamp"),
        "site_id", "site_domain", "site_category", "device_type", "total_impressions",
        "total_clicks",
        ctr_batch(F.col("total_clicks"), F.col("total_impressions")).alias("ctr_percentage"),
        "clicks_count", F.col("total_impressions").alias("impressions_count"),
        "has_clicks", "no_clicks")


def _with_daily_rate(daily: DataFrame) -> DataFrame:
    rate = ctr_batch(F.col("daily_total_clicks"), F.col("daily_total_impressions"))
    return daily.select(*DAILY_GRAIN, "daily_total_impressions", "daily_total_clicks",
                        rate.alias("daily_ctr_percentage"), "hours_with_data")


def daily_agg(hourly: DataFrame, unique_hours: bool = False) -> DataFrame:
    """Roll hours up to days. `unique_hours` promises one row per hour and key, as
    `hourly_agg` gives, and turns the distinct count into a plain one."""
    hours = F.count("event_hour_timestamp") if unique_hours else F.count_distinct("event_hour_timestamp")
    return _with_daily_rate(hourly.groupBy(*DAILY_GRAIN).agg(
        F.sum("total_impressions").alias("daily_total_impressions"),
        F.sum("total_clicks").alias("daily_total_clicks"), hours.alias("hours_with_data")))


def daily_agg_direct(staged: DataFrame) -> DataFrame:
    """Days straight from events, without the hourly shuffle: the hours seen are a
    24-bit set, merged by OR and counted by its bits."""
    bit = F.expr("shiftleft(1, cast(event_hour as int))")
    return _with_daily_rate(hourly_filter(staged).groupBy(*DAILY_GRAIN).agg(
        F.count("*").alias("daily_total_impressions"), F.sum("click").alias("daily_total_clicks"),
        F.bit_count(F.bit_or(bit)).cast("bigint").alias("hours_with_data")))


def day_windows():
    """Previous-row and seven-row windows share partitioning and order: one shuffle,
    one sort. Domain and category settle the order of a day's rows."""
    by_day = Window.partitionBy("site_id", "device_type").orderBy(
        F.col("event_date").asc_nulls_last(), F.col("site_domain").asc_nulls_last(),
        F.col("site_category").asc_nulls_last())
    return by_day, by_day.rowsBetween(-6, Window.currentRow)


def with_previous_day(daily: DataFrame) -> DataFrame:
    by_day, _ = day_windows()
    return daily.withColumn("previous_day_clicks", F.lag("daily_total_clicks").over(by_day)) \
        .withColumn("previous_day_ctr", F.lag("daily_ctr_percentage").over(by_day))


def daily_metrics(daily: DataFrame, calendar_days: bool = False) -> DataFrame:
    """Daily facts with day-over-day change and moving averages.

    The averages run over seven rows; with `calendar_days` over the seven calendar
    days up to the row's own, which differs where days are missing.
    """
    by_day, seven = day_windows()
    if calendar_days:
        day_number = F.unix_date("event_date")
        seven = Window.partitionBy("site_id", "device_type").orderBy(day_number).rangeBetween(-6, 0)
    rate = ctr_batch_hundredths(F.col("daily_total_clicks"), F.col("daily_total_impressions"))
    prepared = daily.withColumn("_rate", rate)
    clicks = F.col("daily_total_clicks")
    return prepared.select(
        *DAILY_GRAIN, "daily_total_impressions", "daily_total_clicks", "daily_ctr_percentage",
        "hours_with_data",
        pct_change(clicks, F.lag(clicks).over(by_day)).alias("clicks_dod_pct_change"),
        ratio_2dp(F.sum(clicks).over(seven), F.count(clicks).over(seven))
        .alias("clicks_7day_moving_avg"),
        from_hundredths(_mean_hundredths(F.sum("_rate").over(seven), F.count("_rate").over(seven)))
        .alias("ctr_7day_moving_avg"))


def _mean_hundredths(total, n):
    """Mean of values given in hundredths, itself in whole hundredths."""
    d = F.nullif(n, F.lit(0).cast("bigint"))
    return F.call_function("div", total * 2 + d, d * 2)


def fct_daily_metrics(events: DataFrame) -> DataFrame:
    """The daily fact from events: dedup by id, one aggregate, one window pass."""
    staged = stage_events(events, ("hour", *DAILY_GRAIN))
    return daily_metrics(daily_agg_direct(staged))


def campaign_filter(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("site_id").isNotNull() | F.col("app_id").isNotNull())


def distinct_campaigns(staged: DataFrame) -> DataFrame:
    return campaign_filter(staged).select(*CAMPAIGN_COLUMNS).distinct()


def campaign_surrogate_key(combinations: DataFrame) -> DataFrame:
    return surrogate_key(combinations, ("site_id", "app_id", "banner_pos", "device_type", "site_domain",
                                        "site_category", "app_domain", "app_category"), "campaign_id")


def dim_campaigns(staged: DataFrame) -> DataFrame:
    keyed = campaign_surrogate_key(distinct_campaigns(staged))
    return keyed.select("campaign_id", *CAMPAIGN_COLUMNS, F.lit(1).alias("is_active"))


DEVICE_COLUMNS = ("device_type", "device_conn_type", "device_model")


def dim_devices(staged: DataFrame) -> DataFrame:
    """Device attribute combinations with a dense key."""
    keyed = surrogate_key(staged.select(*DEVICE_COLUMNS).distinct(), DEVICE_COLUMNS, "device_key")
    return keyed.select("device_key", *DEVICE_COLUMNS)


def rate_by(df: DataFrame, *keys: str) -> DataFrame:
    """impressions, clicks and batch rate by the given keys."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("impressions"),
                                   F.sum(click_flag(F.col("click"))).alias("clicks"))
    return counts.withColumn("ctr", ctr_batch(F.col("clicks"), F.col("impressions")))


def mart_hourly_ctr(hourly: DataFrame) -> DataFrame:
    """Rate per hour over all sites and devices."""
    totals = hourly.groupBy("event_hour_timestamp").agg(
        F.sum("total_impressions").alias("impressions"), F.sum("total_clicks").alias("clicks"))
    return totals.withColumn("ctr", ctr_batch(F.col("clicks"), F.col("impressions")))


def campaign_performance(staged: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Impressions, clicks and rate per campaign. Events are counted per combination
    before the join, so the join handles combinations only."""
    from clickweir.operators.joins import fact_to_campaign
    counts = rate_by(staged, *CAMPAIGN_COLUMNS)
    return fact_to_campaign(counts, campaigns, CAMPAIGN_COLUMNS) \
        .select("campaign_id", "impressions", "clicks", "ctr")


def device_stats(staged: DataFrame) -> DataFrame:
    return rate_by(staged, "event_date", "device_type")
