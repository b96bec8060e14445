"""Serving queries over metric and mart tables.

`as_of` is always an argument. Given as a literal it folds into a plain comparison
that prunes partitions and reaches the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clickweir.functions.ratios import ctr_batch, ratio_2dp
from clickweir.session import delete_path, stored
from clickweir.sources.compaction import compact
from clickweir.sources.tables import compact_versions, leaf_folders, versions_schema

# --- fixed values: how long cached metrics live, alert limits -------------------
TTL_MINUTES = {"1min": 5, "5min": 25}
SPIKE_LIMIT_PCT = 1000
LOW_CTR_LIMIT_PCT = 15
RETENTION_DAYS = 90
# --------------------------------------------------------------------------------


def as_time(as_of: str | Column, kind: str = "timestamp_ntz") -> Column:
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast(kind)


def recent_window_filter(metrics: DataFrame, as_of, interval: str,
                         column: str = "window_start") -> DataFrame:
    return metrics.where(F.col(column) >= as_time(as_of) - F.expr(f"INTERVAL {interval}"))


def latest_ctr(metrics: DataFrame, as_of, interval: str) -> DataFrame:
    """Recent windows, newest first."""
    return recent_window_filter(metrics, as_of, interval).orderBy(F.col("window_start").desc())


def latest_ctr_1min(metrics: DataFrame, as_of) -> DataFrame:
    return latest_ctr(metrics, as_of, "1 HOUR")


def latest_ctr_5min(metrics: DataFrame, as_of) -> DataFrame:
    return latest_ctr(metrics, as_of, "2 HOURS")


def register_views(metrics_1min: DataFrame, metrics_5min: DataFrame, as_of) -> None:
    latest_ctr_1min(metrics_1min, as_of).createOrReplaceTempView("latest_ctr_1min")
    latest_ctr_5min(metrics_5min, as_of).createOrReplaceTempView("latest_ctr_5min")


def avg_ctr_window(metrics: DataFrame, as_of, interval: str = "1 HOUR") -> DataFrame:
    return recent_window_filter(metrics, as_of, interval).agg(F.avg("ctr").alias("avg_ctr"))


def current_metrics_union(metrics_1min: DataFrame, metrics_5min: DataFrame, as_of) -> DataFrame:
    """Metrics still alive: written no longer ago than their time to live. A window
    counts as written when it closes."""
    def alive(df: DataFrame, kind: str) -> DataFrame:
        floor = as_time(as_of) - F.expr(f"INTERVAL {TTL_MINUTES[kind]} MINUTES")
        return df.where((F.col("window_end") > floor) & (F.col("window_end") <= as_time(as_of))) \
            .withColumn("window_type", F.lit(kind))
    return alive(metrics_1min, "1min").unionByName(alive(metrics_5min, "5min"))


def metrics_comparison(current: DataFrame) -> DataFrame:
    return current.groupBy("window_type").agg(
        F.count("*").alias("n_windows"), F.avg("ctr").alias("avg_ctr"),
        F.sum("impressions").alias("total_impressions"), F.sum("clicks").alias("total_clicks"))


def metrics_filter(facts: DataFrame, start: str, end: str, site_id: str | None = None,
                   device_type: int | None = None) -> DataFrame:
    """Facts in a date range, optionally of one site and device, newest first."""
    rows = facts.where(F.col("event_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if site_id is not None:
        rows = rows.where(F.col("site_id") == site_id)
    if device_type is not None:
        rows = rows.where(F.col("device_type") == device_type)
    return rows.select("event_date", "site_id", "device_type", "daily_ctr_percentage",
                       "daily_total_clicks", "daily_total_impressions") \
        .orderBy(F.col("event_date").desc(), "site_id", "device_type")


def last_30_days(facts: DataFrame, as_of: str) -> DataFrame:
    start = F.date_sub(as_time(as_of, "date"), 30)
    return facts.where(F.col("event_date") >= start).orderBy(F.col("event_date").desc())


def overall_ctr(events: DataFrame) -> DataFrame:
    totals = events.where(F.col("click").isin(0, 1)).agg(
        F.count("*").alias("total"), F.count_if(F.col("click") == 1).alias("clicks"))
    return totals.withColumn("ctr", ctr_batch(F.col("clicks"), F.col("total")))


def ctr_bounds(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count("*").alias("n_rows"), F.min("daily_ctr_percentage").alias("min_ctr"),
                     F.max("daily_ctr_percentage").alias("max_ctr"))


def volume_profile(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Total, distinct hours and sites, average per hour. The approximate form needs
    one pass and constant memory per task."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    stats = events.agg(F.count("*").alias("total_records"), distinct("hour").alias("unique_hours"),
                       distinct("site_id").alias("unique_sites"))
    return stats.withColumn("avg_per_hour", ratio_2dp(
        F.col("total_records"), F.greatest(F.lit(1).cast("bigint"), F.col("unique_hours"))))


def hourly_stats(events: DataFrame) -> DataFrame:
    counts = events.where(F.col("hour").isNotNull()).groupBy("hour").agg(
        F.count("*").alias("impression_count"), F.count_if(F.col("click") == 1).alias("click_count"))
    return counts.withColumn("ctr", ctr_batch(F.col("click_count"), F.col("impression_count")))


def latest_hours_topk(stats: DataFrame, k: int = 24) -> DataFrame:
    return stats.orderBy(F.col("hour").desc()).limit(k)


def duplicate_ids_topk(events: DataFrame, k: int = 10) -> DataFrame:
    """First k repeated ids in id order."""
    return events.groupBy("id").agg(F.count("*").alias("cnt")).where("cnt > 1") \
        .orderBy("id").limit(k)


def regex_numeric_check(df: DataFrame, column: str = "banner_pos") -> DataFrame:
    """Rows, and rows whose text is digits only."""
    numeric = F.col(column).cast("string").rlike("^[0-9]+$")
    return df.agg(F.count("*").alias("total"), F.count_if(numeric).alias("valid"))


def like_prefix_filter(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(F.col(column).cast("string").like(pattern))


def loss_check(df: DataFrame, column: str, pattern: str, expected: int) -> DataFrame:
    """Distinct keys that arrived under a pattern against the number sent."""
    return like_prefix_filter(df, column, pattern).agg(F.count_distinct(column).alias("received")) \
        .select(F.lit(expected).alias("expected"), "received",
                (F.lit(expected) - F.col("received")).alias("lost"))


# --- alerts ----------------------------------------------------------------------

def alert_ctr_spike(facts: DataFrame, limit: float = SPIKE_LIMIT_PCT) -> DataFrame:
    return facts.where(F.abs(F.col("clicks_dod_pct_change")) > limit)


def alert_no_data(events: DataFrame, as_of, event_time: str = "event_time",
                  interval: str = "1 HOUR") -> DataFrame:
    """One row: newest event and whether it is older than the interval (or missing)."""
    floor = as_time(as_of) - F.expr(f"INTERVAL {interval}")
    newest = events.agg(F.max(event_time).alias("newest_event"))
    return newest.withColumn("no_data", F.coalesce((F.col("newest_event") < floor), F.lit(True))
                             .cast("int"))


def alert_low_ctr(facts: DataFrame, limit: float = LOW_CTR_LIMIT_PCT) -> DataFrame:
    return facts.where(F.col("daily_ctr_percentage") < limit)


# --- retention -------------------------------------------------------------------

def expired(as_of, days: int = RETENTION_DAYS, column: str = "created_at") -> Column:
    """Older than the retention. A row without a stamp is kept."""
    floor = as_time(as_of) - F.make_dt_interval(F.lit(days))
    return F.coalesce(F.col(column) < floor, F.lit(False))


def retention_split(rows: DataFrame, as_of, days: int = RETENTION_DAYS,
                    column: str = "created_at") -> DataFrame:
    """How many rows a clean-up deletes and keeps."""
    old = expired(as_of, days, column)
    return rows.agg(F.count_if(old).alias("deleted_rows"), F.count_if(~old).alias("kept_rows"))


def retention_cleanup(spark: SparkSession, path: str, as_of, days: int = RETENTION_DAYS,
                      column: str = "created_at") -> int:
    """Delete expired rows of a stored table; return how many.

    Works by leaf folder, whatever partition columns the table has: one scan tells which folders
    are expired altogether (dropped), which are mixed (rewritten from a stored copy of their
    survivors) and which are untouched. Appends go to folders of their own, so they
    are not lost meanwhile. Running it again finishes a clean-up that was cut short.
    """
    table, layout = leaf_folders(spark.read.parquet(path), path)
    old = expired(as_of, days, column)
    per_folder = table.groupBy("_folder").agg(
        F.count_if(old).alias("old"), F.count_if(~old).alias("kept")).where("old > 0")
    # one row per folder that has anything to delete
    affected = per_folder.collect()
    mixed = [r["_folder"] for r in affected if r["kept"] > 0 or not layout]
    if mixed:
        survivors = stored(table.where(F.col("_folder").isin(mixed) & ~old).drop("_folder"))
        if layout:
            survivors.hint("rebalance", *[F.col(c) for c in layout]).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy(*layout).parquet(path)
        else:
            survivors.write.mode("overwrite").parquet(path)
    for row in affected:
        if row["kept"] == 0 and layout:
            delete_path(spark, unquote(row["_folder"]))
    return sum(r["old"] for r in affected)


def optimize_tables(spark: SparkSession, path: str, as_of, metrics: Mapping[str, tuple[str, T.StructType]] = MappingProxyType({}),
                    name: str = "ad_events") -> DataFrame:
    """Compact the closed days of the raw table and of tables of metric versions, given by name with their path
    and the schema of their rows; (table_name, status) rows."""
    day = str(as_of)[:10]
    compact(spark, path, before=day)
    for at, schema in metrics.values():
        compact_versions(spark, at, versions_schema(schema), ["window_start"], day)
    return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in (name, *metrics)])).alias("table_name"),
                                 F.lit("Optimized").alias("status"))


def maintenance(spark: SparkSession, path: str, as_of, days: int = RETENTION_DAYS, column: str = "created_at",
                metrics: Mapping[str, tuple[str, T.StructType]] = MappingProxyType({})) -> DataFrame:
    """Clean up the raw table, optimise it and the metric tables, and report the steps."""
    deleted = retention_cleanup(spark, path, as_of, days, column)
    optimized = optimize_tables(spark, path, as_of, metrics)
    return maintenance_report(spark.range(1).select(F.lit(deleted).alias("deleted_rows")), optimized)


def maintenance_report(deleted: DataFrame, optimized: DataFrame | None = None) -> DataFrame:
    """(step, details) rows of a maintenance run from its `deleted_rows` count and the status of each optimised table."""
    step = deleted.select(F.lit("cleanup_events").alias("step"), F.col("deleted_rows").cast("string").alias("details"))
    if optimized is not None:
        step = step.unionAll(optimized.select(F.lit("optimize_tables"), "status"))
    return step.unionAll(deleted.select(F.lit("status"), F.lit("Maintenance completed")))
