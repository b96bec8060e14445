"""Event-time window aggregates; the same code serves batch and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickweir.functions.ratios import ctr_batch, ctr_stream

ONE_MINUTE = "1 minute"
FIVE_MINUTES = "5 minutes"


def tumbling_counts(events: DataFrame, width: str, keys: Sequence[str] = (),
                    event_time: str = "event_time") -> DataFrame:
    """Mergeable counts per window: events that are clicks, and events that are not.

    Counts combine in every task before the shuffle, so a busy window is as cheap
    there as a quiet one, whatever its share of the events.
    """
    grouped = events.groupBy(F.window(event_time, width).alias("window"), *keys)
    return grouped.agg(F.count_if(F.col("click") == 0).alias("impressions"),
                       F.count_if(F.col("click") == 1).alias("clicks"))


def flatten_window(df: DataFrame, *measures: Column | str) -> DataFrame:
    keys = [c for c in df.columns if c not in ("window", "impressions", "clicks")]
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *keys, *measures)


def tumbling_ctr(events: DataFrame, width: str, keys: Sequence[str] = (),
                 event_time: str = "event_time") -> DataFrame:
    """window_start, window_end, [keys], impressions, clicks, ctr (stream rate)."""
    counts = tumbling_counts(events, width, keys, event_time)
    return flatten_window(counts, "impressions", "clicks",
                          ctr_stream(F.col("clicks"), F.col("impressions")).alias("ctr"))


def merge_windows(metrics: DataFrame, width: str) -> DataFrame:
    """Roll finer window metrics up to wider windows: counts add, the rate is redone."""
    merged = metrics.groupBy(F.window("window_start", width).alias("window")).agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"))
    return flatten_window(merged, "impressions", "clicks",
                          ctr_stream(F.col("clicks"), F.col("impressions")).alias("ctr"))


def dimension_counts(events: DataFrame, width: str, dimension: str,
                     event_time: str = "event_time") -> DataFrame:
    """All events and clicks per window and dimension value; a missing value is 'unknown'."""
    value = F.coalesce(F.col(dimension).cast("string"), F.lit("unknown"))
    return events.groupBy(F.window(event_time, width).alias("window"), value.alias("dim")).agg(
        F.count("*").alias("dim_events"), F.count_if(F.col("click") == 1).alias("dim_clicks"))


def assemble_breakdown(counts: DataFrame, map_name: str) -> DataFrame:
    """Window totals plus a map from dimension value to its batch rate. The second
    grouping sees one row per window and dimension value, not events."""
    rate = ctr_batch(F.col("dim_clicks"), F.col("dim_events")).cast("double")
    per_window = counts.groupBy("window").agg(
        F.sum("dim_events").alias("total_impressions"), F.sum("dim_clicks").alias("total_clicks"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("dim"), rate.alias("ctr")))))
        .alias(map_name))
    return per_window.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "total_impressions", "total_clicks",
        ctr_batch(F.col("total_clicks"), F.col("total_impressions")).cast("double").alias("ctr"),
        map_name)


def breakdown_maps(events: DataFrame, width: str, dimension: str, map_name: str,
                   event_time: str = "event_time") -> DataFrame:
    return assemble_breakdown(dimension_counts(events, width, dimension, event_time), map_name)
