"""Distinct counts and quantiles of any range of hours from stored sketches.

Each hour has one row: a theta sketch of the devices and a KLL sketch of a measure. Sketches unite without loss, so a range is
answered from its hours' rows; the events are not read. A theta sketch keeps 2**LG_DEVICES hashes: up to so many
devices the count is exact, beyond that its error is about 1 / sqrt(2**LG_DEVICES), 0.4 %. A quantile's rank is off by at most RANK_ERROR.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LG_DEVICES = 16
KLL_K = 800
RANK_ERROR = 0.005     # of a KLL sketch of this size, with 99 % confidence


def hourly_sketches(events: DataFrame, time: str = "event_time", device: str = "device_ip", measure: str = "c14") -> DataFrame:
    """hour_start, day, events, devices, measures: a row per hour; sketches are built before the shuffle and united behind it."""
    hour = F.date_trunc("hour", F.col(time).cast("timestamp"))
    return events.groupBy(hour.alias("hour_start")).agg(
        F.count("*").alias("events"), F.theta_sketch_agg(device, LG_DEVICES).alias("devices"),
        F.kll_sketch_agg_bigint(F.col(measure).cast("bigint"), KLL_K).alias("measures")) \
        .withColumn("day", F.to_date("hour_start"))


def of_range(sketches: DataFrame, start: str, end: str) -> DataFrame:
    """Hours from `start` up to `end`; whole days are pruned by their folder."""
    first, last = (F.lit(x).cast("timestamp") for x in (start, end))
    return sketches.where((F.col("hour_start") >= first) & (F.col("hour_start") < last)
                          & F.col("day").between(F.to_date(first), F.to_date(last)))


def _devices() -> Column:
    return F.theta_union_agg("devices", LG_DEVICES)


def range_summary(sketches: DataFrame, start: str, end: str, quantiles: tuple[float, ...] = (0.25, 0.5, 0.95)) -> DataFrame:
    """events, devices and the quantiles q25, q50, ... of the measure in a range."""
    row = of_range(sketches, start, end).agg(F.sum("events").alias("events"), _devices().alias("d"), F.kll_merge_agg_bigint("measures", KLL_K).alias("m"))
    return row.select("events", F.theta_sketch_estimate("d").alias("devices"),
                      *[F.kll_sketch_get_quantile_bigint("m", F.lit(q)).alias(f"q{round(100 * q)}") for q in quantiles])


def returning_devices(sketches: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Devices of each of two ranges, of both, and of either."""
    a, b = (of_range(sketches, *r).agg(_devices().alias(n)) for r, n in ((first, "a"), (second, "b")))
    both = a.select("a", F.lit(1).alias("one")).join(b.select("b", F.lit(1).alias("one")), "one")     # one row each
    return both.select(F.theta_sketch_estimate("a").alias("first"), F.theta_sketch_estimate("b").alias("second"),
                       F.theta_sketch_estimate(F.theta_intersection("a", "b")).alias("returning"),
                       F.theta_sketch_estimate(F.theta_union("a", "b", F.lit(LG_DEVICES))).alias("either"))
