"""The hour code and other time columns.

Batch code uses timestamps without time zone, so no result depends on the
session's zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by)).cast("int")


def parse_hour(hour: Column) -> Column:
    """Hour code to timestamp: 8 digits YYMMDDHH or 10 digits YYYYMMDDHH, else NULL."""
    hour = hour.cast("bigint")
    year = (F.when(hour.between(10_000_000, 99_999_999), _div(hour, 1_000_000) + 2000)
            .when(hour.between(1_000_000_000, 9_999_999_999), _div(hour, 1_000_000)))
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(year, _div(hour, 10_000) % 100, _div(hour, 100) % 100,
                                    (hour % 100).cast("int"), zero, zero)


def hour_of_day(timestamp: Column) -> Column:
    """Two-digit 24-hour text."""
    return F.lpad(F.hour(timestamp).cast("string"), 2, "0")


def hour_parts(hour: Column) -> list[Column]:
    """Year, month, day and hour of an 8-digit code, by div and mod alone."""
    return [
        (_div(hour, 1_000_000) + 2000).alias("year"),
        (_div(hour, 10_000) % 100).alias("month"),
        (_div(hour, 100) % 100).alias("day"),
        (hour % 100).cast("int").alias("hour_of_day"),
    ]


def event_hour_timestamp(event_date: Column, event_hour: Column) -> Column:
    """'YYYY-MM-DD HH:00:00'; a missing part is skipped, not turned into NULL."""
    return F.concat(F.coalesce(event_date.cast("string"), F.lit("")), F.lit(" "),
                    F.coalesce(event_hour, F.lit("")), F.lit(":00:00"))


def epoch_ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def backoff_ms(attempt: Column, base_ms: int = 1000, cap_ms: int = 32000) -> Column:
    """min(base * 2^(attempt-1), cap); 0 before the first retry."""
    # the exponent is bounded so that a wild counter cannot overflow the product
    exponent = F.least(attempt - 1, F.lit(31)).cast("double")
    raised = (F.lit(float(base_ms)) * F.pow(F.lit(2.0), exponent)).cast("bigint")
    return F.when(attempt <= 0, F.lit(0).cast("bigint")).otherwise(
        F.least(raised, F.lit(cap_ms).cast("bigint")))
