"""Rates, changes and averages, exact to two decimals.

Two-decimal results are computed as whole hundredths with integer division, half
away from zero. That is what an exact numeric type gives, needs no wide decimal
division, and does not depend on how an engine rounds binary floats.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hundredths(numerator: Column, denominator: Column) -> Column:
    """round(numerator / denominator, 2) * 100 as bigint; NULL when denominator is 0 or NULL."""
    n = numerator.cast("bigint")
    d = F.nullif(F.abs(denominator.cast("bigint")), F.lit(0).cast("bigint"))
    sign = F.signum(n.cast("double")) * F.signum(denominator.cast("double"))
    # `div` keeps bigint; magnitudes stay far below 2^63 for counts up to 10^14
    magnitude = F.call_function("div", F.abs(n) * 200 + d, d * 2)
    return magnitude * sign.cast("bigint")


def from_hundredths(value: Column) -> Column:
    """Whole hundredths to decimal with two places."""
    return (value.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def ratio_2dp(numerator: Column, denominator: Column) -> Column:
    return from_hundredths(hundredths(numerator, denominator))


def ctr_batch(clicks: Column, events: Column) -> Column:
    """Batch rate: percent of all events that are clicks, 2 dp, NULL without events."""
    return ratio_2dp(clicks.cast("bigint") * 100, events)


def ctr_batch_hundredths(clicks: Column, events: Column) -> Column:
    return hundredths(clicks.cast("bigint") * 100, events)


def ctr_stream(clicks: Column, impressions: Column) -> Column:
    """Stream rate: clicks per hundred non-click events, 0.0 when there are none.

    Not a share: it can exceed 100. Never mix it with `ctr_batch`.
    """
    clicks, impressions = clicks.cast("double"), impressions.cast("double")
    return F.when(impressions > 0, clicks / impressions * 100).otherwise(F.lit(0.0))


def pct_change(current: Column, previous: Column) -> Column:
    """Percent change, 2 dp; NULL when there is no previous value or it is zero."""
    change = (current.cast("bigint") - previous.cast("bigint")) * 100
    return ratio_2dp(change, previous)


def abs_coalesce(value: Column, default: int = 0) -> Column:
    return F.abs(F.coalesce(value, F.lit(default)))


def click_flag(click: Column) -> Column:
    return F.when(click == 1, 1).otherwise(0)


def cost_per_click(cost: Column, clicks: Column) -> Column:
    return F.try_divide(cost, clicks)


def cost_per_action(cost: Column, conversions: Column) -> Column:
    return F.try_divide(cost, conversions)


def return_on_ad_spend(revenue: Column, cost: Column) -> Column:
    return F.try_divide(revenue, cost)
