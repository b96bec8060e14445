"""Joins. There is no hidden broadcast: a side is broadcast only after its estimated size
was held against a bound, and every join also works as a shuffle join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Bytes by the planner's estimate, which for a stored table is the size of its files;
# beyond it the join shuffles and skew handling applies.
BROADCAST_BYTES = 16 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The planner's upper estimate of a frame's size; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint if the planner estimates the frame at `max_bytes` or less, else the
    frame itself. Estimates of joins and aggregates are far too large, so small results
    should be stored first."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def missing_keys(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `new` whose key is not stored; NULL key parts match each other."""
    stored = stored.select(*keys)
    return new.join(stored, null_safe(new, stored, keys), "left_anti")


def relationship_orphans(child: DataFrame, child_col: str, parent: DataFrame,
                         parent_col: str) -> DataFrame:
    """Child values without a parent, with the number of child rows that carry them.

    Children collapse to one row per value before the join, so a value held by a
    third of all rows costs the join no more than any other.
    """
    values = (child.where(F.col(child_col).isNotNull())
              .groupBy(F.col(child_col).alias("orphan_value")).agg(F.count("*").alias("n_rows")))
    parents = parent.select(F.col(parent_col).alias("_parent")).distinct()
    return values.join(parents, F.col("orphan_value") == F.col("_parent"), "left_anti")


def fact_to_campaign(facts: DataFrame, campaigns: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach `campaign_id` on the null-safe campaign key."""
    side = broadcast_if_small(campaigns.select("campaign_id", *keys))
    return facts.join(side, null_safe(facts, side, keys), "left").select(
        *[facts[c] for c in facts.columns], "campaign_id")


def events_to_metrics(events: DataFrame, metrics: DataFrame, width: str = "1 minute",
                      event_time: str = "event_time") -> DataFrame:
    """Each event with the window metric it was counted in. Windows are unique on the
    metric side, so this is an equi-join that never multiplies rows."""
    keyed = events.withColumn("window_start", F.window(event_time, width)["start"])
    return keyed.join(broadcast_if_small(metrics), "window_start", "left")


def batch_vs_stream_reconcile(batch: DataFrame, stream: DataFrame, key: str) -> DataFrame:
    """Full outer join of two roll-ups with one row per key; 0 where a side has none."""
    b = batch.select(key, F.col("clicks").alias("batch_clicks"), F.col("events").alias("batch_events"))
    s = stream.select(key, F.col("clicks").alias("stream_clicks"),
                      F.col("events").alias("stream_events"))
    zero = F.lit(0).cast("bigint")
    joined = b.join(s, key, "full_outer")
    out = joined.select(key, *[F.coalesce(F.col(c), zero).alias(c) for c in
                               ("batch_clicks", "stream_clicks", "batch_events", "stream_events")])
    return out.withColumn("clicks_diff", F.col("batch_clicks") - F.col("stream_clicks")) \
        .withColumn("matched", (F.col("clicks_diff") == 0).cast("int"))
