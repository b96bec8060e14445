"""Campaign keys that stay, and the times in which a campaign was there.

A registry gives every combination a number once: a snapshot numbers only combinations that the registry lacks, after its
largest number. A snapshot also closes the interval of a campaign that is gone and opens one for a campaign that came.
What a snapshot adds lies in folders named after it, so a snapshot that is taken again replaces its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickweir.operators.global_order import surrogate_key
from clickweir.operators.joins import missing_keys, null_safe
from clickweir.plans.marts import campaign_filter
from clickweir.schema import CAMPAIGN_COLUMNS, EVENT_TYPES
from clickweir.session import list_path, path_exists, stored

_COLUMNS = ", ".join(f"{c} {EVENT_TYPES[c]}" for c in CAMPAIGN_COLUMNS)
REGISTRY = f"campaign_id bigint, {_COLUMNS}"
OPEN = "campaign_id bigint, valid_from date"
CLOSED = "campaign_id bigint, valid_from date, valid_to date"


def _snapshots(spark: SparkSession, root: str, name: str) -> list[str]:
    """Names of the snapshots that came to their end, in order."""
    path = f"{root}/{name}"
    if not path_exists(spark, path):
        return []
    return sorted(p.rsplit("=", 1)[1] for p in list_path(spark, path) if "snapshot=" in p and path_exists(spark, f"{p}/_SUCCESS"))


def _read(spark: SparkSession, root: str, name: str, schema: str, snapshots: Sequence[str]) -> DataFrame:
    paths = [f"{root}/{name}/snapshot={s}" for s in snapshots]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def registry(spark: SparkSession, root: str, before: str | None = None) -> DataFrame:
    return _read(spark, root, "registry", REGISTRY, [s for s in _snapshots(spark, root, "registry") if before is None or s < before])


def register(combinations: DataFrame, root: str, snapshot: str, columns: Sequence[str] = CAMPAIGN_COLUMNS) -> DataFrame:
    """Number the combinations that earlier snapshots lack; the registry with them."""
    spark = combinations.sparkSession
    known = registry(spark, root, before=snapshot)
    largest = known.agg(F.coalesce(F.max("campaign_id"), F.lit(0))).first()[0]
    new = stored(missing_keys(combinations.select(*columns).distinct(), known, columns), "new-campaigns")
    order = ("site_id", "app_id", "banner_pos", "device_type", "site_domain", "site_category", "app_domain", "app_category")
    numbered = surrogate_key(new, order, "campaign_id").withColumn("campaign_id", F.col("campaign_id") + F.lit(largest))
    numbered.select("campaign_id", *columns).write.mode("overwrite").parquet(f"{root}/registry/snapshot={snapshot}")
    return _read(spark, root, "registry", REGISTRY, [*[s for s in _snapshots(spark, root, "registry") if s < snapshot], snapshot])


def take_snapshot(staged: DataFrame, root: str, snapshot: str) -> None:
    """Bring the history to the day `snapshot` (YYYY-MM-DD), on which the campaigns of `staged` are there."""
    spark = staged.sparkSession
    there = stored(campaign_filter(staged).select(*CAMPAIGN_COLUMNS).distinct(), "campaigns")
    keys = register(there, root, snapshot)
    ids = there.join(keys, null_safe(there, keys, CAMPAIGN_COLUMNS)).select("campaign_id")
    earlier = [s for s in _snapshots(spark, root, "open") if s < snapshot]
    was = _read(spark, root, "open", OPEN, earlier[-1:])
    both = stored(was.join(ids.withColumn("now", F.lit(True)), "campaign_id", "full"), "campaign-intervals")
    day = F.lit(snapshot).cast("date")
    both.where("now IS NULL").select("campaign_id", "valid_from", day.alias("valid_to")) \
        .write.mode("overwrite").parquet(f"{root}/closed/snapshot={snapshot}")
    both.where("now").select("campaign_id", F.coalesce("valid_from", day).alias("valid_from")) \
        .write.mode("overwrite").parquet(f"{root}/open/snapshot={snapshot}")


def intervals(spark: SparkSession, root: str) -> DataFrame:
    """campaign_id, valid_from, valid_to (NULL while it lasts) of all campaigns."""
    done = _snapshots(spark, root, "open")
    now = _read(spark, root, "open", OPEN, done[-1:]).withColumn("valid_to", F.lit(None).cast("date"))
    return now.unionAll(_read(spark, root, "closed", CLOSED, [s for s in _snapshots(spark, root, "closed") if done and s <= done[-1]]))


def dim_campaigns(spark: SparkSession, root: str) -> DataFrame:
    """One row per campaign ever seen: its key and columns, whether it is there, when it first was and when that last changed."""
    life = intervals(spark, root).groupBy("campaign_id").agg(
        F.max(F.col("valid_to").isNull().cast("int")).alias("is_active"), F.min("valid_from").alias("created_at"),
        F.max(F.coalesce("valid_to", "valid_from")).alias("updated_at"))
    return registry(spark, root).join(life, "campaign_id").select("campaign_id", *CAMPAIGN_COLUMNS, "is_active", "created_at", "updated_at")
