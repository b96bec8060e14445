"""Ad events seen through the driver's `events` table.

The table has no ad columns, duplicates or bad rows, so this view derives the 24
event columns plus `event_time` from it and seeds known defects: every 50th event
comes a second time an hour later with the opposite click value, and fixed
residues carry click = 2, a NULL hour or a NULL site.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickweir.operators.evaluation import evaluate_once

DRIVER_EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                       "value double, props string")


def _tag(prefix: str, value) -> F.Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def as_ad_events(events: DataFrame) -> DataFrame:
    """Works on batch and streaming frames: one scan, no shuffle, codegen only."""
    eid, uid = F.col("event_id"), F.col("user_id")
    copies = F.when(eid % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    base = events.select(
        "event_id", "user_id", "event_type", "ts",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        F.explode(copies).alias("copy"))
    timed = base.withColumn(
        "event_time", F.col("ts") + F.when(F.col("copy") == 1, F.expr("INTERVAL 1 HOUR"))
        .otherwise(F.expr("INTERVAL 0 HOUR")))
    t, k = F.col("event_time"), F.col("k")
    code = ((F.year(t) % 100) * 1_000_000 + F.month(t) * 10_000 + F.dayofmonth(t) * 100
            + F.hour(t)).cast("int")
    site, app = uid % 7, uid % 5
    return timed.select(
        eid.cast("decimal(20,0)").alias("id"),
        F.when(eid % 97 == 96, 2)
        .when((F.col("event_type") == "click") != (F.col("copy") == 1), 1)
        .otherwise(0).alias("click"),
        F.when(eid % 101 != 100, code).alias("hour"),
        (eid % 8).cast("int").alias("banner_pos"),
        F.when(eid % 89 != 88, _tag("site_", site)).alias("site_id"),
        _tag("dom_", site).alias("site_domain"),
        _tag("cat_", site % 3).alias("site_category"),
        F.when(uid % 11 != 0, _tag("app_", app)).alias("app_id"),
        _tag("appdom_", app).alias("app_domain"),
        _tag("appcat_", uid % 2).alias("app_category"),
        _tag("dev_", uid).alias("device_id"),
        _tag("ip_", eid % 997).alias("device_ip"),
        _tag("model_", uid % 13).alias("device_model"),
        (uid % 4).cast("int").alias("device_type"),
        (eid % 6).cast("int").alias("device_conn_type"),
        F.lit(1005).alias("c1"), k.alias("c14"), F.lit(320).alias("c15"), F.lit(50).alias("c16"),
        (k * 7).alias("c17"), (k % 4).alias("c18"), F.lit(35).alias("c19"),
        F.lit(-1).alias("c20"), (k + 13).alias("c21"),
        "event_time")


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ad_events(spark: SparkSession, sf_dir: str, since: str | None = None) -> DataFrame:
    """The view in batch. `since` bounds event_time and reaches the Parquet scan:
    a copy is at most an hour younger than its source row."""
    events = read_driver_table(spark, sf_dir, "events")
    if since is None:
        return as_ad_events(events)
    floor = F.lit(since).cast("timestamp_ntz")
    return (as_ad_events(events.where(F.col("ts") >= floor - F.expr("INTERVAL 1 HOUR")))
            .where(F.col("event_time") >= floor))


def ad_events_of_days(spark: SparkSession, sf_dir: str, days: Sequence[str]) -> DataFrame:
    """The view's events of some days. As bounds of the source's time the days reach the Parquet scan; a copy
    is an hour younger than its source row."""
    def within(time: str, early: str) -> F.Column:
        start = [F.lit(day).cast("timestamp_ntz") for day in days]
        return reduce(or_, [(F.col(time) >= s - F.expr(early)) & (F.col(time) < s + F.expr("INTERVAL 1 DAY")) for s in start])

    events = read_driver_table(spark, sf_dir, "events").where(within("ts", "INTERVAL 1 HOUR"))
    return as_ad_events(events).where(within("event_time", "INTERVAL 0 HOUR"))


def events_glob(sf_dir: str) -> str:
    """The table's path as a glob: a stream takes a folder or a glob, and the table may
    be one file or a folder of files."""
    return f"{sf_dir}/{{events.parquet}}"


def ad_events_stream(spark: SparkSession, sf_dir: str,
                     max_files_per_trigger: int = 1000) -> DataFrame:
    """The view as a stream over the same files; event_time becomes a zoned timestamp,
    which watermarks need."""
    events = (spark.readStream.schema(DRIVER_EVENT_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(events_glob(sf_dir)))
    return as_ad_events(events).withColumn("event_time", F.col("event_time").cast("timestamp"))


def raw_text_rows(ads: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Events, or some of their columns, as an untyped text feed with further seeded defects: non-numeric hours,
    out-of-range clicks, banners and devices, exponent notation, empty text and a
    missing last column."""
    n = F.col("id").cast("bigint")

    def text(name: str) -> F.Column:
        as_text = F.col(name).cast("string")
        return F.coalesce(as_text, F.lit("")) if name in ("hour", "site_id", "app_id") else as_text

    special = {
        "click": F.when(n % 107 == 106, "5").when(n % 109 == 108, F.concat(text("click"), F.lit(".0")))
        .otherwise(text("click")),
        "hour": F.when(n % 103 == 102, "invalid").otherwise(text("hour")),
        "banner_pos": F.when(n % 113 == 112, "10").otherwise(text("banner_pos")),
        "site_domain": F.when(n % 127 == 126, "").otherwise(text("site_domain")),
        "device_type": F.when(n % 131 == 130, "10").otherwise(text("device_type")),
        "c14": F.when(n % 109 == 108, F.concat(text("c14"), F.lit("e0"))).otherwise(text("c14")),
        "c21": F.when(n % 137 != 136, text("c21")),
    }
    return evaluate_once(ads.select(
        *[special.get(c, text(c)).alias(c) for c in (ads.columns if columns is None else columns) if c != "event_time"],
        *(["event_time"] if columns is None else [])))
