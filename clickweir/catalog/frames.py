"""Frames the registered queries start from; all derive from the driver's `events`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickweir.functions.payloads import event_to_json
from clickweir.operators.evaluation import evaluate_once
from clickweir.operators.windows import FIVE_MINUTES, ONE_MINUTE, tumbling_ctr
from clickweir.plans import marts
from clickweir.plans.faults import retry_decode, retry_router
from clickweir.plans.ingest import classify
from clickweir.schema import DAILY_GRAIN, EVENT_COLUMNS
from clickweir.session import scratch_path
from clickweir.sources.driver_tables import ad_events, raw_text_rows
from clickweir.catalog.sql import STAMP

MART_COLUMNS = ("hour", *DAILY_GRAIN)


def ads(spark: SparkSession, d: str) -> DataFrame:
    return ad_events(spark, d)


def raw(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return raw_text_rows(ads(spark, d), columns or None)


def judged(spark: SparkSession, d: str) -> DataFrame:
    return classify(raw(spark, d), keep=("event_time",))


def staged(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return marts.stage_events(ads(spark, d), columns or None)


def staged_for_marts(spark: SparkSession, d: str) -> DataFrame:
    return marts.stage_events(ads(spark, d), MART_COLUMNS)


def hourly(spark: SparkSession, d: str) -> DataFrame:
    return marts.hourly_agg(staged_for_marts(spark, d))


def daily(spark: SparkSession, d: str) -> DataFrame:
    return marts.daily_agg_direct(staged_for_marts(spark, d))


def facts(spark: SparkSession, d: str) -> DataFrame:
    return marts.fct_daily_metrics(ads(spark, d))


def staged_for_campaigns(spark: SparkSession, d: str) -> DataFrame:
    return staged(spark, d, "click", *marts.CAMPAIGN_COLUMNS)


def campaigns(spark: SparkSession, d: str) -> DataFrame:
    return marts.dim_campaigns(staged_for_campaigns(spark, d))


def metrics_1min(spark: SparkSession, d: str, since: str | None = None) -> DataFrame:
    return tumbling_ctr(ad_events(spark, d, since), ONE_MINUTE)


def metrics_5min(spark: SparkSession, d: str, since: str | None = None) -> DataFrame:
    return tumbling_ctr(ad_events(spark, d, since), FIVE_MINUTES)


def stamp() -> F.Column:
    return F.lit(STAMP).cast("timestamp")


def csv_copy(spark: SparkSession, rows: DataFrame) -> str:
    path = scratch_path(spark, "csv")
    rows.drop("event_time").write.option("header", True).csv(path)
    return path


def retry_messages(spark: SparkSession, d: str) -> DataFrame:
    """JSON retry messages of all event columns. Every 53rd has an id of text, every 59th a click that is no number, every
    67th no hour, and every 61st is cut short."""
    n = F.col("id").cast("bigint")
    error = F.element_at(F.array(*[F.lit(x) for x in (
        "Timeout after 30s", "Connection error: reset", "Transformation failed", "Schema mismatch")]),
        F.col("banner_pos") % 4 + 1)
    rows = ads(spark, d).select("*", n.alias("n"), F.col("c18").alias("retry_count"), error.alias("last_error"),
                                F.array(error).alias("error_history"))
    rest = event_to_json([c for c in EVENT_COLUMNS if c not in ("id", "click", "hour")] + ["retry_count", "last_error", "error_history"])
    id_ = F.when(n % 53 == 52, F.concat(F.lit('"msg-'), n.cast("string"), F.lit('"'))).otherwise(n.cast("string"))
    click = F.when(n % 59 == 58, '"x"').otherwise(F.col("click").cast("string"))
    hour = F.when((n % 67 == 66) & (n % 59 != 58), "").otherwise(
        F.concat(F.lit(',"hour":'), F.coalesce(F.col("hour").cast("string"), F.lit("null"))))
    whole = F.concat(F.lit('{"id":'), id_, F.lit(',"click":'), click, hour, F.lit(","), F.substr(rest, F.lit(2)))
    broken = F.concat(F.lit('{"id":'), n.cast("string"), F.lit(',"click"'))
    value = F.when(n % 61 == 60, broken).otherwise(whole)
    return evaluate_once(rows.select("n", value.alias("value"), "event_time"))


def routed(spark: SparkSession, d: str) -> DataFrame:
    return retry_router(retry_decode(retry_messages(spark, d)), now=stamp())
