"""Ingest: text rows to typed, validated events, with every reject kept and explained."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from clickweir.functions.ratios import ratio_2dp
from clickweir.operators.evaluation import evaluate_once
from clickweir.operators.validation import reject_reasons, transform_types
from clickweir.schema import EVENT_COLUMNS, RANGE_BOUNDS, RAW_SCHEMA
from clickweir.session import stored


def classify(raw: DataFrame, bounds=RANGE_BOUNDS, keep=()) -> DataFrame:
    """Typed events plus `reason`, in one pass over the scan, nothing shuffled."""
    return evaluate_once(reject_reasons(transform_types(raw, keep), bounds))


def valid_events(classified: DataFrame, keep=()) -> DataFrame:
    return classified.where(F.col("reason").isNull()).select(*EVENT_COLUMNS, *keep)


def with_raw_row(raw: DataFrame) -> DataFrame:
    """Carry a row's untyped fields along, so a reject can be replayed."""
    return raw.withColumn("raw_row", F.struct(*RAW_SCHEMA.names))


def rejects(classified: DataFrame, line_number="line_number", now=None) -> DataFrame:
    """Dead-letter records of rejected rows: line_number, raw_data (JSON), error,
    timestamp (ms). Only rejects are turned back into text."""
    now = F.current_timestamp() if now is None else now
    return classified.where(F.col("reason").isNotNull()).select(
        F.col(line_number).alias("line_number"),
        F.to_json("raw_row", {"ignoreNullFields": "false"}).alias("raw_data"),
        F.col("reason").alias("error"),
        F.unix_millis(now).alias("timestamp"))


def split_valid_rejects(raw: DataFrame, line_number: str, bounds=RANGE_BOUNDS,
                        now=None) -> tuple[DataFrame, DataFrame]:
    """(valid events, rejects). The log is read and cast once: the judged rows are stored,
    and both sides are filters over them."""
    classified = stored(classify(with_raw_row(raw), bounds, keep=("raw_row", line_number)), "judged")
    return valid_events(classified), rejects(classified, line_number, now)


def ingest_stats(classified: DataFrame, send_failed: int = 0,
                 duration_sec: float | None = None) -> DataFrame:
    """total, success, validation_failed, send_failed, success_rate (%, 2 dp)."""
    stats = classified.agg(
        F.count("*").alias("total"), F.count_if(F.col("reason").isNull()).alias("success"),
        F.count_if(F.col("reason").isNotNull()).alias("validation_failed"))
    stats = stats.withColumn("send_failed", F.lit(send_failed).cast("bigint")) \
        .withColumn("success_rate", ratio_2dp(F.col("success") * 100, F.col("total")))
    if duration_sec:
        stats = stats.withColumn("rows_per_sec", F.col("total") / F.lit(float(duration_sec)))
    return stats


def observe_ingest(classified: DataFrame, observation: str | Observation) -> DataFrame:
    """The same counters as observed metrics: no extra pass in batch or stream."""
    return classified.observe(
        observation, F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("reason").isNull()).alias("success"),
        F.count_if(F.col("reason").isNotNull()).alias("validation_failed"))


def stats_by_reason(classified: DataFrame) -> DataFrame:
    return classified.groupBy(F.coalesce("reason", F.lit("valid")).alias("outcome")) \
        .agg(F.count("*").alias("n_rows"))
