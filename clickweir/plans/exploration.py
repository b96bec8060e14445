"""Exploration queries over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def count_by(events: DataFrame, column: str) -> DataFrame:
    return events.groupBy(column).agg(F.count("*").alias("n_rows"))


def count_by_hour(events: DataFrame) -> DataFrame:
    return count_by(events.where(F.col("hour").isNotNull()), "hour").orderBy("hour")


def count_by_site(events: DataFrame) -> DataFrame:
    return count_by(events, "site_id")


def clicks_by(events: DataFrame, column: str) -> DataFrame:
    """clicks, total and mean click value per value of a column."""
    return events.groupBy(column).agg(
        F.sum("click").alias("clicks"), F.count("*").alias("total"),
        (F.sum("click").cast("double") / F.count("*")).alias("ctr"))


def ctr_by_device(events: DataFrame) -> DataFrame:
    return clicks_by(events, "device_type")


def ctr_by_banner(events: DataFrame) -> DataFrame:
    return clicks_by(events, "banner_pos").select("banner_pos", "ctr")
