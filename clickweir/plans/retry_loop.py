"""Retries carried through to recovery or dead letter.

Waiting messages lie in folders by the minute they are due. A round takes one minute's folder, tries its messages, and
writes what became of them: recovered, dead, or waiting again in the folder of a later minute. All that a round
writes lies in folders named after its minute, so a round that is repeated, after a crash or not, replaces just its own
output. Other folders are not read; rounds go from minute to minute until no folder is left.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickweir.functions.times import backoff_ms
from clickweir.plans.faults import BACKOFF_BASE_MS, BACKOFF_CAP_MS, MAX_RETRIES
from clickweir.session import list_path, path_exists

WAITING = "key string, retry_count int, due_at timestamp, payload string, errors array<string>"
ENDED = "key string, attempts int, outcome string, ended_at timestamp, reason string, payload string, errors array<string>"
_MINUTE = "%Y%m%d%H%M"


def _write(rows: DataFrame, path: str, by: tuple[str, ...]) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _settle(rows: DataFrame, root: str, name: str, now: Column, max_attempts: int, base_ms: int, cap_ms: int) -> None:
    """Put failed messages (WAITING without due_at) where they belong: the count goes up, then it is compared."""
    count = F.coalesce("retry_count", F.lit(0)) + 1
    due = F.timestamp_millis(F.unix_millis(now) + backoff_ms(count, base_ms, cap_ms))
    waiting = rows.where(count < max_attempts).select(
        "key", count.cast("int").alias("retry_count"), due.alias("due_at"), "payload", "errors",
        F.date_format(due, "yyyyMMddHHmm").alias("due_minute"), F.lit(name).alias("round"))
    _write(waiting, f"{root}/waiting", ("due_minute", "round"))
    dead = rows.where(count >= max_attempts).select(
        "key", (count - 1).cast("int").alias("attempts"), F.lit("dead").alias("outcome"), now.alias("ended_at"),
        F.format_string("Max retries exceeded (%d)", count).alias("reason"), "payload", "errors", F.lit(name).alias("round"))
    _write(dead, f"{root}/dead", ("round",))


def enqueue(failed: DataFrame, root: str, name: str, now: datetime, max_attempts: int = MAX_RETRIES,
            base_ms: int = BACKOFF_BASE_MS, cap_ms: int = BACKOFF_CAP_MS) -> None:
    """Take messages (key, retry_count, payload, errors) that have failed at `now`. `name` is the batch they came
    in; the same batch again replaces itself. Later than a round that has run, they wait for the next minute."""
    done = rounds_done(failed.sparkSession, root)
    if done:
        now = max(now, datetime.strptime(done[-1], _MINUTE) + timedelta(minutes=1))
    _settle(failed, root, f"from-{name}", F.lit(now).cast("timestamp"), max_attempts, base_ms, cap_ms)


def _names(spark: SparkSession, path: str, key: str) -> list[str]:
    if not path_exists(spark, path):
        return []
    return sorted(p.rsplit("=", 1)[1] for p in list_path(spark, path) if p.rsplit("/", 1)[1].startswith(key + "="))


def rounds_done(spark: SparkSession, root: str) -> list[str]:
    return _names(spark, f"{root}/done", "round")


def next_minute(spark: SparkSession, root: str) -> str | None:
    """The next minute that has messages, by the names of the folders alone."""
    done = rounds_done(spark, root)
    return next((m for m in _names(spark, f"{root}/waiting", "due_minute") if not done or m > done[-1]), None)


def run_round(spark: SparkSession, root: str, minute: str, recovers: Callable[[DataFrame], Column], error: Column | None = None,
              max_attempts: int = MAX_RETRIES, base_ms: int = BACKOFF_BASE_MS, cap_ms: int = BACKOFF_CAP_MS) -> None:
    """Try the messages due in a minute. `recovers` says by key, retry_count (the attempt) and payload which succeed."""
    now = F.lit(datetime.strptime(minute, _MINUTE) + timedelta(minutes=1)).cast("timestamp")
    due = spark.read.schema(WAITING).parquet(f"{root}/waiting/due_minute={minute}")
    tried = due.withColumn("ok", F.coalesce(recovers(due), F.lit(False)))
    _write(tried.where("ok").select("key", F.col("retry_count").alias("attempts"), F.lit("recovered").alias("outcome"), now.alias("ended_at"),
                                    F.lit(None).cast("string").alias("reason"), "payload", "errors", F.lit(minute).alias("round")),
           f"{root}/recovered", ("round",))
    text = F.lit("retry failed") if error is None else error
    failed = tried.where("NOT ok").withColumn("errors", F.array_append(F.coalesce("errors", F.array().cast("array<string>")), text))
    _settle(failed.drop("ok", "due_at"), root, minute, now, max_attempts, base_ms, cap_ms)
    spark.range(1).write.mode("overwrite").parquet(f"{root}/done/round={minute}")     # the round counts from here


def drain(spark: SparkSession, root: str, recovers: Callable[[DataFrame], Column], until: str | None = None, **limits) -> int:
    """Rounds until nothing waits, or nothing that is due by `until` (yyyyMMddHHmm); how many there were."""
    n = 0
    while (minute := next_minute(spark, root)) is not None and (until is None or minute <= until):
        run_round(spark, root, minute, recovers, **limits)
        n += 1
    return n


def ended(spark: SparkSession, root: str) -> DataFrame:
    """Every message that has come to its end, once."""
    out = spark.createDataFrame([], ENDED)
    for name in ("recovered", "dead"):
        if path_exists(spark, f"{root}/{name}"):
            out = out.unionAll(spark.read.schema(ENDED + ", round string").parquet(f"{root}/{name}").drop("round"))
    return out
