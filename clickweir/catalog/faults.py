"""Fault path queries. Messages derive from the events; every 61st is cut short."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweir.catalog import frames
from clickweir.catalog.registry import query
from clickweir.catalog.sql import STAMP, ratio
from clickweir.plans import faults
from clickweir.schema import EVENT_COLUMNS, EVENT_TYPES
from clickweir.session import scratch_path, stored
from clickweir.sources import tables
from clickweir.sources.event_files import CORRUPT

_ISO = STAMP.replace(" ", "T") + ".000000"
_RAW = """concat('{"raw_value":"', replace(broken_text, '"', '\\"'), '"}')"""
_ENVELOPE = f"""concat('{{"original_message":', CASE WHEN broken THEN {_RAW} ELSE message END,
',"sent_to_dlq_at":"{_ISO}","reason":"', replace(reason, '"', '\\"'), '"}}')"""
_DLQ = "routed WHERE action = 'dlq'"
_ID = "CASE WHEN broken THEN 'unknown' ELSE id END"


def _dead_letters(spark, d):
    """Parsed dead letters with the position they would have in a topic."""
    routed = frames.routed(spark, d).where("action = 'dlq'")
    value = faults.dlq_envelope(faults.original_message(), F.col("reason"), frames.stamp())
    messages = routed.select(
        value.alias("value"), F.lit("ad_events_dlq").alias("topic"),
        (F.col("n") % 3).cast("int").alias("partition"),
        F.call_function("div", F.col("n"), F.lit(3)).alias("offset"))
    return faults.dlq_parse(messages)


_FIELDS = ", ".join(f"CASE WHEN NOT broken THEN CAST({c} AS BIGINT) END AS {c}" if EVENT_TYPES[c] == "int" else f"CASE WHEN NOT broken THEN {c} END AS {c}"
                    for c in EVENT_COLUMNS)
_DECODED = f"""{_FIELDS}, CASE WHEN NOT broken THEN CAST(retry_count AS BIGINT) END AS retry_count, CASE WHEN NOT broken THEN last_error END AS last_error,
CASE WHEN NOT broken THEN last_error END AS error_history"""
_EVENT = [*EVENT_COLUMNS, "retry_count", "last_error"]


@query("retry_decode", f"SELECT n, {_DECODED}, CASE WHEN broken THEN broken_text ELSE message END AS payload_text, broken_text AS corrupt FROM retry")
def _(spark, d):
    """All fields of all messages, and the text of those that are no JSON."""
    rows = faults.retry_decode(frames.retry_messages(spark, d))
    return rows.select("n", *_EVENT, F.array_join("error_history", "|").alias("error_history"), "payload_text", F.col(CORRUPT).alias("corrupt"))


@query("retry_router", f"""SELECT n, {_DECODED}, event_time, CAST(next_retry_count AS BIGINT) AS next_retry_count, action, backoff_ms,
TIMESTAMP '{STAMP}' + to_milliseconds(backoff_ms) AS next_attempt_at, reason FROM routed""")
def _(spark, d):
    return frames.routed(spark, d).select("n", *_EVENT, F.array_join("error_history", "|").alias("error_history"), "event_time",
                                          "next_retry_count", "action", "backoff_ms", "next_attempt_at", "reason")


@query("retry_decode_dlq", "SELECT n, event_time, reason FROM routed WHERE broken")
def _(spark, d):
    return frames.routed(spark, d).where(F.col(CORRUPT).isNotNull()).select("n", "event_time", "reason")


@query("dlq_envelope", f"SELECT {_ENVELOPE} AS value FROM {_DLQ}")
def _(spark, d):
    return faults.retry_decode_dlq(frames.routed(spark, d), frames.stamp())


@query("dlq_parse", f"SELECT {_ID} AS message_id, reason, '{_ISO}' AS sent_to_dlq_at FROM {_DLQ}")
def _(spark, d):
    return _dead_letters(spark, d).select("message_id", "reason", "sent_to_dlq_at")


@query("store_dlq_messages", f"""SELECT {_ID} AS message_id, 'ad_events_dlq' AS topic, n % 3 AS "partition", n // 3 AS "offset",
{_ENVELOPE} AS message_content, reason AS error_reason, TIMESTAMP '{STAMP}' AS processed_at FROM {_DLQ}""")
def _(spark, d):
    """Dead letters written to their table, a replay of the batch included, read back."""
    rows, path = stored(faults.dlq_rows(_dead_letters(spark, d), frames.stamp()), "dead-letters"), scratch_path(spark, "dlq")
    for _ in range(2):
        tables.store_dlq_messages(rows.where("offset % 2 = 0"), path, 0, run="a")
    tables.store_dlq_messages(rows.where("offset % 2 = 1"), path, 0, run="b")
    return spark.read.option("basePath", path).parquet(path).select(*rows.columns)


@query("dlq_daily_log", f"""SELECT {_ID} AS message_id, TIMESTAMP '{STAMP}' AS "timestamp", {_ENVELOPE} AS content, reason AS error_reason,
CAST(CAST(TIMESTAMP '{STAMP}' AS DATE) AS VARCHAR) AS log_date FROM {_DLQ}""")
def _(spark, d):
    """JSON-lines log by day, a replay of the batch included, read back."""
    rows, path = stored(faults.dlq_rows(_dead_letters(spark, d), frames.stamp()), "dead-letters"), scratch_path(spark, "dlq_log")
    for _ in range(2):
        tables.dlq_daily_log(rows, path, 0, run="a")
    return spark.read.schema("message_id string, timestamp timestamp, content string, error_reason string, "
                             "log_date date").json(path).drop("run", "batch_id")


@query("dlq_alert_rows", f"SELECT {_ID} AS message_id, reason, '{_ISO}' AS sent_to_dlq_at FROM {_DLQ}")
def _(spark, d):
    return faults.dlq_alert_rows(_dead_letters(spark, d))


_ELIGIBLE = """retry_count < 3 AND (last_error LIKE '%Transformation failed%' OR last_error LIKE '%Timeout%'
OR last_error LIKE '%Connection error%')"""


@query("retry_eligibility", f"""SELECT n, last_error, CAST(retry_count AS BIGINT) AS retry_count, CAST({_ELIGIBLE} AS BIGINT) AS eligible
FROM retry WHERE NOT broken""")
def _(spark, d):
    rows = faults.retry_decode(frames.retry_messages(spark, d)).where(F.col(CORRUPT).isNull())
    return faults.retry_eligibility(rows, "last_error").select("n", "last_error", "retry_count", "eligible")


@query("dlq_replay", f"""SELECT id AS key, message AS value FROM retry WHERE NOT broken AND {_ELIGIBLE}""")
def _(spark, d):
    """Dead letters stored with their last error; eligible ones go back to the stream."""
    rows = faults.retry_decode(frames.retry_messages(spark, d)).where(F.col(CORRUPT).isNull())
    letters = rows.select(
        F.col("id").cast("string").alias("message_id"), F.col("last_error").alias("error_reason"),
        faults.dlq_envelope(F.col("payload_text"), F.col("last_error"), frames.stamp()).alias("message_content"))
    return faults.dlq_replay(letters)


@query("retry_recovered", """SELECT CAST(id AS VARCHAR) AS id, CAST(click AS BIGINT) AS click, NULL::BIGINT AS was_retried,
NULL::BIGINT AS retry_count FROM ad UNION ALL
SELECT id, CAST(click AS BIGINT), 1, CAST(next_retry_count AS BIGINT) FROM routed WHERE action = 'retry'""")
def _(spark, d):
    recovered = frames.routed(spark, d).where("action = 'retry'").select(
        "id", "click", F.col("next_retry_count").alias("retry_count"))
    rows = faults.retry_recovered(frames.ads(spark, d).select(F.col("id").cast("string"), "click"), recovered)
    return rows.select("id", "click", F.col("was_retried").cast("int").alias("was_retried"), "retry_count")


@query("retry_error_history", """SELECT n, concat(last_error, '|', reason) AS error_history, reason AS last_error
FROM routed WHERE NOT broken AND action = 'dlq'""")
def _(spark, d):
    rows = frames.routed(spark, d).where((F.col("action") == "dlq") & F.col(CORRUPT).isNull())
    return faults.retry_error_history(rows, F.col("reason")).select(
        "n", F.array_join("error_history", "|").alias("error_history"), "last_error")


@query("retry_stats", """SELECT count(*) AS total, count(*) FILTER (NOT broken) AS processed, count(*) FILTER (action = 'retry') AS retried,
count(*) FILTER (action = 'dlq') AS dlq_sent, count(*) FILTER (broken) AS errors FROM routed""")
def _(spark, d):
    return faults.retry_stats(frames.routed(spark, d))


@query("dlq_stats", f"""SELECT received, received AS stored, CAST(0 AS BIGINT) AS errors, {ratio('(100 * received)', 'total')} AS dlq_rate_pct
FROM (SELECT count(*) FILTER (action = 'dlq') AS received, count(*) AS total FROM routed)""")
def _(spark, d):
    """All events in one aggregate, dead letters among them."""
    dead = F.col("action") == "dlq"
    value = F.when(dead, faults.dlq_envelope(faults.original_message(), F.col("reason"), frames.stamp()))
    parsed = faults.dlq_parse(frames.routed(spark, d).select(value.alias("value"), dead.alias("dead")))
    return faults.dlq_stats(parsed, dead=F.col("dead"))
