"""The fault path: retry decisions, dead letters, replay. Pure projections; waiting is a
`next_attempt_at` time for whoever schedules the next attempt, never a sleep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickweir.functions.payloads import json_field_default
from clickweir.functions.ratios import ratio_2dp
from clickweir.functions.times import backoff_ms
from clickweir.operators.evaluation import evaluate_once
from clickweir.schema import DLQ_SCHEMA, RETRY_SCHEMA
from clickweir.sources.event_files import CORRUPT, parse_event_json

# --- fixed values: retry limits, texts and names of the fault path ----------------
MAX_RETRIES = 3
BACKOFF_BASE_MS = 1000
BACKOFF_CAP_MS = 32000
RETRIABLE_REASONS = ("Transformation failed", "Timeout", "Connection error")
UNKNOWN_ID = "unknown"
UNKNOWN_REASON = "Unknown reason"
# ----------------------------------------------------------------------------------


def retry_decode(messages: DataFrame, payload: str = "value") -> DataFrame:
    """Decode retry messages, keeping the text. Any JSON object decodes, whatever its fields and
    their types; what is no object, or no JSON, has its text in `_corrupt_record`.

    Every message is parsed once. A number where text is meant is text, and what does not fit its type is NULL.
    """
    text = F.col(payload).cast("string")
    kept = [c for c in messages.columns if c != payload]
    # only an object begins with a brace
    parsed = evaluate_once(messages.select(*kept, text.alias("payload_text"),
                                           F.when(F.ltrim(text).startswith("{"), F.try_parse_json(text)).alias("_variant")))
    fields = [F.try_variant_get("_variant", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in RETRY_SCHEMA]
    return parsed.select(*kept, "payload_text", *fields,
                         F.when(F.col("_variant").isNull(), F.coalesce("payload_text", F.lit(""))).alias(CORRUPT))


def retry_router(decoded: DataFrame, max_attempts: int = MAX_RETRIES,
                 base_ms: int = BACKOFF_BASE_MS, cap_ms: int = BACKOFF_CAP_MS,
                 now: Column | None = None) -> DataFrame:
    """Add next_retry_count, action, backoff_ms, next_attempt_at and reason.

    The count goes up before it is compared, so `max_attempts` = 3 means two more
    attempts, after 1 s and 2 s.
    """
    now = F.current_timestamp() if now is None else now
    broken = F.col(CORRUPT).isNotNull()
    count = F.coalesce("retry_count", F.lit(0)) + 1
    exhausted = count >= max_attempts
    wait = F.when(~broken & ~exhausted, backoff_ms(count, base_ms, cap_ms))
    return decoded.select(
        "*", F.when(~broken, count).alias("next_retry_count"),
        F.when(broken | exhausted, "dlq").otherwise("retry").alias("action"),
        wait.alias("backoff_ms"),
        F.timestamp_millis(F.unix_millis(now) + wait).alias("next_attempt_at"),
        F.when(broken, F.concat(F.lit("JSON decode error: "), F.col(CORRUPT)))
        .when(exhausted, F.format_string("Max retries exceeded (%d)", count)).alias("reason"))


def original_message(payload: str = "payload_text") -> Column:
    """The message for the envelope: its own JSON, or its text as `raw_value`."""
    raw = F.to_json(F.struct(F.col(payload).alias("raw_value")))
    return F.when(F.col(CORRUPT).isNotNull(), raw).otherwise(F.col(payload))


def dlq_envelope(message: Column, reason: Column, now: Column | None = None) -> Column:
    """JSON text {original_message, sent_to_dlq_at, reason}; the message is embedded as
    the JSON it is, whatever its fields."""
    now = F.current_timestamp() if now is None else now
    stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    tail = F.to_json(F.struct(stamp.alias("sent_to_dlq_at"), reason.alias("reason")))
    return F.concat(F.lit('{"original_message":'), message, F.lit(","), F.substring(tail, 2, 2147483647))


def retry_decode_dlq(routed: DataFrame, now: Column | None = None) -> DataFrame:
    """Envelopes for every message the router sends to the dead letters."""
    return routed.where(F.col("action") == "dlq").select(
        dlq_envelope(original_message(), F.col("reason"), now).alias("value"))


def dlq_parse(messages: DataFrame, payload: str = "value") -> DataFrame:
    """message_id, reason, sent_to_dlq_at, message_content; defaults where absent.
    Undecodable text is kept in `_corrupt_record`."""
    text = F.col(payload).cast("string")
    kept = [c for c in messages.columns if c != payload]
    # the inner message may be any JSON, so fields are taken by path
    decoded = parse_event_json(messages.withColumn("message_content", text), payload, DLQ_SCHEMA)
    inner_id = json_field_default(F.col("message_content"), "$.original_message.id", UNKNOWN_ID)
    return decoded.select(
        *kept, F.when(F.col(CORRUPT).isNull(), inner_id).alias("message_id"),
        F.when(F.col(CORRUPT).isNull(), F.coalesce("reason", F.lit(UNKNOWN_REASON))).alias("reason"),
        "sent_to_dlq_at", "message_content", CORRUPT)


def dlq_rows(parsed: DataFrame, now: Column | None = None, topic: str = "topic",
             partition: str = "partition", offset: str = "offset") -> DataFrame:
    """Rows of the dead-letter table; undecodable messages are counted, not stored."""
    now = F.current_timestamp() if now is None else now
    return parsed.where(F.col(CORRUPT).isNull()).select(
        "message_id", F.col(topic).alias("topic"), F.col(partition).alias("partition"),
        F.col(offset).alias("offset"), "message_content", F.col("reason").alias("error_reason"),
        now.alias("processed_at"))


def dlq_alert_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).select("message_id", "reason", "sent_to_dlq_at")


def retriable(reason: Column, retry_count: Column, max_retries: int = MAX_RETRIES) -> Column:
    named = F.lit(False)
    for text in RETRIABLE_REASONS:
        named = named | F.coalesce(reason.contains(text), F.lit(False))
    return (F.coalesce(retry_count, F.lit(0)) < max_retries) & named


def retry_eligibility(df: DataFrame, reason: str = "error", retry_count: str = "retry_count",
                      max_retries: int = MAX_RETRIES) -> DataFrame:
    return df.withColumn("eligible", retriable(F.col(reason), F.col(retry_count), max_retries).cast("int"))


def dlq_replay(dead_letters: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Original messages of eligible dead letters, ready to append to the raw stream."""
    content = F.col("message_content")
    count = F.get_json_object(content, "$.original_message.retry_count").try_cast("int")
    return dead_letters.where(retriable(F.col("error_reason"), count, max_retries)).select(
        F.col("message_id").alias("key"),
        F.get_json_object(content, "$.original_message").alias("value"))


def retry_recovered(raw: DataFrame, recovered: DataFrame) -> DataFrame:
    """Recovered events rejoin the stream, marked; other rows carry no marks."""
    marked = recovered.withColumn("was_retried", F.lit(True))
    return raw.unionByName(marked, allowMissingColumns=True)


def retry_error_history(df: DataFrame, error: Column) -> DataFrame:
    """Append an error to the history; `last_error` follows."""
    history = F.array_append(F.coalesce("error_history", F.array().cast("array<string>")), error)
    return df.withColumn("error_history", history) \
        .withColumn("last_error", F.element_at("error_history", -1))


def retry_stats(routed: DataFrame) -> DataFrame:
    """Every message counts once under its outcome."""
    broken = F.col(CORRUPT).isNotNull()
    return routed.agg(
        F.count("*").alias("total"), F.count_if(~broken).alias("processed"),
        F.count_if(F.col("action") == "retry").alias("retried"),
        F.count_if(F.col("action") == "dlq").alias("dlq_sent"), F.count_if(broken).alias("errors"))


def dlq_stats(parsed: DataFrame, all_events: int | None = None, dead: Column | None = None) -> DataFrame:
    """received, stored, errors, and the dead-letter share of all events in percent. `dead` says which rows are
    dead letters, where `parsed` has a row for every event; then one aggregate counts both."""
    letter = F.lit(True) if dead is None else dead
    broken = F.col(CORRUPT).isNotNull()
    stats = parsed.agg(F.count_if(letter).alias("received"), F.count_if(letter & ~broken).alias("stored"),
                       F.count_if(letter & broken).alias("errors"), F.count("*").alias("_events"))
    if all_events is None and dead is None:
        return stats.drop("_events")
    every = F.col("_events") if all_events is None else F.lit(all_events)
    return stats.withColumn("dlq_rate_pct", ratio_2dp(F.col("received") * 100, every)).drop("_events")
