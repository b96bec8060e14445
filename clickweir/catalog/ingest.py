"""Ingest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweir.catalog import frames
from clickweir.catalog.registry import query
from clickweir.catalog.sql import STAMP, ratio
from clickweir.operators import validation as v
from clickweir.plans import ingest
from clickweir.schema import EVENT_COLUMNS, EVENT_SCHEMA, EVENT_TYPES, STRING_COLUMNS
from clickweir.session import scratch_path
from clickweir.sources import event_files as files
from clickweir.sources.driver_tables import ad_events

_TEXT = ", ".join(f"coalesce({c}, '') AS {c}" for c in EVENT_COLUMNS)
_TYPED = ", ".join("CAST(id AS VARCHAR) AS id" if c == "id" else
                   (f"CAST({c} AS BIGINT) AS {c}" if EVENT_TYPES[c] == "int" else c) for c in EVENT_COLUMNS)
_NUMERIC = [c for c in EVENT_COLUMNS if EVENT_TYPES[c] != "string"]


@query("scan_events_csv", f"SELECT {_TEXT} FROM raw")
def _(spark, d):
    """Events written as CSV and scanned back, all columns text."""
    rows = files.scan_events_csv(spark, frames.csv_copy(spark, frames.raw(spark, d)))
    return rows.drop(files.CORRUPT)


@query("scan_limit", """SELECT CAST(id AS VARCHAR) AS id, CAST(click AS BIGINT) AS click, event_time
FROM ad ORDER BY ad.id, ad.event_time LIMIT 500""")
def _(spark, d):
    rows = frames.ads(spark, d).select("id", "click", "event_time")
    return files.scan_limit(rows, 500, [F.col("id"), F.col("event_time")])


_JSON = " || ',' || ".join(
    f"'\"{c}\":' || " + (f"'\"' || {c} || '\"'" if c in STRING_COLUMNS else f"CAST({c} AS VARCHAR)")
    for c in EVENT_COLUMNS)


@query("publish_event_json", f"""SELECT CAST(id AS VARCHAR) AS key, '{{' || {_JSON} || '}}' AS value
FROM judged WHERE reason IS NULL""")
def _(spark, d):
    """Valid events as keyed JSON messages."""
    return files.publish_event_json(ingest.valid_events(frames.judged(spark, d)))


_DECODED = ", ".join(f"CASE WHEN NOT broken THEN {'CAST(' + c + ' AS BIGINT)' if EVENT_TYPES[c] == 'int' else c} END AS {c}" for c in EVENT_COLUMNS[1:])


@query("parse_event_json", f"""SELECT n, CASE WHEN NOT broken AND n % 53 <> 52 THEN CAST(n AS VARCHAR) END AS id, {_DECODED},
CAST(broken OR n % 53 = 52 OR n % 59 = 58 AS BIGINT) AS is_corrupt FROM retry""")
def _(spark, d):
    """Decode JSON payloads; undecodable ones, and those with a field of a wrong type, stay, marked."""
    rows = files.parse_event_json(frames.retry_messages(spark, d), on_error="dlq")
    return rows.select("n", *EVENT_COLUMNS, F.col(files.CORRUPT).isNotNull().cast("int").alias("is_corrupt"))


@query("event_json_round_trip", f"SELECT {_TYPED} FROM judged WHERE reason IS NULL")
def _(spark, d):
    """Publish to stored messages, read them back, decode: nothing changes."""
    path = scratch_path(spark, "messages")
    files.write_messages(files.publish_event_json(ingest.valid_events(frames.judged(spark, d))),
                         "parquet", path)
    messages = spark.read.schema("key string, value string").parquet(path)
    return files.parse_event_json(messages, on_error="drop").select(*EVENT_SCHEMA.names)


@query("transform_types", f"SELECT {_TYPED}, type_error, missing_field FROM typed")
def _(spark, d):
    return v.transform_types(frames.raw(spark, d))


@query("validate_required", "SELECT CAST(id AS VARCHAR) AS id, missing_field FROM typed WHERE missing_field IS NOT NULL")
def _(spark, d):
    typed = v.transform_types(frames.raw(spark, d))
    return typed.where(F.col("missing_field").isNotNull()).select("id", "missing_field")


@query("validate_types", " UNION ALL ".join(
    f"SELECT '{c}' AS field, count(*) FILTER (type_error_{c}) AS type_errors FROM flags" for c in _NUMERIC
).join([
    "WITH flags AS (SELECT " + ", ".join(
        (f"{c} IS NOT NULL AND " + (f"TRY_CAST({c} AS DECIMAL(20,0)) IS NULL" if c == "id"
                                    else f"TRY_CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INT) IS NULL"))
        + f" AS type_error_{c}" for c in _NUMERIC) + " FROM raw) ", ""]))
def _(spark, d):
    return v.validate_types(frames.raw(spark, d))


@query("validate_click", """SELECT CAST(id AS VARCHAR) AS id, CAST(click AS BIGINT) AS click FROM typed
WHERE click IS NULL OR click NOT IN (0, 1)""")
def _(spark, d):
    return v.transform_types(frames.raw(spark, d)).where(~v.valid_click()).select("id", "click")


@query("validate_hour", """SELECT CAST(id AS VARCHAR) AS id, CAST(hour AS BIGINT) AS hour FROM typed
WHERE hour IS NULL OR hour NOT BETWEEN 10000000 AND 99999999""")
def _(spark, d):
    return v.transform_types(frames.raw(spark, d)).where(~v.valid_hour()).select("id", "hour")


@query("validate_ranges", """SELECT CAST(id AS VARCHAR) AS id, CAST(banner_pos AS BIGINT) AS banner_pos,
CAST(device_type AS BIGINT) AS device_type, CAST(device_conn_type AS BIGINT) AS device_conn_type FROM typed
WHERE NOT coalesce(banner_pos BETWEEN 0 AND 7 AND device_type BETWEEN 0 AND 5
  AND device_conn_type BETWEEN 0 AND 4, false)""")
def _(spark, d):
    typed = v.transform_types(frames.raw(spark, d))
    ok = F.lit(True)
    for column, bounds in v.RANGE_BOUNDS.items():
        ok = ok & v.valid_range(column, bounds)
    return typed.where(~ok).select("id", "banner_pos", "device_type", "device_conn_type")


_EMPTY = "concat_ws(','," + ",".join(f"CASE WHEN {c} = '' THEN '{c}' END" for c in STRING_COLUMNS) + ")"


@query("warn_empty_strings", f"SELECT CAST(id AS VARCHAR) AS id, {_EMPTY} AS empty_fields FROM typed WHERE {_EMPTY} <> ''")
def _(spark, d):
    rows = v.warn_empty_strings(v.transform_types(frames.raw(spark, d)))
    return rows.where(F.size("empty_fields") > 0).select(
        "id", F.array_join("empty_fields", ",").alias("empty_fields"))


@query("reject_reasons", "SELECT CAST(id AS VARCHAR) AS id, reason FROM judged WHERE reason IS NOT NULL")
def _(spark, d):
    return frames.judged(spark, d).where(F.col("reason").isNotNull()).select("id", "reason")


@query("reject_reason_counts", """SELECT coalesce(reason, 'valid') AS outcome, count(*) AS n_rows FROM judged GROUP BY 1""")
def _(spark, d):
    return ingest.stats_by_reason(frames.judged(spark, d))


@query("split_valid_rejects", """SELECT CAST(id AS VARCHAR) AS id, 'valid' AS side, CAST(NULL AS VARCHAR) AS error,
CAST(NULL AS BIGINT) AS "timestamp" FROM judged WHERE reason IS NULL
UNION ALL SELECT CAST(id AS VARCHAR), 'reject', reason, 1706745600000 FROM judged WHERE reason IS NOT NULL""")
def _(spark, d):
    """Both outputs of ingest; rejects carry error and time."""
    good, bad = ingest.split_valid_rejects(
        frames.raw(spark, d).withColumn("line_number", F.col("id")), "line_number",
        now=F.lit(f"{STAMP}Z").cast("timestamp"))
    none = F.lit(None)
    return good.select("id", F.lit("valid").alias("side"), none.cast("string").alias("error"),
                       none.cast("bigint").alias("timestamp")).unionByName(
        bad.select(F.col("line_number").cast("decimal(20,0)").alias("id"), F.lit("reject").alias("side"),
                   "error", "timestamp"))


@query("ingest_stats", f"""SELECT total, success, total - success AS validation_failed, CAST(0 AS BIGINT) AS send_failed,
{ratio('(100 * success)', 'total')} AS success_rate
FROM (SELECT count(*) AS total, count(*) FILTER (reason IS NULL) AS success FROM judged)""")
def _(spark, d):
    return ingest.ingest_stats(frames.judged(spark, d))


_LENIENT = ", ".join(f"nullif(trim({c}), '') AS {c}" if c == "id" or EVENT_TYPES[c] == "string"
                     else f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN CAST(trim({c}) AS BIGINT) END AS {c}" for c in EVENT_COLUMNS)


@query("csv_null_lenient", f"""SELECT {_LENIENT}, 0 AS corrupt, 'adlog' AS source, 1 AS has_file, 1 AS processed,
row_number() OVER (ORDER BY n, event_time) AS line FROM raw""")
def _(spark, d):
    """Lenient scan of the CSV copy: empty and unreadable fields become NULL."""
    ordered = frames.raw(spark, d).orderBy(F.col("id").cast("bigint"), "event_time")
    rows = files.csv_numbered_lines(spark, frames.csv_copy(spark, ordered), "adlog")
    return rows.select(*EVENT_COLUMNS, F.col(files.CORRUPT).isNotNull().cast("int").alias("corrupt"), F.col("_source").alias("source"),
                       (F.col("_file") != "").cast("int").alias("has_file"), F.col("_processed_at").isNotNull().cast("int").alias("processed"),
                       F.col("_line_number").alias("line"))


@query("recent_events", """SELECT CAST(id AS VARCHAR) AS id, click, event_time FROM (
SELECT id, CAST(click AS BIGINT) AS click, event_time FROM ad WHERE event_time >= TIMESTAMP '2024-01-29 00:00:00')""")
def _(spark, d):
    """Events since a moment; the bound reaches the Parquet scan."""
    return ad_events(spark, d, since="2024-01-29 00:00:00").select("id", "click", "event_time")
