"""Declared event schema and the fixed rules that go with it."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the 24 event columns and their types -----------------------
EVENT_TYPES: dict[str, str] = {
    "id": "decimal(20,0)",
    "click": "int",
    "hour": "int",
    "banner_pos": "int",
    "site_id": "string",
    "site_domain": "string",
    "site_category": "string",
    "app_id": "string",
    "app_domain": "string",
    "app_category": "string",
    "device_id": "string",
    "device_ip": "string",
    "device_model": "string",
    "device_type": "int",
    "device_conn_type": "int",
    "c1": "int",
    "c14": "int",
    "c15": "int",
    "c16": "int",
    "c17": "int",
    "c18": "int",
    "c19": "int",
    "c20": "int",
    "c21": "int",
}
# --- fixed values: inclusive bounds of the range rules -------------------------
HOUR_BOUNDS = (10000000, 99999999)
RANGE_BOUNDS: dict[str, tuple[int, int]] = {
    "banner_pos": (0, 7),
    "device_type": (0, 5),
    "device_conn_type": (0, 4),  # observed data also holds 5; pass other bounds to allow it
}
CLICK_VALUES = (0, 1)
# --- fixed values: mart grains --------------------------------------------------
CAMPAIGN_COLUMNS = ("site_id", "site_domain", "site_category", "app_id", "app_domain",
                    "app_category", "banner_pos", "device_type")
HOURLY_GRAIN = ("event_date", "event_hour", "site_id", "site_domain", "site_category",
                "device_type")
DAILY_GRAIN = ("event_date", "site_id", "site_domain", "site_category", "device_type")
ENCODED_COLUMNS = ("site_id", "site_domain", "site_category", "app_id", "app_domain",
                   "app_category", "device_id", "device_ip", "device_model", "hour")
# -------------------------------------------------------------------------------

EVENT_COLUMNS = tuple(EVENT_TYPES)
INT_COLUMNS = tuple(c for c, t in EVENT_TYPES.items() if t == "int")
STRING_COLUMNS = tuple(c for c, t in EVENT_TYPES.items() if t == "string")

_SPARK_TYPES = {"int": T.IntegerType(), "string": T.StringType(),
                "decimal(20,0)": T.DecimalType(20, 0)}
EVENT_SCHEMA = T.StructType([
    T.StructField(name, _SPARK_TYPES[kind]) for name, kind in EVENT_TYPES.items()
])

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in EVENT_COLUMNS])

METRIC_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("impressions", T.LongType()),
    T.StructField("clicks", T.LongType()),
    T.StructField("ctr", T.DoubleType()),
])

# Envelope a dead letter travels in; the inner message stays JSON text so that a
# message of any shape survives the round trip.
DLQ_SCHEMA = T.StructType([
    T.StructField("original_message", T.StringType()),
    T.StructField("sent_to_dlq_at", T.StringType()),
    T.StructField("reason", T.StringType()),
])

# What a retry message holds: the event, whose id may be any text, and its history.
RETRY_SCHEMA = T.StructType([
    *[T.StructField(f.name, T.StringType() if f.name == "id" else f.dataType) for f in EVENT_SCHEMA],
    T.StructField("retry_count", T.IntegerType()),
    T.StructField("last_error", T.StringType()),
    T.StructField("error_history", T.ArrayType(T.StringType())),
])
