"""SQL functions over the stored metric tables, for sessions that speak SQL.

`as_of` is an argument like everywhere. The functions are temporary: they are registered in a session over its views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# name -> its parameters, what it returns, its body
FUNCTIONS = {
    "ctr_of": ("clicks BIGINT, impressions BIGINT", "DOUBLE",
               "CASE WHEN impressions > 0 THEN CAST(clicks AS DOUBLE) / CAST(impressions AS DOUBLE) * 100 ELSE CAST(0 AS DOUBLE) END"),
    "avg_ctr_since": ("as_of TIMESTAMP_NTZ, hours INT", "DOUBLE",
                      "SELECT avg(ctr) FROM metrics_1min WHERE window_start >= as_of - make_dt_interval(0, hours)"),
}
_LATEST = "SELECT window_start, window_end, impressions, clicks, ctr FROM metrics_{width} WHERE window_start >= as_of - INTERVAL {hours} HOUR"
_ROW = "window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, impressions BIGINT, clicks BIGINT, ctr DOUBLE"
TABLE_FUNCTIONS = {
    "latest_ctr_1min": ("as_of TIMESTAMP_NTZ", _ROW, _LATEST.format(width="1min", hours=1)),
    "latest_ctr_5min": ("as_of TIMESTAMP_NTZ", _ROW, _LATEST.format(width="5min", hours=2)),
    "window_totals": ("first TIMESTAMP_NTZ, last TIMESTAMP_NTZ", "impressions BIGINT, clicks BIGINT, ctr DOUBLE",
                      "SELECT i, c, ctr_of(c, i) FROM (SELECT sum(impressions) AS i, sum(clicks) AS c FROM metrics_1min "
                      "WHERE window_start >= first AND window_start < last)"),
}


def register_functions(spark: SparkSession, minutes: DataFrame, five_minutes: DataFrame) -> None:
    """Make the functions over the two metric tables, whose times have no zone."""
    minutes.createOrReplaceTempView("metrics_1min")
    five_minutes.createOrReplaceTempView("metrics_5min")
    for name, (given, returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS {returns} RETURN {body}")
    for name, (given, returns, body) in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS TABLE({returns}) RETURN {body}")
