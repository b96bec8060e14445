"""Shared CTEs of the SQL twins, written for DuckDB.

The twins state results independently of the Spark code: plain window functions and
aggregates over the whole tables.
"""

from __future__ import annotations

import re

from clickweir.schema import EVENT_COLUMNS, EVENT_TYPES

AS_OF = "2024-01-31 00:00:00"
MIDDAY = "2024-01-15 12:00:00"
STAMP = "2024-02-01 00:00:00"


def cents(n: str, d: str) -> str:
    """round(n / d, 2) in whole hundredths, half away from zero, for d >= 0."""
    return (f"(CASE WHEN ({d}) = 0 THEN NULL ELSE CAST(sign({n}) * ((abs({n}) * 200 + ({d})) "
            f"// (2 * ({d}))) AS BIGINT) END)")


def ratio(n: str, d: str) -> str:
    return f"({cents(n, d)} / 100.0::DOUBLE)"


def ctr(clicks: str, events: str) -> str:
    return ratio(f"100 * {clicks}", events)


def stream_ctr(clicks: str, imps: str) -> str:
    return (f"(CASE WHEN {imps} > 0 THEN CAST({clicks} AS DOUBLE) / CAST({imps} AS DOUBLE) * 100 "
            f"ELSE 0.0::DOUBLE END)")


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


CTES: dict[str, str] = {}

CTES["ad"] = """
  SELECT
    CAST(event_id AS DECIMAL(20,0)) AS id,
    CASE WHEN event_id % 97 = 96 THEN 2
         WHEN (event_type = 'click') <> (d = 1) THEN 1 ELSE 0 END AS click,
    CASE WHEN event_id % 101 = 100 THEN NULL
         ELSE CAST((year(event_time) % 100) * 1000000 + month(event_time) * 10000
                 + day(event_time) * 100 + hour(event_time) AS INT) END AS hour,
    CAST(event_id % 8 AS INT) AS banner_pos,
    CASE WHEN event_id % 89 = 88 THEN NULL
         ELSE concat('site_', CAST(user_id % 7 AS VARCHAR)) END AS site_id,
    concat('dom_', CAST(user_id % 7 AS VARCHAR)) AS site_domain,
    concat('cat_', CAST((user_id % 7) % 3 AS VARCHAR)) AS site_category,
    CASE WHEN user_id % 11 = 0 THEN NULL
         ELSE concat('app_', CAST(user_id % 5 AS VARCHAR)) END AS app_id,
    concat('appdom_', CAST(user_id % 5 AS VARCHAR)) AS app_domain,
    concat('appcat_', CAST(user_id % 2 AS VARCHAR)) AS app_category,
    concat('dev_', CAST(user_id AS VARCHAR)) AS device_id,
    concat('ip_', CAST(event_id % 997 AS VARCHAR)) AS device_ip,
    concat('model_', CAST(user_id % 13 AS VARCHAR)) AS device_model,
    CAST(user_id % 4 AS INT) AS device_type,
    CAST(event_id % 6 AS INT) AS device_conn_type,
    1005 AS c1, k AS c14, 320 AS c15, 50 AS c16, k * 7 AS c17,
    k % 4 AS c18, 35 AS c19, -1 AS c20, k + 13 AS c21,
    event_time
  FROM (SELECT *, CASE WHEN d = 1 THEN ts + INTERVAL 1 HOUR ELSE ts END AS event_time
        FROM (SELECT event_id, ts, user_id, event_type,
                     CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, 0 AS d FROM events
              UNION ALL
              SELECT event_id, ts, user_id, event_type,
                     CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, 1 AS d FROM events
              WHERE event_id % 50 = 0))"""

CTES["valid"] = """
  SELECT *, make_timestamp(2000 + hour // 1000000, (hour // 10000) % 100, (hour // 100) % 100,
                           hour % 100, 0, 0) AS event_timestamp
  FROM ad WHERE click IN (0, 1) AND id IS NOT NULL AND hour IS NOT NULL AND site_id IS NOT NULL"""

CTES["stg"] = """
  SELECT *, CAST(event_timestamp AS DATE) AS event_date, strftime(event_timestamp, '%H') AS event_hour
  FROM valid QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_timestamp DESC) = 1"""

CTES["hourly"] = f"""
  SELECT event_date, concat(CAST(event_date AS VARCHAR), ' ', event_hour, ':00:00') AS event_hour_timestamp,
         site_id, site_domain, site_category, device_type, total_impressions, total_clicks,
         {ctr('total_clicks', 'total_impressions')} AS ctr_percentage,
         total_clicks AS clicks_count, total_impressions AS impressions_count, has_clicks, no_clicks
  FROM (SELECT event_date, event_hour, site_id, site_domain, site_category, device_type,
               count(*) AS total_impressions, CAST(sum(click) AS BIGINT) AS total_clicks,
               CAST(max(click) AS BIGINT) AS has_clicks, CAST(min(click) AS BIGINT) AS no_clicks
        FROM stg GROUP BY ALL)"""

CTES["daily"] = f"""
  SELECT *, {ctr('daily_total_clicks', 'daily_total_impressions')} AS daily_ctr_percentage,
         {cents('100 * daily_total_clicks', 'daily_total_impressions')} AS rate_cents
  FROM (SELECT event_date, site_id, site_domain, site_category, device_type,
               CAST(sum(total_impressions) AS BIGINT) AS daily_total_impressions,
               CAST(sum(total_clicks) AS BIGINT) AS daily_total_clicks,
               count(DISTINCT event_hour_timestamp) AS hours_with_data
        FROM hourly GROUP BY event_date, site_id, site_domain, site_category, device_type)"""

CTES["lagged"] = """
  SELECT *, lag(daily_total_clicks) OVER w AS previous_day_clicks,
         lag(daily_ctr_percentage) OVER w AS previous_day_ctr,
         CAST(sum(daily_total_clicks) OVER w7 AS BIGINT) AS clicks7,
         CAST(sum(rate_cents) OVER w7 AS BIGINT) AS rate7, count(*) OVER w7 AS n7
  FROM daily
  WINDOW w AS (PARTITION BY site_id, device_type ORDER BY event_date, site_domain, site_category),
         w7 AS (PARTITION BY site_id, device_type ORDER BY event_date, site_domain, site_category
                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

CTES["fact"] = f"""
  SELECT event_date, site_id, site_domain, site_category, device_type, daily_total_impressions,
         daily_total_clicks, daily_ctr_percentage, hours_with_data,
         {ratio('(100 * (daily_total_clicks - previous_day_clicks))', 'previous_day_clicks')}
           AS clicks_dod_pct_change,
         {ratio('clicks7', 'n7')} AS clicks_7day_moving_avg,
         (2 * rate7 + n7) // (2 * n7) / 100.0::DOUBLE AS ctr_7day_moving_avg
  FROM lagged"""

CTES["combos"] = """
  SELECT DISTINCT site_id, site_domain, site_category, app_id, app_domain, app_category,
         banner_pos, device_type
  FROM stg WHERE site_id IS NOT NULL OR app_id IS NOT NULL"""

CTES["dim"] = """
  SELECT row_number() OVER (ORDER BY site_id NULLS LAST, app_id NULLS LAST, banner_pos NULLS LAST,
           device_type NULLS LAST, site_domain NULLS LAST, site_category NULLS LAST,
           app_domain NULLS LAST, app_category NULLS LAST) AS campaign_id,
         *, 1 AS is_active
  FROM combos"""

for _name, _width in (("m1", 1), ("m5", 5)):
    CTES[_name] = f"""
  SELECT window_start, window_start + INTERVAL {_width} MINUTE AS window_end, impressions, clicks,
         {stream_ctr('clicks', 'impressions')} AS ctr
  FROM (SELECT time_bucket(INTERVAL {_width} MINUTE, event_time) AS window_start,
               count(*) FILTER (click = 0) AS impressions, count(*) FILTER (click = 1) AS clicks
        FROM ad GROUP BY 1)"""

# --- the untyped feed and its typed form ---------------------------------------

_RAW_SPECIAL = {
    "click": "CASE WHEN n % 107 = 106 THEN '5' WHEN n % 109 = 108 THEN {t} || '.0' ELSE {t} END",
    "hour": "CASE WHEN n % 103 = 102 THEN 'invalid' ELSE {t} END",
    "banner_pos": "CASE WHEN n % 113 = 112 THEN '10' ELSE {t} END",
    "site_domain": "CASE WHEN n % 127 = 126 THEN '' ELSE {t} END",
    "device_type": "CASE WHEN n % 131 = 130 THEN '10' ELSE {t} END",
    "c14": "CASE WHEN n % 109 = 108 THEN {t} || 'e0' ELSE {t} END",
    "c21": "CASE WHEN n % 137 = 136 THEN NULL ELSE {t} END",
}


def _raw(c: str) -> str:
    text = f"coalesce(CAST({c} AS VARCHAR), '')"
    return _RAW_SPECIAL.get(c, "{t}").replace("{t}", text) + f" AS {c}"


CTES["raw"] = ("\n  SELECT " + ",\n         ".join(_raw(c) for c in EVENT_COLUMNS)
               + ",\n         event_time, n FROM (SELECT *, CAST(id AS BIGINT) AS n FROM ad)")


def _typed(c: str) -> str:
    kind = EVENT_TYPES[c]
    if kind == "string":
        return c
    if kind == "int":
        return f"TRY_CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INT)"
    return f"TRY_CAST({c} AS DECIMAL(20,0))"


_NUMERIC = [c for c in EVENT_COLUMNS if EVENT_TYPES[c] != "string"]
CTES["typed"] = (
    "\n  SELECT " + ", ".join(f"{_typed(c)} AS {c}" for c in EVENT_COLUMNS)
    + ",\n    CASE " + " ".join(f"WHEN {c} IS NOT NULL AND {_typed(c)} IS NULL THEN '{c}'" for c in _NUMERIC)
    + " END AS type_error,\n    CASE " + " ".join(f"WHEN {c} IS NULL THEN '{c}'" for c in EVENT_COLUMNS)
    + " END AS missing_field, event_time, n FROM raw")

CTES["judged"] = """
  SELECT *, CASE WHEN type_error IS NOT NULL THEN 'type_error'
    WHEN missing_field IS NOT NULL THEN 'missing_field'
    WHEN click NOT IN (0, 1) THEN 'invalid_click'
    WHEN hour NOT BETWEEN 10000000 AND 99999999 THEN 'invalid_hour'
    WHEN banner_pos NOT BETWEEN 0 AND 7 THEN 'invalid_banner_pos'
    WHEN device_type NOT BETWEEN 0 AND 5 THEN 'invalid_device_type'
    WHEN device_conn_type NOT BETWEEN 0 AND 4 THEN 'invalid_device_conn_type' END AS reason
  FROM typed"""

# --- retry messages --------------------------------------------------------------

_HELD = [c for c in EVENT_COLUMNS if c not in ("id", "click", "hour")]


def _json(c: str) -> str:
    value = f"CAST({c} AS VARCHAR)" if EVENT_TYPES[c] == "int" else f"'\"' || {c} || '\"'"
    return f"',\"{c}\":', coalesce({value}, 'null')"


CTES["retry"] = f"""
  SELECT n, CASE WHEN n % 53 = 52 THEN 'msg-' || n ELSE CAST(n AS VARCHAR) END AS id, CASE WHEN n % 59 <> 58 THEN click END AS click,
         CASE WHEN n % 67 <> 66 OR n % 59 = 58 THEN hour END AS hour, {', '.join(_HELD)}, c18 AS retry_count, n % 61 = 60 AS broken,
         last_error, CASE WHEN n % 61 = 60 THEN concat('{{"id":', n, ',"click"') END AS broken_text, event_time,
         concat('{{"id":', CASE WHEN n % 53 = 52 THEN '"msg-' || n || '"' ELSE CAST(n AS VARCHAR) END,
                ',"click":', CASE WHEN n % 59 = 58 THEN '"x"' ELSE CAST(click AS VARCHAR) END,
                CASE WHEN n % 67 = 66 AND n % 59 <> 58 THEN '' ELSE ',"hour":' || coalesce(CAST(hour AS VARCHAR), 'null') END,
                {', '.join(_json(c) for c in _HELD)}, ',"retry_count":', c18,
                ',"last_error":"', last_error, '","error_history":["', last_error, '"]}}') AS message
  FROM (SELECT *, CAST(id AS BIGINT) AS n, CASE banner_pos % 4 WHEN 0 THEN 'Timeout after 30s' WHEN 1 THEN 'Connection error: reset'
           WHEN 2 THEN 'Transformation failed' ELSE 'Schema mismatch' END AS last_error FROM ad)"""

CTES["routed"] = """
  SELECT *, CASE WHEN broken THEN NULL ELSE retry_count + 1 END AS next_retry_count,
         CASE WHEN broken OR retry_count + 1 >= 3 THEN 'dlq' ELSE 'retry' END AS action,
         CASE WHEN NOT broken AND retry_count + 1 < 3
              THEN CAST(least(1000 * pow(2, retry_count), 32000) AS BIGINT) END AS backoff_ms,
         CASE WHEN broken THEN concat('JSON decode error: ', broken_text)
              WHEN retry_count + 1 >= 3
              THEN concat('Max retries exceeded (', retry_count + 1, ')') END AS reason
  FROM retry"""


def with_ctes(body: str) -> str:
    """Prefix `body` with the shared CTEs it uses, in dependency order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    chain = [f"{name} AS ({CTES[name]})" for name in CTES if name in needed]
    body = body.strip()
    if not chain:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(chain) + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(chain) + ",\n" + body[5:]
    return "WITH " + ",\n".join(chain) + "\n" + body
