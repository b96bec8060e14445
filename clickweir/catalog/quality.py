"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickweir.catalog import frames
from clickweir.catalog.registry import query
from clickweir.catalog.sql import STAMP
from clickweir.functions.payloads import audit_columns
from clickweir.operators import profiling, quality as q
from clickweir.plans import marts
from clickweir.plans.quality_suite import generic_checks, singular_checks
from clickweir.schema import EVENT_SCHEMA, EVENT_TYPES
from clickweir.session import scratch_path
from clickweir.sources.tables import materialize_table


@query("dq_not_null", "SELECT CAST(id AS VARCHAR) AS id, CAST(hour AS BIGINT) AS hour FROM ad WHERE hour IS NULL")
def _(spark, d):
    return q.not_null(frames.ads(spark, d), "hour").select("id", "hour")


@query("dq_unique", "SELECT CAST(id AS VARCHAR) AS id, count(*) AS n_rows FROM ad GROUP BY ad.id HAVING count(*) > 1")
def _(spark, d):
    return q.unique(frames.ads(spark, d), "id")


@query("dq_accepted_values", "SELECT CAST(id AS VARCHAR) AS id, CAST(click AS BIGINT) AS click FROM ad WHERE click NOT IN (0, 1)")
def _(spark, d):
    return q.accepted_values(frames.ads(spark, d), "click", (0, 1)).select("id", "click")


@query("dq_relationships", """SELECT device_id AS orphan_value, count(*) AS n_rows FROM ad
WHERE device_id NOT IN (SELECT device_id FROM stg WHERE banner_pos = 0 AND c18 = 0) GROUP BY 1""")
def _(spark, d):
    """Devices never seen under one narrow condition."""
    parents = frames.staged(spark, d, "device_id", "banner_pos", "c18").where("banner_pos = 0 AND c18 = 0")
    return q.relationships(frames.ads(spark, d), "device_id", parents, "device_id")


@query("dq_expression", """SELECT CAST(event_date AS VARCHAR) AS event_date, site_id, CAST(device_type AS BIGINT) AS device_type,
daily_ctr_percentage FROM fact WHERE NOT coalesce(daily_ctr_percentage <= 40, false)""")
def _(spark, d):
    return q.expression(frames.daily(spark, d), "daily_ctr_percentage <= 40").select(
        "event_date", "site_id", "device_type", "daily_ctr_percentage")


@query("dq_unique_combination", """SELECT CAST(hour AS BIGINT) AS hour, site_id, CAST(device_type AS BIGINT) AS device_type, count(*) AS n_rows
FROM ad GROUP BY ALL HAVING count(*) > 1""")
def _(spark, d):
    return q.unique_combination(frames.ads(spark, d), ["hour", "site_id", "device_type"])


def stored_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The tables a report runs on. Staging and hourly are written once and read by
    all checks; a report over unsaved frames would redo the de-duplication per check."""
    columns = (*frames.MART_COLUMNS, *marts.CAMPAIGN_COLUMNS)
    def keep(df, name, day="event_date"):
        return materialize_table(df, scratch_path(spark, name), day, loaded_at="loaded_at")

    staging = keep(frames.staged(spark, d, *columns), "staging")
    hourly = keep(marts.hourly_agg(staging), "hourly")
    facts = keep(marts.daily_metrics(marts.daily_agg(hourly, unique_hours=True)), "facts")
    stamps = audit_columns(["created_at", "updated_at"])
    campaigns = keep(marts.dim_campaigns(staging).select("*", *stamps), "campaigns", None)
    return {"source": frames.ads(spark, d), "staging": staging, "hourly": hourly, "facts": facts,
            "campaigns": campaigns}


# violated conditions of the singular checks, restated for the twin
_SINGULAR = [
    ("staging_no_duplicates", "(SELECT id FROM stg GROUP BY id HAVING count(*) > 1)"),
    ("staging_valid_click_values", "(SELECT 1 FROM stg WHERE click NOT IN (0, 1) OR click IS NULL)"),
    ("staging_valid_timestamps", f"(SELECT 1 FROM stg WHERE event_timestamp > TIMESTAMP '{STAMP}' "
                                 "OR event_timestamp < TIMESTAMP '2014-10-21 00:00:00')"),
    ("hourly_clicks_lte_impressions", "(SELECT 1 FROM hourly WHERE clicks_count > impressions_count)"),
    ("hourly_ctr_range", "(SELECT 1 FROM hourly WHERE ctr_percentage < 0 OR ctr_percentage > 100 OR ctr_percentage IS NULL)"),
    ("hourly_has_data", "(SELECT 1 FROM hourly WHERE total_impressions = 0 OR impressions_count = 0)"),
    ("hourly_no_negative_values", "(SELECT 1 FROM hourly WHERE total_impressions < 0 OR total_clicks < 0 "
                                  "OR clicks_count < 0 OR impressions_count < 0)"),
    ("facts_clicks_lte_impressions", "(SELECT 1 FROM fact WHERE daily_total_clicks > daily_total_impressions)"),
    ("facts_ctr_range", "(SELECT 1 FROM fact WHERE daily_ctr_percentage < 0 OR daily_ctr_percentage > 100 "
                        "OR daily_ctr_percentage IS NULL)"),
    ("facts_hours_valid", "(SELECT 1 FROM fact WHERE hours_with_data < 0 OR hours_with_data > 24)"),
    ("facts_moving_avg_reasonable", "(SELECT 1 FROM fact WHERE ctr_7day_moving_avg < 0 OR ctr_7day_moving_avg > 100)"),
    ("facts_no_negative_values", "(SELECT 1 FROM fact WHERE daily_total_impressions < 0 OR daily_total_clicks < 0 "
                                 "OR hours_with_data < 0)"),
    ("facts_reasonable_dod_change", "(SELECT 1 FROM fact WHERE abs(coalesce(clicks_dod_pct_change, 0)) > 1000)"),
    ("facts_unique_date_site_device", "(SELECT 1 FROM fact GROUP BY event_date, site_id, device_type HAVING count(*) > 1)"),
    ("campaigns_combination_unique", "(SELECT 1 FROM dim GROUP BY site_id, app_id, banner_pos, device_type HAVING count(*) > 1)"),
    ("campaigns_surrogate_key_unique", "(SELECT 1 FROM dim GROUP BY campaign_id HAVING count(*) > 1)"),
    ("campaigns_valid_is_active", "(SELECT 1 FROM dim WHERE is_active NOT IN (0, 1) OR is_active IS NULL)"),
]


def _report_sql(tests: list[tuple[str, str]]) -> str:
    rows = " UNION ALL ".join(f"SELECT CAST({i + 1} AS BIGINT) AS seq, '{name}' AS test, "
                              f"(SELECT count(*) FROM {rows} v) AS failures" for i, (name, rows) in enumerate(tests))
    return f"SELECT seq, test, failures, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM ({rows})"


@query("dq_singular_suite", _report_sql(_SINGULAR))
def _(spark, d):
    return q.report(singular_checks(STAMP), stored_tables(spark, d))


def _missing(table: str, sql_table: str, columns: str) -> list[tuple[str, str]]:
    return [(f"not_null_{table}_{c}", f"(SELECT 1 FROM {sql_table} WHERE {c} IS NULL)") for c in columns.split()]


_NEVER = "(SELECT 1 WHERE false)"      # stamps are set when a table is written
_GENERIC = [
    *_missing("source", "ad", "id click hour site_id"),
    ("unique_source_id", "(SELECT id FROM ad GROUP BY id HAVING count(*) > 1)"),
    ("accepted_values_source_click", "(SELECT 1 FROM ad WHERE click <> 0 AND click <> 1)"),
    *_missing("staging", "stg", "id click event_timestamp event_date event_hour site_id"),
    ("unique_staging_id", "(SELECT id FROM stg GROUP BY id HAVING count(*) > 1)"),
    ("accepted_values_staging_click", "(SELECT 1 FROM stg WHERE click <> 0 AND click <> 1)"),
    *_missing("hourly", "hourly", "event_date event_hour_timestamp site_id total_impressions total_clicks ctr_percentage clicks_count impressions_count"),
    ("expression_hourly_ctr_percentage", "(SELECT 1 FROM hourly WHERE ctr_percentage > 100 OR ctr_percentage IS NULL)"),
    *_missing("campaigns", "dim", "campaign_id"),
    ("unique_campaigns_campaign_id", "(SELECT 1 FROM dim GROUP BY campaign_id HAVING count(*) > 1)"),
    ("accepted_values_campaigns_is_active", "(SELECT 1 FROM dim WHERE is_active <> 0 AND is_active <> 1)"),
    *_missing("facts", "fact", "event_date site_id daily_total_impressions daily_total_clicks daily_ctr_percentage hours_with_data"),
    ("unique_combination_facts", "(SELECT 1 FROM fact GROUP BY event_date, site_id, device_type HAVING count(*) > 1)"),
    ("expression_facts_daily_total_impressions", "(SELECT 1 FROM fact WHERE daily_total_impressions < 0 OR daily_total_impressions IS NULL)"),
    ("expression_facts_daily_total_clicks", "(SELECT 1 FROM fact WHERE daily_total_clicks < 0 OR daily_total_clicks IS NULL)"),
    ("expression_facts_daily_ctr_percentage", "(SELECT 1 FROM fact WHERE daily_ctr_percentage > 100 OR daily_ctr_percentage < 0 OR daily_ctr_percentage IS NULL)"),
    ("expression_facts_hours_with_data", "(SELECT 1 FROM fact WHERE hours_with_data <= 0 OR hours_with_data IS NULL)"),
    *[(f"not_null_{t}_loaded_at", _NEVER) for t in ("staging", "hourly", "campaigns", "facts")],
    *[(f"not_null_campaigns_{c}", _NEVER) for c in ("created_at", "updated_at")],
]


@query("dq_report", _report_sql(_GENERIC))
def _(spark, d):
    """All column checks of source, staging and marts."""
    return q.report(generic_checks(audited=True), stored_tables(spark, d))


_FAST = _report_sql(_GENERIC)


@query("dq_report_fail_fast", f"""SELECT seq, test, failures, CASE WHEN seq > coalesce(first_fail, 1000) THEN 'skipped'
ELSE status END AS status FROM (SELECT *, min(CASE WHEN failures > 0 THEN seq END) OVER () AS first_fail FROM ({_FAST}))""")
def _(spark, d):
    """The statuses of a run that stops at the first failure, with the failures of all checks."""
    return q.report(generic_checks(audited=True), stored_tables(spark, d), fail_fast=True, count_skipped=True)


_DRIFT = " UNION ALL ".join(
    [f"SELECT '{c}' AS field, 'retyped' AS change, '{t}' AS expected_type, 'string' AS actual_type, "
     f"count({c}) AS n_values FROM raw" for c, t in EVENT_TYPES.items() if t != "string"]
    + ["SELECT 'event_time', 'added', NULL, 'timestamp_ntz', count(event_time) FROM raw"])


@query("schema_drift", _DRIFT)
def _(spark, d):
    """The untyped feed against the declared schema."""
    return profiling.schema_drift_report(frames.raw(spark, d), EVENT_SCHEMA)
