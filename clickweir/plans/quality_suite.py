"""The standing quality suite over staging and marts."""

from __future__ import annotations

from clickweir.operators.quality import (Check, KeyCheck, RowCheck, check_accepted,
                                         check_expression, check_not_null, check_unique)

# --- fixed values: which columns of which table are checked, and the limits --------
EARLIEST_EVENT = "2014-10-21 00:00:00"
SOURCE_NOT_NULL = ("id", "click", "hour", "site_id")
STAGING_NOT_NULL = ("id", "click", "event_timestamp", "event_date", "event_hour", "site_id")
HOURLY_NOT_NULL = ("event_date", "event_hour_timestamp", "site_id", "total_impressions",
                   "total_clicks", "ctr_percentage", "clicks_count", "impressions_count")
FACT_NOT_NULL = ("event_date", "site_id", "daily_total_impressions", "daily_total_clicks",
                 "daily_ctr_percentage", "hours_with_data")
# -----------------------------------------------------------------------------------


def generic_checks(audited: bool = False) -> list[Check]:
    """Column checks. `audited` adds the write-time stamps stored tables carry."""
    checks: list[Check] = [
        *[check_not_null("source", c) for c in SOURCE_NOT_NULL],
        check_unique("source", "id"),
        check_accepted("source", "click", (0, 1)),
        *[check_not_null("staging", c) for c in STAGING_NOT_NULL],
        check_unique("staging", "id"),
        check_accepted("staging", "click", (0, 1)),
        *[check_not_null("hourly", c) for c in HOURLY_NOT_NULL],
        check_expression("hourly", "ctr_percentage", "ctr_percentage <= 100"),
        check_not_null("campaigns", "campaign_id"),
        check_unique("campaigns", "campaign_id"),
        check_accepted("campaigns", "is_active", (0, 1)),
        *[check_not_null("facts", c) for c in FACT_NOT_NULL],
        KeyCheck("unique_combination_facts", "facts", ("event_date", "site_id", "device_type")),
        check_expression("facts", "daily_total_impressions", "daily_total_impressions >= 0"),
        check_expression("facts", "daily_total_clicks", "daily_total_clicks >= 0"),
        check_expression("facts", "daily_ctr_percentage",
                         "daily_ctr_percentage <= 100 AND daily_ctr_percentage >= 0"),
        check_expression("facts", "hours_with_data", "hours_with_data > 0"),
    ]
    if audited:
        checks += [check_not_null(t, "loaded_at") for t in ("staging", "hourly", "campaigns", "facts")]
        checks += [check_not_null("campaigns", c) for c in ("created_at", "updated_at")]
    return checks


def singular_checks(as_of: str) -> list[Check]:
    """Seventeen business checks; each names the rows that break it."""
    # --- fixed values: the conditions that break a business rule ------------------------
    return [
        KeyCheck("staging_no_duplicates", "staging", ("id",)),
        RowCheck("staging_valid_click_values", "staging", "click NOT IN (0, 1) OR click IS NULL"),
        RowCheck("staging_valid_timestamps", "staging",
                 f"event_timestamp > TIMESTAMP_NTZ '{as_of}' "
                 f"OR event_timestamp < TIMESTAMP_NTZ '{EARLIEST_EVENT}'"),
        RowCheck("hourly_clicks_lte_impressions", "hourly", "clicks_count > impressions_count"),
        RowCheck("hourly_ctr_range", "hourly",
                 "ctr_percentage NOT BETWEEN 0 AND 100 OR ctr_percentage IS NULL"),
        RowCheck("hourly_has_data", "hourly", "total_impressions = 0 OR impressions_count = 0"),
        RowCheck("hourly_no_negative_values", "hourly",
                 "total_impressions < 0 OR total_clicks < 0 OR clicks_count < 0 OR impressions_count < 0"),
        RowCheck("facts_clicks_lte_impressions", "facts",
                 "daily_total_clicks > daily_total_impressions"),
        RowCheck("facts_ctr_range", "facts",
                 "daily_ctr_percentage NOT BETWEEN 0 AND 100 OR daily_ctr_percentage IS NULL"),
        RowCheck("facts_hours_valid", "facts", "hours_with_data NOT BETWEEN 0 AND 24"),
        RowCheck("facts_moving_avg_reasonable", "facts", "ctr_7day_moving_avg NOT BETWEEN 0 AND 100"),
        RowCheck("facts_no_negative_values", "facts",
                 "daily_total_impressions < 0 OR daily_total_clicks < 0 OR hours_with_data < 0"),
        RowCheck("facts_reasonable_dod_change", "facts",
                 "abs(coalesce(clicks_dod_pct_change, 0)) > 1000"),
        KeyCheck("facts_unique_date_site_device", "facts", ("event_date", "site_id", "device_type")),
        KeyCheck("campaigns_combination_unique", "campaigns",
                 ("site_id", "app_id", "banner_pos", "device_type")),
        KeyCheck("campaigns_surrogate_key_unique", "campaigns", ("campaign_id",)),
        RowCheck("campaigns_valid_is_active", "campaigns", "is_active NOT IN (0, 1) OR is_active IS NULL"),
    ]
