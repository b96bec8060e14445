"""Queries over tables that are kept up to date: refreshed by the day, compacted, cleaned up."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from clickweir.catalog import frames
from clickweir.catalog.registry import query
from clickweir.catalog.serving import OLD, stored_events
from clickweir.catalog.streams import RAW, raw_rows
from clickweir.functions.times import parse_hour
from clickweir.operators.windows import FIVE_MINUTES, ONE_MINUTE
from clickweir.operators.quality import RowCheck
from clickweir.plans import dimension_history as history, faults, incremental, marts, retry_loop, serving, sketches, sql_functions
from clickweir.plans.model_runs import Model, run_models
from clickweir.plans.quality_suite import generic_checks
from clickweir.schema import CAMPAIGN_COLUMNS, DAILY_GRAIN, EVENT_TYPES
from clickweir.session import scratch_path
from clickweir.sources import compaction, schema_versions, tables
from clickweir.sources.driver_tables import ad_events_of_days, ad_events_stream
from clickweir.sources.event_files import CORRUPT
from clickweir.streaming import jobs

_DAY = "CAST(event_date AS VARCHAR) AS event_date"
_KEYS = f"{_DAY}, site_id, site_domain, site_category, CAST(device_type AS BIGINT) AS device_type"
# what the first version of the event table lacks: a third of one day, and one site's events of another
_LATE = "(event_date = DATE '2024-01-10' AND CAST(id AS BIGINT) % 3 = 0 OR event_date = DATE '2024-01-20' AND site_id = 'site_4')"


def _refreshed(spark, d):
    """(folder of the marts, what the refresh replaced) after two days' events changed."""
    path, root = scratch_path(spark, "events-by-day"), scratch_path(spark, "daily-marts")
    day = parse_hour(F.col("hour")).cast("date")
    events = frames.ads(spark, d).withColumn("event_date", day).where("event_date IS NOT NULL")
    tables.write_table(events.where(f"NOT coalesce({_LATE}, false)"), path)
    incremental.refresh_daily_marts(spark, path, root)
    late = ad_events_of_days(spark, d, ["2024-01-10", "2024-01-20"]).withColumn("event_date", day).where("event_date IS NOT NULL")
    tables.write_table(late, path, refresh="partitions")
    return root, incremental.refresh_daily_marts(spark, path, root)


@query("incremental_refresh", f"""SELECT {_KEYS}, daily_total_impressions, daily_total_clicks, daily_ctr_percentage,
hours_with_data, clicks_dod_pct_change, clicks_7day_moving_avg, ctr_7day_moving_avg FROM fact""")
def _(spark, d):
    """Facts after a refresh of the changed days alone: those of a full one."""
    root, _ = _refreshed(spark, d)
    return spark.read.parquet(f"{root}/facts").select(
        *DAILY_GRAIN, "daily_total_impressions", "daily_total_clicks", "daily_ctr_percentage", "hours_with_data",
        "clicks_dod_pct_change", "clicks_7day_moving_avg", "ctr_7day_moving_avg")


def _days_sql(source: str) -> str:
    return f"""SELECT event_date, site_id, device_type, site_domain, site_category, count(*) AS n, sum(click) AS c, count(DISTINCT event_hour) AS h
FROM {source} GROUP BY ALL"""


@query("incremental_days", f"""WITH s1 AS (SELECT *, CAST(event_timestamp AS DATE) AS event_date, strftime(event_timestamp, '%H') AS event_hour
  FROM (SELECT * FROM valid WHERE NOT coalesce({_LATE.replace('event_date', 'CAST(event_timestamp AS DATE)')}, false))
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_timestamp DESC) = 1),
d1 AS ({_days_sql('s1')}), d2 AS ({_days_sql('stg')}),
changed AS (SELECT DISTINCT event_date, site_id, device_type, site_domain, site_category FROM
  ((SELECT * FROM d1 EXCEPT SELECT * FROM d2) UNION ALL (SELECT * FROM d2 EXCEPT SELECT * FROM d1))),
numbered AS (SELECT *, row_number() OVER (PARTITION BY site_id, device_type ORDER BY event_date, site_domain, site_category) AS k FROM d2),
marks AS (SELECT c.site_id, c.device_type, count(*) FILTER ((r.event_date, r.site_domain, r.site_category)
    <= (c.event_date, c.site_domain, c.site_category)) AS k
  FROM changed c JOIN numbered r USING (site_id, device_type) GROUP BY c.event_date, c.site_id, c.device_type, c.site_domain, c.site_category),
days AS (SELECT event_date FROM changed UNION
  SELECT r.event_date FROM numbered r JOIN marks m USING (site_id, device_type) WHERE r.k BETWEEN m.k AND m.k + 6)
SELECT {_DAY}, CAST(event_date IN (SELECT event_date FROM changed) AS BIGINT) AS changed FROM days""")
def _(spark, d):
    """The days of facts that the refresh replaced, and whether their counts changed or only what follows from others'."""
    _, done = _refreshed(spark, d)
    return spark.createDataFrame([(day, int(day in done.daily)) for day in done.facts], "event_date date, changed int")


@query("compact_raw_events", RAW)
def _(spark, d):
    """The raw table after many small batches and a compaction: the same rows."""
    path = scratch_path(spark, "sink")
    events = frames.ads(spark, d).withColumn("event_time", F.col("event_time").cast("timestamp"))
    for batch in range(6):
        part = events.where(F.pmod(F.xxhash64("id"), F.lit(6)) == batch).withColumn("created_at", F.col("event_time")) \
            .withColumn("updated_at", F.col("event_time")).withColumn("event_date", F.to_date("event_time"))
        tables.write_batch(part, path, batch, ["event_date"], run="a")
    compaction.compact(spark, path, target_bytes=1 << 20)
    return raw_rows(spark, path)


@query("maintenance_report", f"""SELECT 'cleanup_events' AS step, CAST(count(*) FILTER ({OLD}) AS VARCHAR) AS details FROM ad
UNION ALL SELECT 'optimize_tables', 'Optimized' FROM range(3) UNION ALL SELECT 'status', 'Maintenance completed'""")
def _(spark, d):
    """Clean-up, compaction of the raw table and of both metric tables, status."""
    metrics = {}
    for name, width in (("ctr_metrics_1min", ONE_MINUTE), ("ctr_metrics_5min", FIVE_MINUTES)):
        frame, path = jobs.ctr_metrics_stream(ad_events_stream(spark, d), width), scratch_path(spark, "sink")
        jobs.StreamRun(frame, jobs.versions_sink(path), scratch_path(spark, "progress"), "update").catch_up()
        metrics[name] = (path, frame.schema)
    return serving.maintenance(spark, stored_events(spark, d), "2024-01-30 12:00:00", 15, metrics=metrics)


# --- retries to their end -------------------------------------------------------------

_START = "2024-02-01 00:00:00"
# the end of the minute that a message is due in
_DUE = """date_trunc('minute', {failed} + to_milliseconds(CAST(least(20000 * pow(2, {attempt} - 1), 100000) AS BIGINT))) + INTERVAL 1 MINUTE"""


@query("retry_loop", f"""WITH RECURSIVE first AS (SELECT id AS key, retry_count + 1 AS attempt, TIMESTAMP '{_START}' AS failed FROM retry
  WHERE NOT broken AND n % 50 <> 0 AND last_error <> 'Schema mismatch'),
tries AS (
  SELECT key, attempt, failed, CASE WHEN attempt < 6 THEN {_DUE.format(failed='failed', attempt='attempt')} END AS due FROM first
  UNION ALL
  SELECT key, attempt + 1, due, CASE WHEN attempt + 1 < 6 THEN {_DUE.format(failed='due', attempt='(attempt + 1)')} END
  FROM tries WHERE due IS NOT NULL AND (length(key) * 7 + ascii(right(key, 1)) + attempt) % 4 <> 0)
SELECT key, CAST(CASE WHEN due IS NULL THEN attempt - 1 ELSE attempt END AS BIGINT) AS attempts,
  CASE WHEN due IS NULL THEN 'dead' ELSE 'recovered' END AS outcome, coalesce(due, failed) AS ended_at,
  CASE WHEN due IS NULL THEN concat('Max retries exceeded (', attempt, ')') END AS reason
FROM tries WHERE due IS NULL OR (length(key) * 7 + ascii(right(key, 1)) + attempt) % 4 = 0""")
def _(spark, d):
    """Failed messages through all their attempts: one in four attempts succeeds, the sixth is not made."""
    root = scratch_path(spark, "retries")
    decoded = faults.retry_decode(frames.retry_messages(spark, d)).where(
        F.col(CORRUPT).isNull() & (F.col("n") % 50 != 0) & ~F.col("last_error").contains("Schema mismatch"))
    failed = decoded.select(F.col("id").alias("key"), "retry_count", F.col("payload_text").alias("payload"), F.col("error_history").alias("errors"))
    limits = {"max_attempts": 6, "base_ms": 20_000, "cap_ms": 100_000}
    retry_loop.enqueue(failed, root, "a", datetime.fromisoformat(_START), **limits)

    def recovers(due):
        return (F.length("key") * 7 + F.ascii(F.right("key", F.lit(1))) + F.col("retry_count")) % 4 == 0

    retry_loop.drain(spark, root, recovers, **limits)
    return retry_loop.ended(spark, root).select("key", "attempts", "outcome", F.col("ended_at").cast("timestamp_ntz").alias("ended_at"), "reason")


# --- history of campaigns ----------------------------------------------------------------

_SNAPSHOTS = {"2024-02-01": "banner_pos <> 3", "2024-02-02": "banner_pos <> 5 AND NOT coalesce(app_id = 'app_2', false)", "2024-02-03": "banner_pos <> 6"}
_C = ", ".join(CAMPAIGN_COLUMNS)
_SAME = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in CAMPAIGN_COLUMNS)
_ORDER = ", ".join(f"{c} NULLS LAST" for c in ("site_id", "app_id", "banner_pos", "device_type", "site_domain", "site_category", "app_domain", "app_category"))


@query("dim_campaign_history", f"""WITH seen AS ({" UNION ALL ".join(f"SELECT DISTINCT DATE '{s}' AS day, {_C} FROM combos WHERE {w}" for s, w in _SNAPSHOTS.items())}),
keys AS (SELECT row_number() OVER (ORDER BY first_day, {_ORDER}) AS campaign_id, * FROM (SELECT min(day) AS first_day, {_C} FROM seen GROUP BY {_C})),
runs AS (SELECT k.campaign_id, s.day, s.day - CAST(row_number() OVER (PARTITION BY k.campaign_id ORDER BY s.day) AS INT) AS run
  FROM seen s JOIN keys k ON {_SAME.replace('a.', 's.').replace('b.', 'k.')}),
spans AS (SELECT campaign_id, min(day) AS valid_from, CASE WHEN max(day) < DATE '2024-02-03' THEN max(day) + 1 END AS valid_to FROM runs GROUP BY campaign_id, run),
life AS (SELECT campaign_id, CAST(max(CASE WHEN valid_to IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS is_active, min(valid_from) AS created_at,
  max(coalesce(valid_to, valid_from)) AS updated_at, string_agg(concat(valid_from, '..', valid_to), ' ' ORDER BY valid_from) AS spans FROM spans GROUP BY 1)
SELECT campaign_id, {', '.join(f"CAST({c} AS BIGINT) AS {c}" if EVENT_TYPES[c] == 'int' else c for c in CAMPAIGN_COLUMNS)}, is_active,
  CAST(CAST(created_at AS DATE) AS VARCHAR) AS created_at, CAST(CAST(updated_at AS DATE) AS VARCHAR) AS updated_at, spans
FROM keys JOIN life USING (campaign_id)""")
def _(spark, d):
    """Three snapshots, the second taken twice: keys stay, and each campaign has the times in which it was there."""
    root, staged = scratch_path(spark, "campaigns"), frames.staged_for_campaigns(spark, d)
    for day in ("2024-02-01", "2024-02-02", "2024-02-02", "2024-02-03"):
        history.take_snapshot(staged.where(_SNAPSHOTS[day]), root, day)
    span = F.concat("valid_from", F.lit(".."), F.coalesce(F.col("valid_to").cast("string"), F.lit("")))
    spans = history.intervals(spark, root).groupBy("campaign_id").agg(F.array_join(F.array_sort(F.collect_list(span)), " ").alias("spans"))
    return history.dim_campaigns(spark, root).join(spans, "campaign_id")


# --- sketches, schema versions, SQL functions ---------------------------------------------

_RANGE = ("2024-01-08 06:00:00", "2024-01-21 18:00:00")


def _sketches(spark, d):
    path = scratch_path(spark, "sketches")
    return tables.materialize_table(sketches.hourly_sketches(frames.ads(spark, d)), path, "day")


def _in(start: str, end: str) -> str:
    return f"date_trunc('hour', event_time) >= TIMESTAMP '{start}' AND date_trunc('hour', event_time) < TIMESTAMP '{end}'"


@query("sketch_range", f"""SELECT count(*) AS events, count(DISTINCT device_ip) AS devices, 1 AS q25_ok, 1 AS q50_ok, 1 AS q95_ok FROM ad WHERE {_in(*_RANGE)}""")
def _(spark, d):
    """A range of hours from the sketches: events and devices, and whether the quantiles' exact ranks are within the error."""
    row = sketches.range_summary(_sketches(spark, d), *_RANGE)
    time = F.date_trunc("hour", F.col("event_time").cast("timestamp"))
    values = frames.ads(spark, d).where((time >= F.lit(_RANGE[0]).cast("timestamp")) & (time < F.lit(_RANGE[1]).cast("timestamp"))).select("c14")
    got = values.withColumn("one", F.lit(1)).join(F.broadcast(row.withColumn("one", F.lit(1))), "one")      # one row
    n = F.count("c14")
    def ok(q: str, share: float):
        below, upto = F.count_if(F.col("c14") < F.col(q)) / n, F.count_if(F.col("c14") <= F.col(q)) / n
        return ((below <= share + sketches.RANK_ERROR) & (upto >= share - sketches.RANK_ERROR)).cast("int").alias(f"{q}_ok")
    return got.groupBy("events", "devices").agg(ok("q25", 0.25), ok("q50", 0.5), ok("q95", 0.95))


@query("sketch_returning", f"""WITH a AS (SELECT DISTINCT device_ip FROM ad WHERE {_in('2024-01-02 00:00:00', '2024-01-05 00:00:00')}),
b AS (SELECT DISTINCT device_ip FROM ad WHERE {_in('2024-01-20 00:00:00', '2024-01-26 00:00:00')})
SELECT (SELECT count(*) FROM a) AS first, (SELECT count(*) FROM b) AS second, (SELECT count(*) FROM a JOIN b USING (device_ip)) AS returning,
(SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS either""")
def _(spark, d):
    """Devices of two ranges and of both, from sketches alone."""
    return sketches.returning_devices(_sketches(spark, d), ("2024-01-02 00:00:00", "2024-01-05 00:00:00"), ("2024-01-20 00:00:00", "2024-01-26 00:00:00"))


@query("schema_versions", """SELECT n % 3 AS version, CAST(id AS VARCHAR) AS id, CASE WHEN n % 3 = 2 THEN c14 + 3000000000 ELSE CAST(c14 AS BIGINT) END AS c14,
CASE WHEN n % 3 < 2 THEN site_id END AS site_id, CASE WHEN n % 3 > 0 THEN device_ip END AS device_ip,
CASE WHEN n % 3 = 2 THEN 0.5::DOUBLE * CAST(c21 AS INT) ELSE CAST(c21 AS DOUBLE) END AS c21 FROM (SELECT *, CAST(id AS BIGINT) AS n FROM ad)""")
def _(spark, d):
    """Three versions of a table, with a column added, one dropped and two widened, read as one."""
    path, ads = scratch_path(spark, "versions"), frames.ads(spark, d)
    n = F.col("id").cast("bigint")
    columns = (("id", "c14", "site_id", "c21"), ("id", "c14", "site_id", "device_ip", "c21"),
               ("id", (F.col("c14") + F.lit(3_000_000_000)).alias("c14"), "device_ip", (F.col("c21") * F.lit(0.5)).alias("c21")))
    for version, some in enumerate(columns):
        ads.where(n % 3 == version).select(*some).write.parquet(f"{path}/v{version}")
    return schema_versions.read_versions(spark, [f"{path}/v{v}" for v in range(3)])


@query("sql_functions", """SELECT 'avg_ctr_1h' AS name, round(avg(ctr), 6) AS value FROM m1 WHERE window_start >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 HOUR
UNION ALL SELECT 'windows_1min', count(*) FROM m1 WHERE window_start >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 HOUR
UNION ALL SELECT 'windows_5min', count(*) FROM m5 WHERE window_start >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 2 HOUR
UNION ALL SELECT 'total_ctr', round(CAST(sum(clicks) AS DOUBLE) / CAST(sum(impressions) AS DOUBLE) * 100, 6) FROM m1
WHERE window_start >= TIMESTAMP '2024-01-10' AND window_start < TIMESTAMP '2024-01-12'""")
def _(spark, d):
    """The functions called from SQL over stored metrics."""
    for name, frame in (("1min", frames.metrics_1min(spark, d)), ("5min", frames.metrics_5min(spark, d))):
        frame.write.parquet(path := scratch_path(spark, "metrics"))
        if name == "1min":
            minutes = spark.read.parquet(path)
    sql_functions.register_functions(spark, minutes, spark.read.parquet(path))
    at = "TIMESTAMP_NTZ '2024-01-30 12:00:00'"
    return spark.sql(f"""SELECT 'avg_ctr_1h' AS name, round(avg_ctr_since({at}, 1), 6) AS value
        UNION ALL SELECT 'windows_1min', CAST(count(*) AS DOUBLE) FROM latest_ctr_1min({at})
        UNION ALL SELECT 'windows_5min', CAST(count(*) AS DOUBLE) FROM latest_ctr_5min({at})
        UNION ALL SELECT 'total_ctr', round(ctr, 6) FROM window_totals(TIMESTAMP_NTZ '2024-01-10', TIMESTAMP_NTZ '2024-01-12')""")


# --- models with checks between them ---------------------------------------------------

def daily_models(limit: int | None = None) -> list[Model]:
    """Staging, hourly, campaigns, daily and facts; an hour of more than `limit` events fails the check of hourly."""
    def of(table):
        return [c for c in generic_checks() if c.table == table]
    crowded = [] if limit is None else [RowCheck("hourly_limit", "hourly", f"total_impressions > {limit}")]
    columns = (*frames.MART_COLUMNS, *CAMPAIGN_COLUMNS)
    return [
        Model("staging", ("events",), lambda t: marts.stage_events(t["events"], columns), tuple(of("staging"))),
        Model("hourly", ("staging",), lambda t: marts.hourly_agg(t["staging"]), (*of("hourly"), *crowded)),
        Model("campaigns", ("staging",), lambda t: marts.dim_campaigns(t["staging"]), tuple(of("campaigns")), None),
        Model("daily", ("hourly",), lambda t: marts.daily_agg(t["hourly"], unique_hours=True)),
        Model("facts", ("daily",), lambda t: marts.daily_metrics(t["daily"]))]


@query("model_run", """SELECT run, model, CASE WHEN run = 2 AND model = 'hourly' THEN 'failed' WHEN run = 2 AND model IN ('daily', 'facts') THEN 'skipped' ELSE 'done' END AS status,
CASE WHEN run = 2 AND model = 'hourly' THEN 'hourly_limit' END AS failed_check,
CASE WHEN run = 2 AND model = 'hourly' THEN (SELECT count(*) FROM hourly) END AS failures,
CASE WHEN run = 1 OR model IN ('staging', 'campaigns') THEN n END AS n_rows, kept
FROM (SELECT 'staging' AS model, (SELECT count(*) FROM stg) AS n, (SELECT count(*) FROM stg) AS kept
  UNION ALL SELECT 'hourly', (SELECT count(*) FROM hourly), (SELECT count(*) FROM hourly)
  UNION ALL SELECT 'campaigns', (SELECT count(*) FROM dim), (SELECT count(*) FROM dim)
  UNION ALL SELECT 'daily', (SELECT count(*) FROM daily), (SELECT count(*) FROM daily)
  UNION ALL SELECT 'facts', (SELECT count(*) FROM fact), (SELECT count(*) FROM fact)), (SELECT CAST(unnest([1, 2]) AS BIGINT) AS run)""")
def _(spark, d):
    """A run that publishes all, and one whose hourly table breaks a check: what came of each model, and the rows published."""
    root, events = scratch_path(spark, "models"), {"events": frames.ads(spark, d)}
    runs = [run_models(spark, daily_models(limit), events, root).withColumn("run", F.lit(n)) for n, limit in ((1, None), (2, 0))]
    kept = spark.createDataFrame([(m.name, spark.read.parquet(f"{root}/{m.name}").count()) for m in daily_models()], "model string, kept long")
    return runs[0].unionAll(runs[1]).join(kept, "model")
