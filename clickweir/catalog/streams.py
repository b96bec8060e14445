"""Streaming queries: each runs a Structured Streaming job over the events and returns
what its sink holds."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickweir.catalog import frames
from clickweir.catalog.exploration import breakdown_text
from clickweir.catalog.registry import query
from clickweir.operators.windows import FIVE_MINUTES, ONE_MINUTE
from clickweir.plans import faults
from clickweir.schema import EVENT_SCHEMA
from clickweir.session import scratch_path
from clickweir.sources import tables
from clickweir.sources.driver_tables import DRIVER_EVENT_SCHEMA, ad_events_stream, events_glob
from clickweir.sources.event_files import CORRUPT, parse_event_json, stream_source
from clickweir.streaming import jobs
from clickweir.streaming.progress import ProgressLog, arrival_latency, open_windows, read_progress

_M = "window_start, window_end, impressions, clicks, ctr"


def _run(spark: SparkSession, frame: DataFrame, sink, mode: str):
    """Run a job over all there is; (sink path, finished query)."""
    path = scratch_path(spark, "sink")
    run = jobs.StreamRun(frame, sink(path), scratch_path(spark, "progress"), mode)
    return path, run.catch_up()


def _metrics(spark, frame, keys=("window_start",)) -> DataFrame:
    path, _ = _run(spark, frame, jobs.versions_sink, "update")
    return jobs.read_metrics(spark, path, frame.schema, keys)


@query("tumbling_ctr_1min", f"SELECT {_M} FROM m1")
def _(spark, d):
    return _metrics(spark, jobs.ctr_metrics_stream(ad_events_stream(spark, d), ONE_MINUTE))


@query("tumbling_ctr_5min", f"SELECT {_M} FROM m5")
def _(spark, d):
    return _metrics(spark, jobs.ctr_metrics_stream(ad_events_stream(spark, d), FIVE_MINUTES))


@query("keyed_window_ctr", """SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, CAST(hour AS BIGINT) AS hour,
CAST(device_type AS BIGINT) AS device_type, impressions, clicks, CASE WHEN impressions > 0
THEN CAST(clicks AS DOUBLE) / CAST(impressions AS DOUBLE) * 100 ELSE 0.0::DOUBLE END AS ctr
FROM (SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start, hour, device_type,
count(*) FILTER (click = 0) AS impressions, count(*) FILTER (click = 1) AS clicks FROM ad GROUP BY 1, 2, 3)""")
def _(spark, d):
    keys = ("hour", "device_type")
    frame = jobs.ctr_metrics_stream(ad_events_stream(spark, d), ONE_MINUTE, keys)
    return _metrics(spark, frame, ("window_start", *keys))


_CLOSED = "<= (SELECT max(event_time) FROM ad) - INTERVAL 10 SECOND"


@query("sink_metrics_if_absent", f"SELECT {_M} FROM m1 WHERE window_end {_CLOSED}")
def _(spark, d):
    """Closed windows, inserted once although every batch is delivered twice."""
    def twice(path):
        write = jobs.metrics_if_absent_sink(path)

        def deliver(batch, batch_id):
            write(batch, 2 * batch_id)
            write(batch, 2 * batch_id + 1)
        return deliver

    frame = jobs.ctr_metrics_stream(ad_events_stream(spark, d), ONE_MINUTE)
    path, _ = _run(spark, frame, twice, "append")
    return tables.read_batches(spark, path, frame.schema).select(*frame.columns)


@query("tumbling_ctr_chained", f"SELECT {_M} FROM m5 WHERE window_end {_CLOSED}")
def _(spark, d):
    """Five-minute windows chained behind one-minute windows in one job."""
    frame = jobs.chained_ctr_stream(ad_events_stream(spark, d))
    path, _ = _run(spark, frame, jobs.metrics_if_absent_sink, "append")
    return tables.read_batches(spark, path, frame.schema).select(*frame.columns)


@query("insert_if_absent", """SELECT window_start, impressions, clicks, CASE WHEN hour(window_start) < 12 THEN 0 ELSE 1 END AS batch_id FROM m1""")
def _(spark, d):
    """Mornings are stored first; a second batch with all windows adds only the rest."""
    path, metrics = scratch_path(spark, "metrics"), frames.metrics_1min(spark, d)
    tables.insert_if_absent(metrics.where(F.hour("window_start") < 12), path, ["window_start"], 0, run="a")
    tables.insert_if_absent(metrics, path, ["window_start"], 1, run="a")
    return tables.read_batches(spark, path, metrics.schema).select(
        "window_start", "impressions", "clicks", "batch_id")


_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]
RAW = f"""SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, {', '.join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in _COLUMNS)}, event_time, 1 AS stamped FROM ad"""


def raw_rows(spark, path) -> DataFrame:
    """All columns as text, the event time, and whether both write stamps are there."""
    table = spark.read.option("basePath", path).parquet(path)
    stamped = (F.col("created_at").isNotNull() & F.col("updated_at").isNotNull()).cast("int")
    return table.select("event_date", *[F.col(c).cast("string").alias(c) for c in _COLUMNS],
                        F.col("event_time").cast("timestamp_ntz").alias("event_time"), stamped.alias("stamped"))


@query("sink_raw_events", RAW)
def _(spark, d):
    """Two jobs, each with its own checkpoint, write the clicks and the rest to one table."""
    path = scratch_path(spark, "sink")
    for clicks in (True, False):
        part = ad_events_stream(spark, d).where((F.col("click") == 1) == F.lit(clicks))
        jobs.StreamRun(part, jobs.raw_events_sink(path), scratch_path(spark, "progress")).catch_up()
    return raw_rows(spark, path)


@query("stream_source", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def _(spark, d):
    """A subscription by format name and options."""
    stream = stream_source(spark, "parquet", {"path": events_glob(d)}, DRIVER_EVENT_SCHEMA)

    def sink(path):
        return lambda batch, batch_id: tables.write_batch(batch, path, batch_id)

    path, _ = _run(spark, stream, sink, "append")
    return spark.read.parquet(path).select("event_id", "ts", "user_id", "event_type", "value", "props")


# --- arrivals out of order ---------------------------------------------------------

_A = "event_time < TIMESTAMP '2024-01-11' AND id % 20 <> 0"
_B = "event_time >= TIMESTAMP '2024-01-11' AND event_time < TIMESTAMP '2024-01-21' AND id % 20 <> 0"


def _arrivals(spark, d, upto: int = 3, path: str | None = None, first: int = 0) -> str:
    """The events as three deliveries: days before the 11th, days before the 21st, then
    the rest together with every 20th event of all days, which comes late."""
    path = path or scratch_path(spark, "arrivals")
    early = F.expr(_A.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
    middle = F.expr(_B.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
    part = F.when(early, 0).when(middle, 1).otherwise(2)
    marked = frames.ads(spark, d).withColumn("part", part) \
        .withColumn("event_time", F.col("event_time").cast("timestamp"))
    for i in range(first, upto):
        marked.where(F.col("part") == i).drop("part").write.parquet(f"{path}/delivery={i}")
    return path


def _arrival_stream(spark, d, path) -> DataFrame:
    """One delivery per micro-batch is read through a glob per delivery folder."""
    schema = frames.ads(spark, d).withColumn("event_time", F.col("event_time").cast("timestamp")).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000) \
        .parquet(f"{path}/delivery=*")


def _deliver(spark, d, build, sink, mode):
    """(sink path, frame, arrivals): deliveries one after the other, the job restarted from its checkpoint for each."""
    sink_path, progress = scratch_path(spark, "sink"), scratch_path(spark, "progress")
    path = scratch_path(spark, "arrivals")
    for i in range(3):
        _arrivals(spark, d, upto=i + 1, path=path, first=i)
        frame = build(_arrival_stream(spark, d, path))
        jobs.StreamRun(frame, sink(sink_path), progress, mode).catch_up()
    return sink_path, frame, path


@query("exactly_once_checkpoint", RAW)
def _(spark, d):
    """Three deliveries, the job stopped and restarted between them: every event once."""
    path, _, _ = _deliver(spark, d, lambda s: s, jobs.raw_events_sink, "append")
    return raw_rows(spark, path)


def _late(spark, d):
    return _deliver(spark, d, lambda s: jobs.ctr_metrics_stream(s, ONE_MINUTE), jobs.versions_sink, "update")


_KEPT = f"""SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start, click FROM ad
  WHERE ({_A}) OR ({_B}) OR time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE
    > (SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 10 SECOND FROM ad WHERE {_B})"""


@query("bounded_lateness", f"""WITH kept AS ({_KEPT}),
counts AS (SELECT window_start, count(*) FILTER (click = 0) AS impressions, count(*) FILTER (click = 1) AS clicks
  FROM kept GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, impressions, clicks,
  CASE WHEN impressions > 0 THEN CAST(clicks AS DOUBLE) / CAST(impressions AS DOUBLE) * 100 ELSE 0.0::DOUBLE END AS ctr
FROM counts""")
def _(spark, d):
    """Events later than the watermark are left out, all others counted."""
    path, frame, _ = _late(spark, d)
    return jobs.read_metrics(spark, path, frame.schema)


@query("late_data_count", f"""SELECT (SELECT count(*) FROM ad WHERE click IN (0, 1)) AS delivered_rows, count(*) AS counted_rows,
(SELECT count(*) FROM ad WHERE click IN (0, 1)) - count(*) AS late_rows FROM ({_KEPT}) WHERE click IN (0, 1)""")
def _(spark, d):
    """Rows left out as too late over three deliveries and restarts."""
    path, frame, arrivals = _late(spark, d)
    return jobs.late_data_count(spark.read.parquet(arrivals), jobs.read_metrics(spark, path, frame.schema))


@query("compact_versions", f"SELECT {_M} FROM m1")
def _(spark, d):
    """Metrics of all days but the last compacted; readers see the same."""
    path, frame, _ = _deliver(spark, d, lambda s: jobs.ctr_metrics_stream(s, ONE_MINUTE, lateness="60 days"),
                              jobs.versions_sink, "update")
    tables.compact_versions(spark, path, jobs.versions_schema(frame.schema), ["window_start"], "2024-01-30")
    return jobs.read_metrics(spark, path, frame.schema)


@query("stream_dedup", "SELECT DISTINCT CAST(id AS VARCHAR) AS id FROM ad")
def _(spark, d):
    """Each id once; copies come an hour later, so the watermark waits two."""
    stream = jobs.bounded_lateness(ad_events_stream(spark, d), lateness="2 hours")

    def sink(path):
        return lambda batch, batch_id: tables.write_batch(batch.select("id"), path, batch_id)

    path, _ = _run(spark, jobs.stream_dedup(stream), sink, "append")
    return spark.read.option("basePath", path).parquet(path).select("id")


@query("windowed_breakdown_stream", """SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end,
CAST(sum(n) AS BIGINT) AS total_impressions, CAST(sum(c) AS BIGINT) AS total_clicks,
CAST((200 * 100 * CAST(sum(c) AS BIGINT) + CAST(sum(n) AS BIGINT)) // (2 * CAST(sum(n) AS BIGINT)) AS BIGINT) / 100.0::DOUBLE AS ctr,
string_agg(concat(dim, '=', printf('%.2f', ((20000 * c + n) // (2 * n)) / 100.0)), ';' ORDER BY dim) AS breakdown
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, CAST(device_type AS VARCHAR) AS dim,
count(*) AS n, count(*) FILTER (click = 1) AS c FROM ad GROUP BY 1, 2) GROUP BY 1""")
def _(spark, d):
    frame = jobs.breakdown_stream(ad_events_stream(spark, d), FIVE_MINUTES, "device_type")
    path, _ = _run(spark, frame, lambda p: jobs.versions_sink(p, "window.start"), "update")
    return breakdown_text(jobs.read_breakdown(spark, path, frame.schema, "m"))


# --- messages ------------------------------------------------------------------------

def _message_stream(spark, d) -> DataFrame:
    """Retry messages stored as a topic would hold them, read as a stream."""
    path = scratch_path(spark, "topic")
    frames.retry_messages(spark, d).select("n", "value").write.parquet(path)
    return stream_source(spark, "parquet", {"path": path}, "n bigint, value string")


@query("drop_or_raise_malformed", "SELECT CASE WHEN broken OR n % 53 = 52 OR n % 59 = 58 THEN 'dead' ELSE 'good' END AS side, n FROM retry")
def _(spark, d):
    """One stream split by whether the payload decodes."""
    decoded = parse_event_json(_message_stream(spark, d), schema=EVENT_SCHEMA, on_error="dlq")

    def sink(path):
        return jobs.malformed_split_sink(
            lambda b, i: tables.write_batch(b.select("n"), f"{path}/good", i),
            lambda b, i: tables.write_batch(b.select("n"), f"{path}/dead", i), CORRUPT)

    path, _ = _run(spark, decoded, sink, "append")

    def side(name):
        return spark.read.parquet(f"{path}/{name}").select(F.lit(name).alias("side"), "n")
    return side("good").unionByName(side("dead"))


@query("retry_router_stream", "SELECT n, action, backoff_ms, reason FROM routed")
def _(spark, d):
    """The router as a streaming projection."""
    routed = faults.retry_router(faults.retry_decode(_message_stream(spark, d)), now=frames.stamp())

    def sink(path):
        return lambda b, i: tables.write_batch(b.select("n", "action", "backoff_ms", "reason"), path, i)

    path, _ = _run(spark, routed, sink, "append")
    return spark.read.parquet(path).select("n", "action", "backoff_ms", "reason")


# --- failures inside a batch, reports, state ---------------------------------------------

class _Lost(Exception):
    """The failure that a query injects into its own sink."""


def _failing(write, when: str, failed: list):
    """A sink that fails once, before it writes, after half of the rows, or after all of them."""
    def deliver(batch, batch_id):
        if when in failed:
            return write(batch, batch_id)
        failed.append(when)
        if when == "half":
            write(batch.where(F.pmod(F.xxhash64("id"), F.lit(2)) == 0), batch_id)
        if when == "after":
            write(batch, batch_id)
        raise _Lost(when)
    return deliver


@query("exactly_once_failures", RAW)
def _(spark, d):
    """Three deliveries, and in each batch the sink fails once: before, half-way through and after its write. The job
    goes on from its checkpoint, and every event is there once."""
    sink, progress, path = scratch_path(spark, "sink"), scratch_path(spark, "progress"), scratch_path(spark, "arrivals")
    failed: list[str] = []
    for i, when in enumerate(("before", "half", "after")):
        _arrivals(spark, d, upto=i + 1, path=path, first=i)
        run = jobs.StreamRun(_arrival_stream(spark, d, path), _failing(jobs.raw_events_sink(sink), when, failed), progress)
        for _ in range(2):
            try:
                run.catch_up()
                break
            except StreamingQueryException:
                if failed[-1] != when:
                    raise
    if len(failed) < 3:
        raise RuntimeError(f"only {failed} were tried")
    return raw_rows(spark, sink)


@query("stream_progress", f"""WITH first AS (SELECT count(*) AS n FROM ad WHERE {_A}), middle AS (SELECT count(*) AS n FROM ad WHERE {_B})
SELECT 0 AS delivery, n AS input_rows, 0 AS dropped_rows FROM first UNION ALL SELECT 1, n, 0 FROM middle
UNION ALL SELECT 2, (SELECT count(*) FROM ad) - (SELECT n FROM first) - (SELECT n FROM middle),
(SELECT count(*) FROM ad WHERE NOT coalesce({_A}, false) AND NOT coalesce({_B}, false)
 AND event_time < (SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 10 SECOND FROM ad WHERE {_B}))""")
def _(spark, d):
    """Rows read and rows dropped as too late, by the stored reports of a job that was restarted for each delivery."""
    log, reports = ProgressLog(), scratch_path(spark, "reports")
    sink, progress, path = scratch_path(spark, "sink"), scratch_path(spark, "progress"), scratch_path(spark, "arrivals")
    spark.streams.addListener(log)
    try:
        for i in range(3):
            _arrivals(spark, d, upto=i + 1, path=path, first=i)
            once = jobs.stream_dedup(jobs.bounded_lateness(_arrival_stream(spark, d, path)), "id")
            ended = jobs.StreamRun(once, lambda b, n: tables.write_batch(b.select("id"), sink, n), progress).catch_up()
            log.wait(ended.runId)
            log.store(spark, reports)
    finally:
        spark.streams.removeListener(log)
    rows = read_progress(spark, reports).where("input_rows > 0")
    return rows.select((F.row_number().over(Window.orderBy("batch_id")) - 1).alias("delivery"), "input_rows", "dropped_rows")


@query("stream_open_windows", """SELECT window_start, window_end, impressions, clicks FROM m1
WHERE window_end > (SELECT date_trunc('millisecond', max(event_time)) FROM ad) - INTERVAL 3 DAY""")
def _(spark, d):
    """The windows that a stopped stream still waits for, read from its state."""
    frame, progress, sink = jobs.ctr_metrics_stream(ad_events_stream(spark, d), ONE_MINUTE, lateness="3 days"), \
        scratch_path(spark, "progress"), scratch_path(spark, "sink")
    jobs.StreamRun(frame, jobs.versions_sink(sink), progress, "update").catch_up()
    return open_windows(spark, progress)


@query("arrival_latency", """SELECT count(*) AS events, min(s) AS min_s, round(avg(s), 6) AS mean_s, max(s) AS max_s, quantile_cont(s, 0.5) AS p50_s,
quantile_cont(s, 0.95) AS p95_s, quantile_cont(s, 0.99) AS p99_s FROM (SELECT 30.0::DOUBLE * (CAST(id AS BIGINT) % 7) AS s FROM ad)""")
def _(spark, d):
    """How long after their time events were stored, here 0 to 180 seconds by their ids."""
    stored = frames.ads(spark, d).select("event_time", F.timestamp_micros(
        F.unix_micros(F.col("event_time").cast("timestamp")) + 30_000_000 * (F.col("id").cast("bigint") % 7)).alias("created_at"))
    return arrival_latency(stored).withColumn("mean_s", F.round("mean_s", 6))
