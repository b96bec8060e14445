"""Schema versions, campaign history, sketches, SQL functions, progress reports, model runs, large dictionaries."""

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from clickweir.catalog.upkeep import daily_models
from clickweir.operators import quality as q
from clickweir.plans import dimension_history as history, model_prep, sketches
from clickweir.plans.model_runs import Model, run_models
from clickweir.plans.sql_functions import register_functions
from clickweir.schema import CAMPAIGN_COLUMNS
from clickweir.sources import schema_versions as versions
from clickweir.sources.driver_tables import ad_events
from clickweir.streaming import jobs
from clickweir.streaming.progress import ProgressLog, batch_latency, read_progress
from conftest import rows


def struct(text):
    return T.StructType.fromDDL(text)


def test_changes_by_name(spark):
    changes = versions.compare(struct("a int, b string, c long, d double, e int"), struct("a long, c int, d string, e int, f date"))
    assert [(c.column, c.kind) for c in changes] == [("a", "widened"), ("b", "dropped"), ("c", "narrowed"), ("d", "changed"), ("f", "added")]
    assert versions.common_type(T.DecimalType(5, 2), T.DecimalType(7, 1)) == T.DecimalType(8, 2)
    assert versions.common_type(T.LongType(), T.DoubleType()) is None      # a double does not hold every long


def test_versions_read_as_one_or_are_refused(spark, tmp_path):
    paths = [str(tmp_path / f"v{i}") for i in range(4)]
    spark.sql("SELECT 1 AS a, 'x' AS b").write.parquet(paths[0])
    spark.sql("SELECT 5000000000 AS a, 2.5D AS c").write.parquet(paths[1])
    spark.sql("SELECT CAST(7 AS BIGINT) AS a, CAST('y' AS STRING) AS b, 1D AS c").write.parquet(paths[2])
    got = versions.read_versions(spark, paths[:3])
    assert got.schema.simpleString() == "struct<a:bigint,b:string,c:double,version:int>"
    assert sorted(rows(got), key=str) == [(1, "x", None, 0), (5000000000, None, 2.5, 1), (7, "y", 1.0, 2)]
    assert [(c.version, c.column, c.kind) for c in versions.history(spark, paths[:3])] == [
        (1, "a", "widened"), (1, "b", "dropped"), (1, "c", "added"), (2, "b", "added")]
    spark.sql("SELECT 1 AS a").write.parquet(paths[3])
    with pytest.raises(versions.IncompatibleSchema, match="a: int of version 3 is narrower than bigint"):
        versions.read_versions(spark, paths)


def campaigns(spark, *sites):
    return spark.createDataFrame([(s, *[None] * 7) for s in sites], ", ".join(f"{c} {'int' if c in ('banner_pos', 'device_type') else 'string'}" for c in CAMPAIGN_COLUMNS))


def test_keys_stay_and_intervals_follow(spark, tmp_path):
    root = str(tmp_path)
    for day, sites in (("2024-01-01", "ac"), ("2024-01-02", "bc"), ("2024-01-02", "bc"), ("2024-01-03", "abc")):
        history.take_snapshot(campaigns(spark, *sites, *sites), root, day)
    keys = {r["site_id"]: r["campaign_id"] for r in history.registry(spark, root).collect()}
    assert keys == {"a": 1, "c": 2, "b": 3}
    d = [date(2024, 1, n) for n in (1, 2, 3)]
    assert sorted(rows(history.intervals(spark, root)), key=str) == sorted([(1, d[0], d[1]), (1, d[2], None), (2, d[0], None), (3, d[1], None)], key=str)
    dim = {r["campaign_id"]: (r["is_active"], r["created_at"], r["updated_at"]) for r in history.dim_campaigns(spark, root).collect()}
    assert dim == {1: (1, d[0], d[2]), 2: (1, d[0], d[0]), 3: (1, d[1], d[1])}
    history.take_snapshot(campaigns(spark), root, "2024-01-04")
    assert {r["is_active"] for r in history.dim_campaigns(spark, root).collect()} == {0}


def test_sketches_beyond_their_size(spark):
    n = 400_000
    events = spark.range(n).select((F.col("id") % 300_000).cast("string").alias("device_ip"), (F.col("id") * 7919 % 100_003).alias("c14"),
                                   F.timestamp_seconds(1704067200 + F.col("id") % 86_400).alias("event_time"))
    table = sketches.hourly_sketches(events)
    got = sketches.range_summary(table, "2024-01-01 00:00:00", "2024-01-02 00:00:00").first()
    assert got["events"] == n and abs(got["devices"] / 300_000 - 1) < 4 / 2 ** (sketches.LG_DEVICES / 2)
    assert abs(got["q50"] / 100_003 - 0.5) < sketches.RANK_ERROR
    half = sketches.returning_devices(table, ("2024-01-01 00:00:00", "2024-01-01 12:00:00"), ("2024-01-01 12:00:00", "2024-01-02 00:00:00")).first()
    assert half["either"] <= half["first"] + half["second"] and half["returning"] > 0


def test_a_time_bound_reaches_the_scan_through_a_function(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.range(100).select((F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id"))).alias("window_start"),
                            F.lit(datetime(2024, 1, 2)).cast("timestamp_ntz").alias("window_end"), F.lit(8).cast("long").alias("impressions"),
                            F.lit(2).cast("long").alias("clicks"), (F.col("id") * 1.0).alias("ctr")).write.parquet(path)
    table = spark.read.parquet(path)
    register_functions(spark, table, table)
    df = spark.sql("SELECT * FROM latest_ctr_1min(TIMESTAMP_NTZ '2024-01-01 02:00:00')")
    assert df.count() == 40 and "GreaterThanOrEqual(window_start,2024-01-01T01:00)" in df._jdf.queryExecution().executedPlan().toString()
    assert rows(spark.sql("SELECT avg_ctr_since(TIMESTAMP_NTZ '2024-01-01 01:00:00', 1), ctr_of(1, 4), ctr_of(1, 0)")) == [(49.5, 25.0, 0.0)]


def test_a_report_for_every_batch(spark, tmp_path):
    schema, start = "id bigint, click int, event_time timestamp", datetime(2024, 1, 1)
    for i in range(4):
        spark.createDataFrame([(n, n % 2, start + timedelta(seconds=60 * i + n)) for n in range(10)], schema).coalesce(1).write.parquet(str(tmp_path / f"in/part={i}"))
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        for _ in range(2):      # the second run finds nothing to do
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/part=*"))
            run = jobs.StreamRun(jobs.ctr_metrics_stream(stream, "1 minute"), jobs.versions_sink(str(tmp_path / "out")), str(tmp_path / "cp"), "update").catch_up()
            log.wait(run.runId)
            log.store(spark, str(tmp_path / "reports"))
    finally:
        spark.streams.removeListener(log)
    reports = read_progress(spark, str(tmp_path / "reports")).orderBy("batch_id").collect()
    assert [r["batch_id"] for r in reports] == list(range(len(reports))) and sum(r["input_rows"] for r in reports) == 40
    assert [r["input_rows"] for r in reports[:4]] == [10] * 4 and all(r["batch_ms"] >= r["write_ms"] for r in reports)
    assert batch_latency(read_progress(spark, str(tmp_path / "reports"))).first()["batches"] == len(reports)


def test_a_failed_check_leaves_what_needs_it(spark, sf, tmp_path):
    root, events = str(tmp_path), {"events": ad_events(spark, sf)}
    run_models(spark, daily_models(), events, root)
    before = {m.name: sorted(spark.read.parquet(f"{root}/{m.name}").inputFiles()) for m in daily_models()}
    built = []
    models = [Model(m.name, m.inputs, lambda t, m=m: built.append(m.name) or m.build(t), m.checks, m.partition_by) for m in daily_models(limit=0)]
    status = {r["model"]: (r["status"], r["failed_check"]) for r in run_models(spark, models, events, root).collect()}
    assert status == {"staging": ("done", None), "hourly": ("failed", "hourly_limit"), "campaigns": ("done", None),
                      "daily": ("skipped", None), "facts": ("skipped", None)}
    after = {m.name: sorted(spark.read.parquet(f"{root}/{m.name}").inputFiles()) for m in daily_models()}
    assert sorted(built) == ["campaigns", "hourly", "staging"] and {n for n in after if after[n] != before[n]} == {"staging", "campaigns"}


def test_nothing_runs_behind_the_first_failure(spark):
    good, bad = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(None,)], "a int")
    never = spark.range(1).select(F.raise_error(F.lit("was read")).cast("int").alias("a"))
    checks = [q.check_not_null(t, "a") for t in ("one", "two", "three")]
    got = q.report(checks, {"one": good, "two": bad, "three": never}, fail_fast=True).collect()
    assert [(r["status"], r["failures"]) for r in got] == [("pass", 0), ("fail", 1), ("skipped", None)]


def test_large_dictionaries_are_joined_by_cells(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("x"),
                                  F.when(F.col("id") % 7 > 0, (F.col("id") % 50).cast("int")).alias("y"))
    small, large = (Counter(map(tuple, model_prep.label_encode(df, ["x", "y"], max_bytes=b).collect())) for b in (1 << 30, 0))
    assert small == large and len(small) == 6000
    plan = model_prep.label_encode(df, ["x", "y"], max_bytes=0)
    assert plan.columns == ["id", "x", "y"]
