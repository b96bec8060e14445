from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clickweir.operators import windows
from clickweir.session import scratch_path
from clickweir.sources import tables
from clickweir.sources.event_files import parse_event_json
from clickweir.streaming import jobs
from conftest import rows

START = datetime(2024, 1, 1)
SCHEMA = "id bigint, click int, site_category string, device_type int, event_time timestamp"


def batch(spark, *events):
    return spark.createDataFrame(
        [(i, click, cat, 1, START + timedelta(seconds=at)) for i, click, cat, at in events], SCHEMA)


class Feed:
    """A folder that grows by one file per call."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, str(path), 0

    def add(self, *events):
        batch(self.spark, *events).coalesce(1).write.parquet(f"{self.path}/part={self.n}")
        self.n += 1

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1) \
            .parquet(f"{self.path}/part=*")


@pytest.fixture()
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def test_event_mixes(spark):
    for clicks, stream_rate in ((4, 4 / 6 * 100), (3, 3 / 7 * 100)):
        df = batch(spark, *[(i, int(i < clicks), "c", i) for i in range(10)])
        row = windows.tumbling_ctr(df, windows.ONE_MINUTE).first()
        assert (row["impressions"], row["clicks"]) == (10 - clicks, clicks)
        assert row["ctr"] == pytest.approx(stream_rate)


def test_breakdown_of_unknown_values(spark):
    df = batch(spark, (1, 1, "a", 0), (2, 0, "a", 1), (3, 1, None, 2))
    row = windows.breakdown_maps(df, windows.ONE_MINUTE, "site_category", "category_ctr").first()
    assert row["category_ctr"] == {"a": 50.0, "unknown": 100.0}
    assert (row["total_impressions"], row["total_clicks"], row["ctr"]) == (3, 2, 66.67)


def test_stream_equals_batch(spark, feed, tmp_path):
    for part in range(3):
        feed.add(*[(part * 100 + i, i % 3 % 2, "c", part * 300 + i * 7) for i in range(40)])
    frame = jobs.ctr_metrics_stream(feed.stream(), windows.ONE_MINUTE)
    run = jobs.StreamRun(frame, jobs.versions_sink(str(tmp_path / "t")), str(tmp_path / "cp"), "update")
    run.catch_up()
    got = sorted(rows(jobs.read_metrics(spark, str(tmp_path / "t"), frame.schema)))
    stored = spark.read.parquet(f"{feed.path}/part=*")
    assert got == sorted(rows(windows.tumbling_ctr(stored, windows.ONE_MINUTE)))
    five = sorted(rows(windows.tumbling_ctr(stored, windows.FIVE_MINUTES)))
    assert sorted(rows(windows.merge_windows(windows.tumbling_ctr(stored, windows.ONE_MINUTE),
                                             windows.FIVE_MINUTES))) == five


def test_late_rows(spark, feed, tmp_path):
    feed.add((1, 0, "c", 0), (2, 0, "c", 150))
    feed.add((3, 1, "c", 10), (4, 0, "c", 160))    # late, but the watermark moved only just now
    feed.add((5, 1, "c", 20), (6, 0, "c", 170))    # late: dropped
    frame = jobs.ctr_metrics_stream(feed.stream(), windows.ONE_MINUTE)
    jobs.StreamRun(frame, jobs.versions_sink(str(tmp_path / "t")), str(tmp_path / "cp"), "update").catch_up()
    got = {r["window_start"]: (r["impressions"], r["clicks"])
           for r in jobs.read_metrics(spark, str(tmp_path / "t"), frame.schema).collect()}
    assert got == {START: (1, 1), START + timedelta(seconds=120): (3, 0)}
    metrics = jobs.read_metrics(spark, str(tmp_path / "t"), frame.schema)
    late = jobs.late_data_count(spark.read.parquet(f"{feed.path}/part=*"), metrics)
    assert tuple(late.first()) == (6, 5, 1)


def test_append_emits_closed_windows_once(spark, feed, tmp_path):
    feed.add((1, 0, "c", 0), (2, 1, "c", 70), (3, 1, "c", 400))
    frame = jobs.chained_ctr_stream(feed.stream())
    run = jobs.StreamRun(frame, jobs.metrics_if_absent_sink(str(tmp_path / "t")), str(tmp_path / "cp"))
    run.catch_up()
    feed.add((4, 0, "c", 1000))
    run = jobs.StreamRun(jobs.chained_ctr_stream(feed.stream()), run.write, run.checkpoint)
    run.catch_up()
    got = sorted((r["window_start"], r["impressions"], r["clicks"])
                 for r in tables.read_batches(spark, str(tmp_path / "t"), frame.schema).collect())
    assert got == [(START, 1, 1), (START + timedelta(seconds=300), 0, 1)]


def test_replayed_metrics_are_ignored(spark, tmp_path):
    path = str(tmp_path / "m")
    first = windows.tumbling_ctr(batch(spark, (1, 1, "c", 0)), windows.ONE_MINUTE)
    other = windows.tumbling_ctr(batch(spark, (1, 0, "c", 0), (2, 1, "c", 90)), windows.ONE_MINUTE)
    tables.insert_if_absent(first, path, ["window_start"], 0, run="a")
    tables.insert_if_absent(first, path, ["window_start"], 0, run="a")   # the same batch again
    tables.insert_if_absent(other, path, ["window_start"], 1, run="a")   # one key is already there
    tables.insert_if_absent(first.limit(0), path, ["window_start"], 2, run="a")
    with pytest.raises(ValueError):
        tables.insert_if_absent(first, path, ["window_start"], 3)
    later = windows.tumbling_ctr(batch(spark, (9, 1, "c", 86400 * 3)), windows.ONE_MINUTE)
    tables.insert_if_absent(later, path, ["window_start"], 0, run="b")   # another run's first batch
    got = sorted((r["window_start"], r["clicks"], r["batch_id"])
                 for r in tables.read_batches(spark, path, first.schema).collect())
    assert got == [(START, 1, 0), (START + timedelta(seconds=60), 1, 1), (START + timedelta(days=3), 1, 0)]


def test_only_the_days_of_a_batch_are_listed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    for day in range(5):
        row = windows.tumbling_ctr(batch(spark, (day, 1, "c", 86400 * day)), windows.ONE_MINUTE)
        tables.insert_if_absent(row, path, ["window_start"], day, run="a")
    seen = []
    monkeypatch.setattr(tables, "path_exists", lambda spark, folder: seen.append(folder) or True)
    tables.insert_if_absent(row, path, ["window_start"], 9, run="a")
    assert len(seen) == 1 and "metric_date=" in seen[0]


def test_two_runs_share_a_table(spark, feed, tmp_path):
    path = str(tmp_path / "raw")
    feed.add(*[(i, 0, "c", i) for i in range(6)])
    jobs.StreamRun(feed.stream().where("id < 3"), jobs.raw_events_sink(path), str(tmp_path / "a")).catch_up()
    jobs.StreamRun(feed.stream().where("id >= 3"), jobs.raw_events_sink(path), str(tmp_path / "b")).catch_up()
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(6))


def test_compaction_keeps_the_newest(spark, feed, tmp_path):
    path, progress = str(tmp_path / "t"), str(tmp_path / "cp")
    for i in range(3):
        feed.add((i, 0, "c", i), (10 + i, 1, "c", 86400 + i))
        frame = jobs.ctr_metrics_stream(feed.stream(), windows.ONE_MINUTE, lateness="9 days")
        jobs.StreamRun(frame, jobs.versions_sink(path), progress, "update").catch_up()
    before = sorted(rows(jobs.read_metrics(spark, path, frame.schema)))
    day = (START + timedelta(days=1)).date().isoformat()
    schema = jobs.versions_schema(frame.schema)
    assert tables.compact_versions(spark, path, schema, ["window_start"], day) == 3
    assert sorted(rows(jobs.read_metrics(spark, path, frame.schema))) == before
    assert tables.read_batches(spark, path, schema).where(F.col("metric_date") < day).count() == 1


def test_a_failed_batch_is_redone_once(spark, feed, tmp_path):
    feed.add(*[(i, 0, "c", i) for i in range(20)])
    path, progress = str(tmp_path / "raw"), str(tmp_path / "cp")
    sink = jobs.raw_events_sink(path)

    def fails_after_writing(df, batch_id):
        sink(df, batch_id)
        raise RuntimeError("lost")

    with pytest.raises(StreamingQueryException):
        jobs.StreamRun(feed.stream(), fails_after_writing, progress).catch_up()
    feed.add(*[(100 + i, 1, "c", i) for i in range(5)])
    jobs.StreamRun(feed.stream(), sink, progress).catch_up()
    stored = spark.read.option("basePath", path).parquet(path)
    assert sorted(r["id"] for r in stored.collect()) == [*range(20), *range(100, 105)]
    assert {"event_date", "created_at", "updated_at"} <= set(stored.columns)


def test_stream_dedup(spark, feed, tmp_path):
    feed.add((1, 0, "c", 0), (1, 0, "c", 1), (2, 0, "c", 2))
    feed.add((2, 1, "c", 3), (3, 1, "c", 4))
    deduped = jobs.stream_dedup(jobs.bounded_lateness(feed.stream()))
    path = str(tmp_path / "t")
    jobs.StreamRun(deduped, lambda df, i: tables.write_batch(df, path, i), str(tmp_path / "cp")).catch_up()
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_keyed_and_breakdown_streams(spark, feed, tmp_path):
    feed.add((1, 1, "a", 0), (2, 0, "b", 1))
    feed.add((3, 0, "a", 2), (4, 0, None, 3))
    frame = jobs.breakdown_stream(feed.stream(), windows.ONE_MINUTE, "site_category")
    path = str(tmp_path / "t")
    jobs.StreamRun(frame, jobs.versions_sink(path, "window.start"), str(tmp_path / "cp"), "update").catch_up()
    row = jobs.read_breakdown(spark, path, frame.schema, "category_ctr").first()
    assert row["category_ctr"] == {"a": 50.0, "b": 0.0, "unknown": 0.0} and row["total_impressions"] == 4


def test_malformed_fails_the_stream(spark, tmp_path):
    spark.createDataFrame([("{broken",)], "value string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("value string").parquet(str(tmp_path / "in"))
    decoded = parse_event_json(stream, on_error="fail")
    with pytest.raises(StreamingQueryException):
        jobs.StreamRun(decoded, lambda df, i: df.collect(), str(tmp_path / "cp")).catch_up()


def test_scratch_paths_are_new(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_stream_reads_a_file_or_a_folder(spark, sf, tmp_path):
    from clickweir.sources.driver_tables import ad_events, ad_events_stream, read_driver_table
    read_driver_table(spark, sf, "events").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    expected = ad_events(spark, sf).count()
    for i, folder in enumerate((sf, str(tmp_path))):
        path = str(tmp_path / f"out{i}")
        jobs.StreamRun(ad_events_stream(spark, folder), lambda df, b, p=path: tables.write_batch(df, p, b),
                       str(tmp_path / f"cp{i}")).catch_up()
        assert spark.read.parquet(path).count() == expected
