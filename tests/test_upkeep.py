"""Incremental marts and compaction: the same rows as from scratch, and no more files touched than needed."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickweir.catalog.marts import stored_minutes
from clickweir.operators.joins import batch_vs_stream_reconcile
from clickweir.plans import incremental, marts
from clickweir.schema import EVENT_COLUMNS, EVENT_SCHEMA
from clickweir.session import delete_path, move_path
from clickweir.sources import compaction, driver_tables, tables
from conftest import rows

START = date(2024, 3, 1)


def events(spark, *given):
    """(id, day, hour, click, site, device) as events with their day."""
    data = []
    for n, day, hour, click, site, device in given:
        at = START + timedelta(days=day)
        row = dict.fromkeys(EVENT_COLUMNS) | {"id": n, "click": click, "hour": int(f"{at:%y%m%d}{hour:02d}"), "site_id": site,
                                              "site_domain": "d", "site_category": "c", "device_type": device}
        data.append((*row.values(), at))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_SCHEMA).replace("decimal(20,0)", "long")
    return spark.createDataFrame(data, schema + ", event_date date").withColumn("id", F.col("id").cast("decimal(20,0)"))


def base(days=20):
    return [(100 * d + 10 * s + i, d, i, (d + i + s) % 3 % 2, f"s{s}", s % 2) for d in range(days) for s in range(3) for i in range(4)
            if (d + s) % 5]


def files(path):
    return {os.path.join(f, n) for f, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def full(spark, path):
    return sorted(map(str, rows(marts.fct_daily_metrics(spark.read.parquet(path).drop("event_date")))))


def facts(spark, root):
    order = marts.fct_daily_metrics(spark.read.parquet(f"{root}/staged").withColumn("hour", F.lit(1))).columns
    return sorted(map(str, rows(spark.read.parquet(f"{root}/facts").select(*order))))


def put(spark, path, given, day=None):
    df = events(spark, *given)
    tables.materialize_table(df if day is None else df.where(F.col("event_date") == day), path,
                             refresh="full" if day is None else "partitions")


@pytest.fixture()
def made(spark, tmp_path):
    path, root = str(tmp_path / "events"), str(tmp_path / "marts")
    put(spark, path, base())
    done = incremental.refresh_daily_marts(spark, path, root)
    assert len(done.facts) == 20 and facts(spark, root) == full(spark, path)
    return path, root


def test_only_the_day_and_what_follows_from_it(spark, made):
    path, root = made
    before = {t: files(f"{root}/{t}") for t in ("staged", "daily", "facts")}
    day = START + timedelta(days=5)
    given = [(n, d, h, 1 - c if d == 5 and s == "s1" else c, s, v) for n, d, h, c, s, v in base()]
    put(spark, path, given, day)
    done = incremental.refresh_daily_marts(spark, path, root)
    assert facts(spark, root) == full(spark, path)
    assert done.changed == done.staged == done.daily == [day]
    # site 1 has no row where day + 1 is a multiple of 5: six rows behind day 5 reach to day 12
    assert done.facts == [START + timedelta(days=d) for d in (5, 6, 7, 8, 10, 11, 12)]
    for table, days in (("staged", done.staged), ("daily", done.daily), ("facts", done.facts)):
        now = files(f"{root}/{table}")
        for f in before[table] | now:
            replaced = any(f"event_date={d}" in f for d in days)
            assert replaced != (f in before[table] and f in now), f
    assert incremental.refresh_daily_marts(spark, path, root) == incremental.Refresh([], [], [], [])


def test_a_refresh_lists_one_table_of_all_days(spark, made, monkeypatch):
    """Only the daily aggregate is opened whole; of the others no more than the days in work."""
    path, root = made
    real, opened = incremental._read, []
    monkeypatch.setattr(incremental, "_read", lambda spark, path, like: opened.append(os.path.basename(path)) or real(spark, path, like))
    put(spark, path, [(n, d, h, 1 - c, s, v) for n, d, h, c, s, v in base()], START + timedelta(days=5))
    incremental.refresh_daily_marts(spark, path, root)
    assert opened == ["daily"] and facts(spark, root) == full(spark, path)


@pytest.mark.parametrize("few", [0, 256])
def test_days_are_read_by_folder_or_by_filter(spark, made, monkeypatch, few):
    _, root = made
    monkeypatch.setattr(incremental, "FEW_FOLDERS", few)
    like = spark.read.schema("site_id string, daily_total_clicks long, event_date date").parquet(f"{root}/daily")
    days = [START + timedelta(days=d) for d in (3, 4, 400)]
    got = incremental._read_days(spark, f"{root}/daily", like, days)
    assert got.columns == like.columns and got.count() > 0
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(like.where(F.col("event_date").isin(days)))))
    assert rows(incremental._read_days(spark, f"{root}/daily", like, days[2:])) == []


def test_events_of_days_reach_the_scan(spark, sf):
    days = ["2024-01-10", "2024-01-20"]
    got = driver_tables.ad_events_of_days(spark, sf, days)
    expected = driver_tables.ad_events(spark, sf).where(F.to_date("event_time").isin([date.fromisoformat(d) for d in days]))
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(expected))) and got.count() > 0
    scan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in scan and "GreaterThanOrEqual(ts,2024-01-09T23:00)" in scan


def test_new_files_with_the_same_rows_change_nothing(spark, made):
    path, root = made
    before = files(root)
    put(spark, path, base()[::-1], START + timedelta(days=3))
    assert incremental.refresh_daily_marts(spark, path, root) == incremental.Refresh([], [], [], [])
    assert {f for f in files(root) if "/state/" not in f} == {f for f in before if "/state/" not in f}


def test_copies_on_other_days_days_that_come_and_go(spark, made):
    path, root = made
    newer = [(100, 9, 5, 1, "s0", 0)]                  # of an id of day 1
    put(spark, path, base() + newer, START + timedelta(days=9))
    done = incremental.refresh_daily_marts(spark, path, root)
    assert done.changed == [START + timedelta(days=9)] and START + timedelta(days=1) in done.staged
    assert facts(spark, root) == full(spark, path)
    put(spark, path, base(), START + timedelta(days=9))     # the newer copy goes, the older one counts again
    done = incremental.refresh_daily_marts(spark, path, root)
    assert START + timedelta(days=1) in done.staged and facts(spark, root) == full(spark, path)
    delete_path(spark, f"{path}/event_date={START + timedelta(days=7)}")
    put(spark, path, base(22), START + timedelta(days=21))
    done = incremental.refresh_daily_marts(spark, path, root)
    assert done.changed == [START + timedelta(days=d) for d in (7, 21)] and facts(spark, root) == full(spark, path)
    assert not os.path.exists(f"{root}/daily/event_date={START + timedelta(days=7)}")


@pytest.mark.parametrize("step", [0, 1, 2])
def test_a_refresh_cut_short_is_redone(spark, made, monkeypatch, step):
    path, root = made
    put(spark, path, base() + [(100, 9, 5, 1, "s0", 0)], START + timedelta(days=9))
    real, calls = incremental._replace_days, []

    def failing(*args):
        if len(calls) == step:
            raise OSError("lost")
        calls.append(1)
        real(*args)
    monkeypatch.setattr(incremental, "_replace_days", failing)
    with pytest.raises(OSError):
        incremental.refresh_daily_marts(spark, path, root)
    monkeypatch.setattr(incremental, "_replace_days", real)
    incremental.refresh_daily_marts(spark, path, root)
    assert facts(spark, root) == full(spark, path)


def test_events_are_scanned_by_the_day(spark, made):
    path, _ = made
    scan = incremental.of_days(spark.read.parquet(path), {START + timedelta(days=3)})
    plan = incremental.marts.stage_events(scan.drop("event_date"), incremental.COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-03-04" in plan


# --- compaction ---------------------------------------------------------------------

def small_batches(spark, path, n=30):
    for i in range(n):
        df = spark.range(40 * i, 40 * i + 40).select("id", F.date_add(F.lit(START), (F.col("id") % 2).cast("int")).alias("event_date"))
        tables.write_batch(df.coalesce(1), path, i, ["event_date"], run="a")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_bins_are_few_and_rows_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    small_batches(spark, path)
    size = {f: os.path.getsize(f) for f in files(path)}
    target = 4000
    last = {f for f in size if "batch_id=29" in f}
    assert compaction.compact(spark, path, target_bytes=target) == 58
    assert ids(spark.read.parquet(path)) == list(range(1200))
    for d in (0, 1):
        day = f"event_date={START + timedelta(days=d)}"
        total = sum(n for f, n in size.items() if day in f and f not in last)
        assert sum(day in f and f not in last for f in files(path)) <= -(-total // target)
    assert last <= files(path)          # a stream may write them again
    tables.write_batch(spark.range(1160, 1200).select("id", F.lit(START).alias("event_date")), path, 29, ["event_date"], run="a")
    assert set(range(1160)) <= set(ids(spark.read.parquet(path)))
    assert compaction.compact(spark, path, target_bytes=target, before="2024-03-01") == 0


class Cut(Exception):
    pass


@pytest.mark.parametrize("where", ["before commit", "no deletes", "some deletes", "some moves"])
def test_a_compaction_cut_short(spark, tmp_path, monkeypatch, where):
    path, calls = str(tmp_path / "t"), []
    small_batches(spark, path, 8)

    def after(n, real):
        def run(*args):
            if len(calls) == n:
                raise Cut
            calls.append(1)
            return real(*args)
        return run
    with monkeypatch.context() as m:
        if where == "before commit":
            real = compaction.finish
            m.setattr(compaction, "finish", after(1, real))
            m.setattr(compaction, "_committed", lambda *_: False)
        elif where == "some moves":
            m.setattr(compaction, "move_path", after(1, move_path))
        else:
            m.setattr(compaction, "delete_path", after(0 if where == "no deletes" else 3, delete_path))
        with pytest.raises(Cut):
            compaction.compact(spark, path, target_bytes=1000)
    if where == "before commit":
        delete_path(spark, [w for w in compaction._works(spark, path)][0] + "/replaced")
    assert ids(compaction.read_compacted(spark, path)) == list(range(320))
    compaction.finish(spark, path)
    assert ids(spark.read.parquet(path)) == list(range(320)) and not compaction._works(spark, path)
    compaction.compact(spark, path, target_bytes=1 << 20)
    assert ids(compaction.read_compacted(spark, path)) == list(range(320))


# --- reconciliation -----------------------------------------------------------------

def test_a_window_missing_from_the_stored_stream_is_found(spark, sf):
    metrics = stored_minutes(spark, sf)
    lost = metrics.where("clicks > 0").orderBy("window_start").first()["window_start"]
    hours = metrics.groupBy(F.date_trunc("hour", "window_start").alias("hour_start")).agg(
        F.sum("clicks").alias("clicks"), F.sum(F.col("clicks") + F.col("impressions")).alias("events"))
    gap = metrics.where(F.col("window_start") != F.lit(lost)).groupBy(F.date_trunc("hour", "window_start").alias("hour_start")).agg(
        F.sum("clicks").alias("clicks"), F.sum(F.col("clicks") + F.col("impressions")).alias("events"))
    found = batch_vs_stream_reconcile(hours, gap, "hour_start").where("NOT cast(matched AS boolean)").collect()
    assert [r["hour_start"] for r in found] == [datetime(lost.year, lost.month, lost.day, lost.hour)]
