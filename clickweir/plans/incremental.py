"""Daily marts that follow their events day by day.

Beside the marts lies one row per day of events: a signature of its files, and a fingerprint of its rows
(count, XOR and sum of row hashes). Days whose files changed are read; those whose rows changed too are refreshed:

1. staging: the ids of the changed days, before and after, and the other days that have copies of them; only rows
   of such ids are staged again, and only those days' folders are replaced;
2. days: aggregated from the replaced folders, and compared row by row with what was there;
3. facts: a changed or vanished row changes the change of the next row, and the averages of the six rows
   behind it, of the same site and device. Days with such rows are replaced, others keep their files.

The days in work are noted before anything is replaced, and the fingerprints follow last. So a refresh that was cut
short is noticed by the next one, which redoes those days altogether.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from clickweir.plans import marts
from clickweir.schema import DAILY_GRAIN
from clickweir.session import delete_path, path_exists, stored
from clickweir.sources.tables import materialize_table, write_table

DAY = "event_date"
COLUMNS = ("hour", *DAILY_GRAIN)       # of the events, that the marts need
ROWS_BEHIND = 6                        # rows whose averages a row enters, besides its own
SERIES = ("site_id", "device_type")
FEW_FOLDERS = 256

STATE = "event_date date, files long, files_hash long, n_rows long, rows_xor long, rows_sum long"


@dataclass(frozen=True)
class Refresh:
    """Days whose events changed, and the days that were replaced in each table."""
    changed: list[datetime.date]
    staged: list[datetime.date]
    daily: list[datetime.date]
    facts: list[datetime.date]


def of_days(table: DataFrame, days: Iterable[datetime.date]) -> DataFrame:
    """Rows of some days; as literals they reach the scan as partition filters."""
    return table.where(F.col(DAY).isin(*sorted(days)) if days else F.lit(False))


def file_signatures(spark: SparkSession, path: str) -> DataFrame:
    """Per day, the number of its files and a hash of their names, sizes and times. Nothing is read but the listing."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path", "length", "modificationTime"))
    return files.groupBy(F.regexp_extract("path", f"/{DAY}=([^/]+)/", 1).try_cast("date").alias(DAY)) \
        .agg(F.count("*").alias("files"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("files_hash")) \
        .where(F.col(DAY).isNotNull())


def row_fingerprints(rows: DataFrame) -> DataFrame:
    """Per day, what tells its rows from others whatever their order: their number, the XOR and the sum of their hashes."""
    columns = sorted(c for c in rows.columns if c != DAY)
    return rows.groupBy(DAY).agg(F.count("*").alias("n_rows"), F.bit_xor(F.xxhash64(*columns)).alias("rows_xor"),
                                 F.sum(F.hash(*columns).cast("long")).alias("rows_sum"))


def _state(spark: SparkSession, root: str) -> DataFrame | None:
    """The fingerprints of the last refresh, if it came to its end."""
    if not path_exists(spark, f"{root}/state/_SUCCESS"):
        return None
    return spark.read.schema(STATE).parquet(f"{root}/state")


def _replace_days(rows: DataFrame, path: str, days: Iterable[datetime.date]) -> None:
    """Replace the folders of `days` with `rows`, which are of these days only; a day without rows loses its folder."""
    spark = rows.sparkSession
    there = {r[DAY] for r in rows.select(DAY).distinct().collect()}      # days in work
    write_table(rows, path, DAY, refresh="partitions")
    for day in set(days) - there:
        delete_path(spark, f"{path}/{DAY}={day}")


def _read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def _read_days(spark: SparkSession, path: str, like: DataFrame, days: Iterable[datetime.date]) -> DataFrame:
    """Rows of some days; of a few only their own folders are listed, however many the table has."""
    days = sorted(days)
    if len(days) > FEW_FOLDERS:
        return of_days(_read(spark, path, like), days)
    folders = [f for f in (f"{path}/{DAY}={day}" for day in days) if path_exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).option("basePath", path).parquet(*folders).select(*like.columns)


def _same_series(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on site and device, where NULL equals NULL."""
    k = keys.select(*[F.col(c).alias(f"k_{c}") for c in SERIES])
    on = F.lit(True)
    for c in SERIES:
        on = on & F.col(c).eqNullSafe(F.col(f"k_{c}"))
    return rows.join(k, on, how)


def dependent_rows(daily: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of `daily` whose facts follow from `changed` rows, which may be rows that are gone: the rows
    themselves and the next six of their series."""
    marks = changed.select(*DAILY_GRAIN, F.lit(True).alias("mark"), F.lit(False).alias("there"))
    rows = _same_series(daily, changed, "left_semi").select(*DAILY_GRAIN, F.lit(False).alias("mark"), F.lit(True).alias("there"))
    # one row for each place, of a row that is there, a mark, or both
    places = rows.unionAll(marks).groupBy(*DAILY_GRAIN).agg(F.max("mark").alias("mark"), F.max("there").alias("there"))
    order = (F.col(DAY).asc_nulls_last(), F.col("site_domain").asc_nulls_last(), F.col("site_category").asc_nulls_last())
    upto = Window.partitionBy(*SERIES).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = places.withColumn("n", F.count_if("there").over(upto)) \
        .withColumn("last", F.max(F.when(F.col("mark"), F.col("n"))).over(upto))
    return numbered.where(F.col("there") & (F.col("n") - F.col("last") <= ROWS_BEHIND)).select(*DAILY_GRAIN)


def _build_all(events: DataFrame, root: str) -> None:
    staged = materialize_table(marts.stage_events(events.drop(DAY), COLUMNS), f"{root}/staged", DAY)
    daily = materialize_table(marts.daily_agg_direct(staged), f"{root}/daily", DAY)
    write_table(marts.daily_metrics(daily), f"{root}/facts", DAY)


def refresh_daily_marts(spark: SparkSession, events_path: str, root: str) -> Refresh:
    """Bring `root`/staged, daily and facts up to date with the events, a table partitioned by `event_date`, the
    day of the events' hour. The first time everything is built. Returns what was replaced."""
    events = spark.read.parquet(events_path).withColumn(DAY, F.col(DAY).cast("date"))
    signatures = stored(file_signatures(spark, events_path), "file-signatures")
    state, pending_path = _state(spark, root), f"{root}/pending"
    fingerprints = stored(signatures.limit(0).join(row_fingerprints(events), DAY), "none") if state is None else state

    # days of the calendar, here and below
    files = signatures.join(fingerprints.select(F.col(DAY).alias("day"), F.col("files").alias("f"), F.col("files_hash").alias("h")),
                            F.col(DAY) == F.col("day"), "full")
    touched_days = [r[0] for r in files.where(~(F.col("files").eqNullSafe(F.col("f")) & F.col("files_hash").eqNullSafe(F.col("h"))))
                    .select(F.coalesce(DAY, "day")).collect()]
    pending = {r[DAY] for r in spark.read.schema("event_date date").parquet(pending_path).collect()} \
        if path_exists(spark, f"{pending_path}/_SUCCESS") else set()
    if not touched_days and not pending:
        return Refresh([], [], [], [])

    # the first time these are all days, which need not be named
    touched_rows = events.where(F.col(DAY).isNotNull()) if state is None else of_days(events, touched_days)
    now = stored(row_fingerprints(touched_rows), "row-fingerprints")
    before = (fingerprints if state is None else of_days(fingerprints, touched_days)).select(DAY, F.struct("n_rows", "rows_xor", "rows_sum").alias("was"))
    compared = now.select(DAY, F.struct("n_rows", "rows_xor", "rows_sum").alias("is")).join(before, DAY, "full")
    changed = {r[DAY] for r in compared.where(~F.col("is").eqNullSafe(F.col("was"))).select(DAY).collect()}

    done = Refresh(sorted(changed), [], [], [])
    if state is None and not pending:
        spark.createDataFrame([(d,) for d in changed], "event_date date").coalesce(1).write.mode("overwrite").parquet(pending_path)
        _build_all(events, root)
        done = Refresh(sorted(changed), sorted(changed), sorted(changed), sorted(changed))
    elif changed or pending:
        done = _refresh_days(spark, events, root, changed, pending, pending_path)

    kept = fingerprints.where(~F.col(DAY).isin(*touched_days)) if touched_days and state is not None else fingerprints
    fresh = signatures.join(now, DAY).select(*[f.name for f in T.StructType.fromDDL(STATE)])
    stored(kept.unionByName(fresh), "state").coalesce(1).write.mode("overwrite").parquet(f"{root}/state")
    delete_path(spark, pending_path)
    return done


def _refresh_days(spark, events, root, changed, pending, pending_path) -> Refresh:
    redo = changed | pending
    if not path_exists(spark, f"{root}/facts/_SUCCESS"):       # the first build was cut short
        _build_all(events, root)
        days = sorted(redo)
        return Refresh(sorted(changed), days, days, days)

    sample = marts.stage_events(events.drop(DAY), COLUMNS)
    staged = _read_days(spark, f"{root}/staged", sample, redo)
    touched = stored(of_days(events, redo).select("id").unionAll(staged.select("id"))
                     .where("id IS NOT NULL").distinct(), "touched-ids")
    # copies of these ids on other days: a scan of ids alone
    elsewhere = events.where(~F.col(DAY).isin(*sorted(redo))).select(DAY, "id").join(touched, "id", "left_semi")
    affected = redo | {r[DAY] for r in elsewhere.select(DAY).distinct().collect()}
    spark.createDataFrame([(d,) for d in affected], "event_date date").coalesce(1).write.mode("overwrite").parquet(pending_path)

    newest = marts.stage_events(of_days(events, affected).drop(DAY).join(touched, "id", "left_semi"), COLUMNS)
    others = _read_days(spark, f"{root}/staged", sample, affected).join(touched, "id", "left_anti")
    _replace_days(stored(others.unionByName(newest), "staged-days"), f"{root}/staged", affected)

    new = stored(marts.daily_agg_direct(_read_days(spark, f"{root}/staged", sample, affected)), "daily-days")
    old = stored(_read_days(spark, f"{root}/daily", new, affected), "daily-before")
    differ = new.unionAll(old) if pending else new.exceptAll(old).unionAll(old.exceptAll(new))
    changed_rows = stored(differ.select(*DAILY_GRAIN).distinct(), "changed-rows")
    days = {r[DAY] for r in changed_rows.select(DAY).distinct().collect()}
    if not days:
        return Refresh(sorted(changed), sorted(affected), [], [])
    _replace_days(of_days(new, days), f"{root}/daily", days)

    daily = _read(spark, f"{root}/daily", new)
    dependents = days | {r[DAY] for r in dependent_rows(daily, changed_rows).select(DAY).distinct().collect()}
    again = marts.daily_metrics(_same_series(daily, changed_rows, "left_semi"))
    facts = _read_days(spark, f"{root}/facts", again, dependents)
    kept = _same_series(facts, changed_rows, "left_anti")
    _replace_days(stored(kept.unionByName(of_days(again, dependents)), "fact-days"), f"{root}/facts", dependents)
    return Refresh(sorted(changed), sorted(affected), sorted(days), sorted(dependents))
