"""Few large files instead of many small ones, in a table that sinks append to.

Files of a day are put in bins, the largest first; a bin is closed when it has reached the target, so a
day gets at most as many bins as its bytes hold targets, rounded up. A bin of several files becomes one file:

1. the new generation is written in a folder that readers skip;
2. the list of the files it replaces is written beside it, which commits it;
3. those files are deleted, the new ones moved into place, and the folder goes.

Cut before 2, nothing has happened. Cut later, `finish` does the rest, however often; until then
`read_compacted` reads every row once. A stream may replay its last batch, so the last batch of each run is left alone.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickweir.operators.joins import broadcast_if_small
from clickweir.session import delete_path, list_path, move_path, path_exists, stored
from clickweir.sources.tables import leaf_folders

TARGET_BYTES = 128 << 20
WORK = "_compaction"        # readers skip names that begin with an underscore


def file_inventory(table: DataFrame, path: str, day: str = "event_date") -> DataFrame:
    """file, bytes, day, run and batch of every file of a table written by `write_batch`."""
    _, layout = leaf_folders(table, path)
    if layout != [day, "run", "batch_id"]:
        raise ValueError(f"{path} is laid out by {layout}")
    return table.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
                        F.col(day).alias("day"), "run", "batch_id").distinct()


def binned(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Files with the number of their bin within the day."""
    upto = Window.partitionBy("day").orderBy(F.col("bytes").desc(), "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(upto), F.lit(0)) / F.lit(target_bytes)))


def _works(spark: SparkSession, path: str) -> list[str]:
    return list_path(spark, f"{path}/{WORK}") if path_exists(spark, f"{path}/{WORK}") else []


def _committed(spark: SparkSession, work: str) -> bool:
    return path_exists(spark, f"{work}/replaced/_SUCCESS")


def compact(spark: SparkSession, path: str, day: str = "event_date", target_bytes: int = TARGET_BYTES,
            before: str | None = None) -> int:
    """Rewrite the small files of a table, of days before `before`; return how many files were replaced."""
    finish(spark, path)
    table = spark.read.option("basePath", path).parquet(path)
    names = [c for c in table.columns if c not in (day, "run", "batch_id")]
    files = stored(file_inventory(table, path, day), "files")
    last = files.groupBy(F.col("run").alias("r")).agg(F.max("batch_id").alias("last"))
    closed = files.join(last, F.col("run") == F.col("r")).where((F.col("batch_id") < F.col("last")) | F.col("run").startswith("compacted-"))
    if before is not None:
        closed = closed.where(F.col("day") < F.lit(before).cast("date"))
    bins = binned(closed.select("file", "bytes", "day"), target_bytes)
    crowded = stored(bins.withColumn("n", F.count("*").over(Window.partitionBy("day", "bin"))).where("n > 1").select("file", "bin"), "bins")
    n_files = crowded.count()
    if not n_files:
        return 0
    run = f"compacted-{uuid.uuid4().hex}"
    work = f"{path}/{WORK}/{run}"
    rows = (table.select("*", F.col("_metadata.file_path").alias("_file")).join(broadcast_if_small(crowded), F.col("_file") == F.col("file"))
            .select(*names, day, F.lit(run).alias("run"), F.col("bin").cast("int").alias("batch_id")))
    # a bin is one task's, and its rows are one file
    rows.repartition(day, "batch_id").write.partitionBy(day, "run", "batch_id").parquet(f"{work}/data")
    crowded.select("file").write.parquet(f"{work}/replaced")
    finish(spark, path)
    return n_files


def finish(spark: SparkSession, path: str) -> None:
    """Finish what a compaction that was cut short has committed, and drop what it hasn't."""
    for work in _works(spark, path):
        if _committed(spark, work):
            folders = set()
            for row in spark.read.parquet(f"{work}/replaced").toLocalIterator():
                file = unquote(row["file"])
                delete_path(spark, file)
                folders.add(file.rsplit("/", 1)[0])
            for folder in folders:
                if path_exists(spark, folder) and not any(not n.rsplit("/", 1)[1].startswith((".", "_")) for n in list_path(spark, folder)):
                    delete_path(spark, folder)
            for of_day in list_path(spark, f"{work}/data"):
                for of_run in list_path(spark, of_day) if "=" in of_day.rsplit("/", 1)[1] else []:
                    for of_bin in list_path(spark, of_run):
                        move_path(spark, of_bin, "/".join([path, *of_bin.split("/")[-3:]]))
        delete_path(spark, work)


def read_compacted(spark: SparkSession, path: str) -> DataFrame:
    """All rows once, also while a committed compaction is not finished."""
    table = spark.read.option("basePath", path).parquet(path)
    for work in _works(spark, path):
        if _committed(spark, work):
            gone = spark.read.parquet(f"{work}/replaced")
            live = table.select("*", F.col("_metadata.file_path").alias("_file"))
            table = live.join(broadcast_if_small(gone), F.col("_file") == F.col("file"), "left_anti").drop("_file")
            left = [b for d in list_path(spark, f"{work}/data") if "=" in d.rsplit("/", 1)[1] for r in list_path(spark, d) for b in list_path(spark, r)]
            if left:
                table = table.unionByName(spark.read.option("basePath", f"{work}/data").parquet(*left))
    return table
