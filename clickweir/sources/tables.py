"""Stored tables: full refresh, idempotent batch appends, metrics, dead letters, samples."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickweir.functions.payloads import audit_columns
from clickweir.operators.joins import missing_keys
from clickweir.session import delete_path, path_exists, stored


def materialize_table(df: DataFrame, path: str, partition_by: str | None = "event_date",
                      loaded_at: str | None = None, refresh: str = "full") -> DataFrame:
    """Write a table, as `write_table` does, and read it back."""
    if loaded_at:
        df = df.select("*", *audit_columns([loaded_at]))
    write_table(df, path, partition_by, refresh)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_table(df: DataFrame, path: str, partition_by: str | None = "event_date", refresh: str = "full") -> None:
    """Write a table; nothing of it is listed.

    refresh='full' replaces the whole table; 'partitions' replaces only the days
    present in `df`, which is how one late day is redone without touching the rest.
    Rows are rebalanced by day first: adaptive execution merges light days into few
    files and splits a heavy day over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    writer = df.write.mode("overwrite")
    if partition_by:
        mode = {"full": "static", "partitions": "dynamic"}[refresh]
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", mode)
    writer.parquet(path)


def stream_run(df: DataFrame) -> str:
    """Id of the streaming query whose micro-batch `df` is. A query keeps it over restarts
    from its checkpoint; a new checkpoint has a new one."""
    run = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if run is None:
        raise ValueError("outside a streaming query a batch needs the name of its run")
    return run


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (),
                run: str | None = None) -> None:
    """Append one micro-batch under `partition_by`, then its run and batch id.

    A replayed batch overwrites exactly its own folders, so the append happens once, and
    another run never touches them. Rows are rebalanced first, so that files are few.
    """
    run = run or stream_run(df)
    rows = df.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(batch_id))
    if partition_by:
        rows = rows.hint("rebalance", *[F.col(c) for c in partition_by])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*partition_by, "run", "batch_id").parquet(path)


def read_batches(spark: SparkSession, path: str, schema, folders: Sequence[str] | None = None) -> DataFrame:
    """All committed micro-batches of a table written by `write_batch`, or those in some of its folders."""
    full = T.StructType([f for f in schema.fields if f.name not in ("run", "batch_id")]
                        + [T.StructField("run", T.StringType()), T.StructField("batch_id", T.IntegerType())])
    found = [f for f in ([path] if folders is None else folders) if path_exists(spark, f)]
    if not found:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*found)


def insert_if_absent(new: DataFrame, path: str, keys: Sequence[str], batch_id: int,
                     day_of: str = "window_start", run: str | None = None) -> None:
    """Add rows whose key the table does not have yet; of rows with one key the smallest.

    The table is partitioned by day first, and only the folders of the batch's days are
    listed and read, so the cost follows the batch and not the age of the table.
    """
    spark, run = new.sparkSession, run or stream_run(new)
    rest = [c for c in new.columns if c not in keys]
    one = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")) \
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*new.columns) \
        .withColumn("metric_date", F.to_date(day_of))
    # the days of one batch
    days = [r["metric_date"] for r in one.select("metric_date").distinct().collect()]
    folders = [f"{path}/metric_date={'__HIVE_DEFAULT_PARTITION__' if day is None else day}" for day in days]
    known = read_batches(spark, path, one.schema, folders).where(
        ~((F.col("run") == run) & (F.col("batch_id") == batch_id)))
    write_batch(missing_keys(one, known, keys), path, batch_id, ["metric_date"], run)


def latest_versions(versions: DataFrame, keys: Sequence[str],
                    version: Sequence[str] = ("written_at", "batch_id")) -> DataFrame:
    """Newest version of every key. `max_by` combines before the shuffle."""
    payload = [c for c in versions.columns if c not in (*keys, *version, "run")]
    newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.struct(*version)).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload])


def leaf_folders(table: DataFrame, path: str) -> tuple[DataFrame, list[str]]:
    """The table with `_folder`, the folder each row's file lies in, and the partition columns
    of its layout, which must be one for all files."""
    file = F.col("_metadata.file_path")
    marked = table.withColumn("_folder", F.regexp_replace(file, "/[^/]*$", ""))
    names = F.regexp_extract_all("_folder", F.lit("/([^/=]+)=[^/]*"), F.lit(1))
    layouts = marked.select(F.array_join(names, "/").alias("names")).distinct().limit(2).collect()
    if len(layouts) > 1:
        raise ValueError(f"{path} mixes partition layouts: {[r['names'] for r in layouts]}")
    return marked, [n for r in layouts for n in r["names"].split("/") if n]


def versions_schema(schema: T.StructType) -> T.StructType:
    """Columns of a table that a `versions_sink` writes, for rows of `schema`."""
    return T.StructType([*schema.fields, T.StructField("written_at", T.TimestampType()),
                         T.StructField("metric_date", T.DateType())])


def compact_versions(spark: SparkSession, path: str, schema, keys: Sequence[str], before: str) -> int:
    """Keep only the newest version of every key on days before `before`; return the folders dropped.

    The survivors are stored as a run of their own before the old folders go, and readers
    take the newest version, so a run cut short loses nothing and can be repeated.
    """
    run = f"compacted-{uuid.uuid4().hex}"
    day = F.col("metric_date") < F.lit(before).cast("date")
    old, _ = leaf_folders(read_batches(spark, path, schema).where(day), path)
    folders = [r["_folder"] for r in old.select("_folder").distinct().collect()]   # of the closed days
    if not folders:
        return 0
    payload = [c for c in old.columns if c not in (*keys, "run", "batch_id", "_folder")]
    newest = old.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.struct("written_at", "batch_id")).alias("_row"))
    rows = stored(newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload]), "compacted")
    write_batch(rows, path, 0, ["metric_date"], run)
    for folder in folders:
        delete_path(spark, unquote(folder))
    return len(folders)


def store_dlq_messages(rows: DataFrame, path: str, batch_id: int, run: str | None = None) -> None:
    write_batch(rows.withColumn("received_date", F.to_date("processed_at")), path, batch_id,
                ["received_date"], run)


def dlq_daily_log(rows: DataFrame, path: str, batch_id: int, run: str | None = None) -> None:
    """JSON lines, one folder per day, run and batch; a replayed batch replaces its own."""
    log = rows.select("message_id", F.col("processed_at").alias("timestamp"),
                      F.col("message_content").alias("content"), "error_reason",
                      F.to_date("processed_at").alias("log_date"),
                      F.lit(run or stream_run(rows)).alias("run"), F.lit(batch_id).alias("batch_id"))
    log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("log_date", "run", "batch_id").json(path)


def write_samples(samples: dict[str, DataFrame], path: str) -> None:
    for name, sample in samples.items():
        sample.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
