"""Streaming jobs over the same aggregates the batch code uses.

Sinks are micro-batch writes keyed by batch id: a batch replayed after a failure
overwrites its own output, so with checkpointed offsets every event counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from clickweir.operators.windows import (FIVE_MINUTES, ONE_MINUTE, assemble_breakdown,
                                         dimension_counts, flatten_window, tumbling_counts,
                                         tumbling_ctr)
from clickweir.functions.ratios import ctr_stream
from clickweir.sources.tables import insert_if_absent, latest_versions, read_batches, versions_schema, write_batch

# --- fixed values: lateness and trigger interval ---------------------------------
LATENESS = "10 seconds"
TRIGGER = "60 seconds"
# ---------------------------------------------------------------------------------


def bounded_lateness(stream: DataFrame, event_time: str = "event_time",
                     lateness: str = LATENESS) -> DataFrame:
    return stream.withWatermark(event_time, lateness)


def stream_dedup(stream: DataFrame, key: str = "id") -> DataFrame:
    """First row of every key within the watermark. State is dropped as the watermark
    passes, so it follows the lateness and not the history. (Staging keeps the newest
    copy instead, which no stream can know.)"""
    return stream.dropDuplicatesWithinWatermark([key])


def ctr_metrics_stream(stream: DataFrame, width: str, keys: Sequence[str] = (),
                       lateness: str = LATENESS) -> DataFrame:
    return tumbling_ctr(bounded_lateness(stream, lateness=lateness), width, keys)


def chained_ctr_stream(stream: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Five-minute metrics built from the one-minute counts, so the wide windows see one
    row per minute instead of all events (append mode)."""
    minutes = tumbling_counts(bounded_lateness(stream, lateness=lateness), ONE_MINUTE)
    wide = minutes.groupBy(F.window(F.window_time("window"), FIVE_MINUTES).alias("window")).agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"))
    return flatten_window(wide, "impressions", "clicks",
                          ctr_stream(F.col("clicks"), F.col("impressions")).alias("ctr"))


def breakdown_stream(stream: DataFrame, width: str, dimension: str,
                     lateness: str = LATENESS) -> DataFrame:
    """Counts per window and dimension value; `read_breakdown` assembles the maps."""
    return dimension_counts(bounded_lateness(stream, lateness=lateness), width, dimension)


# --- running ----------------------------------------------------------------------

@dataclass(frozen=True)
class StreamRun:
    """A stream with its sink: `write` gets each micro-batch and its id."""
    frame: DataFrame
    write: Callable[[DataFrame, int], None]
    checkpoint: str
    mode: str = "append"

    def _writer(self):
        return (self.frame.writeStream.outputMode(self.mode)
                .option("checkpointLocation", self.checkpoint).foreachBatch(self.write))

    def start(self, every: str = TRIGGER) -> StreamingQuery:
        """Run until stopped; restarts continue from the checkpoint."""
        return self._writer().trigger(processingTime=every).start()

    def catch_up(self) -> StreamingQuery:
        """Process all that is there, in bounded micro-batches, and stop."""
        query = self._writer().trigger(availableNow=True).start()
        query.awaitTermination()
        return query


def raw_events_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Append events with write-time stamps, partitioned by event day."""
    def write(batch: DataFrame, batch_id: int) -> None:
        stamp = F.current_timestamp()
        rows = batch.withColumn("created_at", stamp).withColumn("updated_at", stamp) \
            .withColumn("event_date", F.to_date("event_time"))
        write_batch(rows, path, batch_id, ["event_date"])
    return write


def metrics_if_absent_sink(path: str, keys: Sequence[str] = ("window_start",)) -> Callable:
    """For append mode: a window is final when it arrives, and is added if not yet there."""
    def write(batch: DataFrame, batch_id: int) -> None:
        insert_if_absent(batch, path, keys, batch_id)
    return write


def versions_sink(path: str, day_of: str = "window_start") -> Callable:
    """For update mode: keep every batch's version of a row; readers take the newest, and
    `compact_versions` drops the others of closed days."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("metric_date", F.to_date(day_of)).withColumn("written_at", F.current_timestamp())
        write_batch(rows, path, batch_id, ["metric_date"])
    return write


def read_metrics(spark: SparkSession, path: str, schema, keys: Sequence[str] = ("window_start",)) -> DataFrame:
    """Newest version of every window a `versions_sink` wrote."""
    return latest_versions(read_batches(spark, path, versions_schema(schema)).drop("metric_date"), keys)


def read_breakdown(spark: SparkSession, path: str, schema, map_name: str) -> DataFrame:
    versions = read_batches(spark, path, versions_schema(schema)).drop("metric_date")
    newest = latest_versions(versions, ["window", "dim"])
    return assemble_breakdown(newest, map_name)


def malformed_split_sink(good: Callable, dead: Callable, corrupt: str) -> Callable:
    """One stream, two outputs: decodable rows to `good`, the rest to `dead`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()     # decoding is deterministic, so a lost block may be made anew
        try:
            good(batch.where(F.col(corrupt).isNull()).drop(corrupt), batch_id)
            dead(batch.where(F.col(corrupt).isNotNull()), batch_id)
        finally:
            batch.unpersist()
    return write


def late_data_count(delivered: DataFrame, metrics: DataFrame) -> DataFrame:
    """Rows delivered, counted in windows and left out as too late, from the stored input and
    the stored metrics, so over all batches and restarts. Only rows that windows count, with click 0 or 1."""
    none = F.lit(0).cast("bigint")
    both = delivered.where("click IN (0, 1)").select(F.lit(1).cast("bigint").alias("d"), none.alias("c")).union(
        metrics.select(none, F.col("impressions") + F.col("clicks")))
    return both.agg(F.coalesce(F.sum("d"), none).alias("delivered_rows"),
                    F.coalesce(F.sum("c"), none).alias("counted_rows")) \
        .withColumn("late_rows", F.col("delivered_rows") - F.col("counted_rows"))
