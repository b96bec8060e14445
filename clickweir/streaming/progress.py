"""What running streams report: a stored row per micro-batch, and the windows that are still open."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from clickweir.sources.tables import read_batches

REPORT = ("run string, batch_id int, started timestamp, input_rows long, dropped_rows long, state_rows long, "
          "batch_ms long, write_ms long, watermark timestamp")


class ProgressLog(StreamingQueryListener):
    """Holds one report per micro-batch of all queries of a session until `store` writes them. Reports of
    triggers that ran no batch are left out."""

    def __init__(self) -> None:
        self._reports: dict[tuple[str, int], tuple] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if "addBatch" not in p.durationMs:
            return
        row = (str(p.id), p.batchId, p.timestamp, p.numInputRows, sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
               sum(s.numRowsTotal for s in p.stateOperators), p.durationMs.get("triggerExecution"), p.durationMs["addBatch"],
               (p.eventTime or {}).get("watermark"))
        with self._news:
            self._reports[row[:2]] = row

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def wait(self, run_id, seconds: float = 60) -> None:
        """Until the reports of a run that has ended are here; they come after its end."""
        with self._news:
            if not self._news.wait_for(lambda: str(run_id) in self._ended, seconds):
                raise TimeoutError(f"no end of {run_id} was reported")

    def store(self, spark: SparkSession, path: str) -> int:
        """Write the reports held, a folder for each query and batch, and let go of them; a batch that was
        repeated replaces its report."""
        with self._news:
            reports, self._reports = list(self._reports.values()), {}
        if reports:
            text = spark.createDataFrame(reports, REPORT.replace("timestamp", "string").replace("int,", "long,"))
            rows = text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _schema(spark)])
            rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch_id").parquet(path)
        return len(reports)


def _schema(spark: SparkSession):
    return spark.createDataFrame([], REPORT).schema


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All reports, over restarts and queries."""
    return read_batches(spark, path, _schema(spark))


def batch_latency(reports: DataFrame) -> DataFrame:
    """Batches, and the mean, median, 95th percentile and largest of their time in ms."""
    ms = F.col("batch_ms")
    return reports.agg(F.count("*").alias("batches"), F.avg(ms).alias("mean_ms"), F.expr("percentile(batch_ms, 0.5)").alias("median_ms"),
                       F.expr("percentile(batch_ms, 0.95)").alias("p95_ms"), F.max(ms).alias("max_ms"))


def arrival_latency(stored: DataFrame, event_time: str = "event_time", stored_at: str = "created_at") -> DataFrame:
    """Seconds from an event's time to when it was stored: least, mean, largest and three percentiles."""
    s = F.unix_micros(F.col(stored_at).cast("timestamp")) / 1e6 - F.unix_micros(F.col(event_time).cast("timestamp")) / 1e6
    rows = stored.select(s.alias("s")).where("s IS NOT NULL")
    return rows.agg(F.count("*").alias("events"), F.min("s").alias("min_s"), F.avg("s").alias("mean_s"), F.max("s").alias("max_s"),
                    *[F.percentile("s", F.lit(p)).alias(f"p{round(100 * p)}_s") for p in (0.5, 0.95, 0.99)])


def open_windows(spark: SparkSession, checkpoint: str, values: Sequence[str] = ("impressions", "clicks")) -> DataFrame:
    """Windows that a windowed count still holds in its state, from the checkpoint of a stopped query."""
    named = "struct<" + ",".join(f"{v}:bigint" for v in values) + ">"
    return spark.read.format("statestore").load(checkpoint).select(
        F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"),
        F.col("value").cast(named).alias("v")).select("window_start", "window_end", "v.*")


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query and the batches their state is kept for."""
    return spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorName", "minBatchId", "maxBatchId")
