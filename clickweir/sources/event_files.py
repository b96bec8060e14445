"""Event files and event streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from clickweir.schema import EVENT_SCHEMA, RAW_SCHEMA, STRING_COLUMNS
from clickweir.session import stored

CORRUPT = "_corrupt_record"


def scan_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV (plain or gzip), every column text, UTF-8.

    A line with the wrong number of columns keeps its text in `_corrupt_record`.
    Otherwise an empty field is empty text, as a row reader without type guesses
    would give; NULL is left for fields the line does not have.
    """
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
    rows = (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return rows.select(
        *[F.when(F.col(CORRUPT).isNull(), F.coalesce(F.col(c), F.lit(""))).otherwise(F.col(c)).alias(c)
          for c in RAW_SCHEMA.names], CORRUPT)


def scan_limit(df: DataFrame, n: int | None, order_by: list[Column] | None = None) -> DataFrame:
    """First n records; 0 or None means all. With an order this is a top-n per task
    and a merge, never a full sort."""
    if not n:
        return df
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def stream_source(spark: SparkSession, fmt: str, options: Mapping[str, str],
                  schema: T.StructType | str | None = None) -> DataFrame:
    """Subscribe from the earliest record. The format is a parameter: file formats
    here, a broker where its connector is installed."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    return reader.options(**options).load()


def parse_event_json(df: DataFrame, payload: str = "value",
                     schema: T.StructType = EVENT_SCHEMA, on_error: str = "dlq") -> DataFrame:
    """Decode JSON text to typed columns beside the other columns of `df`.

    on_error: 'dlq' keeps undecodable rows with their text in `_corrupt_record`,
    'drop' leaves them out, 'fail' fails the job.
    """
    if on_error not in ("dlq", "drop", "fail"):
        raise ValueError(f"on_error must be dlq, drop or fail, not {on_error!r}")
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(payload).cast("string"), full,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = df.withColumn("_event", parsed)
    # NULL text decodes to NULL without a corrupt record, so it is tested by itself
    corrupt = F.when(F.col(payload).isNull(), F.lit("")).otherwise(F.col(f"_event.{CORRUPT}"))
    if on_error == "drop":
        rows = rows.where(corrupt.isNull())
    elif on_error == "fail":
        corrupt = F.when(corrupt.isNotNull(), F.raise_error(
            F.concat(F.lit("undecodable event: "), corrupt)).cast("string"))
    out = [c for c in df.columns if c != payload]
    columns = [F.col(f"_event.{f.name}").alias(f.name) for f in schema.fields]
    if on_error != "drop":
        columns.append(corrupt.alias(CORRUPT))
    return rows.select(*out, *columns)


def csv_null_lenient(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Lenient scan: empty text and unreadable integers become NULL, the id stays text,
    a line with the wrong number of columns is marked in `_corrupt_record`. Adds
    `_source`, `_file` and `_processed_at`.

    `_line_number` orders the lines of a file; it is taken from the position Spark
    gives each row, so it is increasing, not dense.
    """
    rows = scan_events_csv(spark, path)
    columns = []
    for name in RAW_SCHEMA.names:
        text = F.nullif(F.trim(F.col(name)), F.lit(""))
        if name in STRING_COLUMNS or name == "id":
            columns.append(text.alias(name))
        else:
            columns.append(text.try_cast("int").alias(name))
    return rows.select(
        *columns, CORRUPT, F.lit(source).alias("_source"), F.input_file_name().alias("_file"),
        F.current_timestamp().alias("_processed_at"),
        F.monotonically_increasing_id().alias("_line_number"))


def csv_numbered_lines(spark: SparkSession, path: str, source: str) -> DataFrame:
    """The lenient scan with `_line_number` 1, 2, ... over all files in the order of their names.

    A task reads a split of a file from its first line to its last, so within a split numbers have no gaps. The rows are
    stored as they come; only the splits, one row each, are put in order, and each split's rows are moved by what lies before it.
    """
    rows = stored(csv_null_lenient(spark, path, source).withColumn("_split", F.col("_metadata.file_block_start")), "numbered-lines")
    splits = rows.groupBy("_file", "_split").agg(F.min("_line_number").alias("_first"), F.count("*").alias("_lines"))
    # one row per split
    before = Window.partitionBy(F.lit(0)).orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    moved = splits.select(F.col("_file").alias("_f"), F.col("_split").alias("_s"),
                          (F.coalesce(F.sum("_lines").over(before), F.lit(0)) - F.col("_first") + 1).alias("_by"))
    return (rows.join(F.broadcast(moved), (F.col("_file") == F.col("_f")) & (F.col("_split") == F.col("_s")))
            .withColumn("_line_number", F.col("_line_number") + F.col("_by")).drop("_split", "_f", "_s", "_by"))


def publish_event_json(df: DataFrame) -> DataFrame:
    """Keyed JSON messages: key is the id as text, value the whole event."""
    from clickweir.functions.payloads import event_to_json
    return df.select(F.col("id").cast("string").alias("key"),
                     event_to_json(EVENT_SCHEMA.names).alias("value"))


def write_messages(messages: DataFrame, fmt: str, path: str | None = None, **options: str) -> None:
    """Send keyed messages to any batch sink with key and value columns."""
    writer = messages.write.format(fmt).options(**options)
    if path is None:
        writer.save()
    else:
        writer.mode("append").save(path)
