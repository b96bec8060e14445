"""Positions in a total order over a whole table, without one task seeing all of it.

Rows are range-partitioned and written to the scratch folder together with their
partition number, which fixes the boundaries for good. Per-partition totals (one row per partition) give each
partition its offset, and the running sum inside a partition does the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickweir.session import stored


def running_total(df: DataFrame, order: Sequence[Column], weight: Column | None = None,
                  within: Sequence[str] = (), alias: str = "position") -> DataFrame:
    """Add the running sum of `weight` (1 by default) in the given order.

    The order must be total over distinct rows, else equal rows crowd one partition.
    With `within`, sums restart in every group of those columns; groups may span
    partitions and need not fit into one task.
    """
    spark = df.sparkSession
    weight = F.lit(1) if weight is None else weight
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    full_order = [*[F.col(c).asc_nulls_last() for c in within], *order]
    ranged = stored(
        df.withColumn("_weight", weight.cast("bigint"))
        .repartitionByRange(parts, *full_order)
        .withColumn("_part", F.spark_partition_id()))

    groups = list(within)
    totals = ranged.groupBy("_part", *groups).agg(F.sum("_weight").alias("_total"))
    # at most one row per partition and group boundary
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_part").alias("_p"), *[F.col(g).alias(f"_g_{g}") for g in groups],
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))

    inside = Window.partitionBy("_part", *groups).orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.withColumn("_running", F.sum("_weight").over(inside))
    on = F.col("_part") == F.col("_p")
    for g in groups:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    # offsets have at most (partitions + groups) rows: bounded by settings, not by data,
    # as long as `within` names few groups
    return running.join(F.broadcast(offsets) if not groups else offsets, on, "left").select(
        *df.columns, (F.col("_running") + F.col("_offset")).alias(alias))


def surrogate_key(df: DataFrame, columns: Sequence[str], alias: str) -> DataFrame:
    """Dense 1-based key over distinct rows in the order of all columns, NULLs last."""
    order = [F.col(c).asc_nulls_last() for c in columns]
    return running_total(df, order, alias=alias)
