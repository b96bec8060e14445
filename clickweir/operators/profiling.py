"""Profiles of a table's columns from one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from clickweir.operators.global_order import running_total


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n) for every value of every column, values as text.

    One narrow row per cell, combined before the shuffle: frequent values shrink to
    one row per task, whatever their share of the table.
    """
    cells = df.select([F.col(c).cast("string").alias(c) for c in columns]) \
        .unpivot([], list(columns), "column_name", "value")
    return cells.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def _names(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The column names as rows, so that columns without values are not lost."""
    return df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")


def profile_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls, exact distinct count per column; zeros for an empty table."""
    counts = value_counts(df, columns)
    types = dict(df.dtypes)
    kind = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    found = counts.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("n_nulls"),
        F.count("value").alias("n_distinct"))
    return _names(df, columns).join(found, "column_name", "left").select(
        "column_name", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "n_nulls", "n_distinct")],
        kind[F.col("column_name")].alias("data_type"))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min and max per numeric column, in one pass."""
    parts = []
    for c in columns:
        x = F.col(c).cast("double")
        parts.append(F.struct(
            F.lit(c).alias("column_name"), F.count(c).alias("n"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")))
    return df.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def exact_quantiles(df: DataFrame, columns: Sequence[str],
                    percents: Sequence[int] = (25, 50, 75)) -> DataFrame:
    """Interpolated quantiles per numeric column, exact at any size; NULL without values.

    Equal values are merged into a frequency table, which is put into global order;
    no task needs a whole column.
    """
    cells = df.select([F.col(c).cast("double").alias(c) for c in columns]) \
        .unpivot([], list(columns), "column_name", "value").where(F.col("value").isNotNull())
    freq = cells.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    cumulative = running_total(freq, [F.col("value").asc()], F.col("n"), ["column_name"], "upto")
    totals = cumulative.groupBy("column_name").agg(F.max("upto").alias("total"))
    wanted = F.explode(F.array(*[F.lit(int(p)) for p in percents])).alias("pct")
    # position of the quantile among 0-based ranks: pct/100 * (total - 1)
    targets = totals.select(F.col("column_name").alias("_name"), wanted, "total") \
        .withColumn("lo", F.expr("pct * (total - 1) div 100")) \
        .withColumn("frac", F.expr("(pct * (total - 1) % 100) / 100.0D")) \
        .withColumn("hi", F.least(F.col("lo") + 1, F.col("total") - 1))

    def holds(rank: str):
        return (F.col("upto") > F.col(rank)) & (F.col("upto") - F.col("n") <= F.col(rank))

    # one row per column and percent
    hit = cumulative.join(F.broadcast(targets), F.col("column_name") == F.col("_name")) \
        .where(holds("lo") | holds("hi"))
    found = hit.groupBy("column_name", "pct").agg(
        F.max(F.when(holds("lo"), F.col("value"))).alias("a"),
        F.max(F.when(holds("hi"), F.col("value"))).alias("b"), F.max("frac").alias("frac"),
    ).select("column_name", "pct", (F.col("a") + (F.col("b") - F.col("a")) * F.col("frac")).alias("value"))
    return _names(df, columns).withColumn("pct", F.explode(F.array(*[F.lit(int(p)) for p in percents]))) \
        .join(found, ["column_name", "pct"], "left")


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values: counted before the shuffle, then top-n per task."""
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
            .agg(F.count("*").alias("n_rows"))
            .orderBy(F.col("n_rows").desc(), F.col("value")).limit(n))


def click_distribution(df: DataFrame) -> DataFrame:
    """Rows and share per click value."""
    counts = df.groupBy("click").agg(F.count("*").alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(0)))  # one row per click value
    return counts.select("click", "n_rows", (F.col("n_rows") / total).alias("share"))


def schema_drift(expected, actual) -> list[tuple[str, str, str | None, str | None]]:
    """Fields added, dropped or retyped between two schemas; names compare without case."""
    old = {f.name.lower(): f.dataType.simpleString() for f in expected.fields}
    new = {f.name.lower(): f.dataType.simpleString() for f in actual.fields}
    rows = [(n, "added", None, t) for n, t in new.items() if n not in old]
    rows += [(n, "dropped", t, None) for n, t in old.items() if n not in new]
    rows += [(n, "retyped", old[n], new[n]) for n in old if n in new and old[n] != new[n]]
    return sorted(rows)


def schema_drift_report(df: DataFrame, expected) -> DataFrame:
    """The drift of a table with the number of values each drifted field holds (0 for
    dropped ones), counted in one pass."""
    drift = schema_drift(expected, df.schema)
    entries = [F.struct(
        F.lit(field).alias("field"), F.lit(change).alias("change"),
        F.lit(old).cast("string").alias("expected_type"), F.lit(new).cast("string").alias("actual_type"),
        (F.lit(0).cast("bigint") if new is None else F.count(field)).alias("n_values"))
        for field, change, old, new in drift]
    if not entries:
        return df.sparkSession.createDataFrame(
            [], "field string, change string, expected_type string, actual_type string, n_values bigint")
    return df.agg(F.array(*entries).alias("drift")).select(F.inline("drift"))
