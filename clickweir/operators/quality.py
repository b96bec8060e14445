"""Data-quality checks.

Every check has two forms: a frame of the offending rows, and a count inside a report.
A report evaluates all row-level checks of a table in one aggregate over one scan;
only uniqueness and relationship checks need their own grouping.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickweir.operators.joins import relationship_orphans


# --- offending rows ------------------------------------------------------------

def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with another value; NULL is left to `not_null`."""
    return df.where(~F.col(column).isin(*values))


def expression(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which the SQL condition does not hold."""
    return df.where(~F.coalesce(F.expr(condition), F.lit(False)))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Repeated keys with their number of rows."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values; NULLs do not repeat."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def relationships(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    return relationship_orphans(child, child_col, parent, parent_col)


# --- suites --------------------------------------------------------------------

@dataclass(frozen=True)
class RowCheck:
    """A row offends when `violation` is true."""
    name: str
    table: str
    violation: str


@dataclass(frozen=True)
class KeyCheck:
    """A key offends when it repeats."""
    name: str
    table: str
    columns: tuple[str, ...]
    skip_nulls: bool = False


Check = RowCheck | KeyCheck


def check_not_null(table: str, column: str) -> RowCheck:
    return RowCheck(f"not_null_{table}_{column}", table, f"{column} IS NULL")


def check_accepted(table: str, column: str, values: Sequence[int]) -> RowCheck:
    listed = ", ".join(str(v) for v in values)
    return RowCheck(f"accepted_values_{table}_{column}", table, f"{column} NOT IN ({listed})")


def check_expression(table: str, column: str, condition: str) -> RowCheck:
    return RowCheck(f"expression_{table}_{column}", table, f"NOT coalesce({condition}, false)")


def check_unique(table: str, column: str) -> KeyCheck:
    return KeyCheck(f"unique_{table}_{column}", table, (column,), skip_nulls=True)


def violations(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The offending rows (row checks) or keys (key checks) of one check."""
    df = tables[check.table]
    if isinstance(check, RowCheck):
        return df.where(F.expr(check.violation))
    if check.skip_nulls:
        df = df.dropna(subset=list(check.columns))
    return unique_combination(df, check.columns)


def _row_failures(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    entries = [F.struct(F.lit(c.name).alias("test"),
                        F.count_if(F.expr(c.violation)).alias("failures")) for c in checks]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def _key_failures(check: KeyCheck, tables: Mapping[str, DataFrame]) -> DataFrame:
    return violations(check, tables).agg(F.count("*").alias("failures")) \
        .select(F.lit(check.name).alias("test"), "failures")


def _failures(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """(test, failures) of checks; the row checks of a table share one pass."""
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        rows = [c for c in checks if c.table == table and isinstance(c, RowCheck)]
        if rows:
            parts.append(_row_failures(tables[table], rows))
    parts += [_key_failures(c, tables) for c in checks if isinstance(c, KeyCheck)]
    return reduce(DataFrame.unionByName, parts)


def report(checks: Sequence[Check], tables: Mapping[str, DataFrame],
           fail_fast: bool = False, count_skipped: bool = False) -> DataFrame:
    """(seq, test, failures, status) for a suite.

    With fail_fast, checks run table by table in their order, and nothing runs behind the first that fails: the checks
    behind it are 'skipped', without a number of failures. With count_skipped these are counted all the same, so the
    report says what a run that stopped would have left unseen.
    """
    if fail_fast and not count_skipped:
        return _report_until_failure(checks, tables)
    order = F.create_map(*[x for i, c in enumerate(checks) for x in (F.lit(c.name), F.lit(i + 1))])
    found = _failures(checks, tables).select(order[F.col("test")].alias("seq"), "test", "failures")
    status = F.when(F.col("failures") > 0, "fail").otherwise("pass")
    if fail_fast:
        one_per_check = Window.partitionBy(F.lit(0))
        first = F.min(F.when(F.col("failures") > 0, F.col("seq"))).over(one_per_check)
        status = F.when(F.col("seq") > F.coalesce(first, F.lit(len(checks))), "skipped").otherwise(status)
    return found.withColumn("status", status)


def _report_until_failure(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    rows, stopped = [], False
    for _, group in groupby(enumerate(checks, 1), key=lambda x: x[1].table):
        run = list(group)
        # one row per check
        failures = {} if stopped else {r["test"]: r["failures"] for r in _failures([c for _, c in run], tables).collect()}
        for seq, check in run:
            if stopped:
                rows.append((seq, check.name, None, "skipped"))
            else:
                stopped = failures[check.name] > 0
                rows.append((seq, check.name, failures[check.name], "fail" if stopped else "pass"))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "seq int, test string, failures long, status string")


def freshness_today(df: DataFrame, created_at: str, as_of) -> DataFrame:
    """Rows created on the day of `as_of`; the bare comparison reaches the scan."""
    start = F.date_trunc("day", F.lit(as_of).cast("timestamp")).cast("timestamp_ntz")
    return df.where(F.col(created_at) >= start).agg(F.count("*").alias("rows_today"))
