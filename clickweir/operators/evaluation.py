"""Control over where computed columns are evaluated."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def evaluate_once(df: DataFrame) -> DataFrame:
    """The same rows behind a one-element inline.

    A filter on a computed column cannot move below it; moved, it would repeat all
    casts, once to test and once to return. It also starts a new method in the
    generated code, which keeps wide projections below the size the JVM compiles.
    """
    return df.select(F.inline(F.array(F.struct("*"))))
