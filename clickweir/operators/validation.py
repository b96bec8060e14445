"""Typing and validation of text rows, as one projection without a shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from clickweir.schema import (CLICK_VALUES, EVENT_COLUMNS, EVENT_TYPES, HOUR_BOUNDS,
                              RANGE_BOUNDS, STRING_COLUMNS)


def to_typed(name: str) -> Column:
    """One text field to its declared type, NULL when that fails.

    A plain integer is read as such. Other spellings go through a wide decimal, so
    '1e+2' and '3.9' give 100 and 3; a decimal, unlike a double, takes no 'NaN', 'inf'
    or '1d' for a number. The id keeps all its digits: as a double, neighbouring ids of
    this size would fall together.
    """
    text, kind = F.col(name), EVENT_TYPES[name]
    if kind == "string":
        return text
    if kind == "int":
        return F.coalesce(text.try_cast("int"), text.try_cast("decimal(38,18)").try_cast("int"))
    if kind.startswith("decimal"):    # an id with a fraction is no id; rounded it would be another
        exact = text.try_cast("decimal(38,18)")
        return F.when(exact == F.floor(exact), text.try_cast(kind))
    return text.try_cast(kind)


def transform_types(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Cast all 24 fields. `type_error` names the first field that has text but no
    value of its type, `missing_field` the first field that is absent.

    The casts sit in a projection of their own, so each is done once and the flags
    only look at its outcome.
    """
    numeric = [c for c in EVENT_COLUMNS if EVENT_TYPES[c] != "string"]
    cast = raw.select("*", *[to_typed(c).alias(f"_{c}") for c in numeric])
    bad = F.coalesce(*[F.when(F.col(c).isNotNull() & F.col(f"_{c}").isNull(), F.lit(c)) for c in numeric])
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in EVENT_COLUMNS])
    return cast.select(
        *[F.col(f"_{c}").alias(c) if c in numeric else F.col(c) for c in EVENT_COLUMNS], *keep,
        bad.alias("type_error"), missing.alias("missing_field"))


def all_present(columns: Sequence[str] = EVENT_COLUMNS) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def valid_click() -> Column:
    return F.coalesce(F.col("click").isin(*CLICK_VALUES), F.lit(False))


def valid_hour() -> Column:
    """Digit count only; codes that are no date fall out at staging."""
    return F.coalesce(F.col("hour").between(*HOUR_BOUNDS), F.lit(False))


def valid_range(column: str, bounds: tuple[int, int]) -> Column:
    return F.coalesce(F.col(column).between(*bounds), F.lit(False))


def rules(bounds: Mapping[str, tuple[int, int]] = RANGE_BOUNDS) -> dict[str, Column]:
    """Reason -> condition under which a typed row passes, in the order they are tried."""
    checks = {"type_error": F.col("type_error").isNull(),
              "missing_field": F.col("missing_field").isNull(),
              "invalid_click": valid_click(),
              "invalid_hour": valid_hour()}
    for column, limits in bounds.items():
        checks[f"invalid_{column}"] = valid_range(column, limits)
    return checks


def reject_reasons(typed: DataFrame, bounds: Mapping[str, tuple[int, int]] = RANGE_BOUNDS) -> DataFrame:
    """Add `reason`: the first rule a row fails, NULL for a valid row."""
    failed = [F.when(~passes, F.lit(reason)) for reason, passes in rules(bounds).items()]
    return typed.withColumn("reason", F.coalesce(*failed))


def warn_empty_strings(df: DataFrame) -> DataFrame:
    """Add `empty_fields`: text fields holding empty text. A warning, not a reject."""
    marks = F.array(*[F.when(F.col(c) == "", F.lit(c)) for c in STRING_COLUMNS])
    return df.withColumn("empty_fields", F.filter(marks, lambda x: x.isNotNull()))


def validate_types(raw: DataFrame) -> DataFrame:
    """Rows per field that fail their type, all fields in one pass."""
    names = [c for c in EVENT_COLUMNS if EVENT_TYPES[c] != "string"]
    one = raw.agg(*[F.count_if(F.col(c).isNotNull() & to_typed(c).isNull()).alias(c) for c in names])
    return one.unpivot([], names, "field", "type_errors")


