"""JSON payload columns and derived feature columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def event_to_json(columns: Sequence[str]) -> Column:
    """One JSON object per row; explicit nulls, non-ASCII text kept as is."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_field_default(payload: Column, path: str, default: str) -> Column:
    """Nested field of JSON text, or the default when absent or null."""
    return F.coalesce(F.get_json_object(payload, path), F.lit(default))


def audit_columns(names: Sequence[str] = ("created_at", "updated_at"),
                  now: Column | None = None) -> list[Column]:
    """Write-time stamps. Added only at the write edge, so queries stay repeatable."""
    now = F.current_timestamp() if now is None else now
    return [now.alias(name) for name in names]


def cross_feature(*columns: str, separator: str = "|") -> Column:
    """Joint value of several columns; NULL parts become empty text."""
    return F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                    for c in columns])


def cross_feature_hash(*columns: str, buckets: int) -> Column:
    """The joint value folded into a fixed number of buckets."""
    return F.pmod(F.xxhash64(cross_feature(*columns)), F.lit(buckets)).cast("int")
