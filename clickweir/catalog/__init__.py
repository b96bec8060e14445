"""Registered queries, each with its SQL twin where SQL can say it."""

from clickweir.catalog import (exploration, faults, fields, ingest, marts, quality,  # noqa: F401
                               serving, streams, upkeep)
from clickweir.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
