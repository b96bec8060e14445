"""What the Python workers of this subpackage need: its code, small batches, and freed memory given back."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from inspect import signature

import pyarrow as pa
from pyspark.sql import SparkSession

# A batch is held by the JVM, on the way and by the worker; rows are whole texts of any length.
BATCH_CONF = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
              "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers of the application, once, and bound the bytes of an Arrow batch
    where the session doesn't say otherwise."""
    for key, value in BATCH_CONF.items():
        if not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, value)
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # only the driver reads this file; Spark serves it to the executors
    target = os.path.join(tempfile.mkdtemp(prefix="clickweir-"), "clickweir-code.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def give_back() -> None:
    """Return freed memory to the system; a reused worker would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def releasing(fn: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`fn` for mapInArrow, with memory given back when a task ends."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()
    return run


def frees(fn):
    """`fn` of a group, with memory given back behind each."""
    @wraps(fn)
    def run(*args):
        try:
            return fn(*args)
        finally:
            give_back()
    run.__signature__ = signature(fn)
    return run
