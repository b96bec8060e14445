"""Tables built from each other, with checks before each is published.

A model is built from its inputs into a stored candidate. Its checks run on the candidate; only when all hold does it
replace the published table. If one fails, the table stays as it was, and so do all models that need it. Models that don't need
each other are built side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from clickweir.operators.quality import Check, report
from clickweir.session import stored
from clickweir.sources.tables import materialize_table

STATUS = "model string, status string, failed_check string, failures long, n_rows long"


@dataclass(frozen=True)
class Model:
    """`build` gets its inputs, published tables or sources, by name."""
    name: str
    inputs: tuple[str, ...]
    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    checks: tuple[Check, ...] = ()
    partition_by: str | None = "event_date"


def _run(spark: SparkSession, model: Model, inputs: Mapping[str, DataFrame], path: str) -> tuple:
    candidate = stored(model.build(inputs), f"candidate-{model.name}")
    if model.checks:
        # the checks speak of the model by its name
        failed = report(list(model.checks), {**inputs, model.name: candidate}).where("failures > 0").orderBy("seq").first()
        if failed is not None:
            return (model.name, "failed", failed["test"], failed["failures"], None)
    materialize_table(candidate, path, model.partition_by)
    return (model.name, "done", None, None, candidate.count())


def run_models(spark: SparkSession, models: Sequence[Model], sources: Mapping[str, DataFrame], root: str, at_once: int = 4) -> DataFrame:
    """Build and publish under `root`; one status row per model: done, failed, or skipped for what it needs."""
    by_name = {m.name: m for m in models}
    order = TopologicalSorter({m.name: [i for i in m.inputs if i in by_name] for m in models})
    order.prepare()
    done: dict[str, tuple] = {}
    running = {}
    with ThreadPoolExecutor(at_once) as pool:
        while order.is_active():
            for name in order.get_ready():
                model = by_name[name]
                if any(i in by_name and done[i][1] != "done" for i in model.inputs):
                    done[name] = (name, "skipped", None, None, None)
                    order.done(name)
                    continue
                inputs = {i: sources[i] if i in sources else spark.read.parquet(f"{root}/{i}") for i in model.inputs}
                running[pool.submit(_run, spark, model, inputs, f"{root}/{name}")] = name
            if running:
                ended, _ = wait(running, return_when=FIRST_COMPLETED)
                for future in ended:
                    name = running.pop(future)
                    done[name] = future.result()
                    order.done(name)
    return spark.createDataFrame([done[m.name] for m in models], STATUS)
